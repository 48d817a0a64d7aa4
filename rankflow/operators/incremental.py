"""Aggregates kept up to date by deliveries (a04-a06, c01).

Each delivery is reduced to its own partial aggregate and committed to a ledger as one batch, so
only the delivery is read, a repeated one counts once and readers never see half of it.  The
aggregate of all deliveries is the merge of the stored partials, which are as many rows a batch as
it has keys; ``compact`` replaces the batches so far by their merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.sources.ledger import BatchLedger


@dataclass(frozen=True)
class Measure:
    """``kind``: count (of rows, or of non-null values of ``col``), sum, min, max, or max_below (the largest
    value under ``bound``, a04)."""

    name: str
    kind: str
    col: str | None = None
    bound: float = 1.0

    def partial(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1) if self.col is None else F.col(self.col)).alias(self.name)
        c = F.col(self.col)
        found = {"sum": F.sum, "min": F.min, "max": F.max, "max_below": lambda x: F.max(F.when(x < self.bound, x))}[self.kind](c)
        return found.alias(self.name)

    def merged(self) -> Column:
        c = F.col(self.name)
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "max_below": F.max}[self.kind](c).alias(self.name)


class KeptAggregate:
    """The aggregate by ``keys`` (null is a key) over all batches delivered to ``ledger``."""

    def __init__(self, ledger: BatchLedger, keys: Sequence[str], measures: Sequence[Measure]) -> None:
        self.ledger, self.keys, self.measures = ledger, list(keys), list(measures)

    def deliver(self, batch: str, rows: DataFrame) -> bool:
        """Adds the rows as one batch; False if the batch was delivered before."""
        if self.ledger.committed(batch):
            return False
        return self.ledger.deliver(batch, rows.groupBy(*self.keys).agg(*[m.partial() for m in self.measures]))

    def read(self) -> DataFrame:
        return self.ledger.read().groupBy(*self.keys).agg(*[m.merged() for m in self.measures])

    def compact(self, batch: str) -> bool:
        """Replaces all batches by one of their merge, under an id of its own; ids replaced stay delivered."""
        return self.ledger.deliver(batch, self.read(), replaces=[m["batch"] for m in self.ledger.manifests()])
