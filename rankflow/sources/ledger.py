"""Atomic, repeatable deliveries into a stored table (s09, s10, s11, t01).

A table is a folder of attempts and a ledger.  A batch is written to an attempt of its own,
which no reader sees; then one small manifest, named by the batch id, is moved into the ledger.
The move is the commit.  Readers open the attempts that the ledger names, so a killed batch
shows nothing, a repeated one is found committed and writes nothing, and a reader that runs
beside a writer sees a batch whole or not at all.

    <table>/attempts/<batch>-<random>/   Parquet files of one attempt
    <table>/ledger/<batch>.json          {"batch", "attempt", "rows", "replaces"}

With ``keys`` a batch keeps one row per key (the least, in the order of the other columns) and
only rows whose keys no committed batch holds; null equals null.  One writer commits at a time;
two that deliver the same batch id leave one manifest.  Attempts without a manifest are removed
by ``remove_orphans``, which must not run beside a writer.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.aggregates import one_per_key
from rankflow.operators.relational import without_keys
from rankflow.session import materialize


class BatchLedger:
    """A table of committed batches at ``path`` (any Hadoop file system)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None) -> None:
        """``schema`` serves an empty table; batches must agree with it by name."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- reading ----------------------------------------------------------------

    def manifests(self) -> list[dict]:
        """Committed batches, in the order of their ids (one small file each)."""
        fs, folder = self._at("ledger")
        if not fs.exists(folder):
            return []
        found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
        if not found:
            return []
        rows = self.spark.read.schema("batch string, attempt string, rows long, replaces array<string>").json([p.toString() for p in found]).collect()
        return sorted((r.asDict() for r in rows), key=lambda m: m["batch"])

    def committed(self, batch: str) -> bool:
        fs, at = self._at("ledger", f"{self._name(batch)}.json")
        return bool(fs.exists(at))

    def read(self) -> DataFrame:
        """The rows of all committed batches that no later one replaces."""
        whole = self.manifests()
        gone = {b for m in whole for b in m["replaces"] or ()}
        live = [f"{self.path}/attempts/{m['attempt']}" for m in whole if m["batch"] not in gone and m["rows"]]
        if live:
            reader = self.spark.read.option("mergeSchema", True) if self.schema is None else self.spark.read.schema(self.schema)
            return reader.parquet(*live)
        if self.schema is None:
            raise ValueError(f"{self.path} holds no rows and no schema was given")
        return self.spark.createDataFrame([], self.schema)

    # -- writing ----------------------------------------------------------------

    def deliver(self, batch: str, rows: DataFrame, keys: Sequence[str] | None = None, range_col: str | None = None,
                replaces: Sequence[str] = ()) -> bool:
        """Commits ``rows`` as ``batch``; False if that batch was committed before.

        ``range_col``: stored rows are looked at only within the batch's range of this column (and
        where it is null), for tables whose keys include it.  ``replaces``: batches that readers
        no longer see from this commit on (a corrected delivery).
        """
        if self.committed(batch):
            return False
        if keys:
            rows = materialize(one_per_key(rows, keys), "delivery")  # the batch is fixed before it is compared
            stored = self._stored(set(replaces))
            if stored is not None:
                if range_col is not None:
                    low, high = rows.agg(F.min(range_col), F.max(range_col)).first()
                    stored = stored.where(F.col(range_col).isNull() | F.col(range_col).between(low, high))
                rows = without_keys(rows, stored, keys)
        attempt = f"{self._name(batch)}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.path}/attempts/{attempt}")
        count = self.spark.read.parquet(f"{self.path}/attempts/{attempt}").count()
        return self._commit({"batch": batch, "attempt": attempt, "rows": count, "replaces": list(replaces)})

    def _stored(self, without: set[str]) -> DataFrame | None:
        live = [m for m in self.manifests() if m["rows"]]
        gone = {b for m in live for b in m["replaces"] or ()} | without
        paths = [f"{self.path}/attempts/{m['attempt']}" for m in live if m["batch"] not in gone]
        return self.spark.read.parquet(*paths) if paths else None

    def _commit(self, manifest: dict) -> bool:
        fs, final = self._at("ledger", f"{self._name(manifest['batch'])}.json")
        _, draft = self._at("drafts", f"{manifest['attempt']}.json")
        fs.mkdirs(final.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        try:  # fails if the manifest is there
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(
                draft, final, self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception:
            if fs.exists(final):
                fs.delete(draft, False)
                return False
            raise
        return True

    def remove_orphans(self) -> int:
        """Removes attempts that were never committed; their number."""
        fs, folder = self._at("attempts")
        if not fs.exists(folder):
            return 0
        known = {m["attempt"] for m in self.manifests()}
        lost = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in known]
        for path in lost:
            fs.delete(path, True)
        return len(lost)

    def _at(self, *names: str):
        path = self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return path.getFileSystem(self._conf), path

    @staticmethod
    def _name(batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.=-]+", batch):
            raise ValueError(f"a batch id may hold letters, digits and _.=- only: {batch!r}")
        return batch


def deliver_stream(ledger: BatchLedger, name: str, batch: DataFrame, batch_id: int, keys: Sequence[str] | None, range_col: str | None) -> None:
    """One micro-batch of the stream ``name``: a retry of it finds it committed."""
    ledger.deliver(f"{name}-{batch_id:012d}", batch, keys, range_col)
