"""Delimited files read by many tasks even where quoted fields hold newlines (s01, s02).

A split of a file may begin inside a quoted field, so a task alone can't tell where records
begin.  Quotes come in pairs (a quote inside a field is doubled), so they can be counted:

1. One scan counts the quotes of each split and takes each file's first line, its header.
2. The running parity of the splits before it says whether a split begins inside a field.
   (One number a split and one header a file come to the driver, which lists the splits anyway.)
3. A second scan follows the parity from line to line: a record begins at each line whose
   parity is even.  Records are parsed and their fields named by their own file's header.
4. What a split holds of records that cross its ends is put together by file and parsed.  If no
   split begins inside a field, nothing is left for this step and it is not run.

Fields without quotes and without text are NULL, empty quoted ones are empty texts.  A record
with too few fields has NULLs, further ones are left out.  Blank lines are skipped; a carriage
return in a record without quotes is a blank.  A file
whose first line doesn't name the key column is an error, and so are splits that differ
between the scans.  A field whose quotes don't end goes on to the end of its file.
"""

from __future__ import annotations

import csv
import itertools
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankflow.session import materialize

ROWS = 10_000


#: What decides where files are split.
SPLIT_SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


def _lines(spark: SparkSession, paths: str | Sequence[str], glob: str, only: Callable[[Column], Column] | None = None) -> DataFrame:
    """Lines in file order within each split; ``file`` names the file, ``id`` and ``start`` the split.
    ``only``: a condition on the name of a file, which is judged when files are listed.

    Files are listed and split through a session of their own whose settings are held, so that
    all scans have the same splits even when executors come and go between them.
    """
    reader = spark.newSession()
    for key in SPLIT_SETTINGS:
        reader.conf.set(key, spark.conf.get(key))
    reader.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    read = reader.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n").text(paths)
    if only is not None:
        read = read.where(only(F.col("_metadata.file_name")))  # other files are never opened
    lines = read.select("value", F.col("_metadata.file_path").alias("path"), F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("file"),
                        F.xxhash64("_metadata.file_path").alias("id"), F.col("_metadata.file_block_start").alias("start"))
    return spark.createDataFrame([], lines.schema).unionByName(lines)  # all else follows the caller's session


def _splits(lines: DataFrame) -> DataFrame:
    """``path, file, id, start, odd, head``: each split's parity of quotes, and the first line of those that
    begin a file."""
    counted = lines.select("path", "file", "id", "start", "value", F.monotonically_increasing_id().alias("at"),
                           (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    return materialize(counted.groupBy("path", "file", "id", "start").agg(
        (F.sum("quotes") % 2).cast("int").alias("odd"),
        F.min_by(F.when(F.col("start") == 0, F.col("value")), "at").alias("head")), "splits")


class _Layout:
    """Which splits begin or end inside a field, and each file's header."""

    def __init__(self, splits: pa.Table, heads: dict[int, list[str]], header_of: tuple[np.ndarray, np.ndarray]) -> None:
        order = np.lexsort((splits["start"].to_numpy(), splits["id"].to_numpy()))
        self.id, self.start = splits["id"].to_numpy()[order], splits["start"].to_numpy()[order]
        odd = splits["odd"].to_numpy()[order].astype(np.int64)
        first = np.ones(len(odd), bool)
        first[1:] = self.id[1:] != self.id[:-1]
        before = np.cumsum(odd) - odd
        self.begins = (before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(odd))))) % 2
        self.ends = (self.begins + odd) % 2
        self.heads, self.header_of = heads, header_of

    def split(self, file: int, start: int) -> int:
        low, high = np.searchsorted(self.id, file, "left"), np.searchsorted(self.id, file, "right")
        at = low + int(np.searchsorted(self.start[low:high], start))
        if at >= high or self.start[at] != start:
            raise RuntimeError("a file's splits differ between two scans")
        return at

    def names(self, file: int) -> list[str]:
        ids, header = self.header_of
        return self.heads[int(header[np.searchsorted(ids, file)])]


def _header(line: str | None, sep: str) -> list[str]:
    found = next(csv.reader([(line or "").lstrip("﻿").rstrip("\r")], delimiter=sep), [])
    return [name.strip().lower() for name in found]


def _layout(splits: DataFrame, sep: str, key: str) -> _Layout:
    texts = [r["head"] for r in splits.where("start = 0").select("head").distinct().collect()]  # kinds of header
    heads = {i: _header(t, sep) for i, t in enumerate(texts)}
    without = [t for i, t in enumerate(texts) if key.lower() not in heads[i] or len(heads[i]) > 1 and len(set(heads[i]) - {""}) < 2]
    if without:
        wrong = splits.where((F.col("start") == 0) & F.coalesce(F.col("head").isin([t for t in without if t is not None]), F.lit(True))).select("path").first()[0]
        raise ValueError(f"no header row naming {key} in {wrong}")
    kind = {t: i for i, t in enumerate(texts)}
    files = splits.where("start = 0").select("id", "head").toArrow()  # one row a file
    ids = files["id"].to_numpy()
    order = np.argsort(ids)
    header = np.array([kind[t] for t in files["head"].to_pylist()], np.int64)
    return _Layout(splits.select("id", "start", "odd").toArrow(), heads, (ids[order], header[order]))  # one row a split


def _named(records: Iterable[str], names: list[str], columns: Sequence[str], sep: str) -> list[list[str | None]]:
    """Fields of records by column (lower-case names)."""
    place = [names.index(c.lower()) if c.lower() in names else -1 for c in columns]
    out: list[list[str | None]] = [[] for _ in columns]
    csv.field_size_limit(1 << 30)
    for row in _parsed(list(records), sep):
        if not row or row == [None]:
            continue
        for values, at in zip(out, place):
            values.append(row[at] if 0 <= at < len(row) else None)
    return out


def _parsed(records: list[str], sep: str) -> Iterable[list[str | None]]:
    try:
        return list(csv.reader(records, delimiter=sep, quoting=csv.QUOTE_NOTNULL))
    except csv.Error:  # a carriage return outside quotes
        return [row for r in records for row in csv.reader([r if '"' in r else r.replace("\r", " ")], delimiter=sep, quoting=csv.QUOTE_NOTNULL)]


class _Split:
    """One split's lines: whole records, and what it holds of others (part 0: of a record that began
    before the split, 1: of one that goes on after it)."""

    def __init__(self, layout: _Layout, file: int, start: int) -> None:
        self.file, self.start, self.names = file, start, layout.names(file)
        self.odd = bool(layout.begins[layout.split(file, start)])
        self.part = 0 if self.odd else 1
        self.header = start == 0
        self.open: list[str] = []
        self.fragments: list[tuple[int, str]] = []

    def take(self, lines: list[str], odd: list[bool]) -> list[str]:
        """The records that end in these lines and began in the split."""
        if not (self.open or self.odd or self.header or self.part == 0) and True not in odd:
            return [line.removesuffix("\r") for line in lines]
        whole = []
        for line, turns in zip(lines, odd):
            self.open.append(line)
            if turns:
                self.odd = not self.odd
            if self.odd:
                continue
            record = "\n".join(self.open).removesuffix("\r")
            if self.part == 0:
                self.fragments.append((0, record))
            elif self.header:
                self.header = False
            else:
                whole.append(record)
            self.open, self.part = [], 1
        return whole

    def end(self) -> list[tuple[int, str]]:
        if self.open:
            self.fragments.append((self.part, "\n".join(self.open)))
        return self.fragments


def _split_lines(batches, layout: _Layout):
    """(split, lines, whether their quotes are odd, file name) in file order; the split alone at its end."""
    split = None
    for batch in batches:
        odd = pc.count_substring(batch.column(0), '"').to_numpy() % 2 == 1
        ids, at = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        cut = np.flatnonzero((ids[1:] != ids[:-1]) | (at[1:] != at[:-1])) + 1
        for low, high in itertools.pairwise([0, *cut.tolist(), len(ids)] if len(ids) else []):
            if split is None or (split.file, split.start) != (ids[low], at[low]):
                if split is not None:
                    yield split, None, None, None
                split = _Split(layout, int(ids[low]), int(at[low]))
            yield split, batch.column(0).slice(low, high - low).to_pylist(), odd[low:high].tolist(), batch.column(1)[low].as_py()
    if split is not None:
        yield split, None, None, None


def _plain_fields(records: list[str], names: list[str], columns: Sequence[str], sep: str) -> list[pa.Array] | None:
    """Fields by column, cut by Arrow; None unless the records are plain lines with a field a name."""
    text = "\n".join(records)
    if len(names) < 2 or len(sep) != 1 or any(c in text for c in '"\r\0\ufeff') or text.count("\n") != len(records) - 1:
        return None
    raw = text.encode()
    if not raw.strip(b"\n"):
        return [pa.array([], pa.string())] * len(columns)
    at = [str(i) for i in range(len(names))]
    try:
        table = pacsv.read_csv(pa.BufferReader(raw), pacsv.ReadOptions(use_threads=False, block_size=len(raw) + 1, column_names=at),
                               pacsv.ParseOptions(delimiter=sep, quote_char=False, double_quote=False, escape_char=False),
                               pacsv.ConvertOptions(column_types=dict.fromkeys(at, pa.string()), null_values=[""], strings_can_be_null=True))
    except pa.ArrowInvalid:  # fields too few or too many
        return None
    none = pa.nulls(table.num_rows, pa.string())
    low = [c.lower() for c in columns]
    return [table.column(names.index(c)).combine_chunks() if c in names else none for c in low]


def _named_batches(records: list[str], file: str | None, names: list[str], columns: Sequence[str], sep: str):
    if not records:
        return
    fields = _plain_fields(records, names, columns, sep)
    if fields is None:
        fields = [pa.array(v, pa.large_string()) for v in _named(records, names, columns, sep)]
    n = len(fields[0])
    for at in range(0, n, ROWS):
        part = [v.slice(at, ROWS).cast(pa.string()) for v in fields]
        yield pa.RecordBatch.from_arrays([pa.array([file] * len(part[0]), pa.string()), *part], names=["_file", *columns])


def read_records(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], key: str = "productId", sep: str = ",", glob: str = "*.csv",
                 only: Callable[[Column], Column] | None = None) -> DataFrame:
    """``_file`` (name of the record's file) and the named columns as texts, of every file below the
    paths; files may name their columns in any order and case.  ``only`` is a condition on file
    names (as the file system gives them): other files aren't opened."""
    lines = _lines(spark, paths, glob, only)
    splits = _splits(lines)
    layout = _layout(splits, sep, key)
    shared = spark.sparkContext.broadcast(layout)  # one entry a split and a file, as in the driver's own list of them
    schema = ", ".join(["_file string", *(f"`{c}` string" for c in columns)])

    def records(batches):
        for split, texts, odd, file in _split_lines(batches, shared.value):
            if texts is not None:
                yield from _named_batches(split.take(texts, odd), file, split.names, columns, sep)

    def fragments(batches):
        for split, texts, odd, _ in _split_lines(batches, shared.value):
            if texts is not None:
                split.take(texts, odd)
                continue
            for part, text in split.end():
                yield pa.RecordBatch.from_arrays([pa.array([split.file]), pa.array([split.start]), pa.array([part], pa.int32()), pa.array([text])],
                                                 names=["id", "start", "part", "text"])

    def joined(batches):
        for batch in batches:
            for file, of, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                yield from _named_batches([text.removesuffix("\r")], file, shared.value.names(of), columns, sep)

    taken = lines.select("value", "file", "id", "start")
    whole = taken.mapInArrow(records, schema)
    if not (layout.begins.any() or layout.ends.any()):
        return whole
    ends = taken.mapInArrow(fragments, "id long, start long, part int, text string")
    order = Window.partitionBy("id").orderBy("start", "part")
    parts = ends.withColumn("record", F.sum("part").over(order)).groupBy("id", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "part", "text"))), lambda t: t["text"]), "\n").alias("text"))
    names = splits.where("start = 0").select("id", "file")
    return whole.unionByName(parts.join(names, "id").select("file", "id", "text").mapInArrow(joined, schema))
