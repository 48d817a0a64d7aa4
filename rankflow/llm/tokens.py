"""Token-id output (operator 6): documents tokenised, Huffman-coded by global counts and
written in ascending doc_id order, in blocks that are decoded independently.

A store is a folder of two Parquet tables.  ``codes`` has a row (id, length) for each id
that occurs; lengths alone fix the canonical codes.  ``blocks`` has rows of some whole
documents each: part and seq (their order), doc_ids and doc_tokens (ids a document),
n_tokens, checkpoints (bit offset of every ``huffman.STRIDE``-th id, 32 bits each) and
payload (the bits).  Blocks of a part follow each other by seq, parts by their number.
"""

from __future__ import annotations

import gc
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.llm import huffman
from rankflow.llm.common import offsets, release_memory, steps
from rankflow.session import materialize, scratch_path

#: A special token that stands between words encoded in one call; a word that holds it goes alone.
BETWEEN = "<|startoftext|>"
#: Words whose ids a worker remembers (some 150 bytes each), and bytes of text that become words at once.
CACHE_WORDS, BATCH_BYTES = 300_000, 12_000_000


@dataclass(frozen=True)
class TokenSpec:
    """``end_id`` closes each document; ``block_tokens``: a block is closed at so many ids (a longer
    document is a block of its own)."""

    tokenizer: str = "word_bpe_49k.json"
    end_id: int = 2
    block_tokens: int = 1 << 17


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Latin letters, then ASCII punctuation but no apostrophe, which may belong to the letters.
_LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


def _byte_characters() -> dict[int, str]:
    """Letters à to ÿ (and ß) as byte-level vocabularies write their UTF-8 bytes: printable bytes of
    Latin-1 as themselves, the others as the characters from U+0100 on, in their order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


_AS_BYTES = _byte_characters()


class WordTokenizer:
    """Ids of whole texts, made word by word.

    The tokenizer drops white space and never looks across it, so a text's ids are those of
    its blank-separated words in turn; each distinct word is encoded once.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(BETWEEN)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}

        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.ends = np.zeros(self.size, bool)  # ids that end a word
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith(self.tokenizer.model.end_of_word_suffix or " ")

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word as the tokenizer makes them."""
        plain = [w for w in words if "<|" not in w] if self.between is not None else []
        found: dict[str, bytes] = {}
        for at in range(0, len(plain), 1000):
            group = plain[at:at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([BETWEEN.join(group)], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(ids == self.between)
            data, edge = ids.astype(self.kind), np.concatenate([[-1], cuts, [len(ids)]])
            for k, w in enumerate(group):
                found[w] = data[edge[k] + 1:edge[k + 1]].tobytes()
        return [found[w] if w in found else np.array(
            self.tokenizer.encode(w, add_special_tokens=False).ids, self.kind).tobytes() for w in words]

    def _ids_of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of Latin letters: one piece for the tokenizer's regular expressions,
        which its normaliser leaves as it is, so its model alone makes the ids."""
        out = []
        for at in range(0, len(words), 1000):
            group = words[at:at + 1000]
            text = " ".join(w if w.isascii() else w.translate(_AS_BYTES) for w in group)
            ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            cuts, data = (np.flatnonzero(self.ends[ids]) + 1).tolist(), ids.astype(self.kind)
            if len(cuts) != len(group):  # a vocabulary without some byte
                out += self._ids(group)
                continue
            out += [data[a:b].tobytes() for a, b in zip([0, *cuts], cuts)]
        return out

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words.  Latin letters with punctuation behind them are two pieces for
        the tokenizer: the letters in lower case, and the punctuation."""
        known, whole, letters, tails, rest = self.known, [], [], [], []
        for w in words:
            if m := _LETTERS(w):
                whole.append(w)
                letters.append(m[1].lower())
                tails.append(m[2])
            else:
                rest.append(w)
        simple = [x for x in set(letters) if x not in known]
        made = dict(zip(simple, self._ids_of_letters(simple)))
        rest += set(tails)
        made.update(zip(rest, self._ids(rest)))
        heads = [made[x] if x in made else known[x] for x in letters]
        made.update((w, h + made[t] if t else h) for w, h, t in zip(whole, heads, tails))
        return made

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, each closed by ``end_id``, and the ids of each text."""
        lists = pc.ascii_split_whitespace(texts)
        cuts = offsets_of_lists(lists)
        flat = lists.flatten().dictionary_encode()
        words = flat.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        made = self._encode(new)
        which = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        del lists, flat  # each part is let go once the next is made
        if len(self.known) < CACHE_WORDS:  # a word met twice is likely to come again
            often = np.bincount(which, minlength=len(words)) > 1
            self.known.update((w, made[w]) for w, again in zip(words, often.tolist()) if again and w in made)
        blobs = [self.known[w] if w in self.known else made[w] for w in words]
        width = np.dtype(self.kind).itemsize
        size = np.array([len(b) // width for b in blobs], np.int64)
        pool = np.concatenate([np.frombuffer(b"".join(blobs), self.kind), np.array([end_id], self.kind)])
        base = np.cumsum(size) - size
        del words, new, made, blobs
        # the end id is one more word, behind the last word of each text
        which = np.insert(which, cuts[1:], len(size))
        size, base = np.append(size, 1), np.append(base, len(pool) - 1)
        per_word = size[which]
        before = np.cumsum(per_word) - per_word
        out = np.empty(int(per_word.sum()), self.kind)
        for a in range(0, len(which), 1 << 19):
            n, b = per_word[a:a + (1 << 19)], base[which[a:a + (1 << 19)]]
            first = int(before[a])
            cell = np.arange(int(n.sum()))
            out[first:first + len(cell)] = pool[np.repeat(b - (np.cumsum(n) - n), n) + cell]
        ends = np.concatenate([before, [len(out)]])
        edge = cuts + np.arange(len(cuts))
        return out, np.diff(ends[edge])


def offsets_of_lists(lists: pa.ListArray) -> np.ndarray:
    off = np.asarray(lists.offsets, np.int64)
    return off - off[0]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One for each worker process: its words stay known over batches."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenized(docs: DataFrame, spec: TokenSpec = TokenSpec()) -> DataFrame:
    """Per row: doc_id and ids (little-endian, 2 bytes each where the vocabulary allows, else 4)."""
    path, end_id = tokenizer_path(spec.tokenizer), spec.end_id

    def run(batches):
        release_memory()
        words = _tokenizer(path)
        for batch in batches:
            for part in steps(batch, 1, BATCH_BYTES):
                gc.disable()  # millions of small strings and no cycles: collections would only walk them
                try:
                    ids, per = words.encode(part.column(1), end_id)
                finally:
                    gc.enable()
                width = ids.dtype.itemsize
                off = pa.py_buffer(np.concatenate([[0], np.cumsum(per) * width]).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.Array.from_buffers(pa.binary(), part.num_rows, [None, off, pa.py_buffer(ids)])],
                    names=["doc_id", "ids"])
                del ids, off
                release_memory()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def id_counts(tokens: DataFrame, width: type, size: int) -> np.ndarray:
    """Global count of each id: a vector a task, added up by id (at most ``size`` rows reach the driver)."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            arr = batch.column(0)
            off = offsets(arr)
            if off[-1] > off[0]:
                total += np.bincount(np.frombuffer(arr.buffers()[2], np.uint8)[off[0]:off[-1]].view(width), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    counts = np.zeros(size, np.int64)
    for row in tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def _blocks_schema(doc_id: T.DataType) -> str:
    return (f"part int, seq int, doc_ids array<{doc_id.simpleString()}>, doc_tokens array<int>, n_tokens long, "
            "checkpoints binary, payload binary")


def write_tokens(docs: DataFrame, path: str, spec: TokenSpec = TokenSpec()) -> None:
    """Write the store of ``docs`` at ``path`` (a new folder).

    All rows are written, null and empty texts as the end id alone; rows without a doc_id
    come first, rows of one doc_id stay together in the order of their ids.  An empty table
    gives an empty store.
    """
    spark = docs.sparkSession
    words = _tokenizer(tokenizer_path(spec.tokenizer))
    width, size = words.kind, max(words.size, spec.end_id + 1)
    tokens = materialize(tokenized(docs, spec), "token-ids")
    lengths = huffman.code_lengths(id_counts(tokens, width, size))
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": pa.array(used, pa.int64()), "length": pa.array(lengths[used], pa.int16())})).coalesce(1).write.parquet(f"{path}/codes")
    shared, limit = spark.sparkContext.broadcast((lengths, huffman.canonical(lengths))), spec.block_tokens

    def run(batches):
        from pyspark import TaskContext

        own_lengths, codes = shared.value
        part, seq, names, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def block():
            flat = np.concatenate(ids)
            payload, marks, _ = huffman.encode(flat, own_lengths, codes)
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "doc_ids": list(names), "doc_tokens": [len(x) for x in ids], "n_tokens": len(flat),
                "checkpoints": marks.astype("<u4").tobytes(), "payload": payload}], schema=schema)

        for batch in batches:
            schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(batch.schema.field(0).type)), ("doc_tokens", pa.list_(pa.int32())),
                                ("n_tokens", pa.int64()), ("checkpoints", pa.binary()), ("payload", pa.binary())])
            for name, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                names.append(name)
                ids.append(np.frombuffer(blob.as_py(), width))
                held += len(ids[-1])
                if held >= limit:
                    yield block()
                    seq, names, ids, held = seq + 1, [], [], 0
        if names:
            yield block()

    n = spark.conf.get("spark.sql.shuffle.partitions")
    ordered = tokens.repartitionByRange(int(n), "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(run, _blocks_schema(docs.schema["doc_id"].dataType)).write.parquet(f"{path}/blocks")


def _decoded(batch_row: dict, table) -> list[np.ndarray]:
    flat = huffman.decode(batch_row["payload"], np.frombuffer(batch_row["checkpoints"], "<u4"), batch_row["n_tokens"], table)
    cuts = np.cumsum(batch_row["doc_tokens"])[:-1]
    return np.split(flat, cuts)


def _code_table(spark: SparkSession, path: str):
    rows = spark.read.parquet(f"{path}/codes").toArrow()  # a row for each id of the vocabulary at most
    lengths = np.zeros(int(pc.max(rows["id"]).as_py() or 0) + 1 if rows.num_rows else 1, np.uint8)
    lengths[rows["id"].to_numpy()] = rows["length"].to_numpy()
    return lengths


def _read(spark: SparkSession, path: str, make, extra: str):
    """Rows ``(part, seq, pos, doc_id, *make(ids))`` for every document of a store."""
    shared = spark.sparkContext.broadcast(_code_table(spark, path))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType

    def run(batches):
        table = huffman.decode_table(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                found = _decoded(row, table)
                n = len(found)
                cols = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), pa.array(range(n), pa.int32()),
                        pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type), *make(found)]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "seq", "pos", "doc_id", *[x.split()[0] for x in extra.split(", ")]])

    return blocks.mapInArrow(run, f"part int, seq int, pos int, doc_id {kind.simpleString()}, {extra}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store: part, seq, pos, doc_id, ids (array<int>)."""
    return _read(spark, path, lambda found: [pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))], "ids array<int>")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store, from its files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    docs = _read(spark, path, lambda found: [
        pa.array([len(x) for x in found], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())],
        "n_tokens long, ids_crc32 long")
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "seq", "n_tokens", "doc_tokens")
    from pyspark.sql import Window

    # Ids before each block: sums over parts (a row each), then over the blocks of a part, then
    # over the documents of a block; no window holds more than one of these.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    inside = blocks.select("part", "seq", (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")).alias("before"))
    starts = inside.join(parts, "part").select("part", "seq", (F.col("before") + F.col("before_part")).alias("before"))
    own = Window.partitionBy("part", "seq").orderBy("pos")
    return docs.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.sum("n_tokens").over(own) - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")


def store_path(spark: SparkSession) -> str:
    """A new place for a store in the shared folder."""
    return scratch_path(spark, "token-store")
