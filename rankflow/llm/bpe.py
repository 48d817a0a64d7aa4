"""Byte-level BPE (operator 12): ranked merges of distinct words, many at once.

1. Texts are split by the vocabulary's pattern; each match (a word) is encoded by itself.
2. Words are counted, and the most frequent ones become a dictionary of bounded size:
   word -> ids, computed once; its rarer part by 128-bit hashes of the words in place of the
   words.  Words that it lacks are encoded in their rows, each once a text.
3. Many words are encoded at once (``Merges``): their bytes' ids stand one after the other in an
   array, and a step joins in each word the leftmost pair of least rank.
4. In long words a step joins the pair wherever it stands.
5. Decoding looks up each id's piece and concatenates the pieces' bytes.

Joining one pair everywhere equals joining the leftmost pair again and again as long as the
merges that build a token rise in rank (``merges_rise``, tested for the public vocabulary):
then no join makes a pair of lower rank, and each token is joined from one split alone.

A null text counts as empty: no ids.  Rows are encoded one by one, so repeated rows and null
or repeated ids are kept as they are; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import release_memory, steps, text_bytes
from rankflow.session import materialize

#: The rank of a pair that the vocabulary lacks.
NONE = np.iinfo(np.int32).max


#: White space, and a coarser split that keeps it as the patterns of rank files do: runs of other
#: characters with a blank before them, and what white space is left.  Words never cross its parts.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
COARSE = f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
#: Signs that are one word together when they end a part.
SIGNS = ".,!?;:)\"%&*#$"


@dataclass(frozen=True)
class EncodeSpec:
    """The dictionary holds at most ``words`` words of at most ``word_bytes`` bytes as such, and
    ``hashed`` rarer ones by their hashes.  A task counts about ``counted`` distinct parts of texts
    before it hands them on, and remembers the ids of ``held`` parts of several words.  In words
    above ``short`` bytes a pair is joined wherever it stands."""

    words: int = 1 << 17
    hashed: int = 1 << 21
    word_bytes: int = 64
    counted: int = 200_000
    held: int = 50_000
    short: int = 64


class Vocabulary:
    """Ranks of byte strings (the rank is the id) and the pattern that splits texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, coarse: str | None = COARSE) -> None:
        """``coarse``: a quicker split whose parts hold whole matches of ``pattern``; None if there is none."""
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the ranks lack the single bytes {missing[:5]}")
        if len(set(ranks.values())) < len(ranks):
            raise ValueError("two byte strings have the same rank")
        self.ranks, self.pattern, self.coarse = ranks, pattern, coarse

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        """A rank file: base64 of the bytes and the rank, one token a line.  The driver reads it."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merges_rise(self) -> bool:
        """Whether every token's own merges end in the token itself and rise in rank."""
        for token, own in self.ranks.items():
            parts, last = [token[i:i + 1] for i in range(len(token))], -1
            while len(parts) > 1:
                found = min(((self.ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
                if found[0] is math.inf or found[0] < last:
                    return False
                last, i = found
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            if self.ranks[parts[0]] != own:
                return False
        return True

    def pieces(self) -> list[bytes | None]:
        """Pieces by id; an id without a piece is null."""
        out: list[bytes | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out


class Merges:
    """The pairs of ids whose bytes together are a token, in ascending order, and that token's id."""

    def __init__(self, vocabulary: Vocabulary, short: int = EncodeSpec.short) -> None:
        self.ranks, self.short = vocabulary.ranks, short
        found = []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, rank))
        found.sort()
        self.pairs = np.array([p for p, _ in found] + [np.iinfo(np.int64).max], np.int64)
        self.joined = np.array([r for _, r in found] + [NONE], np.int32)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.first = self._rank(np.repeat(self.single, 256), np.tile(self.single, 256))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.joined[at], NONE)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids, and where each word's ids start (and the last one's end).  Each string is
        taken as one word; an empty word has none."""
        raw = [w.encode() for w in words]
        whole = np.array([self.ranks.get(w, -1) for w in raw], np.int64)
        size = np.array([len(w) for w in raw], np.int64)
        size[whole >= 0] = 0
        known, (ids, word) = np.flatnonzero(whole >= 0), self._merged(b"".join(itertools.compress(raw, size)), size)
        ids, word = np.concatenate([whole[known].astype(np.int32), ids]), np.concatenate([known, word])
        return ids[np.argsort(word, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(raw)))])

    def _merged(self, raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of these bytes and sizes, and each id's word; a word's ids are in order."""
        data, word, long = np.frombuffer(raw, np.uint8), np.repeat(np.arange(len(size)), size), size > self.short
        ids, done = self.single[data], [(np.zeros(0, np.int32), np.zeros(0, np.int64))]
        rank = np.full(len(ids), NONE, np.int32)  # of the pair of an id and the next one of its word
        rank[:-1] = np.where(word[1:] == word[:-1], self.first[data[:-1].astype(np.int64) * 256 + data[1:]], NONE)
        while len(ids):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least, many = np.minimum.reduceat(rank, start), np.diff(np.append(start, len(ids)))
            live = least < NONE
            if not live.all():
                on = np.repeat(live, many)
                done.append((ids[~on], word[~on]))
                ids, word, rank, least, many = ids[on], word[on], rank[on], least[live], many[live]
            best = np.repeat(least, many)
            at = np.flatnonzero(rank == best)
            later = np.concatenate([[False], word[at[1:]] == word[at[:-1]]])[:len(at)]
            if later.any():  # the leftmost; in a long word all, of adjacent ones every other one
                number = np.arange(len(at))
                head = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(at) != 1]), number, 0))
                at = at[np.where(long[word[at]], (number - head) % 2 == 0, ~later)]
            ids[at] = best[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, word, rank, at = ids[stay], word[stay], rank[stay], at - np.arange(len(at))
            rank[at] = NONE
            anew = np.concatenate([at, at - 1])
            anew = anew[(anew >= 0) & (anew < len(ids) - 1)]
            anew = anew[word[anew] == word[anew + 1]]
            rank[anew] = self._rank(ids[anew], ids[anew + 1])
        return np.concatenate([i for i, _ in done]), np.concatenate([w for _, w in done])


def word_counts(docs: DataFrame, vocabulary: Vocabulary, spec: EncodeSpec = EncodeSpec(), text: str = "text") -> DataFrame:
    """``word, n``: the words that occur twice or more and fit the dictionary."""
    pattern, coarse, limit, room = vocabulary.pattern, vocabulary.coarse, spec.word_bytes, spec.counted

    def run(batches):
        find, counts = regex.compile(pattern).findall, Counter()
        split = re.compile(coarse).findall if coarse else find
        for batch in batches:
            for part in steps(batch, 0):
                for t in part.column(0).to_pylist():
                    counts.update(split(t))
                if len(counts) >= room:
                    yield _counted(counts, find, bool(coarse), limit)
                    counts = Counter()
        yield _counted(counts, find, bool(coarse), limit)
        counts = None
        release_memory()

    return docs.select(F.coalesce(text, F.lit("")).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).where("n > 1")


def _words_of(part: str, find, coarse: bool):
    """The words of a part: one, or one and signs, without the pattern where that is plain."""
    if coarse:
        if part.isalpha() or part[1:].isalpha() and part[0] == " ":
            return (part,)
        body = part.rstrip(SIGNS)
        if body != part and (body.isalpha() or body[1:].isalpha() and body[0] == " "):
            return body, part[len(body):]
    return find(part)


def _counted(parts: Counter, find, coarse: bool, limit: int) -> pa.RecordBatch:
    counts: Counter = Counter()
    for part, n in parts.items():
        for word in _words_of(part, find, coarse):
            counts[word] += n
    kept = [(w, n) for w, n in counts.items() if len(w) * 4 <= limit or len(w.encode()) <= limit]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])


def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of each word's hash."""
    raw = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w.encode()) for w in words]), "<i8")
    return raw[::2], raw[1::2].astype(np.int32)


class Dictionary:
    """Frequent words and their ids, and rarer words' hashes (sorted) and ids.  Ids are binary, of 2
    bytes each if the vocabulary allows, else of 4."""

    def __init__(self, plain: pa.Table, hashed: pa.Table, kind: str) -> None:
        """``plain``: word, ids; ``hashed``: h1 in ascending order, h2, ids."""
        self.kind = kind
        self.words, self.ids = plain["word"].combine_chunks(), plain["ids"].combine_chunks()
        self.h1, self.h2, self.hashed_ids = hashed["h1"].to_numpy(), hashed["h2"].to_numpy(), hashed["ids"].combine_chunks()
        self._codes = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_codes": None}

    def codes(self, find, coarse: bool, room: int) -> _Codes:
        """The frequent words as a mapping, opened once a worker."""
        if self._codes is None:
            data, off = text_bytes(self.ids)
            raw, at = data.view(self.kind).astype("<i4").tobytes(), (off * 4 // np.dtype(self.kind).itemsize).tolist()
            self._codes = _Codes({w: raw[a:b] for w, a, b in zip(self.words.to_pylist(), at, at[1:])}, find, coarse, room)
        self._codes.end_text()
        return self._codes

    def look_up(self, words: list[str], merges: Merges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and each word's first place and number among them: those of the hashed words, then those
        of the words that are encoded here."""
        if not len(self.h1) or not words:
            ids, at = merges.encode(words)
            return ids, at[:-1], np.diff(at)
        h1, h2 = _hashes(words)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        lacking = np.flatnonzero((self.h1[at] != h1) | (self.h2[at] != h2))
        data, off = text_bytes(self.hashed_ids.take(pa.array(at)))
        ids, off = data.view(self.kind).astype(np.int32), off // np.dtype(self.kind).itemsize
        first, many = off[:-1].copy(), np.diff(off)
        own, off = merges.encode([words[i] for i in lacking])
        first[lacking], many[lacking] = off[:-1] + len(ids), np.diff(off)
        return np.concatenate([ids, own]), first, many


def dictionary(docs: DataFrame, vocabulary: Vocabulary, merges: Broadcast, spec: EncodeSpec = EncodeSpec(), text: str = "text") -> Dictionary:
    """The most frequent words (``merges``: the vocabulary's): words of one step of the frequency scale (an eighth of a doubling) are
    taken together or not at all."""
    step = F.floor(F.log2("n") * 8).cast("int")
    counts = materialize(word_counts(docs, vocabulary, spec, text).withColumn("step", step), "bpe-words")
    least, plain, total = None, None, 0
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():  # 8 rows a doubling of the frequency
        total += row["count"]
        if total <= spec.words:
            plain = row["step"]
        if total > spec.words + spec.hashed:
            break
        least = row["step"]
    kind = "<u2" if max(vocabulary.ranks.values()) < 1 << 16 else "<u4"

    def packed(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            h1, h2 = _hashes(words)
            ids, at = merges.value.encode(words)
            off = (at * np.dtype(kind).itemsize).astype(np.int32)
            packs = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(off), pa.py_buffer(ids.astype(kind).tobytes())])
            yield pa.RecordBatch.from_arrays([pc.if_else(batch.column(1), batch.column(0), None), pa.array(h1), pa.array(h2), packs], names=["word", "h1", "h2", "ids"])

    taken = counts.where(F.col("step") >= least) if least is not None else counts.limit(0)
    spread = taken.select("word", (F.col("step") >= plain if plain is not None else F.lit(False)).alias("plain")).repartition(
        docs.sparkSession.sparkContext.defaultParallelism * 4, "word")
    made = materialize(spread.mapInArrow(packed, "word string, h1 long, h2 int, ids binary"), "bpe-ids")
    return Dictionary(made.where("word IS NOT NULL").select("word", "ids").toArrow(),  # at most spec.words rows
                      made.where("word IS NULL").select("h1", "h2", "ids").orderBy("h1").toArrow(), kind)  # at most spec.hashed rows


class _Codes(dict):
    """Ids of parts of texts.  Words that the dictionary lacks have numbers of their own, -1, -2, ...
    in each text, and parts with such words are forgotten after it."""

    def __init__(self, known: dict[str, bytes], find, coarse: bool, room: int) -> None:
        super().__init__(known)
        self.find, self.coarse, self.room = find, coarse, room
        self.rare: dict[str, bytes] = {}
        self.held: list[str] = []
        self.passing: list[str] = []

    def __missing__(self, part: str) -> bytes:
        words = _words_of(part, self.find, self.coarse)
        if len(words) == 1:
            return self._rare(part) if words[0] == part else self[words[0]]
        codes, lacking = [], False
        for word in words:
            code = self.get(word)
            if code is None:
                lacking, code = True, self._rare(word)
            codes.append(code)
        (self.passing if lacking else self.held).append(part)
        joined = self[part] = b"".join(codes)
        return joined

    def _rare(self, word: str) -> bytes:
        code = self.rare.get(word)
        if code is None:
            code = self.rare[word] = (-1 - len(self.rare)).to_bytes(4, "little", signed=True)
        return code

    def end_text(self) -> list[str]:
        """The words that the text has and the dictionary lacks."""
        rare = list(self.rare)
        for part in self.passing:
            del self[part]
        if len(self.held) >= self.room:
            for part in self.held:
                del self[part]
            self.held.clear()
        self.rare.clear()
        self.passing.clear()
        return rare


def _coded(docs: DataFrame, vocabulary: Vocabulary, spec: EncodeSpec, text: str) -> Callable:
    """A function of the batches of a task (text, doc_id): yields, in steps of bounded bytes, doc_ids,
    all their ids, and where each document's ids start."""
    context = docs.sparkSession.sparkContext
    merges = context.broadcast(Merges(vocabulary, spec.short))
    shared = context.broadcast(dictionary(docs, vocabulary, merges, spec, text))  # at most words + hashed short words
    pattern, coarse, room = vocabulary.pattern, vocabulary.coarse, spec.held

    def run(batches):
        find = regex.compile(pattern).findall
        split = re.compile(coarse).findall if coarse else find
        known = shared.value
        codes = known.codes(find, bool(coarse), room)
        for batch in batches:
            for part in steps(batch, 0):
                found, rare, size = [], [], [0]
                for t in part.column(0).to_pylist():
                    found.append(b"".join(map(codes.__getitem__, split(t))))
                    rare += codes.end_text()
                    size.append(len(rare))
                yield part.column(1), *_filled(found, np.array(size), *known.look_up(rare, merges.value))

    return run


def _filled(found: list[bytes], rare: np.ndarray, own: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of texts, and where each text's ids start.  Ids below 0 stand for the text's words from
    ``rare`` on, with ``many`` ids each from ``first`` on in ``own``."""
    ids, at = np.frombuffer(b"".join(found), "<i4"), np.cumsum([0, *(len(x) // 4 for x in found)])
    place = np.flatnonzero(ids < 0)
    if len(place):
        word = rare[np.searchsorted(at, place, side="right") - 1] - ids[place] - 1
        size = np.ones(len(ids), np.int64)
        size[place] = many[word]
        start = np.concatenate([[0], np.cumsum(size)])
        inside = np.arange(size[place].sum()) - np.repeat(np.cumsum(size[place]) - size[place], size[place])
        ids = np.repeat(ids, size)
        ids[np.repeat(start[place], many[word]) + inside] = own[np.repeat(first[word], many[word]) + inside]
        at = start[at]
    return ids, at


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(text, F.lit("")).alias("text"), F.col(doc_id).alias("doc_id"))


def encode(docs: DataFrame, vocabulary: Vocabulary, spec: EncodeSpec = EncodeSpec(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ids``: one row per document."""
    coded = _coded(docs, vocabulary, spec, text)

    def run(batches):
        for doc_ids, ids, at in coded(batches):
            yield pa.RecordBatch.from_arrays([doc_ids, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], names=["doc_id", "ids"])
        release_memory()

    kind = docs.schema[doc_id].dataType.simpleString()
    return _texts(docs, text, doc_id).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, bytes``: each row's pieces one after the other.  An unknown id fails."""
    pieces, kind = vocabulary.pieces(), encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_joined(ids.values.to_numpy(), pieces) for ids in batch.column(1)], pa.binary())],
                                             names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def _joined(ids: np.ndarray, pieces: list[bytes | None]) -> bytes:
    if len(ids) and (ids.min() < 0 or ids.max() >= len(pieces)):
        raise ValueError("an id is not in the vocabulary")
    try:
        return b"".join(map(pieces.__getitem__, ids.tolist()))
    except TypeError as e:
        raise ValueError("an id is not in the vocabulary") from e


def digests(docs: DataFrame, vocabulary: Vocabulary, spec: EncodeSpec = EncodeSpec()) -> DataFrame:
    """Per document: the number of ids, and SHA-256 of the ids (32-bit little-endian) and of the bytes
    that they decode to."""
    pieces, kind = vocabulary.pieces(), docs.schema["doc_id"].dataType.simpleString()
    coded = _coded(docs, vocabulary, spec, "text")

    def run(batches):
        for doc_ids, ids, at in coded(batches):
            raw = memoryview(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.diff(at)), pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in itertools.pairwise(at.tolist())], pa.string()),
                 pa.array([hashlib.sha256(_joined(ids[a:b], pieces)).hexdigest() for a, b in itertools.pairwise(at.tolist())], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        release_memory()

    return _texts(docs, "text", "doc_id").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> Vocabulary:
    """A vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return Vocabulary.load(public_tokenizers.path(name), public_tokenizers.PATTERN)
