"""Phrase collocations by mergeable Misra-Gries summaries and an exact count.

A phrase of up to ``longest`` words is frequent in its language if it occurs
``least`` times.  Frequent phrases are found in three passes over the texts:

1. Single words and pairs are hashed.  Each task sends, per hash partition, a
   summary: the sorted hashes it met and their counts.  A partition merges its
   summaries and, whenever it holds more counters than its capacity, takes the
   first count beyond the capacity off every counter.  The capacity is
   ``SLACK`` times the partition's mass over ``least``, plus one, so all that
   is ever taken off a counter stays below ``least`` / ``SLACK``: a hash whose
   counter and what was taken off come to less than ``least`` cannot be
   frequent, and every frequent one survives.
2. The same for longer phrases, but only those all of whose pairs survived: a
   phrase is never more frequent than its parts.
3. Phrases that survived are counted exactly, by their words: each task packs
   its counts by hash partition of the phrase, and partitions add them up.

Survivors are known to the tasks as a bit field of fixed size, indexed by the
upper bits of the hash (each hash partition is a stretch of it).  A bit set by
another phrase only means that one phrase more is counted exactly; nothing is
lost, however full the field is.

Memory: a task holds ``TASK_ENTRIES`` hashes and their counts before it sends
a summary, a partition its capacity and one batch of summaries.

Defined results: a null lang is ``und``; null and empty texts have no words;
repeated rows count each time; a table without frequent phrases gives no row.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.shared import slices, stored

#: Bits of the field that tells tasks what survived: 8 MB, whatever the input.
FIELD_BITS = 26
#: How many times the capacity exceeds mass / threshold.
SLACK = 8
#: Distinct hashes a task gathers before it sends a summary of them.
TASK_ENTRIES = 800_000
#: Distinct phrases a task counts exactly before it sends their counts.
TASK_PHRASES = 400_000
#: Bytes of text per numpy step.
STEP_BYTES = 1 << 20
#: Counters in one row of a summary at most.
ROW_ENTRIES = 8192

# What ends a piece, and what parts words.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + b"\n" * len(_ENDS))
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ words and phrases
class Words:
    """The words of some texts of one language, in order: their numbers in
    ``kinds``, their hashes, and the number of the piece each stands in."""

    def __init__(self, lang: str, texts: list[str]):
        data = "\n".join(texts).encode().translate(_TABLE).replace(b"\n", b" \xff ")
        found = pa.array(data.split(), pa.binary()).dictionary_encode()
        self.kinds = found.dictionary.to_pylist()
        ids = found.indices.to_numpy()
        is_break = np.fromiter((k == _BREAK for k in self.kinds), bool, len(self.kinds))[ids]
        self.ids = ids[~is_break]
        self.piece = np.cumsum(is_break)[~is_break].astype(np.int32)
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(k, seed) for k in self.kinds), np.uint64, len(self.kinds))
        self.hashes = hashes[self.ids]

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, hash, whole) for each n: the hash of the n words from each word
        on, and whether these stand in one piece."""
        h = self.hashes
        for n in range(1, longest + 1):
            if n > len(self.hashes):
                return
            if n > 1:
                h = h[:-1] * _MIX + self.hashes[n - 1:]
                h = h ^ (h >> np.uint64(29))
                h *= _MIX
                h ^= h >> np.uint64(32)
            yield n, h, self.piece[:len(h)] == self.piece[n - 1:]

    def surviving(self, longest: int, field: np.ndarray, pairs: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``phrases`` whose bit is set in ``field``; with ``pairs`` those
        longer ones whose pairs' bits are all set in it."""
        good = None
        for n, h, whole in self.phrases(longest):
            if n == 2:
                good = _set(pairs if pairs is not None else field, h) & whole
                chain = good
            elif n > 2:
                chain = chain[:-1] & good[n - 2:]
                whole = whole & chain
            yield n, h, whole & _set(field, h) if pairs is None else whole


def _set(field: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h >> np.uint64(64 - FIELD_BITS)).astype(np.int64)
    return (field[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _by_lang(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    for batch in slices(batches, limit=STEP_BYTES):
        codes = batch.column("lang").dictionary_encode()
        kinds, codes = codes.dictionary.to_pylist(), codes.indices.to_numpy()
        for k, lang in enumerate(kinds):
            yield lang, batch.column("text").filter(pa.array(codes == k)).to_pylist()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text")).where("text != ''")


# ------------------------------------------------------------------ summaries
def merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and the sums of their counts."""
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h = h[order]
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return h[starts], np.add.reduceat(c[order], starts) if len(h) else c


def reduced(h: np.ndarray, c: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The summary with ``capacity`` counters at most, and what that took off
    every counter."""
    if len(c) <= capacity:
        return h, c, 0
    off = int(np.partition(c, len(c) - capacity - 1)[len(c) - capacity - 1])
    stay = c > off
    return h[stay], c[stay] - off, off


_SUMMARY = "part int, mass long, hashes binary, counts binary"


def _rows(h: np.ndarray, c: np.ndarray, shift: int) -> Iterator[pa.RecordBatch]:
    """A task's summary, cut at the hash partitions."""
    part = (h >> np.uint64(shift)).astype(np.int64)
    cuts = np.union1d(np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(h) else np.zeros(0, np.int64),
                      np.arange(0, len(h), ROW_ENTRIES))
    ends = np.r_[cuts[1:], len(h)].astype(np.int64)
    for k in range(0, len(cuts), 256):
        span = list(zip(cuts[k:k + 256].tolist(), ends[k:k + 256].tolist(), strict=True))
        yield pa.RecordBatch.from_arrays([
            pa.array([int(part[a]) for a, _ in span], pa.int32()), pa.array([int(c[a:b].sum()) for a, b in span], pa.int64()),
            pa.array([_packed(h[a:b]) for a, b in span], pa.binary()),
            pa.array([_small(c[a:b]).tobytes() for a, b in span], pa.binary())], ["part", "mass", "hashes", "counts"])


def _packed(h: np.ndarray) -> bytes:
    """Sorted hashes as differences, lowest bytes first, as compressors like
    them."""
    return np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _small(c: np.ndarray) -> np.ndarray:
    return c.astype(np.uint8 if len(c) == 0 or c.max() < 256 else np.int64)


def _counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == n else np.int64).astype(np.int64)


def _summarised(shift: int, lengths: range, pairs) -> callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held = [], [], 0
        field = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        for lang, texts in _by_lang(batches):
            words = Words(lang, texts)
            found = words.phrases(lengths[-1]) if field is None else words.surviving(lengths[-1], field, field)
            for n, h, whole in found:
                if n in lengths:
                    h, c = np.unique(h[whole], return_counts=True)
                    hashes.append(h)
                    counts.append(c.astype(np.int64))
                    held += len(h)
            if held > TASK_ENTRIES:
                h, c = merged(hashes, counts)
                hashes, counts, held = [h], [c], len(h)
                if held > TASK_ENTRIES // 2:
                    hashes, counts, held = [], [], 0
                    yield from _rows(h, c, shift)
                    # what Arrow holds on to is another task's memory
                    pa.default_memory_pool().release_unused()
        if held:
            yield from _rows(*merged(hashes, counts), shift)
    return run


def _survivors(shift: int, masses: dict[int, int], least: int):
    """Merges the summaries of each hash partition of a task, which come
    sorted by partition, and sends the partition's stretch of the field."""
    def stretch(part: int, h: np.ndarray, c: np.ndarray, off: int) -> tuple:
        bits = np.zeros(1 << FIELD_BITS - 64 + shift, bool)
        kept = h[c + off >= least]
        bits[((kept >> np.uint64(64 - FIELD_BITS)) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
        return part, len(kept), np.packbits(bits, bitorder="little").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()), strict=True)],
                                          ["part", "kept", "bits"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, off, hashes, counts, held = None, 0, [], [], 0
        for batch in batches:
            done = []
            for p, packed, small in zip(batch.column("part").to_pylist(), batch.column("hashes"), batch.column("counts"), strict=True):
                if p != part and part is not None:
                    done.append(stretch(part, *merged(hashes, counts), off))
                    off, hashes, counts, held = 0, [], [], 0
                part = p
                h = _unpacked(packed.as_buffer())
                hashes.append(h)
                counts.append(_counts(small.as_buffer(), len(h)))
                held += len(h)
                capacity = SLACK * masses[p] // least + 1
                if held > 2 * capacity + 64 * ROW_ENTRIES:
                    h, c, taken = reduced(*merged(hashes, counts), capacity)
                    off, hashes, counts, held = off + taken, [h], [c], len(h)
            yield batch_of(done)
        yield batch_of([stretch(part, *merged(hashes, counts), off)] if part is not None else [])
    return run


def survivors(spark: SparkSession, texts: DataFrame, lengths: range, least: int, pairs=None) -> np.ndarray:
    """The bit field of the phrases of these lengths that may be frequent.
    The driver gets one number and one stretch of the field per hash
    partition."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a power of two, and at least a byte of the field each
    level = min(max(4, (parts - 1).bit_length()), FIELD_BITS - 3)
    shift = 64 - level
    rows = stored(spark, texts.mapInArrow(_summarised(shift, lengths, pairs), _SUMMARY), "phrase-summaries")
    masses = {r.part: r.mass for r in rows.groupBy("part").agg(F.sum("mass").alias("mass")).collect()}
    # the partition itself is the key, so that each task gets neighbours
    dealt = rows.select("part", "hashes", "counts").repartitionByRange(1 << level, "part").sortWithinPartitions("part")
    field = np.zeros(1 << FIELD_BITS - 3, np.uint8)
    stretch = len(field) >> level
    for r in dealt.mapInArrow(_survivors(shift, masses, least), "part int, kept long, bits binary").select("part", "bits").collect():
        field[r.part * stretch:(r.part + 1) * stretch] = np.frombuffer(r.bits, np.uint8)
    return field


# ------------------------------------------------------------------ exact counts
_PACKED_COUNTS = "part int, lang string, n_words int, phrases binary, counts binary"


def _counted(longest: int, short, long, parts: int):
    """Exact counts of the phrases of a task, packed by language, length and
    hash of the phrase."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = (np.frombuffer(x.value, np.uint8) for x in (short, long))
        counts: dict[tuple[str, int], dict[bytes, int]] = {}
        for lang, texts in _by_lang(batches):
            words = Words(lang, texts)
            _add(counts.setdefault((lang, 0), {}), b"", len(words.ids))
            for n, h, whole in words.surviving(longest, low, low):
                at = np.flatnonzero(whole & _set(low if n < 3 else high, h))
                found = counts.setdefault((lang, n), {})
                for phrase, c in _exact(words, n, at, h[at]):
                    _add(found, phrase, c)
            if sum(map(len, counts.values())) > TASK_PHRASES:
                yield from _count_rows(counts, parts)
                counts = {}
        yield from _count_rows(counts, parts)
    return run


def _add(counts: dict[bytes, int], phrase: bytes, n: int) -> None:
    counts[phrase] = counts.get(phrase, 0) + n


def _count_rows(counts: dict[tuple[str, int], dict[bytes, int]], parts: int) -> Iterator[pa.RecordBatch]:
    for (lang, n), found in counts.items():
        dealt: dict[int, list[bytes]] = {}
        for phrase in found:
            dealt.setdefault(xxhash.xxh3_64_intdigest(phrase) % parts, []).append(phrase)
        rows = [(p, lang, n, b"\n".join(of), np.array([found[x] for x in of], np.int64).tobytes()) for p, of in dealt.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
                zip(*rows, strict=True), (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                ["part", "lang", "n_words", "phrases", "counts"])


def _added_up(least: int):
    """The packed counts of each hash partition, which come sorted by
    partition, language and length, as one row per frequent phrase.  A phrase
    has no line break, so one parts them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, found = None, {}
        for batch in batches:
            done = []
            for p, lang, n, phrases, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != (p, lang, n):
                    done.append((key, found))
                    key, found = (p, lang, n), {}
                for phrase, c in zip(phrases.split(b"\n"), np.frombuffer(counts, np.int64).tolist(), strict=True):
                    _add(found, phrase, c)
            yield from _frequent_rows(done, least)
        yield from _frequent_rows([(key, found)], least)
    return run


def _frequent_rows(done: list[tuple], least: int) -> Iterator[pa.RecordBatch]:
    for key, found in done:
        kept = {phrase: c for phrase, c in found.items() if c >= least or key[2] == 0}
        if kept:
            yield pa.RecordBatch.from_arrays([
                pa.array([key[1]] * len(kept), pa.string()), pa.array([key[2]] * len(kept), pa.int32()),
                pa.array(kept, pa.binary()).cast(pa.string()), pa.array(kept.values(), pa.int64())],
                ["lang", "n_words", "phrase", "n"])


def _exact(words: Words, n: int, at: np.ndarray, h: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """The phrases of n words at these places with their counts."""
    if not len(at):
        return
    order = np.argsort(h, kind="stable")
    at, h = at[order], h[order]
    new = np.r_[True, h[1:] != h[:-1]]
    group = np.cumsum(new) - 1
    first = at[np.flatnonzero(new)]
    same = np.ones(len(at), bool)
    for j in range(n):
        same &= words.ids[at + j] == words.ids[first + j][group]
    sizes = np.bincount(group[same], minlength=len(first))
    kinds, ids = words.kinds, words.ids
    columns = [[kinds[i] for i in ids[first + j].tolist()] for j in range(n)]
    yield from zip(map(b" ".join, zip(*columns, strict=True)), sizes.tolist(), strict=True)
    if not same.all():  # other phrases under the same hash
        yield from _exact(words, n, at[~same], h[~same])


def frequent(spark: SparkSession, docs: DataFrame, longest: int = 5, least: int = 100) -> DataFrame:
    """(lang, n_words, phrase, n): the exact count of every phrase of up to
    ``longest`` words that occurs ``least`` times in its language, and under
    n_words 0 the words of each language; stored."""
    texts = _texts(docs)
    sc = spark.sparkContext
    low = sc.broadcast(survivors(spark, texts, range(1, 3), least).tobytes())
    high = sc.broadcast(survivors(spark, texts, range(3, longest + 1), least, low).tobytes()) if longest > 2 else low
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.mapInArrow(_counted(longest, low, high, parts), _PACKED_COUNTS)
    dealt = rows.repartition(parts, "part").sortWithinPartitions("part", "lang", "n_words")
    out = stored(spark, dealt.mapInArrow(_added_up(least), "lang string, n_words int, phrase string, n long"), "phrase-counts")
    low.destroy()
    if longest > 2:
        high.destroy()
    return out


# ------------------------------------------------------------------ collocations
def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every frequent phrase of two words
    or more, by its lowest-scoring cut."""
    totals = counts.where("n_words = 0").select("lang", F.col("n").alias("total"))
    parts = counts.where("n_words > 0").select("lang", "phrase", F.col("n").alias("f"))
    words = F.split("phrase", " ")
    cuts = counts.where("n_words > 1").select("lang", "phrase", F.col("n").alias("a"), words.alias("w"),
                                              F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.join(totals, "lang")
    # 4 + 15 + 17 digits and what products add stay within 38
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(total AS DECIMAL(17,0)))"
                   " DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.any_value("a").alias("a"), F.any_value("total").alias("n"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def contained(counts: DataFrame, percent: int = 100) -> DataFrame:
    """(lang, phrase, most): for phrases at an end of a frequent phrase one
    word longer the largest count of such a phrase.

    A phrase inside any longer one stands at an end of one a word longer,
    which is at least as frequent as the longer one."""
    words = F.split("phrase", " ")
    ends = counts.where("n_words > 2").select("lang", "n", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("n_words") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("n_words") - 1), " "))).alias("phrase"))
    return ends.groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(spark: SparkSession, docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000,
                 percent: int = 100) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r,
    n, score.  A phrase that stands inside a longer frequent one ``percent``
    of the time is left to that one."""
    counts = frequent(spark, docs, longest, least)
    rows = scored(counts).join(contained(counts), ["lang", "phrase"], "left")
    rows = rows.where(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a")))
    along = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(along).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
