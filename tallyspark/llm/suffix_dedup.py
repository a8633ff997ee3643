"""Repeated-substring removal by bucket-pointer refinement.

A byte is removed if it is covered by a string of ``length`` bytes that also
starts anywhere else.  The suffixes to compare are the starts of all windows
of ``length`` bytes; equal windows must end up in one bucket.

1. Initial q-gram buckets.  Each window is filed under one of its q-grams,
   the leftmost with the least hash, so equal windows file alike and runs of
   neighbouring windows (a block) share one.  Spark counts blocks per q-gram;
   a q-gram that occurs once cannot hold a repeated window and goes.
2. A q-gram whose blocks are all equal is settled: every window repeats.
3. In the others one block of each kind is refined.  Bucket identifiers of
   8-grams are sorted in pairs with the identifiers 8 bytes on, which gives
   identifiers of 16-grams, these give 32-grams, and so on up to ``length``:
   every round reuses the identifiers the last one updated.  Suffixes whose
   bucket has become a singleton are not sorted again.
4. The first and last repeated window of each kind of block go back to all its
   occurrences, are merged per document and cut out.

Copies collapse in grouped counts before anything is compared; where a q-gram
has more than ``LOCAL_KINDS`` kinds of blocks (a passage in very many
surroundings), its windows are counted by a 128-bit name in a shuffle of their
own, so no task holds a hot bucket.  Documents are shuffled once.

Defined results: a null text is the empty text; texts shorter than ``length``
keep all bytes; repeated rows are occurrences of their own, so each loses all
windows; doc_id may be null or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.shared import slices, stored

LENGTH, Q = 200, 64
LOCAL_KINDS = 2048
#: Bytes searched at once, few enough for the arrays to stay in a core's
#: cache; of a longer text at once; and of block text refined at once.
SEARCHED, CHUNK, REFINED = 1 << 17, 4 << 20, 1 << 20
#: Names of repeated windows sent to every task at most; beyond that they are
#: joined.
SENT_NAMES = 250_000
_BLOCKS = "gram long, kind long, k1 long, k2 long, lo long, size int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


# ------------------------------------------------------------------ blocks
def gram_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """A hash of the ``q`` bytes from each position on, by doubling."""
    base = np.array([0x9E3779B97F4A7C15], np.uint64)
    power, width = x.astype(np.uint64) + np.uint64(1), 1
    h, done = None, 0
    while True:
        if q & width:
            n = len(x) - done - width + 1
            h = power[:n].copy() if h is None else h[:n] * base + power[done:done + n]
            done += width
        if done == q:
            break
        n = len(power) - width
        power = power[:n] * base + power[width:width + n]
        base, width = base * base, 2 * width
    h ^= h >> np.uint64(31)
    h *= np.array([0xBF58476D1CE4E5B9], np.uint64)
    return h


def _sliding(h: np.ndarray, w: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``w`` values."""
    best, size = h, 1
    while size * 2 <= w:
        best = pick(best[:len(best) - size], best[size:])
        size *= 2
    n = len(h) - w + 1
    return pick(best[:n], best[w - size:w - size + n])


def anchors(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost minimum of each run of ``w`` values."""
    least = _sliding(h, w, np.minimum)
    # a value is the minimum of some run iff it equals the largest of the
    # minima of the runs it lies in
    edge = np.zeros(w - 1, np.uint64)
    largest = _sliding(np.concatenate([edge, least, edge]), w, np.maximum)
    minimal = h == largest
    minima = np.flatnonzero(minimal)
    # how many lie before a position is the number of the first from it on
    at = (np.cumsum(minimal, dtype=np.int32) - minimal)[:len(least)]
    wrong = np.flatnonzero(h[minima[at]] != least)
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[h[minima[at[wrong]]] != least[wrong]]
    return minima[at]


def blocks(texts: list[bytes], length: int, q: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, first window, windows, gram name, kind name) of every block."""
    buffer = b"".join(texts)
    if len(buffer) < length:
        return
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    at = anchors(gram_hashes(np.frombuffer(buffer, np.uint8), q), length - q + 1)
    # windows that lie inside a text
    count = np.maximum(sizes - length + 1, 0)
    first = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(count.sum())
    at = at[first]
    lo = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
    n = np.diff(np.r_[lo, len(at)])
    lo, at = first[lo], at[lo]
    doc = np.searchsorted(starts, lo, side="right") - 1
    name, view = xxhash.xxh3_64_intdigest, memoryview(buffer)
    for d, i, k, a, s in zip(doc.tolist(), lo.tolist(), n.tolist(), at.tolist(), starts[doc].tolist(), strict=True):
        yield d, i - s, k, name(view[a:a + q]), name(view[i:i + k + length - 1], (a - i) << 20 | k)


def text_blocks(texts: list[bytes], length: int, q: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``blocks``, long texts in overlapping chunks."""
    short = [t if len(t) <= CHUNK else b"" for t in texts]
    yield from blocks(short, length, q)
    for d, t in enumerate(texts):
        if len(t) > CHUNK:
            for at in range(0, len(t) - length + 1, CHUNK):
                for _, lo, n, gram, kind in blocks([t[at:at + CHUNK + length - 1]], length, q):
                    yield d, at + lo, n, gram, kind


# ------------------------------------------------------------------ refinement
def refined(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, window start, bucket) of every window of ``texts``; windows
    have the same bucket iff they are equal.  ``length`` is 8 at least."""
    sizes = np.array([len(t) for t in texts], np.int64)
    x = np.frombuffer(b"".join(texts) + bytes(8), np.uint8).astype(np.uint64)
    total = len(x) - 8
    grams = np.zeros(total, np.uint64)
    for k in range(8):
        grams |= x[k:k + total] << np.uint64(8 * k)
    bucket, width = np.unique(grams, return_inverse=True)[1], 8
    while width * 2 <= length:
        bucket = _pairs(bucket[:len(bucket) - width], bucket[width:])
        width *= 2
    count = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(texts)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = start + (np.cumsum(sizes) - sizes)[owner]
    return owner, start, _pairs(bucket[at], bucket[at + length - width])


def _pairs(here: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Buckets of the pairs of identifiers; only suffixes whose own bucket
    and later bucket both hold several are sorted."""
    if not len(here):
        return here
    top = int(max(here.max(), later.max())) + 1
    several = (np.bincount(here, minlength=top) > 1)[here] & (np.bincount(later, minlength=top) > 1)[later]
    out = np.arange(len(here), dtype=np.int64)
    active = np.flatnonzero(several)
    if len(active):
        names, ids = np.unique(here[active] * top + later[active], return_inverse=True)
        # singletons keep numbers of their own beyond those of the sorted
        out += len(names)
        out[active] = ids
    return out


def repeated_range(texts: list[bytes], weights: list[int], length: int) -> list[tuple[int, int] | None]:
    """First and last window of each text that occurs more than once, a text
    standing for ``weights`` copies."""
    owner, start, bucket = refined(texts, length)
    held = np.bincount(bucket, weights=np.minimum(weights, 2)[owner]) if len(bucket) else np.zeros(0)
    again = held[bucket] > 1
    owner, start = owner[again], start[again]
    first = np.full(len(texts), np.iinfo(np.int64).max)
    last = np.full(len(texts), -1)
    np.minimum.at(first, owner, start)
    np.maximum.at(last, owner, start)
    return [(a, b) if b >= 0 else None for a, b in zip(first.tolist(), last.tolist(), strict=True)]


# ------------------------------------------------------------------ tables
def keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, data): the texts' bytes under a key that is never null
    and tells apart rows that share a doc_id but not a text."""
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(-1)).alias("k1"),
                       F.xxhash64(data, doc_id.isNull()).alias("k2"),
                       doc_id.alias("doc_id"), data.alias("data"))


def block_table(rows: DataFrame, length: int, q: int) -> DataFrame:
    def find(batches):
        for batch in slices(batches, "data", SEARCHED):
            found = list(text_blocks(batch.column("data").to_pylist(), length, q))
            doc, lo, n, gram, kind = zip(*found, strict=True) if found else [[]] * 5
            own = pa.array(doc, pa.int64())
            yield pa.record_batch([
                pa.array(np.array(gram, np.uint64).view(np.int64)), pa.array(np.array(kind, np.uint64).view(np.int64)),
                batch.column("k1").take(own), batch.column("k2").take(own), pa.array(lo, pa.int64()),
                pa.array(n, pa.int32())], names=["gram", "kind", "k1", "k2", "lo", "size"])

    return rows.select("k1", "k2", "data").mapInArrow(find, _BLOCKS)


def _kind_texts(rows: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """(gram, kind, n, hot, block): the bytes of one block of each kind."""
    wanted = kinds.groupBy(F.col("one.k1").alias("k1"), F.col("one.k2").alias("k2")).agg(
        F.collect_list(F.struct("gram", "kind", "n", "hot", "one.lo", "one.size")).alias("wanted"))

    def cut(batches):
        for batch in slices(batches, "data"):
            out = []
            for data, wanted in zip(batch.column("data").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                out += [(w["gram"], w["kind"], w["n"], w["hot"], data[w["lo"]:w["lo"] + w["size"] + length - 1])
                        for w in wanted]
            yield _batch(out, [("gram", pa.int64()), ("kind", pa.int64()), ("n", pa.int64()), ("hot", pa.bool_()),
                               ("block", pa.binary())])

    joined = rows.join(wanted, ["k1", "k2"])
    # a row that occurs again yields its blocks again
    return joined.select("data", "wanted").mapInArrow(cut, "gram long, kind long, n long, hot boolean, block binary")


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)], names=[f for f, _ in fields])


_RANGES = [("gram", pa.int64()), ("kind", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]
_RANGE_DDL = "gram long, kind long, first int, last int"


def _local_ranges(texts: DataFrame, length: int) -> DataFrame:
    """Refine whole q-gram buckets, as many at once as ``REFINED`` allows."""
    def refine(batches):
        held: dict[tuple[int, int], tuple[int, bytes]] = {}
        size, gram = 0, None
        for batch in batches:
            for g, k, n, block in zip(*(batch.column(c).to_pylist() for c in ("gram", "kind", "n", "block")), strict=True):
                if g != gram and size > REFINED:
                    yield done(held)
                    held, size = {}, 0
                gram = g
                if (g, k) not in held:
                    size += len(block)
                held[g, k] = (n, block)
        yield done(held)

    def done(held):
        ranges = repeated_range([b for _, b in held.values()], [n for n, _ in held.values()], length) if held else []
        return _batch([(g, k, *r) for (g, k), r in zip(held, ranges, strict=True) if r], _RANGES)

    own = texts.where("NOT hot").repartition("gram").sortWithinPartitions("gram")
    return own.mapInArrow(refine, _RANGE_DDL)


def _window_names(block: bytes, length: int) -> np.ndarray:
    """(w1, w2) of every window of a block: a 128-bit name."""
    view = memoryview(block)
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[i:i + length]) for i in range(len(block) - length + 1)), "<i8").reshape(-1, 2)


def _hot_ranges(spark: SparkSession, texts: DataFrame, length: int) -> DataFrame:
    """Windows of hot q-grams, counted by name.  The names that repeat go
    back to the blocks: to every task if they are few, else by a join."""
    def windows(batches):
        for batch in batches:
            for g, k, n, block in zip(*(batch.column(c).to_pylist() for c in ("gram", "kind", "n", "block")), strict=True):
                names = _window_names(block, length)
                count = len(names)
                yield pa.record_batch([pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(np.full(count, g)),
                                       pa.array(np.full(count, k)), pa.array(np.full(count, min(n, 2))),
                                       pa.array(np.arange(count, dtype=np.int32))],
                                      names=["w1", "w2", "gram", "kind", "n", "at"])

    hot = texts.where("hot").dropDuplicates(["gram", "kind"])
    rows = hot.mapInArrow(windows, "w1 long, w2 long, gram long, kind long, n long, at int")
    again = rows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).where("total > 1").select("w1", "w2")
    again = stored(spark, again, "repeated-windows")
    if again.count() > SENT_NAMES:
        return rows.join(again, ["w1", "w2"], "left_semi").groupBy("gram", "kind").agg(
            F.min("at").alias("first"), F.max("at").alias("last"))
    sent = spark.sparkContext.broadcast(frozenset(map(tuple, again.collect())))

    def ranges(batches):
        for batch in batches:
            out = []
            for g, k, block in zip(*(batch.column(c).to_pylist() for c in ("gram", "kind", "block")), strict=True):
                at = [i for i, w in enumerate(_window_names(block, length).tolist()) if tuple(w) in sent.value]
                out += [(g, k, at[0], at[-1])] if at else []
            yield _batch(out, _RANGES)

    return hot.mapInArrow(ranges, _RANGE_DDL)


def removed_spans(spark: SparkSession, rows: DataFrame, length: int, q: int) -> DataFrame:
    """(k1, k2, spans): byte ranges to remove, overlapping and unordered."""
    found = block_table(rows, length, q)
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("kind").alias("a"), F.max("kind").alias("b")).where(
        "n > 1").select("gram", (F.col("a") != F.col("b")).alias("mixed"))
    # stored, so that both sides of the join come from a shuffle of their own
    # and Spark can split a q-gram that very many blocks share
    grams = stored(spark, grams, "grams")
    repeated = stored(spark, found.join(grams, "gram"), "blocks")
    mixed = repeated.where("mixed")
    kinds = mixed.groupBy("gram", "kind").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "lo", "size")).alias("one"))
    hot = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > LOCAL_KINDS).select(
        "gram", F.lit(True).alias("hot"))
    kinds = kinds.join(hot, "gram", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    texts = stored(spark, _kind_texts(rows, kinds, length), "kinds")
    ranges = _local_ranges(texts, length).unionByName(_hot_ranges(spark, texts, length))
    settled = repeated.where("NOT mixed").select("k1", "k2", "lo", (F.col("lo") + F.col("size") + length - 1).alias("end"))
    partly = mixed.join(ranges, ["gram", "kind"]).select(
        "k1", "k2", (F.col("lo") + F.col("first")).alias("lo"), (F.col("lo") + F.col("last") + length).alias("end"))
    return settled.unionByName(partly).groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "end")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[list[int]] = []
    for lo, end in sorted((s["lo"], s["end"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([lo, end])
    return [(a, b) for a, b in out]


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for run in runs for e in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def with_runs(spark: SparkSession, docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """(doc_id, data, spans) per row of ``docs``; spans may be null."""
    rows = keyed(docs)
    return rows.join(removed_spans(spark, rows, length, q), ["k1", "k2"], "left").select("doc_id", "data", "spans")


def deduplicated(spark: SparkSession, docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """(doc_id, kept binary): the remaining bytes of every row.  Cuts follow
    bytes, so what is left need not be valid UTF-8."""
    def cut(batches):
        for batch in slices(batches, "data"):
            kept = [without(d, merged(s or [])) for d, s in zip(batch.column("data").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(kept, pa.binary())], names=["doc_id", "kept"])
    return with_runs(spark, docs, length, q).mapInArrow(cut, "doc_id long, kept binary")


def summary(spark: SparkSession, docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    def digest(batches):
        for batch in slices(batches, "data"):
            out = []
            for doc_id, data, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "data", "spans")), strict=True):
                runs = merged(spans or [])
                out.append((doc_id, len(data), sum(b - a for a, b in runs), len(runs),
                            hashlib.sha256(without(data, runs)).hexdigest()))
            yield _batch(out, [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                               ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    return with_runs(spark, docs, length, q).mapInArrow(digest, RESULT)
