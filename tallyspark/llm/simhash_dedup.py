"""SimHash near-duplicates through a Gray-order hierarchical index.

Every text gets a 64-bit fingerprint.  Distinct fingerprints within
``max_bits`` differing bits are linked and the connected components labelled
with their smallest doc_id.

The index: fingerprints sorted by their rank in Gray order lie next to ones
that share most of their bits.  Runs of neighbours form nodes holding the mask
of bits on which all below agree and the pattern of those bits; what nodes
share is factored into the node above, so a child holds only bits newly fixed.
A search carries the differences found so far down the tree and drops a whole
group once they exceed ``max_bits``.

Distribution: a fingerprint is cut into ``max_bits + 2`` blocks; two
fingerprints in reach agree on at least two of them, so they meet in the
bucket of some pair of blocks.  One index is built per bucket, all buckets of
a task at once.  A bucket of more than ``BUCKET_ROWS`` fingerprints is dealt
out as a grid of smaller ones that covers every pair.  A task sends out one
link per fingerprint it could join to a smaller one, never its pairs.

Defined results: null and empty texts have fingerprint zero and are linked
like others; fewer words than a shingle make one shingle; repeated rows share
a component; a null doc_id never labels a component that has another.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.components import components
from tallyspark.llm.shared import neutral, slices, stored

SEED = 42
BUCKET_ROWS = 8192
FANOUT = 16
#: Entries of the search front held at once.
FRONT = 2_000_000
#: Shingles hashed at once.
SHINGLES = 1 << 16
ALL = np.uint64(2**64 - 1)


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits; bit k is set if it is set in over half the shingles' XXH64."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    starts, n = starts.tolist(), max(1, len(words) - shingle + 1)
    width, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        hashes = np.array([digest(joined[starts[i]:starts[i + width] - 1], SEED)
                           for i in range(at, min(n, at + SHINGLES))], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > n).astype(np.uint64)).sum())


def named(docs: DataFrame) -> DataFrame:
    """``docs`` with two hashes that name the text, never null."""
    text = F.col("text").cast("string")
    return docs.withColumns({"__n1": F.xxhash64(text, text.isNull()), "__n2": F.xxhash64(F.lit(1), text, text.isNull())})


def fingerprints(docs: DataFrame, shingle: int, names: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) per row, and the long columns ``names`` of ``docs``; fp is
    the fingerprint's bits as a signed long."""
    def emit(batches):
        for batch in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fps.view(np.int64)), *map(batch.column, names)],
                                  names=["doc_id", "fp", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *names)
    return rows.mapInArrow(emit, ", ".join(f"{c} long" for c in ("doc_id", "fp", *names)))


# ------------------------------------------------------------------ index
def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in the Gray sequence."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical indexes over ``fps``, one per run of equal ``group``;
    within a run the fingerprints are in Gray order."""

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.fps = fps
        # Level 0 holds the fingerprints: every bit fixed.
        self.levels = [(fps, np.full(len(fps), ALL), np.arange(len(fps) + 1))]
        pattern, mask, owner = fps, self.levels[0][1], group
        while True:
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            inside = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
            starts = np.flatnonzero(inside % FANOUT == 0)
            shared = np.bitwise_and.reduceat(pattern, starts) ^ np.bitwise_or.reduceat(pattern, starts)
            above = np.bitwise_and.reduceat(mask, starts) & ~shared
            pattern, mask, owner = pattern[starts] & above, above, owner[starts]
            self.levels.append((pattern, mask, np.r_[starts, len(inside)]))
            if len(starts) == len(first):
                break
        self.root = np.cumsum(np.r_[0, group[1:] != group[:-1]])
        self.largest = int(np.diff(np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]).max())

    def pairs(self, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query row, later row of its run) for all within ``max_bits``."""
        pattern, mask, children = self.levels[-1]
        q, node = queries, self.root[queries]
        apart = np.bitwise_count((self.fps[q] ^ pattern[node]) & mask[node])
        for below in range(len(self.levels) - 2, -1, -1):
            kept = apart <= max_bits
            q, node, apart = q[kept], node[kept], apart[kept]
            n = children[node + 1] - children[node]
            child = np.repeat(children[node] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            q, apart, parent_mask = np.repeat(q, n), np.repeat(apart, n), np.repeat(mask[node], n)
            pattern, mask, children = self.levels[below]
            new = mask[child] & ~parent_mask
            apart = apart + np.bitwise_count((self.fps[q] ^ pattern[child]) & new)
            node = child
        kept = (apart <= max_bits) & (node > q)
        return q[kept], node[kept]

    def forest(self, max_bits: int) -> np.ndarray:
        """For every row the first row of its run it is joined to."""
        label = np.arange(len(self.fps))
        step = max(1, FRONT // max(1, self.largest))
        for at in range(0, len(self.fps), step):
            a, b = self.pairs(np.arange(at, min(at + step, len(self.fps))), max_bits)
            while True:
                x, y = label[a], label[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
                while (label[label] != label).any():
                    label = label[label]
        return label


# ------------------------------------------------------------------ links
def _keys(fps: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """A bucket key per pair of blocks: the pair's number, then the bits."""
    edges = np.linspace(0, 64, max_bits + 3).astype(int)
    blocks = [(fps >> np.uint64(lo)) & np.uint64((1 << int(hi - lo)) - 1) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    wide = np.uint64(max(np.diff(edges)))
    return [((np.uint64(k) << (wide * np.uint64(2))) | (x << wide) | y).astype(np.int64)
            for k, (x, y) in enumerate(combinations(blocks, 2))]


def links(spark: SparkSession, distinct: DataFrame, max_bits: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints (``fp``, distinct)
    that chains of at most ``max_bits`` differing bits connect."""
    def keyed(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            keys = _keys(fps, max_bits)
            yield pa.record_batch([pa.array(np.concatenate(keys)),
                                   pa.array(np.tile(fps.view(np.int64), len(keys))),
                                   pa.array(np.tile(gray_rank(fps), len(keys)).view(np.int64))],
                                  names=["bucket", "fp", "rank"])

    rows = distinct.select("fp").mapInArrow(keyed, "bucket long, fp long, rank long")
    large = (rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
             .select("bucket", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts")))
    dealt = rows.join(large, "bucket", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda other: F.least(own, other) * F.col("parts") + F.greatest(own, other))
    dealt = dealt.select("bucket", "fp", "rank",
                         F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(cells)).alias("cell"))
    # ranks are unsigned: flip the top bit so that signed order is theirs
    order = F.col("rank").bitwiseXOR(F.lit(-2**63))
    ready = dealt.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", order)

    def joined(batches):
        held = None
        for batch in batches:
            part = [batch.column(c).to_numpy() for c in ("bucket", "cell", "fp")]
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part, strict=True)]
            last = np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from _joined([x[:cut] for x in part], max_bits)
            held = [x[cut:] for x in part]
        if held is not None and len(held[0]):
            yield from _joined(held, max_bits)

    return ready.select("bucket", "cell", "fp").mapInArrow(joined, "a long, b long")


def _joined(part: list[np.ndarray], max_bits: int):
    bucket, cell, fps = part
    new = np.r_[True, (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])]
    group = np.cumsum(new)
    shared = np.bincount(group)[group] > 1
    if not shared.any():
        return
    fps, group = fps[shared].view(np.uint64), group[shared]
    label = GrayIndex(fps, group).forest(max_bits)
    linked = np.flatnonzero(label != np.arange(len(label)))
    signed = fps.view(np.int64)
    yield pa.record_batch([pa.array(signed[linked]), pa.array(signed[label[linked]])], names=["a", "b"])


# ------------------------------------------------------------------ components
def _members(spark: SparkSession, prints: DataFrame, distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` (a row per fp) with its component, the smallest fp in it."""
    found = components(spark, links(spark, prints.select("fp").distinct(), max_bits))
    member = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    return member.withColumn("component", F.coalesce("component", "fp"))


def fingerprint_components(spark: SparkSession, prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component_id) for every distinct fp of ``prints`` (doc_id, fp)."""
    member = _members(spark, prints, prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), max_bits)
    label = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return member.join(label, "component").select("fp", "component_id")


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    prints = stored(spark, fingerprints(docs, shingle), "fingerprints")
    label = fingerprint_components(spark, prints, max_bits)
    return prints.join(label, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` per component: the one with the smallest doc_id (a
    null counts as the largest), of several texts under it one.  Other columns
    pass through whatever their names."""
    names = ("__n1", "__n2")
    docs, restored = neutral(docs, ["doc_id", "text"])
    rows = named(docs)
    prints = stored(spark, fingerprints(rows, shingle, names), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", *names)
    first = prints.groupBy("fp").agg(F.min(row).alias("row"))
    kept = _members(spark, prints, first, max_bits).groupBy("component").agg(F.min("row").alias("row")).select("row.*")
    kept = kept.select(F.col("doc_id").alias("kept_id"), *[F.col(c).alias(f"kept{c}") for c in names])
    same = lambda table: [table["doc_id"].cast("long").eqNullSafe(F.col("kept_id")), *[table[c] == F.col(f"kept{c}") for c in names]]
    copies = prints.groupBy("doc_id", *names).agg(F.count(F.lit(1)).alias("copies"))
    kept = stored(spark, kept.join(copies, same(copies)).select(*kept.columns, "copies"), "kept")
    single, several = kept.where("copies = 1").drop("copies"), kept.where("copies > 1").drop("copies")
    once = rows.join(single, same(rows), "left_semi").drop(*names)
    if several.isEmpty():  # no kept row occurs twice: the texts need not be read again
        return restored(once)
    rest = rows.join(several, same(rows), "left_semi").dropDuplicates(["doc_id", *names]).drop(*names)
    return restored(once.unionByName(rest))
