"""Prefix tries of conversations and their subtree totals.

Every distinct sequence of first turns is a node.  Turns get their place in
the conversation and the name of the prefix they end in one sorted pass: rows
are dealt by ranges of (conversation, turn), so a conversation of any length
spans as many tasks as it needs.  A prefix name is a polynomial in the digests
of its turns modulo 2**127 - 1; a task works out its part of the polynomial
without what comes before, and one row per task, combined on the driver, says
what the part continues.

Subtree totals come from parallel tree contraction.  Each phase

* compresses every unary chain by pointer jumping: in each join round all
  chain nodes jump as far again as they have come, until they point at the
  leaf or branching node that ends their chain;
* rakes every leaf, with the chain above it, into the next branching node.

A phase at least halves the leaves, so phases and rounds are logarithmic in
the tree's size whatever its shape.  Then phases are undone in reverse: the
end of a chain has its total by then, and every node of the chain takes it up
by one join.  Each round is a table in the shared folder; only numbers of
nodes reach the driver.

Defined results: turns go by ``turn`` (null first); turns with one number go
by the SHA-256 of role and text; null roles and texts are empty; repeated rows
are turns of their own; rows without a conv_id belong to no conversation; an
empty table has no nodes.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.shared import stored

#: Prefix names are numbers below this prime, written in 16 bytes.
MODULUS = 2**127 - 1
_BASE = int.from_bytes(hashlib.sha256(b"base").digest(), "big") % MODULUS
_ROOT = int.from_bytes(hashlib.sha256(b"root").digest(), "big") % MODULUS
#: Bytes of conversation numbers in one piece of what a node's hash is made of.
PIECE_BYTES = 1 << 16


def _name(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _number(name: bytes) -> int:
    return int.from_bytes(name, "big")


def _root() -> Column:
    return F.lit(_name(_ROOT))


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def digest(role: Column, text: Column) -> Column:
    """32 bytes for the content of a turn."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


# ------------------------------------------------------------------ prefix names
_LOCAL = "part int, conv long, pos long, name binary, before binary, size long, open boolean"


def _local_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix name of each turn of one sorted task.  Those of the
    task's first conversation are ``open``: they count from the task's start,
    with nothing before it."""
    part, conv, pos, value, first = TaskContext.get().partitionId(), None, 0, 0, None
    for batch in batches:
        out: list[tuple] = []
        for c, x, size in zip(batch.column("conv").to_pylist(), batch.column("digest").to_pylist(),
                              batch.column("size").to_pylist(), strict=True):
            if c != conv:
                first = c if conv is None else first
                conv, pos, value = c, 0, 0 if c == first else _ROOT
            before, pos = value, pos + 1
            value = (value * _BASE + _number(x)) % MODULUS
            out.append((part, c, pos, _name(value), _name(before), size, c == first))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
            zip(*out, strict=True) if out else [()] * 7,
            (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()), strict=True)],
            ["part", "conv", "pos", "name", "before", "size", "open"])


def _starts(ends: list) -> dict[int, tuple[int, int]]:
    """For each task the place and the prefix name that its first
    conversation goes on from."""
    starts, conv, pos, value = {}, None, 0, _ROOT
    for r in sorted(ends, key=lambda r: r.part):
        starts[r.part] = (pos, value) if r.first == conv else (0, _ROOT)
        before, at = starts[r.part]
        conv, pos, value = r.last.conv, r.last.pos, _number(r.last.name)
        if r.last.open:
            pos, value = before + pos, (at * pow(_BASE, pos, MODULUS) + value) % MODULUS
    return starts


def _continued(starts: dict[int, tuple[int, int]]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, conv, pos, name, before, size, is_open in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if is_open:
                    offset, value = starts[part]
                    power = pow(_BASE, pos - 1, MODULUS)
                    before = _name((value * power + _number(before)) % MODULUS)
                    name = _name((value * power * _BASE + _number(name)) % MODULUS)
                    pos += offset
                rows.append((conv, pos, name, before, size))
            yield _turn_batch(rows)
    return run


def _turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    columns = zip(*rows, strict=True) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)],
                                      ["conv", "pos", "name", "before", "size"])


def named_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(conv, pos, name, before, size) per turn: its place from 1, the names
    of the prefixes that end with it and before it, its code points; stored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        digest(role, text).alias("digest"), F.length(text).cast("long").alias("size"))
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("digest")]
    dealt = rows.repartitionByRange(_parts(spark), *order).sortWithinPartitions(*order)
    local = stored(spark, dealt.select("conv", "digest", "size").mapInArrow(_local_names, _LOCAL), "turns-local")
    ends = local.groupBy("part").agg(
        F.min("conv").alias("first"), F.max(F.struct("conv", "pos", "name", "open")).alias("last")).collect()
    turns = local.mapInArrow(_continued(_starts(ends)), "conv long, pos long, name binary, before binary, size long")
    return stored(spark, turns, "turns")


def members(turns: DataFrame) -> DataFrame:
    """(name, before, depth, conv, size, ends) for every prefix of every
    conversation, the textless root included; ``ends`` where the conversation
    does."""
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("length"))
    own = turns.join(lengths, "conv").select(
        "name", "before", F.col("pos").alias("depth"), "conv", "size", (F.col("pos") == F.col("length")).alias("ends"))
    return own.unionByName(_at_root(lengths, F.lit(False)))


def _at_root(convs: DataFrame, ends: Column) -> DataFrame:
    return convs.select(_root().alias("name"), F.lit(None).cast("binary").alias("before"), F.lit(0).cast("long").alias("depth"),
                        "conv", F.lit(0).cast("long").alias("size"), ends.alias("ends"))


# ------------------------------------------------------------------ branching
def _shifted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns moved from behind one prefix to behind another.  ``name`` minus
    what its old prefix contributes, plus the new one's contribution."""
    for batch in batches:
        rows = []
        for conv, pos, name, before, size, cut, old, taken, new in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if old != new:
                power, by = pow(_BASE, pos - cut - 1, MODULUS), _number(new) - _number(old)
                before = _name((_number(before) + by * power) % MODULUS)
                name = _name((_number(name) + by * power * _BASE) % MODULUS)
            rows.append((conv, taken + pos - cut, name, before, size))
        yield _turn_batch(rows)


def branched(spark: SparkSession, turns: DataFrame, share: int = 100, most: int = 6) -> DataFrame:
    """``members`` of the rebuilt conversations: c gets the first h turns of
    conversation c - c % share in place of its own first h, with h = crc32(c)
    % most.  Only the first ``most`` - 1 turns of a conversation are ever
    gathered."""
    head = F.when(F.col("pos") < most, F.struct("pos", "name", "before", "size"))
    heads = stored(spark, turns.groupBy("conv").agg(F.max("pos").alias("length"), F.sort_array(F.collect_list(head)).alias("head")),
                   "conversation-heads")
    base = heads.select(F.col("conv").alias("base"), F.col("head").alias("shared"))
    cut = (F.crc32(F.col("conv").cast("string")) % most).cast("int")
    plans = heads.withColumn("base", F.col("conv") - F.col("conv") % share).join(base, "base", "left").select(
        "conv", "length", "head", cut.alias("cut"), F.slice(F.coalesce("shared", F.slice("head", 1, 0)), F.lit(1), cut).alias("shared"))
    end_of = lambda a: F.coalesce(F.element_at(F.when(F.size(a) > 0, F.col(a)), -1)["name"], _root())
    plans = plans.withColumn("head", F.slice("head", F.lit(1), F.col("cut"))).select(
        "conv", "length", "cut", "shared", end_of("head").alias("old"), F.size("shared").cast("long").alias("taken"), end_of("shared").alias("new"))
    plans = stored(spark, plans, "conversation-plans")
    stops = F.col("length") <= F.col("cut")
    shared = plans.select("conv", "taken", stops.alias("stops"), F.explode("shared").alias("t")).select(
        "t.name", "t.before", F.col("t.pos").alias("depth"), "conv", "t.size", (F.col("stops") & (F.col("t.pos") == F.col("taken"))).alias("ends"))
    moved = turns.join(plans.select("conv", "cut", "old", "taken", "new"), "conv").where("pos > cut").select(
        "conv", "pos", "name", "before", "size", "cut", "old", "taken", "new")
    moved = moved.mapInArrow(_shifted, "conv long, pos long, name binary, before binary, size long")
    last = plans.select("conv", (F.col("taken") + F.col("length") - F.col("cut")).alias("last"))
    own = moved.join(last, "conv").select(
        "name", "before", F.col("pos").alias("depth"), "conv", "size", (F.col("pos") == F.col("last")).alias("ends"))
    return own.unionByName(shared).unionByName(_at_root(plans, stops & (F.col("taken") == 0)))


# ------------------------------------------------------------------ contraction
def _plus(values: list[str], a: str, b: str) -> list[Column]:
    return [(F.col(f"{a}{v}") + F.coalesce(F.col(f"{b}{v}"), F.lit(0))).alias(v) for v in values]


def _compressed(spark: SparkSession, unary: DataFrame, values: list[str]) -> list[DataFrame]:
    """(node, to, values): for each unary node the end of its chain and the
    sum from the node down to, without, that end.

    Nodes that still point at a unary node point at different ones, so no key
    of these joins is hot."""
    targets = unary.select(F.col("node").alias("to"), F.lit(True).alias("more"))
    moving = unary.select("node", F.col("only").alias("to"), *[F.col(f"path_{v}").alias(v) for v in values])
    moving = stored(spark, moving.join(targets, "to", "left").withColumn("more", F.coalesce("more", F.lit(False))), "chains")
    settled = [moving.where("NOT more")]
    moving = moving.where("more")
    while moving.count():
        there = moving
        for part in settled:
            there = there.unionByName(part)
        there = there.select(F.col("node").alias("to"), F.col("to").alias("beyond"), F.col("more").alias("further"),
                             *[F.col(v).alias(f"there_{v}") for v in values])
        here = moving.select("node", "to", *[F.col(v).alias(f"here_{v}") for v in values])
        jumped = stored(spark, here.join(there, "to").select(
            "node", F.col("beyond").alias("to"), *_plus(values, "here_", "there_"), F.col("further").alias("more")), "chains")
        settled.append(jumped.where("NOT more"))
        moving = jumped.where("more")
    return [part.drop("more") for part in settled]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def subtree_totals(spark: SparkSession, tree: DataFrame, values: list[str]) -> DataFrame:
    """(node, values): each node's sum over its subtree, itself included.

    ``tree`` has node, parent (null at a root) and long ``values``; it may be
    a forest."""
    zeros = {f"edge_{v}": F.lit(0).cast("long") for v in values}
    live = tree.select("node", "parent", *values).withColumns(zeros)
    phases: list[tuple[DataFrame, list[DataFrame]]] = []
    while True:
        # edge_v: what compressed nodes between a node and its parent add
        kids = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count(F.lit(1)).alias("kids"), F.min("node").alias("only"), *[F.sum(f"edge_{v}").alias(f"below_{v}") for v in values])
        shape = stored(spark, live.join(kids, "node", "left").withColumns(
            {"kids": F.coalesce("kids", F.lit(0))} | {f"path_{v}": F.col(v) + F.col(f"below_{v}") for v in values}), "tree")
        leaves, unary = shape.where("kids = 0"), shape.where("kids = 1")
        n_unary, n_branching = shape.agg(F.count_if(F.col("kids") == 1), F.count_if(F.col("kids") > 1)).first()
        chains = _compressed(spark, unary, values) if n_unary else []
        phases.append((leaves.select("node", *values), chains))
        if not n_branching:
            break
        rest = shape.where("kids != 1").select("node", "parent", "kids", *values, *zeros)
        if chains:
            # a chain's top is nobody's only child on a chain
            tops = unary.join(unary.select(F.col("only").alias("node")), "node", "left_anti")
            tops = tops.select("node", F.col("parent").alias("above"), *[F.col(f"edge_{v}").alias(f"over_{v}") for v in values])
            tops = _union(chains).select("node", "to", *[F.col(v).alias(f"chain_{v}") for v in values]).join(tops, "node")
            tops = tops.select(F.col("to").alias("node"), "above", F.lit(True).alias("hangs"),
                               *[(F.col(f"chain_{v}") + F.col(f"over_{v}")).alias(f"new_{v}") for v in values])
            rest = rest.join(tops, "node", "left").select(
                "node", F.when(F.col("hangs"), F.col("above")).otherwise(F.col("parent")).alias("parent"), "kids", *values,
                *[F.when(F.col("hangs"), F.col(f"new_{v}")).otherwise(F.col(f"edge_{v}")).alias(f"edge_{v}") for v in values])
        rest = stored(spark, rest, "tree-ends")
        raked = rest.where("kids = 0 AND parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.col(v) + F.col(f"edge_{v}")).alias(f"raked_{v}") for v in values])
        live = rest.where("kids > 1").join(raked, "node", "left").select(
            "node", "parent", *_plus(values, "", "raked_"), *zeros)
    solved: list[DataFrame] = []
    for leaves, chains in reversed(phases):
        solved.append(leaves)
        if chains:
            ends = _union(solved).select(F.col("node").alias("to"), *[F.col(v).alias(f"end_{v}") for v in values])
            here = _union(chains).select("node", "to", *[F.col(v).alias(f"here_{v}") for v in values])
            solved.append(stored(spark, here.join(ends, "to").select("node", *_plus(values, "here_", "end_")), "totals"))
    return _union(solved)


# ------------------------------------------------------------------ hashes of ends
def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring conversation numbers of a node as text, a piece at a
    time."""
    node, first, held, size = None, None, [], 0
    done: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [()] * 3
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                           pa.array(columns[2], pa.string())], ["node", "first", "ids"])
    for batch in batches:
        for n, c in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if held and (n != node or size >= PIECE_BYTES):
                done.append((node, first, ",".join(held)))
                held, size = [], 0
            if not held:
                node, first = n, c
            held.append(str(c))
            size += len(held[-1]) + 1
        if done:
            yield batch_of()
    if held:
        done.append((node, first, ",".join(held)))
    yield batch_of()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state, done = None, None, []

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [(), ()]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], ["node", "sha"])
    for batch in batches:
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if n == node:
                state.update(b",")
            else:
                if state:
                    done.append((node, state.hexdigest()))
                node, state = n, hashlib.sha256()
            state.update(ids.encode())
        yield batch_of()
    if state:
        done.append((node, state.hexdigest()))
    yield batch_of()


def joined_hashes(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """(node, sha): SHA-256 of each node's conversation numbers, ascending and
    comma-joined.  A hash is made in one stream, so a node's numbers are first
    joined, wherever they lie, into pieces of text and only these are brought
    together, one piece in memory at a time."""
    order = [F.asc("node"), F.asc("conv")]
    pieces = ends.select("node", "conv").repartitionByRange(_parts(spark), *order).sortWithinPartitions(*order).mapInArrow(
        _pieces, "node long, first long, ids string")
    return pieces.repartition(_parts(spark), "node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(
        _hashed, "node long, sha string")


# ------------------------------------------------------------------ the trie
def trie(spark: SparkSession, prefixes: DataFrame) -> DataFrame:
    """One row per node of the trie of ``members``: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    prefixes = stored(spark, prefixes, "prefixes")
    nodes = prefixes.groupBy("name").agg(
        F.min("before").alias("before"), F.min("depth").alias("depth"), F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("size").alias("size"), F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv"))).alias("end"))
    nodes = stored(spark, nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    kids = nodes.where("before IS NOT NULL").groupBy(F.col("before").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(kids, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    above = nodes.select(F.col("name").alias("before"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = stored(spark, nodes.join(above, "before", "left").withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("size")}), "trie")
    totals = subtree_totals(spark, nodes, ["n_leaves", "saved_tokens"])
    several = nodes.where("n_ends > 1").select("name", "node")
    hashes = joined_hashes(spark, prefixes.where("ends").select("name", "conv").join(several, "name"))
    few = F.sha2(F.coalesce(F.col("end").cast("string"), F.lit("")), 256)
    return nodes.drop("n_leaves", "saved_tokens").join(totals, "node").join(hashes, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", few).alias("ends_sha256"))
