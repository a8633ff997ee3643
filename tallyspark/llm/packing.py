"""Sequence packing by concatenate and cut.

Pass one tokenises the documents and stores, per row, its ids and the number
of ids before it in its partition.  One total per partition goes to the
driver, where prefix sums give every partition its global offset.  Pass two
places each document at its global position and cuts at every multiple of the
sequence length.  All sequences but the last are full, so padding is less
than one sequence in all, and no row is shuffled.

Defined results: a null or empty text is the single end-of-text id; repeated
rows are packed as often as they occur; pieces of rows without a doc_id have
none; the order is that of the scan; an empty table packs to nothing.  Columns
other than doc_id and text are not looked at.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.shared import slices, stored

# Fixed value: the split pattern that belongs to the byte-level vocabulary.
SPLIT_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
PIECES = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long,
    sequence_id long, offset long"""
_TOKENS = "part int, doc_id long, before long, doc_tokens long, ids binary"
_MODELS: dict[str, "ByteTokenizer"] = {}


class ByteTokenizer:
    """Ids of a byte-level ``tokenizers`` file.

    Texts in Latin-1 without special strings take the faster ``tiktoken``
    encoder, built from the same file; there both agree id by id.  Any other
    text, or a file of another build, is encoded by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = _fast_encoder(spec)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and _latin(text) and not any(s in text for s in self.special):
            return np.asarray(self.fast.encode_ordinary(text), np.uint32)
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _fast_encoder(spec: dict):
    """A tiktoken encoder for ``spec``, or None if it is not a plain
    byte-level merge list whose ids rise with the merges."""
    import tiktoken
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or model["type"] != "BPE"):
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = model["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in added}
    return tiktoken.Encoding("byte_level", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenizer(path: str) -> ByteTokenizer:
    """The tokenizer of ``path``, loaded once per worker process."""
    if path not in _MODELS:
        _MODELS[path] = ByteTokenizer(path)
    return _MODELS[path]


def token_table(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Pass one: (part, doc_id, before, doc_tokens, ids) per document, stored."""
    def encode(batches):
        encoder, part, before = tokenizer(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids = [np.append(encoder(t or ""), np.uint32(end_id)) for t in batch.column("text").to_pylist()]
            counts = np.array([len(x) for x in ids], np.int64)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.record_batch([
                pa.array(np.full(len(ids), part, np.int32)), batch.column("doc_id"), pa.array(starts),
                pa.array(counts), pa.array([_packed(x) for x in ids], pa.binary())],
                names=["part", "doc_id", "before", "doc_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(spark, rows.mapInArrow(encode, _TOKENS), "tokens")


def _packed(ids: np.ndarray) -> bytes:
    """Two bytes an id where they suffice (led by 2), else four (led by 4)."""
    small = ids.max() < 1 << 16
    return bytes([2 if small else 4]) + ids.astype("<u2" if small else "<u4").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


def _offsets(spark: SparkSession, tokens: DataFrame):
    """Global offset of each partition: a broadcast of one number a partition."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect()
    offsets, at = {}, 0
    for part, n in sorted(map(tuple, totals)):
        offsets[part] = at
        at += n
    return spark.sparkContext.broadcast(offsets)


def pieces(spark: SparkSession, docs: DataFrame, tokenizer_path: str, sequence_tokens: int = 1024,
           end_id: int = 0) -> DataFrame:
    """The pieces of all documents (see ``PIECES``), one row each."""
    tokens = token_table(spark, docs, tokenizer_path, end_id)
    return cut(spark, tokens, sequence_tokens)


def cut(spark: SparkSession, tokens: DataFrame, sequence_tokens: int) -> DataFrame:
    """Pass two: fixed windows over the concatenation, as piece rows."""
    offsets = _offsets(spark, tokens)

    def place(batches):
        for batch in slices(batches, "ids"):
            rows = []
            for part, doc_id, before, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = offsets.value[part] + before
                raw = memoryview(_unpacked(data).tobytes())
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, sequence_tokens)
                    length = min(n - start, sequence_tokens - offset)
                    rows.append((doc_id, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), n,
                                 sequence, offset))
                    start += length
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                  names=[f.split()[0] for f in PIECES.split(",")])

    return tokens.select("part", "doc_id", "before", "doc_tokens", "ids").mapInArrow(place, PIECES)


def sequences(spark: SparkSession, tokens: DataFrame, sequence_tokens: int) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves.

    Windows that lie inside one task's run of rows are cut there; the two
    boundary records a run leaves are joined by sequence_id."""
    offsets = _offsets(spark, tokens)

    def windows(batches):
        held, at = np.zeros(0, "<u4"), None
        for batch in slices(batches, "ids"):
            out = []
            for part, before, data in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "ids")), strict=True):
                here = offsets.value[part] + before
                if at is None or here != at + len(held):
                    if at is not None and len(held):
                        out.append((at, held))
                    held, at = np.zeros(0, "<u4"), here
                held = np.concatenate([held, _unpacked(data)])
                while at // sequence_tokens != (at + len(held)) // sequence_tokens:
                    n = sequence_tokens - at % sequence_tokens
                    out.append((at, held[:n]))
                    held, at = held[n:], at + n
            if out:
                yield _window_rows(out, sequence_tokens)
        if at is not None and len(held):
            yield _window_rows([(at, held)], sequence_tokens)

    rows = tokens.select("part", "before", "ids").mapInArrow(
        windows, "sequence_id long, offset int, ids array<int>")
    whole = rows.where((F.col("offset") == 0) & (F.size("ids") == sequence_tokens)).select("sequence_id", "ids")
    parts = rows.where((F.col("offset") != 0) | (F.size("ids") < sequence_tokens))
    joined = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return whole.unionByName(joined.select("sequence_id", F.flatten("p.ids").alias("ids")))


def _window_rows(out: list, sequence_tokens: int) -> pa.RecordBatch:
    return pa.record_batch([pa.array([at // sequence_tokens for at, _ in out], pa.int64()),
                            pa.array([at % sequence_tokens for at, _ in out], pa.int32()),
                            pa.array([x.astype(np.int32) for _, x in out], pa.list_(pa.int32()))],
                           names=["sequence_id", "offset", "ids"])
