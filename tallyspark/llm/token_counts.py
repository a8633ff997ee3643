"""Token counts by heap-and-linked-list byte-pair merging.

A segment's characters form a doubly linked list; a heap holds its adjacent
pairs that are vocabulary pieces, lowest rank first and leftmost among equals.
Popping a pair merges it, unless one side has changed meanwhile, and pushes
the pairs it forms with its neighbours.  The count is the initial symbols
minus the merges; no ids are produced.  A character outside the vocabulary
counts as its UTF-8 bytes (byte fallback).

No piece joins a character to a following space mark, nor holds a line break,
so merging never crosses those places: a text is cut there and the counts of
its segments added.  Counts of short segments are kept in a table of bounded
size per worker.

Defined results: null and empty texts have no tokens; a long text is counted
segment by segment, and a segment without a place to cut by one heap over its
characters; repeated rows are counted each by itself; an empty table gives no
row.  Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import slices

SPACE = "▁"
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Segments kept per worker, and the longest that is kept.
KEPT_SEGMENTS, KEPT_CHARS = 400_000, 32
_MODELS: dict[str, "PairMerger"] = {}


class PairMerger:
    """Counts the tokens of one SentencePiece BPE vocabulary."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        order = sorted(ids, key=lambda i: (-model.get_score(i), i))
        self.rank = {model.id_to_piece(i): r for r, i in enumerate(order)}
        probe = " ﬁ  AＡ\tx éé "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the vocabulary rewrites characters before merging")
        cuts = "" if any("\n" in p for p in self.rank) else "\n"
        inner = any(SPACE in p.lstrip(SPACE) for p in self.rank)
        pattern = f"{SPACE}+[^{SPACE}{cuts}]*|[^{SPACE}{cuts}]+" + (f"|{cuts}" if cuts else "")
        self.segments = (lambda t: [t]) if inner else re.compile(pattern).findall
        self.kept = _Kept(self)

    def weight(self, char: str) -> int:
        return 1 if char in self.rank else len(char.encode())

    def count_segment(self, text: str) -> int:
        rank, symbols = self.rank, list(text)
        n = len(symbols)
        weights = [self.weight(c) for c in symbols]
        total = sum(weights)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(symbols[i] + symbols[i + 1])
            if r is not None:
                heap.append((r, i, symbols[i] + symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = after[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != piece:
                continue
            total -= weights[i] + weights[j] - 1
            symbols[i], symbols[j], weights[i] = piece, "", 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                r = rank.get(piece + symbols[after[i]])
                if r is not None:
                    heapq.heappush(heap, (r, i, piece + symbols[after[i]]))
            h = before[i]
            if h >= 0:
                r = rank.get(symbols[h] + piece)
                if r is not None:
                    heapq.heappush(heap, (r, h, symbols[h] + piece))
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.kept.__getitem__, self.segments(SPACE + text.replace(" ", SPACE))))


class _Kept(dict):
    """Counts of segments met before."""

    def __init__(self, merger: PairMerger):
        self.merger = merger

    def __missing__(self, segment: str) -> int:
        n = self.merger.count_segment(segment)
        if len(segment) <= KEPT_CHARS:
            if len(self) >= KEPT_SEGMENTS:
                self.clear()
            self[segment] = n
        return n


def merger(path: str) -> PairMerger:
    """The merger of ``path``, loaded once per worker process."""
    if path not in _MODELS:
        _MODELS[path] = PairMerger(path)
    return _MODELS[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``."""
    def count(batches):
        counter = merger(model_path)
        for batch in slices(batches):
            text = batch.column("text")
            n = pa.array([counter.count(t or "") for t in text.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.record_batch([batch.column("doc_id"), size, n, pc.greater(n, limit)],
                                  names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, COUNTS)
