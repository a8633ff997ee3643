"""Benchmark decontamination by q-gram lemma filtering.

Every stretch of ``WINDOW`` characters of a benchmark item is a window,
wherever it starts (a shorter item is one window).  A document is contaminated
by an item if some stretch of it lies within ``edits`` edit operations of one
of its windows, ``edits`` being a share of the window's length.  So an exact
quote of ``WINDOW`` less that share, 90 characters, is found at any offset,
and shorter ones from longer items are not.  Both sides are compared in lower
case with white space runs as one blank.

The lemma: a stretch within e edits of a window of length m shares at least
m - q + 1 - q*e of its q-grams, and all of them lie on neighbouring diagonals
(document position minus item position).  So shared q-grams are counted in
diagonal bands, each twice the largest budget wide and overlapping the next by
half, bands below the bound are dropped, and what stays is verified by an
alignment confined to the band.

The benchmark is broadcast in blocks of at most ``BLOCK_CHARS`` characters;
a larger one takes several passes.  Documents are read where they lie and
never shuffled.  A long or repetitive text is gone through in stretches of at
most ``MOST_HITS`` shared q-grams, each overlapping the next by an item.

Defined results: null and empty texts are clean; items that are null or have
fewer than ``LEAST_CHARS`` characters are not looked for, as they would mark
clean documents; repeated rows are judged alike, also without a doc_id; an
empty benchmark finds nothing; an empty table gives no row; of columns other
than doc_id and text ``leaks`` sees nothing, and ``decontaminated`` returns
them, whatever their names, as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.shared import neutral, slices

Q = 8
WINDOW, EDIT_SHARE, LEAST_CHARS = 100, 0.1, 40
BLOCK_CHARS = 32 << 20
#: Shared q-grams looked at at once; cells of one alignment step.
MOST_HITS, MOST_CELLS = 4 << 20, 1 << 20
_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)
LEAKS = "doc_id long, item_id long, edits int, start long, windows int"


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``Q`` characters from each position on."""
    h, base = chars.astype(np.uint64) + np.uint64(1), _BASE
    width = 1
    while width < Q:
        if len(h) <= width:
            return h[:0]
        h = h[:-width] * base + h[width:]
        base, width = base * base, 2 * width
    h ^= h >> np.uint64(29)
    return h * _BASE


def budget(length: int) -> int:
    """Edits a window may have: its share, and few enough that at least one
    shared q-gram is due."""
    return max(0, min(math.floor(EDIT_SHARE * length), (length - Q) // Q))


class Probes:
    """The windows of a block of benchmark items and the index of their grams."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(i, plain(t)) for i, t in items if t is not None]
        texts = [(i, t) for i, t in texts if len(t) >= LEAST_CHARS]
        self.ids = [i for i, _ in texts]
        self.chars = [codes(t) for _, t in texts]
        sizes = [min(len(c), WINDOW) for c in self.chars]
        self.windows = [(m, budget(m), m - Q + 1 - Q * budget(m)) for m in sizes]
        self.longest = max(map(len, self.chars), default=0)
        self.step = max((e for _, e, _ in self.windows), default=0) + 1
        self.least = np.array([least for _, _, least in self.windows], np.int64)
        grams = [gram_hashes(c) for c in self.chars]
        flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        pos = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.pos = item[order], pos[order]
        self.grams, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        bits = max(16, min(24, int(np.ceil(np.log2(len(flat) + 1))) + 6))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.grams >> self.shift).astype(np.int64)] = True

    # -------------------------------------------------------------- filtering
    def shared(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, number of the gram) of every q-gram some item has."""
        h = gram_hashes(chars)
        at = np.flatnonzero(self.table[(h >> self.shift).astype(np.int64)])
        gram = np.searchsorted(self.grams, h[at])
        gram[gram == len(self.grams)] = 0
        same = self.grams[gram] == h[at]
        return at[same], gram[same]

    def stretches(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position, item, position in item) of every shared q-gram, in
        stretches that hold about ``MOST_HITS`` and at least an item.  Each
        begins an item before the last one ended, so that a region lies whole
        in one of them."""
        at, gram = self.shared(chars)
        if not len(at):
            return
        n = self.first[gram + 1] - self.first[gram]
        sums = np.cumsum(n)
        back, begin = self.longest + 2 * self.step, 0
        while begin < len(at):
            before = sums[begin] - n[begin]
            end = max(int(np.searchsorted(sums, before + MOST_HITS, side="right")),
                      int(np.searchsorted(at, at[begin] + 2 * back, side="right")))
            end = min(max(end, begin + 1), len(at))
            some, many = gram[begin:end], n[begin:end]
            ends = np.cumsum(many)
            posting = np.arange(ends[-1]) + np.repeat(self.first[some] - (ends - many), many)
            yield np.repeat(at[begin:end], many), self.item[posting], self.pos[posting]
            if end == len(at):
                return
            begin = max(int(np.searchsorted(at, at[end] - back)), begin + 1)

    def regions(self, chars: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
        """(document, item, first diagonal, diagonals, item positions) of each
        run of bands whose shared q-grams reach the item's bound; documents
        start at ``starts``."""
        for at, item, pos in self.stretches(chars):
            doc = np.searchsorted(starts, at, side="right") - 1
            # no diagonal lies further below zero than the longest item is long
            band = (at - pos + self.longest) // self.step
            # one number per (document, item, band); bands of a pair are adjacent
            bands = (self.longest + len(chars)) // self.step + 3
            pair, which = np.unique(doc * len(self.ids) + item, return_inverse=True)
            key = which * bands + band
            order = np.argsort(key, kind="stable")
            key, pos = key[order], pos[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            cells, ends = key[first], np.r_[first[1:], len(key)]
            n = ends - first
            next_to = np.r_[cells[1:] == cells[:-1] + 1, False]
            joined = n + np.where(next_to, np.r_[n[1:], 0], 0)
            # a band that starts one cell before an occupied one is covered by
            # the occupied cell's own band or by the cell before it
            stay = np.flatnonzero(joined >= self.least[pair[cells // bands] % len(self.ids)])
            if not len(stay):
                continue
            new = np.r_[True, (stay[1:] != stay[:-1] + 1) | (cells[stay[1:]] != cells[stay[:-1]] + 1)]
            for run in np.split(stay, np.flatnonzero(new)[1:]):
                a, z = run[0], run[-1]
                last = ends[z + 1] if next_to[z] else ends[z]
                p = pair[cells[a] // bands]
                low = int(cells[a] % bands) * self.step - self.longest
                yield (int(p // len(self.ids)), int(p % len(self.ids)), low, int(cells[z] - cells[a] + 2) * self.step,
                       np.unique(pos[first[a]:last]))

    # -------------------------------------------------------------- verifying
    def leaks(self, texts: list[str | None]) -> dict[tuple[int, int], tuple[int, int, int]]:
        """{(row, item): (fewest edits, start in the compared text, windows
        that reach the bound)}."""
        parts = [codes(plain(t or "")) for t in texts]
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        chars = np.concatenate([x for p in parts for x in (p, np.zeros(1, "<u4"))] or [np.zeros(0, "<u4")])
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, low, width, pos in self.regions(chars, starts) if self.ids else ():
            m, e, least = self.windows[item]
            whole = self.chars[item]
            s = np.arange(len(whole) - m + 1)
            held = np.searchsorted(pos, s + m - Q, side="right") - np.searchsorted(pos, s)
            s, held = s[held >= least], held[held >= least]
            edits, start, seen = out.get((doc, item), (e + 1, 0, 0))
            if edits and len(s):
                found = self._fewest(whole, m, e, s[np.argsort(-held, kind="stable")], parts[doc], low - int(starts[doc]), width)
                edits, start = min((edits, start), found) if seen else found
            if edits <= e:
                out[doc, item] = (edits, start, max(seen, len(s)))
        return out

    def _fewest(self, whole: np.ndarray, m: int, e: int, s: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int]:
        """Fewest edits of the windows that start at ``s``, best first, and
        where in the text; more than ``e`` are not told apart."""
        at = s[:, None] + np.arange(m)
        if width > WINDOW:
            # a repetitive text: the same window at another start is the same
            # everywhere on so many diagonals but for the ends of the region
            _, one = np.unique(whole[at], axis=0, return_index=True)
            low, width = low + int(s.min()) - e, width + int(s.max() - s.min()) + 2 * e
            s, begin = s[np.sort(one)], None
            at = s[:, None] + np.arange(m)
        else:
            begin, width = low + s - e, width + 2 * e
        best = (e + 1, 0)
        some = max(1, MOST_CELLS // width)
        for k in range(0, len(s), some):
            first = np.full(len(s[k:k + some]), low) if begin is None else begin[k:k + some]
            best = min(best, banded(whole[at[k:k + some]], text, first, width))
            if not best[0]:
                break
        return best


def banded(windows: np.ndarray, text: np.ndarray, first: np.ndarray, width: int) -> tuple[int, int]:
    """Fewest edits that turn one of the ``windows`` (a row each) into a
    stretch of ``text`` with the alignment kept on ``width`` diagonals from its
    ``first`` on, and the text position at which the best diagonal starts; one
    more than their length where none has a start."""
    k, m = windows.shape
    far = m + 1
    diagonals = np.arange(width)
    begin = first[:, None] + diagonals
    # a start before the text or after its end is no start
    row = np.where((begin >= 0) & (begin <= len(text)), 0, far)
    # the text with room on either side for whatever diagonal there is
    pad = max(0, -int(first.min()))
    over = max(0, int(first.max()) + width + m - len(text))
    padded = np.concatenate([np.full(pad, -1, np.int64), text.astype(np.int64), np.full(over, -1, np.int64)])
    begin += pad
    edge = np.full((k, 1), far)
    for i in range(m):
        here = padded[begin + i]
        kept = np.where(here >= 0, row + (here != windows[:, i:i + 1]), far)
        skipped = np.concatenate([row[:, 1:], edge], axis=1) + 1
        row = np.minimum(kept, skipped)
        row = np.minimum.accumulate(row - diagonals, axis=1) + diagonals
    w, d = divmod(int(row.argmin()), width)
    return int(row[w, d]), max(0, d + int(first[w]))


# ------------------------------------------------------------------ tables
def probe_blocks(spark: SparkSession, benchmark: DataFrame) -> Iterator:
    """Broadcasts of the benchmark's items, block by block."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    for b in range(blocks):
        items = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        yield spark.sparkContext.broadcast(Probes(sorted((tuple(r) for r in items), key=str)))


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document row and benchmark item found in it: fewest edits,
    where the stretch starts in the compared text, and how many windows reach
    the bound of shared q-grams."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for probes in probe_blocks(spark, benchmark):
        def find(batches, probes=probes):
            for batch in slices(batches):
                ids, found = batch.column("doc_id").to_pylist(), probes.value.leaks(batch.column("text").to_pylist())
                table = [(ids[d], probes.value.ids[i], e, s, w) for (d, i), (e, s, w) in sorted(found.items())]
                cols = list(zip(*table, strict=True)) if table else [[]] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), strict=True)],
                                      names=["doc_id", "item_id", "edits", "start", "windows"])
        part = rows.mapInArrow(find, LEAKS)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which a benchmark item is found."""
    out, restored = neutral(docs, ["text"])
    for probes in probe_blocks(spark, benchmark):
        def keep(batches, probes=probes):
            for batch in slices(batches):
                bad = {d for d, _ in probes.value.leaks(batch.column("text").to_pylist())}
                yield batch.filter(pc.invert(pa.array([i in bad for i in range(batch.num_rows)], pa.bool_())))
        out = out.mapInArrow(keep, out.schema)
    return restored(out)
