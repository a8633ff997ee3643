"""Language identification with a bidirectional gated recurrent network.

The network reads bytes in both directions, labels every position with a
distribution over the learned languages and pools the positions of a document
by their mean.  It is trained in numpy by backpropagation through time on
windows drawn from a bounded sample of labelled documents: ``SAMPLE_DOCS`` a
language at most, ``WINDOWS`` windows each, picked by hash, so the same rows
give the same model.  Whole texts are read: a text is laid out as lanes of
``LANE`` bytes, each starting from the zero state, many lanes at once.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is every text if nothing could be learned.  Repeated rows get the same
answer.  A null doc_id counts as the empty string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.shared import neutral, slices

UNDETERMINED = "und"
#: Bound of the sample the network is fitted on.
SAMPLE_DOCS, WINDOWS, WINDOW = 400, 6, 48
HIDDEN, STEPS, BATCH, RATE = 8, 220, 192, 0.02
LANE, LANES = 128, 2048
#: A document whose best language has less is of none of them.
LEAST_SCORE = 0.4
PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """Two byte GRUs, one per direction, and a shared output layer.

    A direction has ``table`` (3H x 256: update, reset and candidate inputs of
    each byte) and ``recur`` (3H x H).  Arrays keep lanes in the last axis."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.languages = languages
        self.weights = {"table0": draw(3 * h, 256, scale=0.3), "table1": draw(3 * h, 256, scale=0.3),
                        "recur0": draw(3 * h, h, scale=0.3), "recur1": draw(3 * h, h, scale=0.3),
                        "out": draw(len(languages), 2 * h, scale=0.3),
                        "bias": np.zeros((len(languages), 1), np.float32)}

    # -------------------------------------------------------------- inference
    def _states(self, lanes: np.ndarray, direction: int, used: np.ndarray):
        """Hidden states step by step; lanes is (steps, lanes) bytes, of which
        the first ``used`` count: the backward state starts from zero there."""
        h, n = HIDDEN, lanes.shape[1]
        table, recur = self.weights[f"table{direction}"], self.weights[f"recur{direction}"]
        state, inputs = np.zeros((h, n), np.float32), np.empty((3 * h, n), np.float32)
        back, shortest = np.empty((3 * h, n), np.float32), used.min()
        for t in range(len(lanes)) if direction == 0 else reversed(range(len(lanes))):
            np.take(table, lanes[t], axis=1, out=inputs, mode="clip")
            np.matmul(recur, state, out=back)
            gates = inputs[:2 * h]
            gates += back[:2 * h]
            _sigmoid(gates)
            candidate = inputs[2 * h:]
            back[2 * h:] *= gates[h:]
            candidate += back[2 * h:]
            np.tanh(candidate, out=candidate)
            state -= candidate
            state *= gates[:h]
            state += candidate
            if direction == 1 and t >= shortest:
                state *= t < used
            yield t, state

    def positions(self, lanes: np.ndarray, used: np.ndarray | None = None) -> np.ndarray:
        """(steps, languages, lanes): the distribution at every position."""
        h = HIDDEN
        used = np.full(lanes.shape[1], len(lanes)) if used is None else used
        scores = np.empty((len(lanes), len(self.languages), lanes.shape[1]), np.float32)
        for t, state in self._states(lanes, 0, used):
            np.matmul(self.weights["out"][:, :h], state, out=scores[t])
        for t, state in self._states(lanes, 1, used):
            s = scores[t]
            s += self.weights["out"][:, h:] @ state
            s += self.weights["bias"]
            s -= s.max(axis=0)
            np.exp(s, out=s)
            s /= s.sum(axis=0)
        return scores

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): mean distribution over each text's positions."""
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = -(-sizes // LANE)
        grid = np.full((int(counts.sum()), LANE), 32, np.uint8)
        first, flat = np.cumsum(counts) - counts, grid.reshape(-1)
        for t, at in zip(texts, first, strict=True):
            flat[at * LANE:at * LANE + len(t)] = np.frombuffer(t, np.uint8)
        owner = np.repeat(np.arange(len(texts)), counts)
        used = np.minimum(sizes[owner] - (np.arange(len(grid)) - first[owner]) * LANE, LANE)
        total = np.zeros((len(texts), len(self.languages)))
        steps = np.arange(LANE)[:, None]
        for at in range(0, len(grid), LANES):
            part = slice(at, at + LANES)
            probs = self.positions(np.ascontiguousarray(grid[part].T), used[part])
            probs *= (steps < used[part])[:, None, :]
            np.add.at(total, owner[part], probs.sum(axis=0).T)
        return total / np.maximum(sizes, 1)[:, None]

    # -------------------------------------------------------------- training
    def _forward(self, x: np.ndarray, direction: int):
        h, w = HIDDEN, self.weights
        state, kept = np.zeros((h, x.shape[1]), np.float32), {}
        for t in range(len(x)) if direction == 0 else reversed(range(len(x))):
            a, g = w[f"table{direction}"][:, x[t]], w[f"recur{direction}"] @ state
            gates = _sigmoid(a[:2 * h] + g[:2 * h])
            z, r = gates[:h], gates[h:]
            c = np.tanh(a[2 * h:] + r * g[2 * h:])
            new = c + z * (state - c)
            kept[t] = (state, z, r, c, g[2 * h:], new)
            state = new
        return kept

    def _backward(self, x, kept, direction, dstates, grads):
        """Backpropagation through time of one direction."""
        h, recur = HIDDEN, self.weights[f"recur{direction}"]
        carry = np.zeros_like(dstates[0])
        inner = np.empty((len(x), 3 * h, x.shape[1]), np.float32)
        drecur = np.zeros_like(recur)
        for t in reversed(range(len(x))) if direction == 0 else range(len(x)):
            state, z, r, c, gc, _ = kept[t]
            dh = dstates[t] + carry
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (state - c) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            inner[t] = np.concatenate([dz, dr, dc])
            dg = np.concatenate([dz, dr, dc * r])
            drecur += dg @ state.T
            carry = dh * z + recur.T @ dg
        hot = np.zeros((x.size, 256), np.float32)
        hot[np.arange(x.size), x.reshape(-1)] = 1
        grads[f"table{direction}"] = inner.transpose(1, 0, 2).reshape(3 * h, -1) @ hot
        grads[f"recur{direction}"] = drecur

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over all positions and its gradients; x is
        (steps, lanes) bytes, y the language of each lane."""
        h, w = HIDDEN, self.weights
        kept = [self._forward(x, d) for d in (0, 1)]
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        dstates = np.empty((2, len(x), h, x.shape[1]), np.float32)
        loss, lanes = 0.0, np.arange(x.shape[1])
        for t in range(len(x)):
            both = np.concatenate([kept[0][t][5], kept[1][t][5]])
            s = w["out"] @ both + w["bias"]
            p = np.exp(s - s.max(axis=0))
            p /= p.sum(axis=0)
            loss -= np.log(p[y, lanes] + 1e-12).sum()
            p[y, lanes] -= 1
            p /= x.size
            grads["out"] += p @ both.T
            grads["bias"] += p.sum(axis=1, keepdims=True)
            back = w["out"].T @ p
            dstates[0, t], dstates[1, t] = back[:h], back[h:]
        for d in (0, 1):
            self._backward(x, kept[d], d, dstates[d], grads)
        return loss / x.size, grads

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 7) -> "Network":
        """Adam over random batches with the same share for each language."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(x) for k, x in self.weights.items()}
        by = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        for step in range(1, STEPS + 1):
            pick = np.concatenate([rng.choice(rows, max(1, BATCH // len(by))) for rows in by])
            _, grads = self.gradients(np.ascontiguousarray(windows[pick].T), labels[pick])
            rate = RATE * (1 - (step - 1) / STEPS)
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.weights[k] -= (rate * m[k] / (1 - 0.9**step)
                                    / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


# ------------------------------------------------------------------ tables
def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, (n, WINDOW) bytes and labels of the fitting sample."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    data, size = F.col("text").cast("binary"), F.octet_length("text")
    spots = [F.pmod(F.xxhash64("doc_id", "text", F.lit(k)), F.greatest(size - WINDOW + 1, F.lit(1))) for k in range(WINDOWS)]
    # the share of a language's rows whose hash falls below its rate
    draw, rate = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)), F.lit(0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, int(min(1.0, 1.5 * SAMPLE_DOCS / n) * (1 << 20))).otherwise(rate)
    picked = rows.where(draw < rate).select("lang", draw.alias("draw"), F.array(
        *[F.substring(data, (s + 1).cast("int"), F.lit(WINDOW)) for s in spots]).alias("windows")).collect()
    windows, labels, taken = [], [], dict.fromkeys(languages, 0)
    for r in sorted(picked, key=lambda r: (r.lang, r.draw, r.windows)):
        if taken[r.lang] < SAMPLE_DOCS:
            taken[r.lang] += 1
            # a shorter text repeats itself
            windows += [np.resize(np.frombuffer(w, np.uint8), WINDOW) for w in r.windows]
            labels += [languages.index(r.lang)] * WINDOWS
    return languages, np.array(windows, np.uint8).reshape(-1, WINDOW), np.array(labels)


def train(docs: DataFrame) -> Network | None:
    """The network for ``docs`` (doc_id, text, lang); None without labels."""
    languages, windows, labels = sample(docs)
    have = sorted(set(labels.tolist()))
    if not have:
        return None
    return Network([languages[k] for k in have]).fit(windows, np.searchsorted(have, labels))


def predict(spark: SparkSession, docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row, from the texts alone."""
    shared = spark.sparkContext.broadcast(network)

    def label(batches):
        net = shared.value
        for batch in slices(batches):
            usable = [net is not None and bool(x) for x in batch.column("letters").to_pylist()]
            langs, scores = np.full(len(usable), UNDETERMINED, object), np.zeros(len(usable))
            rows = np.flatnonzero(usable)
            if len(rows):
                texts = batch.column("text").take(pa.array(rows)).cast(pa.binary()).to_pylist()
                probs = net.pooled(texts)
                best = probs.argmax(axis=1)
                langs[rows] = [net.languages[k] for k in best]
                scores[rows] = np.clip(probs[np.arange(len(rows)), best], 0, 1)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                                   pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text.alias("text"),
                       text.rlike(r"\p{L}").alias("letters"))
    return rows.mapInArrow(label, PREDICTIONS)


def accepted(spark: SparkSession, docs: DataFrame, network: Network | None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` with a determined language scored ``least`` or
    more; without a network, those with a letter.  Other columns pass through
    whatever their names."""
    shared = spark.sparkContext.broadcast(network)

    def keep(batches):
        net = shared.value
        for batch in slices(batches):
            usable = np.array([bool(x) for x in batch.column("__letters").to_pylist()], bool)
            rows = np.flatnonzero(usable)
            if net is not None and len(rows):
                texts = batch.column("text").take(pa.array(rows)).cast(pa.binary()).to_pylist()
                usable[rows] = net.pooled(texts).max(axis=1) >= least
            yield batch.drop_columns(["__letters"]).filter(pa.array(usable))

    rows, restored = neutral(docs, ["text"])
    letters = F.col("text").rlike(r"\p{L}").alias("__letters")
    return restored(rows.select("*", letters).mapInArrow(keep, rows.schema))


def language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return predict(spark, docs, train(docs))
