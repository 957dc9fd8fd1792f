"""Quality classifier: a byte-level convolutional network in numpy (operator 10).

Network, for the UTF-8 bytes of a whole text:

* FILTERS learned filters, each WIDTH bytes wide.  Bytes are one-hot, so a
  filter is a weight per (offset, byte) and the convolution is WIDTH table
  look-ups per position, at every position of the text.
* Max-pooling over overlapping chunks: two SEGMENT-byte segments each,
  starting at every segment, so that the chunks cover the whole document.
* A small dense layer per chunk, whose units are max-pooled over all chunks,
  and a logistic output.

The score is the probability of quality 1.  Texts are read in blocks, so
memory does not grow with their length.

Fitting uses a bounded sample of labelled rows (``max_rows`` rows of at most
``max_bytes`` bytes each, by hash order, so it does not depend on
partitioning), Adam and class weights, on the driver; a sixth of it is kept
back to centre the output.  Scoring covers every document.  Only text bytes enter a score.

Defined results: null and empty texts are scored as zero bytes; without
labelled rows, or with labels of one class only, every score is that class's
share (0.5 without any); repeated rows score alike; an empty table gives an
empty table."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import appended, small_batches, with_columns

FILTERS = 16
WIDTH = 8
SEGMENT = 128
HIDDEN = 16
MAX_ROWS = 8000
MAX_BYTES = 32768
EPOCHS = 14
_BLOCK_SEGMENTS = 64


class ByteCnn:
    def __init__(self, seed: int = 11, filters: int = FILTERS, width: int = WIDTH, segment: int = SEGMENT,
                 hidden: int = HIDDEN):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.segment, self.width = segment, width
        self.constant: float | None = None
        self.p = {"table": rng.normal(0, 0.3, (width, 256, filters)).astype(np.float32),
                  "w1": rng.normal(0, 0.3, (filters + 1, hidden)).astype(np.float32),
                  "b1": np.zeros(hidden, np.float32),
                  "w2": rng.normal(0, 0.3, hidden).astype(np.float32),
                  "b2": np.zeros(1, np.float32)}

    # -- forward ----------------------------------------------------------
    def _padded(self, data: bytes) -> tuple[np.ndarray, int, int]:
        n = max(1, len(data))
        segments = -(-n // self.segment)
        buf = np.zeros(segments * self.segment + self.width - 1, np.uint8)
        buf[:len(data)] = np.frombuffer(data, np.uint8)
        return buf, n, segments

    def segment_maxima(self, data: bytes, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum of each filter in each segment (and its position)."""
        buf, n, segments = self._padded(data)
        table = self.p["table"]
        out = np.empty((segments, table.shape[2]), np.float32)
        at = np.empty(out.shape, np.int64) if where else None
        for s in range(0, segments, _BLOCK_SEGMENTS):
            e = min(segments, s + _BLOCK_SEGMENTS)
            lo, hi = s * self.segment, e * self.segment
            acc = table[0].take(buf[lo:hi], axis=0)
            for k in range(1, self.width):
                acc += table[k].take(buf[lo + k:hi + k], axis=0)
            if n < hi:
                acc[n - lo:] = -np.inf
            acc = acc.reshape(e - s, self.segment, -1)
            if where:
                best = acc.argmax(axis=1)
                at[s:e] = best + np.arange(lo, hi, self.segment)[:, None]
                out[s:e] = np.take_along_axis(acc, best[:, None, :], axis=1)[:, 0]
            else:
                out[s:e] = acc.max(axis=1)
        return out, at

    def _fill(self, n: int, chunks: int) -> np.ndarray:
        """How full each chunk is (its share of bytes that are text)."""
        begin = np.arange(chunks) * self.segment
        return np.minimum(1.0, (n - begin) / (2 * self.segment)).astype(np.float32)

    def _chunks(self, seg: np.ndarray, n: int) -> np.ndarray:
        pooled = np.maximum(seg[:-1], seg[1:]) if len(seg) > 1 else seg
        return np.concatenate([pooled, self._fill(max(1, n), len(pooled))[:, None]], axis=1)

    def logit(self, data: bytes) -> float:
        seg, _ = self.segment_maxima(data)
        z = np.maximum(self._chunks(seg, len(data)) @ self.p["w1"] + self.p["b1"], 0).max(axis=0)
        return float(z @ self.p["w2"] + self.p["b2"][0])

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        return 1.0 / (1.0 + np.exp(-np.clip(self.logit(text.encode()), -30, 30)))

    # -- fitting ----------------------------------------------------------
    def _gradient(self, data: bytes, label: float, weight: float, grad: dict) -> None:
        seg, at = self.segment_maxima(data, where=True)
        x = self._chunks(seg, len(data))
        pre = x @ self.p["w1"] + self.p["b1"]
        top = pre.argmax(axis=0)
        units = np.arange(pre.shape[1])
        h = np.maximum(pre[top, units], 0)
        p = 1.0 / (1.0 + np.exp(-np.clip(h @ self.p["w2"] + self.p["b2"][0], -30, 30)))
        d = np.float32(weight * (p - label))
        grad["w2"] += d * h
        grad["b2"] += d
        dh = d * self.p["w2"] * (h > 0)
        grad["b1"] += dh
        np.add.at(grad["w1"].T, units, dh[:, None] * x[top])
        dx = np.zeros_like(x)
        np.add.at(dx, top, dh[:, None] * self.p["w1"].T)
        chunk, flt = np.nonzero(dx[:, :-1])
        if not len(chunk):
            return
        source = chunk
        if len(seg) > 1:
            source = chunk + (seg[chunk + 1, flt] > seg[chunk, flt])
        buf, _, _ = self._padded(data)
        pos, value = at[source, flt], dx[chunk, flt]
        for k in range(self.width):
            np.add.at(grad["table"][k], (buf[pos + k], flt), value)

    def fit(self, texts: list[str], labels: list[int], epochs: int = EPOCHS, batch: int = 24, rate: float = 0.01,
            seed: int = 3) -> ByteCnn:
        y = np.asarray(labels, np.float64)
        if len(set(labels)) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        data = [t.encode() for t in texts]
        rest, data = data[:len(data) // 6], data[len(data) // 6:]
        y_rest, y = y[:len(rest)], y[len(rest):]
        if y.min() == y.max():
            rest, data, y = [], rest + data, np.concatenate([y_rest, y])
        share = y.mean()
        weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
        rng = np.random.Generator(np.random.PCG64(seed))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, total = 0, epochs * -(-len(data) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for i in range(0, len(order), batch):
                grad = {k: np.zeros_like(x) for k, x in self.p.items()}
                part = order[i:i + batch]
                for j in part:
                    self._gradient(data[j], y[j], weight[j], grad)
                step += 1
                lr = rate * (1 - step / (total + 1))
                for k, g in grad.items():
                    g /= len(part)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.98 * v[k] + 0.02 * g * g
                    up = (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.98 ** step)) + 1e-6)
                    self.p[k] -= (lr * up).astype(np.float32)
        if len(rest):
            self._centre(np.array([self.logit(d) for d in rest]), y_rest)
        return self

    def _centre(self, logits: np.ndarray, y: np.ndarray) -> None:
        """Shift the output so that 0.5 is the best balanced cut of the rows
        kept back from training (the middle of the range of best cuts)."""
        if y.min() == y.max():
            return
        order = np.argsort(logits, kind="stable")
        s, t = logits[order], y[order]
        low = np.cumsum(t == 0) / (t == 0).sum()
        high = np.cumsum((t > 0)[::-1])[::-1] / (t > 0).sum()
        gain = low[:-1] + high[1:]
        gain[s[1:] == s[:-1]] = -1
        best = np.flatnonzero(gain >= gain.max() - 1e-12)
        self.p["b2"] -= np.float32((s[best[0]] + s[best[-1] + 1]) / 2)


def held_out(doc_id: Column) -> Column:
    """Rows never used for fitting: crc32 of the id's text, modulo 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int | None = None) -> DataFrame:
    """(text, quality) of at most ``max_rows`` labelled rows outside the
    held-out third, in hash order; texts over ``max_bytes`` bytes are passed
    over.  The sampled ids (at most ``max_rows``) are broadcast."""
    ids = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()) \
        .where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("__tw_id")) \
        .agg(F.min("quality").alias("__tw_y")).orderBy(F.xxhash64("__tw_id"), "__tw_id").limit(max_rows)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    if max_bytes is not None:
        rows = rows.where(F.octet_length("text") <= max_bytes)
    return rows.join(F.broadcast(ids), F.col("doc_id") == F.col("__tw_id")) \
        .select("doc_id", "text", F.col("__tw_y").alias("quality"))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> ByteCnn:
    rows = sorted({tuple(r) for r in labelled_sample(docs, labels, max_rows, max_bytes).collect()},
                  key=lambda r: (zlib.crc32(b"%d" % r[0]), r))[:max_rows]
    return ByteCnn().fit([r[1] for r in rows], [r[2] for r in rows])


def with_score(docs: DataFrame, model: ByteCnn, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Append ``score_col``: the probability of quality 1, to 4 places."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in small_batches(batches):
            scores = [round(float(shared.value.score(t or "")), 4) for t in part.column(text_col).to_pylist()]
            yield appended(part, {score_col: pa.array(scores, pa.float64())})

    return with_columns(docs, run, f"`{score_col}` double")
