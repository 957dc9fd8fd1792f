"""Quality rules: boosted trees over document statistics (operator 3).

One pass over each whole text gives the statistics (numpy over UTF-8 bytes).
Base rules reject texts with too few words or too many repeated word windows.
The trees learn a quality verdict from a bounded sample of labelled rows;
chosen statistics are constrained so that more of a defect (symbols, repeated
lines or windows, shouted words, cell marks) never raises the score.

Defined results: a null text has no words and fails the base rules; without
labelled rows of both classes the trees say "keep"; repeated rows get equal
verdicts; an empty table gives an empty table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tracewise.llm.boosting import Boosted
from tracewise.llm.byte_cnn import labelled_sample
from tracewise.llm.common import appended, small_batches, text_chunks, with_columns
from tracewise.llm.wordhash import joined, run_hashes, span_hashes, word_hashes, word_spans

MAX_ROWS = 20_000
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
            "bangs_per_word", "bars_per_word", "digit_share", "distinct_share", "words_per_line", "stops_per_word",
            "same_as_previous_share"]
#: -1: more of it never raises the score
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
            "bangs_per_word": -1, "bars_per_word": -1, "same_as_previous_share": -1}

# fixed value: characters counted as symbols
SYMBOLS = "#*$%&|<>"


def statistics(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Base statistics (as in BASE) and features (as in FEATURES) of each text."""
    base = np.zeros((len(texts), len(BASE)), np.int64)
    feats = np.zeros((len(texts), len(FEATURES)))
    symbols = [ord(c) for c in SYMBOLS]
    for i, j in text_chunks(texts):
        buf, at = joined(texts[i:j])
        starts, ends = word_spans(buf)
        words = word_hashes(buf, starts, ends)
        points = np.zeros(len(buf) + 1, np.int32)
        np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
        cut = np.searchsorted(starts, at)
        newline = np.flatnonzero(buf == 10)
        for k in range(j - i):
            a, b = int(cut[k]), int(cut[k + 1])
            if a == b:
                continue
            text = buf[at[k]:at[k + 1] - 1]
            hist = np.bincount(text, minlength=256)
            w, n = words[a:b], b - a
            chars = int((points[ends[a:b]] - points[starts[a:b]]).sum())
            line_end = newline[np.searchsorted(newline, at[k]):np.searchsorted(newline, at[k + 1])]
            line_at = np.concatenate([[at[k]], line_end[:-1] + 1])
            first = np.searchsorted(starts[a:b], line_at)
            last = np.append(first[1:], n)
            filled = np.flatnonzero(last > first)
            dup = _repeated_lines(buf, line_at[filled], line_end[filled], w, first[filled], last[filled])
            repeat = _repeated_words(w, WINDOW_WORDS)
            n_symbols = int(hist[symbols].sum())
            base[i + k] = (n, chars, n_symbols, dup, repeat)
            letters = hist[65:91].sum() + hist[97:123].sum()
            same = int((w[1:] == w[:-1]).sum())
            feats[i + k] = (np.log1p(n), chars / n, n_symbols / n, dup / max(1, len(filled)), repeat / n,
                            hist[65:91].sum() / max(1, letters), hist[33] / n, hist[124] / n,
                            hist[48:58].sum() / max(1, chars), len(np.unique(w)) / n, n / max(1, len(filled)),
                            (hist[46] + hist[63]) / n, same / max(1, n - 1))
    return base, feats


def _repeated_lines(buf, line_at, line_end, words, first, last) -> int:
    """Lines with a word that equal an earlier line, byte by byte.  Lines are
    grouped by their words' hash, then compared whole."""
    if len(line_at) < 2:
        return 0
    key = span_hashes(words, first, last, 3)
    if len(np.unique(key)) == len(key):
        return 0
    data = memoryview(buf)
    seen, dup = {}, 0
    for h, a, b in zip(key.tolist(), line_at.tolist(), line_end.tolist(), strict=True):
        line = bytes(data[a:b])
        kinds = seen.setdefault(h, set())
        if line in kinds:
            dup += 1
        kinds.add(line)
    return dup


def _repeated_words(words: np.ndarray, size: int) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    h = run_hashes(words, size)
    if len(h) < 2:
        return 0
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(words) + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return int((np.cumsum(step)[:-1] > 0).sum())


def base_failed(base: np.ndarray) -> np.ndarray:
    n, repeat = base[:, 0], base[:, 4]
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


def fit_rules(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Boosted:
    """Fit on the statistics (never the texts) of at most ``max_rows``
    labelled rows that pass the base rules."""
    sample = labelled_sample(docs, labels, max_rows)

    def run(batches):
        for part in small_batches(batches, 2048):
            base, feats = statistics(part.column("text").to_pylist())
            ok = ~base_failed(base)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.column("quality").to_numpy(zero_copy_only=False)[ok], pa.int32()),
                 pa.array(feats[ok].tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    rows = sorted((r["x"], r["y"]) for r in sample.select("text", "quality").mapInArrow(
        run, "y int, x array<double>").collect())
    model = Boosted(len(FEATURES), {FEATURES.index(k): s for k, s in MONOTONE.items()})
    y = np.array([r[1] for r in rows], float)
    if len(y) == 0 or y.min() == y.max():
        model.base = 1.0
        return model
    return model.fit(np.array([r[0] for r in rows]), y)


def with_verdict(docs: DataFrame, model: Boosted, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Append the base statistics, base_failed, rule_score and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in small_batches(batches, 2048):
            base, feats = statistics([t or "" for t in part.column(text_col).to_pylist()])
            failed = base_failed(base)
            score = shared.value.probability(feats)
            extra = [*(pa.array(base[:, k]) for k in range(len(BASE))), pa.array(failed), pa.array(score),
                     pa.array(~failed & (score >= threshold))]
            yield appended(part, dict(zip([*BASE, "base_failed", "rule_score", "kept"], extra, strict=True)))

    schema = ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, rule_score double, kept boolean"
    return with_columns(docs, run, schema)
