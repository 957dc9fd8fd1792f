"""Substring deduplication by sliding sentence spans (operator 6).

A sentence ends with a word that ends in a terminator (closing quotes and
brackets may follow), or at a line break.  A full-width terminator ends a sentence
wherever it stands, so scripts without blanks have sentences, too.  There a
word is a whole sentence; it counts as one word for every two characters of
three bytes or more (at least one).
Every run of consecutive sentences is hashed: the run that begins at a
sentence takes at least MIN_SENTENCES sentences and goes on until it holds
MIN_WORDS words; a sentence of LONG_SENTENCE words or more is a run by itself,
and the shortest run that ends with the text is taken as well.
Whether a run repeats thus depends on its own words only (case and white space
do not count).  Runs are joined globally by a 128-bit hash.  The first
occurrence (smallest doc_id, then position) stays; the sentences that any
other occurrence covers are removed.

The global step moves some 36 bytes a run, never text: a map-side combined
minimum per hash gives first occurrences, which are materialised.  Frequent
hashes (at most MAX_FREQUENT: those with at least that fraction of all
repeated runs) are looked up where the runs are made, so a passage in a third
of all documents never becomes a hot join key; the others are joined back.

Defined results: a null text is empty, texts without a whole run are
untouched, of equal texts the smallest id's stays whole and the others lose
every sentence of a run.  Rows with a null id keep their text and count as no
occurrence.  Rows that repeat an id are one document: occurrences are told
apart by (id, text digest).  An empty table gives an empty table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import appended, materialise, small_batches, text_chunks, text_rows, with_columns
from tracewise.llm.wordhash import joined, span_hashes, word_hashes, word_spans

MIN_SENTENCES = 2
MIN_WORDS = 25
LONG_SENTENCE = 25
MAX_FREQUENT = 50_000

# fixed values: terminators and what may close a quotation or bracket after them
ENDS = ".!?"
WIDE_ENDS = "。！？"
CLOSERS = "\"')]}»’”」』）】"

_END = np.zeros(256, bool)
_END[[ord(c) for c in ENDS]] = True


def _marks(buf: np.ndarray, chars: str, at: np.ndarray, back: bool) -> np.ndarray:
    """Length in bytes of the character of ``chars`` that begins at (or, with
    ``back``, ends before) each offset, else 0."""
    out = np.zeros(len(at), np.int64)
    codes = [c.encode() for c in chars]
    near = np.zeros(256, bool)
    near[[code[-1 if back else 0] for code in codes]] = True
    # the byte next to the offset rules most of them out
    some = np.flatnonzero((at >= back) & (at < len(buf) + back))
    some = some[near[buf[at[some] - back]]]
    for code in codes:
        begin = at[some] - len(code) if back else at[some]
        ok = (begin >= 0) & (begin + len(code) <= len(buf))
        safe = np.where(ok, begin, 0)
        for k, byte in enumerate(code):
            ok &= buf[np.minimum(safe + k, len(buf) - 1)] == byte
        out[some[ok]] = len(code)
    return out


def text_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets [start, end) of the words, cut after full-width terminators."""
    starts, ends = word_spans(buf)
    lead = np.flatnonzero((buf == 0xE3) | (buf == 0xEF))
    wide = lead[_marks(buf, WIDE_ENDS, lead, False) > 0] if len(lead) else lead
    if not len(wide):
        return starts, ends
    cut = wide + 3
    while (step := _marks(buf, CLOSERS, cut, False)).any():
        cut = cut + step
    cut = np.unique(cut[_marks(buf, WIDE_ENDS, cut, False) == 0])
    word = np.searchsorted(starts, cut, "right") - 1
    cut = cut[(word >= 0) & (starts[word] < cut) & (cut < ends[word])]
    return np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))


def word_units(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Prefix sums of what each word counts."""
    wide = buf >= 0xE0
    if not wide.any():
        return np.arange(len(starts) + 1)
    wide = np.concatenate([[0], np.cumsum(wide)])
    return np.concatenate([[0], np.cumsum(np.maximum(1, (wide[ends] - wide[starts]) // 2))])


def sentences(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Index of each sentence's first word, and the number of words, for the
    words [starts, ends) of texts that end in line breaks."""
    n = len(starts)
    if not n:
        return np.zeros(1, np.int64)
    last = ends.copy()
    open_ = np.arange(n)
    while len(open_):
        step = _marks(buf, CLOSERS, last[open_], True)
        step[last[open_] - step < starts[open_]] = 0
        last[open_] -= step
        open_ = open_[step > 0]
    inside = last > starts
    closed = inside & (_END[buf[np.maximum(last - 1, 0)]] | ((last - starts >= 3) & (_marks(buf, WIDE_ENDS, last, True) > 0)))
    before = np.searchsorted(starts, np.flatnonzero(buf == 10)) - 1  # the word before each line break
    closed[before[before >= 0]] = True
    first = np.flatnonzero(closed[:-1]) + 1
    return np.concatenate([[0], first, [n]])


def sentence_runs(sizes: np.ndarray, bounds: np.ndarray, min_sentences: int, min_words: int,
                  long_sentence: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, and sentence range [i, j), of each run.  ``sizes`` are prefix sums
    of the sentences' words; text k has the sentences [bounds[k], bounds[k + 1])."""
    i = np.arange(len(sizes) - 1)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    j = np.maximum(i + min_sentences, np.searchsorted(sizes, sizes[:-1] + min_words))
    whole = j <= bounds[owner + 1]
    long = np.flatnonzero(np.diff(sizes) >= long_sentence)
    begin, end = bounds[:-1], bounds[1:]
    tail = np.minimum(end - min_sentences, np.searchsorted(sizes, sizes[end] - min_words, "right") - 1)
    ended = np.flatnonzero(tail >= begin)
    return (np.concatenate([owner[whole], owner[long], ended]), np.concatenate([i[whole], long, tail[ended]]),
            np.concatenate([j[whole], long + 1, end[ended]]))


class Frequent:
    """The most frequent run hashes and the first occurrence of each, sorted
    by hash: at most MAX_FREQUENT entries, so they can be sent everywhere."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r["ha"], r["hb"]))
        self.ha, self.hb, self.doc, self.digest, self.i = (
            np.array([r[c] for r in rows], np.int64) for c in ("ha", "hb", "fd", "fg", "fi"))

    def find(self, doc, digest, i, ha, hb):
        """Which runs are in the list, and which of these are no first occurrence."""
        listed = np.zeros(len(ha), bool)
        if not len(self.ha):
            return listed, listed
        at = np.minimum(np.searchsorted(self.ha, ha), len(self.ha) - 1)
        # equal upper halves are next to each other; they differ in hb only by chance
        for step in range(2):
            k = np.minimum(at + step, len(self.ha) - 1)
            hit = (self.ha[k] == ha) & (self.hb[k] == hb) & ~listed
            listed |= hit
            at = np.where(hit, k, at)
        return listed, listed & ~((self.doc[at] == doc) & (self.digest[at] == digest) & (self.i[at] == i))


def merged(text: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sentence ranges [i, j) with those of a text that meet put together."""
    order = np.argsort(i, kind="stable")
    text, i, j = text[order], i[order], np.maximum.accumulate(j[order])
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] > j[:-1]) | (text[1:] != text[:-1])
    return text[new], i[new], j[np.append(new[1:], True)] if len(j) else j


def runs(rows: DataFrame, min_sentences: int, min_words: int, long_sentence: int,
         frequent: Frequent | None = None) -> DataFrame:
    """(doc_id, digest, i, j, ha, hb) of every sentence run of (doc_id, text).
    With ``frequent`` the runs listed there give only the merged ranges they
    cover, with ``hb`` null (and in ``ha`` the id, so that they spread as keys)."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent) if frequent is not None else None

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            texts = batch.column("text").to_pylist()
            for x, y in text_chunks(texts):
                buf, at = joined(texts[x:y])
                starts, ends = text_words(buf)
                words = word_hashes(buf, starts, ends, fold=True)
                units = word_units(buf, starts, ends)
                cut = np.searchsorted(starts, at)
                cuts = sentences(buf, starts, ends)
                bounds = np.searchsorted(cuts, cut)
                text, i, j = sentence_runs(units[cuts], bounds, min_sentences, min_words, long_sentence)
                if not len(i):
                    continue
                own, digests = ids[x:y], span_hashes(words, cut[:-1], cut[1:], 5).view(np.int64)
                ha = span_hashes(words, cuts[i], cuts[j], 1).view(np.int64)
                hb = span_hashes(words, cuts[i], cuts[j], 2).view(np.int64)
                covered = np.zeros(len(i), bool)
                if shared is not None:
                    listed, again = shared.value.find(own[text], digests[text], i - bounds[text], ha, hb)
                    more = merged(text[again], i[again], j[again])
                    text, i, j = (np.concatenate([c[~listed], m]) for c, m in zip((text, i, j), more, strict=True))
                    ha, hb = np.concatenate([ha[~listed], own[more[0]]]), np.concatenate([hb[~listed], more[0]])
                    covered = np.arange(len(i)) >= len(i) - len(more[0])
                cols = [own[text], digests[text], i - bounds[text], j - bounds[text], ha]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, t) for c, t in zip(cols, types, strict=True)), pa.array(hb, pa.int64(), mask=covered)],
                    names=["doc_id", "digest", "i", "j", "ha", "hb"])

    return rows.where("doc_id IS NOT NULL").mapInArrow(
        run, "doc_id long, digest long, i int, j int, ha long, hb long")


def repeated_runs(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
                  long_sentence: int = LONG_SENTENCE, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, digest, i, j): the runs that are not the first of their kind."""
    rows = text_rows(docs, id_col, text_col)
    first = runs(rows, min_sentences, min_words, long_sentence).groupBy("ha", "hb").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "digest", "i")).alias("f")).where("n > 1") \
        .select("ha", "hb", "n", F.col("f.doc_id").alias("fd"), F.col("f.digest").alias("fg"), F.col("f.i").alias("fi"))
    first = materialise(first)
    total = first.agg(F.sum("n")).first()[0] or 0
    often = max(3, -(-total // MAX_FREQUENT))  # so many occurrences can only MAX_FREQUENT hashes have
    listed = Frequent(first.where(F.col("n") >= often).collect())
    found = runs(rows, min_sentences, min_words, long_sentence, listed)
    return found.join(first.where(F.col("n") < often).drop("n"), ["ha", "hb"], "left") \
        .where("hb IS NULL OR NOT (doc_id = fd AND digest = fg AND i = fi)").select("doc_id", "digest", "i", "j")


def _cut(text: str, covered: list[tuple[int, int]]) -> tuple[str, int]:
    """Text without the covered sentences, and how many these are."""
    buf, at = joined([text])
    starts, ends = text_words(buf)
    cuts = sentences(buf, starts, ends)
    gone = np.zeros(len(cuts), np.int32)
    for i, j in covered:
        gone[i] += 1
        gone[j] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    # a sentence's bytes run up to the next one's first word; blanks before the first word stay with it
    edge = np.concatenate([[0], starts[cuts[1:-1]], [at[1] - 1]])
    data = buf.tobytes()
    return b"".join(data[a:b] for a, b, g in zip(edge[:-1].tolist(), edge[1:].tolist(), gone.tolist(), strict=True)
                    if not g).decode(), int(gone.sum())


def _digests(texts: list[str]) -> list[int]:
    out = []
    for t in texts:
        buf, _ = joined([t])
        starts, ends = text_words(buf)
        words = word_hashes(buf, starts, ends, fold=True)
        out.append(int(span_hashes(words, np.zeros(1, np.int64), np.full(1, len(words)), 5).view(np.int64)[0]))
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_sentences: int = MIN_SENTENCES,
                    min_words: int = MIN_WORDS, long_sentence: int = LONG_SENTENCE,
                    removed_col: str = "n_removed") -> DataFrame:
    """``docs`` with the covered sentences cut out of ``text_col`` (null where
    it was null), and ``removed_col``: the number of sentences cut."""
    again = repeated_runs(docs, min_sentences, min_words, long_sentence, id_col, text_col)
    # bounded by the document's own sentences
    lists = again.groupBy(F.col("doc_id").alias("__tw_id")).agg(
        F.collect_set(F.struct("digest", "i", "j")).alias("__tw_runs"))
    joined_rows = docs.join(lists, F.col(id_col).cast("long") == F.col("__tw_id"), "left").drop("__tw_id")

    def run(batches):
        for part in small_batches(batches):
            texts = part.column(text_col).to_pylist()
            covered = part.column("__tw_runs").to_pylist()
            removed = [0] * len(texts)
            for k, (t, c) in enumerate(zip(texts, covered, strict=True)):
                if not c or not t:
                    continue
                kinds = {x["digest"] for x in c}
                own = _digests([t])[0] if len(kinds) > 1 else next(iter(kinds))
                texts[k], removed[k] = _cut(t, [(x["i"], x["j"]) for x in c if x["digest"] == own])
            k = part.schema.get_field_index(text_col)
            part = part.set_column(k, part.schema.field(k), pa.array(texts, pa.string()))
            yield appended(part, {removed_col: pa.array(removed, pa.int64())})

    return with_columns(joined_rows, run, f"`{removed_col}` long").drop("__tw_runs")
