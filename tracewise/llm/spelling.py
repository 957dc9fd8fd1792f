"""Spelling variant grouping by permuterm rotations (operator 12).

1. Words are counted per batch, then by one aggregate.
2. Every word gets a terminator, and all rotations of the marked word are
   sorted.  Take a word ``a x b`` whose character ``x`` is edited: its rotation
   behind ``x`` is ``b$a x``.  Without its last character that is the prefix
   ``b$a``, which names the place and all other characters.  The words that
   only differ there have the same prefix, and the word ``a b`` without the
   character has the prefix as a whole rotation.  So a replacement, an insertion or a deletion at one
   place is one prefix range that skips the edited character.
3. The sorted rotations are scanned range by range.  A range holds at most one
   word for each character and one without it, so it is bounded by the
   alphabet.  Its words come in order of their counts, so a word's best
   neighbour is the first or the second of the range; no pairs are made.
4. Each word adds up its ranges.  Leaving out any one of a run of equal
   characters gives the same shorter word; only the first of the run counts, so
   no neighbour is counted twice.
5. Words follow their forms step by step; a word that reaches a form without a
   form of its own leaves the rounds.  Counts grow by the ratio with each step,
   so the steps are few and there are no cycles.

Defined results: null and empty texts have no words; a null id is written as
an empty string where words are damaged on purpose; repeated rows count again;
words of equal count are ordered by code points.  An empty table gives an empty table."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import materialise, small_batches, text_rows

TERMINATOR = "$"
MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
HELD_WORDS = 200_000

#: what a word is, once A-Z are lower-cased
WORD = re.compile("[a-zÀ-ÿ]+")


def lower_words(text: str) -> list[str]:
    # on bytes, lower() knows just ASCII
    return WORD.findall(text.encode().lower().decode())


def damage(doc_id: int | None, words: Counter, one_in: int) -> Iterator[tuple[str, int]]:
    """The words of one document; one word in ``one_in`` (by crc32 of id and
    word) loses a character."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in words.items():
        h = zlib.crc32(word.encode(), head)
        if h % one_in == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1:]
        yield word, n


def word_counts(docs: DataFrame, one_in: int | None = None, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``min_chars`` characters that occur
    at least ``min_count`` times; see :func:`damage` for ``one_in``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts = Counter()
        for part in small_batches(batches):
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = Counter(lower_words(text))
                for word, n in damage(doc, words, one_in) if one_in else words.items():
                    if len(word) >= min_chars:
                        counts[word] += n
            if len(counts) >= HELD_WORDS:
                yield out()
                counts = Counter()
        if counts:
            yield out()

    return text_rows(docs, id_col, text_col).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, skips, counts): for every rotation of a marked word
    the whole rotation (``skips`` false), and, unless it ends with the
    terminator, the rotation without its last character.  ``counts``: leaving
    that character out is the word's first way to the shorter word."""
    length = F.length("word")
    marked = F.concat("word", F.lit(TERMINATOR))
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("i")).select(
        "word", "n", "i", F.concat(F.substring(marked, F.col("i") + 1, length + 1), F.substring(marked, F.lit(1), F.col("i")))
        .alias("rotation"))
    whole = F.struct(F.col("rotation").alias("prefix"), F.lit(False).alias("skips"), F.lit(False).alias("counts"))
    # position i in the word (from 1) is the last character of rotation i
    before = F.substring("word", F.col("i") - 1, F.lit(1))
    own = F.substring("word", F.col("i"), F.lit(1))
    cut = F.struct(F.substring("rotation", F.lit(1), length).alias("prefix"), F.lit(True).alias("skips"),
                   ((F.col("i") == 1) | (before != own)).alias("counts"))
    return turned.select("word", "n", F.explode(F.when(F.col("i") == 0, F.array(whole)).otherwise(
        F.array(whole, cut))).alias("x")).select("x.prefix", "word", "n", "x.skips", "x.counts")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rotations -> (word, near, best, best_n), one row for each word
    and range of two or more words."""

    def ranges(t: pa.Table) -> pa.RecordBatch:
        prefix = t.column("prefix").combine_chunks().dictionary_encode()
        code = prefix.indices.to_numpy()
        at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        size = np.diff(np.append(at, len(code)))
        skips, counts = (t.column(c).to_numpy() for c in ("skips", "counts"))
        group = np.repeat(np.arange(len(at)), size)
        n_skip = np.add.reduceat(skips.astype(np.int64), at)
        n_count = np.add.reduceat(counts.astype(np.int64), at)
        has_whole = n_skip < size
        near = np.where(skips, n_skip[group] - 1 + (has_whole[group] & counts), n_count[group])
        first = at[group]
        best = np.where(np.arange(len(code)) == first, first + 1, first)
        keep = np.flatnonzero(size[group] > 1)
        return pa.RecordBatch.from_arrays(
            [t.column("word").take(pa.array(keep)).combine_chunks(), pa.array(near[keep], pa.int64()),
             t.column("word").take(pa.array(best[keep])).combine_chunks(), t.column("n").take(pa.array(best[keep])).combine_chunks()],
            names=["word", "near", "best", "best_n"])

    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        if not t.num_rows:
            continue
        last = t.column("prefix")[-1].as_py()
        # the last range may go on in the next batch
        k = t.num_rows - 1
        while k and t.column("prefix")[k - 1].as_py() == last:
            k -= 1
        if k:
            yield ranges(t.slice(0, k).combine_chunks())
        held = t.slice(k)
    if held is not None and held.num_rows:
        yield ranges(held.combine_chunks())


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): how many words are one edit away, and the
    most frequent of them."""
    ordered = rotations(words).repartition("prefix").sortWithinPartitions("prefix", F.col("n").desc(), "word")
    found = ordered.mapInArrow(_scan, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).where("n_near > 0") \
        .select("word", "n_near", F.col("b.form").alias("form"), (-F.col("b.minus")).alias("form_n"))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) rows without cycles: the last form."""
    goes_on = forms.select(F.col("word").alias("form"), F.lit(True).alias("__more"))
    steps = materialise(forms.select("word", "form").join(goes_on, "form", "left").select(
        "word", "form", F.coalesce("__more", F.lit(False)).alias("more")))
    arrived = steps.where("NOT more").select("word", F.col("form").alias("root"))
    moving = steps.where("more").select("word", F.col("form").alias("at"))
    while not moving.isEmpty():
        step = materialise(moving.join(steps.select(F.col("word").alias("at"), "form", "more"), "at")
                           .select("word", "form", "more"))
        arrived = arrived.unionByName(step.where("NOT more").select("word", F.col("form").alias("root")))
        moving = step.where("more").select("word", F.col("form").alias("at"))
    return arrived


def spelling_variants(words: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) rows.  ``form`` is
    the most frequent word one edit away, if at least ``ratio`` times (more
    than once) as frequent; ``root`` the end of the forms."""
    if ratio <= 1:
        raise ValueError("ratio must be over 1, else forms could go in circles")
    words = materialise(words.select("word", "n"))
    near = words.join(neighbours(words), "word", "left")
    fits = F.col("form_n") >= ratio * F.col("n")
    judged = materialise(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(fits, F.col("form")).alias("form"),
                                     F.when(fits, F.col("form_n")).cast("long").alias("form_n")))
    roots = follow(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
