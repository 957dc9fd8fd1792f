"""Document fingerprints by winnowing (operator 1), DataFrame functions only.

Words of a text are hashed, ``k`` consecutive word hashes are combined by a
rotate-and-xor rolling hash, and of every window of ``w`` consecutive k-gram
hashes the minimum is kept, the rightmost one at ties, with its position.  Any
run of ``w + k - 1`` words that two texts share therefore yields a common
(hash) entry.  Windows and grams are built by doubling over shifted arrays, so
each costs O(log) passes over the row's own array.  The order inside a window
is that of the hash's upper 32 bits; the entry keeps all 64.

Defined results: a null text is empty; a text without words has an empty
fingerprint; one with fewer than k words has one gram of all its words, one
with fewer than w grams has one window.  The likeness of two empty
fingerprints is 1, of one empty and one other 0.  Equal texts have equal
fingerprints; repeated rows each get their own row.  In the order of documents
rows without an id come last, by a hash of their text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import WORD_SPLIT, text_rows

GRAM_WORDS = 5
WINDOW_GRAMS = 4
_POS = (1 << 31) - 1


def _rotl(x: Column, n: int) -> Column:
    n %= 64
    return x if n == 0 else F.shiftleft(x, n).bitwiseOR(F.shiftrightunsigned(x, 64 - n))


def _roll(n: int):
    """Combine the hash of some words with that of the next ``n``."""
    return lambda x, y: _rotl(x, n).bitwiseXOR(y)


def _pairs(a: Column, shift: int, b: Column, length: Column, fn) -> Column:
    """fn(a[i], b[i + shift]) for the ``length`` indices i that exist."""
    return F.zip_with(F.slice(a, F.lit(1), length), F.slice(b, F.lit(shift + 1), length), fn)


def with_fingerprint(df: DataFrame, text: str, prefix: str, k: int = GRAM_WORDS,
                     w: int = WINDOW_GRAMS) -> DataFrame:
    """Append ``{prefix}hashes`` and ``{prefix}positions`` (array<bigint>): the
    kept gram hashes in text order and the word positions where they begin."""
    c = f"__tw_{prefix}"
    n, g = f"{c}n", f"{c}g"
    df = df.withColumn(c, F.transform(F.filter(F.split(F.col(text), WORD_SPLIT, -1), lambda x: x != ""),
                                      lambda x: F.xxhash64(x)))
    df = df.withColumn(n, F.size(c))
    # grams of 2, 4, ... words by doubling, then the words still missing
    part, have, names = c, 1, [c]
    while have < k:
        step = min(have, k - have)
        other = part if step == have else c
        nxt = f"{c}{have + (step if step == have else 1)}"
        step = step if step == have else 1
        df = df.withColumn(nxt, _pairs(
            F.col(part), have, F.col(other), F.greatest(F.col(n) - (have + step - 1), F.lit(0)),
            _roll(step)))
        part, have = nxt, have + step
        names.append(nxt)
    df = df.withColumn(g, F.when(F.col(n) == 0, F.array().cast("array<bigint>"))
                       .when(F.col(n) < k, F.array(F.xxhash64(F.col(c)))).otherwise(F.col(part)))
    # order key: upper 32 hash bits, then the later position first
    m, v = f"{c}m", f"{c}v"
    df = df.withColumn(m, F.size(g)).withColumn(v, F.transform(
        F.col(g), lambda x, i: F.shiftleft(F.shiftrightunsigned(x, 32), 31).bitwiseOR(F.lit(_POS) - i)))
    part, have, keys = v, 1, [v]
    while have < w:
        step = min(have, w - have)
        nxt = f"{v}{have + step}"
        df = df.withColumn(nxt, _pairs(F.col(part), step, F.col(part),
                                       F.greatest(F.col(m) - (have + step - 1), F.lit(0)),
                                       lambda x, y: F.least(x, y)))
        part, have = nxt, have + step
        keys.append(nxt)
    kept = f"{c}k"
    df = df.withColumn(kept, F.when(F.col(m) == 0, F.array().cast("array<bigint>"))
                       .when(F.col(m) < w, F.array(F.array_min(v))).otherwise(F.array_distinct(part)))
    df = df.withColumn(f"{prefix}positions",
                       F.transform(kept, lambda x: F.lit(_POS) - x.bitwiseAND(F.lit(_POS))))
    df = df.withColumn(f"{prefix}hashes", F.transform(
        f"{prefix}positions", lambda p: F.get(F.col(g), p.cast("int"))))
    return df.drop(*names, n, g, m, *keys, kept)


def fingerprint_key(prefix: str) -> Column:
    """128-bit digest of a fingerprint (hashes and positions) as hex."""
    h, p = F.col(f"{prefix}hashes"), F.col(f"{prefix}positions")
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(h, p)), 16, "0"),
                            F.lpad(F.hex(F.xxhash64(F.lit(1), p, h)), 16, "0")))


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two fingerprints' hash sets."""
    x, y = F.col(f"{a}hashes"), F.col(f"{b}hashes")
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(x, y)).cast("double") / union)


def fingerprints(docs: DataFrame, k: int = GRAM_WORDS, w: int = WINDOW_GRAMS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, hashes, positions) of every document."""
    rows = text_rows(docs, id_col, text_col)
    return with_fingerprint(rows, "text", "", k, w).select("doc_id", "hashes", "positions")


def with_next_text(rows: DataFrame, buckets: int) -> DataFrame:
    """Append ``next_text``: the text of the next row in descending doc_id
    order (equal ids by text), the first row's after the last.

    Rows are dealt to id ranges; the first row of each range also goes, marked,
    to the range before it, so that ``lead`` inside a range sees its successor.
    The driver sees only the split points and each range's first id (as many
    as there are ranges).  Rows without an id come last, in the order of a hash
    of their text (then the text), in ranges of that hash; equal ones travel as
    one row and a count, so that a text without id may repeat without end."""
    spark = rows.sparkSession
    cuts = sorted(set(rows.select("doc_id").na.drop().approxQuantile(
        "doc_id", [i / buckets for i in range(1, buckets)], 0.1 / buckets)))
    step = max(1, int(len(cuts) ** 0.5))
    coarse = F.array(*[F.lit(x) for x in cuts[step - 1::step]]) if cuts else None
    fine = F.array(*[F.lit(x) for x in cuts]) if cuts else None
    if cuts:
        at = F.size(F.filter(coarse, lambda x: x <= F.col("__tw_d"))) * step
        bucket = at + F.size(F.filter(F.slice(fine, at + 1, F.lit(step)), lambda x: x <= F.col("__tw_d")))
    else:
        bucket = F.lit(0)
    known = rows.where("doc_id IS NOT NULL").select(
        "doc_id", "text", F.lit(1).cast("long").alias("__tw_n"), F.lit(None).cast("long").alias("__tw_h"),
        F.col("doc_id").cast("double").alias("__tw_d"))
    known = known.withColumn("__tw_b", bucket.cast("int")).drop("__tw_d")
    unknown = rows.where("doc_id IS NULL").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("__tw_n")) \
        .withColumn("__tw_h", F.xxhash64("text"))
    share = F.col("__tw_h").cast("double") / F.lit(2.0 ** 64) + 0.5
    unknown = unknown.withColumn("__tw_b", (-1 - F.least(F.lit(buckets - 1), F.floor(share * buckets))).cast("int"))
    rows = known.unionByName(unknown)
    heads = rows.groupBy("__tw_b").agg(F.max("doc_id").alias("top"), F.min("__tw_h").alias("low")) \
        .orderBy(F.desc("__tw_b")).collect()
    if not heads:
        return rows.select("doc_id", "text", F.lit(None).cast("string").alias("next_text"))
    # the range before (in descending order) each range; the first range comes after the last
    before = [(heads[i - 1]["__tw_b"], h["__tw_b"], h["top"], h["low"]) for i, h in enumerate(heads)]
    firsts = spark.createDataFrame(before, "__tw_to int, __tw_b int, __tw_top long, __tw_low long")
    carried = (rows.join(F.broadcast(firsts), "__tw_b")
               .where(F.col("doc_id").eqNullSafe(F.col("__tw_top")) & F.col("__tw_h").eqNullSafe(F.col("__tw_low")))
               .groupBy(F.col("__tw_to").alias("__tw_b")).agg(F.min("text").alias("text"))
               .select(F.lit(None).cast("long").alias("doc_id"), "text", "__tw_b", F.lit(1).alias("__tw_c"),
                       F.lit(1).cast("long").alias("__tw_n"), F.lit(None).cast("long").alias("__tw_h")))
    own = rows.select("doc_id", "text", "__tw_b", F.lit(0).alias("__tw_c"), "__tw_n", "__tw_h")
    from pyspark.sql import Window
    order = Window.partitionBy("__tw_b").orderBy("__tw_c", F.desc_nulls_last("doc_id"), "__tw_h", "text")
    out = own.unionByName(carried).withColumn("next_text", F.lead("text").over(order)).where("__tw_c = 0")
    # of equal rows without id, all but the last are followed by an equal one
    out = out.select("doc_id", "text", "next_text", "__tw_n",
                     F.explode(F.sequence(F.lit(1).cast("long"), F.col("__tw_n"))).alias("__tw_i"))
    return out.select("doc_id", "text", F.when(F.col("__tw_i") < F.col("__tw_n"), F.col("text"))
                      .otherwise(F.col("next_text")).alias("next_text"))


def edited_fingerprints(docs: DataFrame, k: int = GRAM_WORDS, w: int = WINDOW_GRAMS,
                        buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited text (last half replaced by
    the beginning of the next document) and of the next document's text."""
    rows = text_rows(docs)
    spark = docs.sparkSession
    buckets = buckets or max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = with_next_text(rows, buckets)
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))
    for text, prefix in (("text", "own_"), ("edited", "edited_"), ("next_text", "next_")):
        rows = with_fingerprint(rows, text, prefix, k, w)
    return rows
