"""Lines that many documents share (operator 13).

1. Each document's lines are exploded as the 128-bit hashes of their distinct
   keys; a key is the line without white space at both ends, A-Z lower-cased.
2. Distinct documents are counted per hash.  The count deals rows by hash and
   document first, so a line that a third of all documents hold is not
   gathered in one task.
3. The frequent hashes are matched with the lines again.  Hashes so frequent
   that only MAX_LISTED can exist are looked up where the lines are read, all
   others meet their lines in a join; so no join key is hot.
4. Each document gets the set of its own frequent hashes, loses the lines that
   hash to one of them and is reassembled by position.

Defined results: a null or empty text is one empty line, and a null text stays
null.  Keys shorter than ``min_chars`` code points are never dropped.  Rows
that repeat an id are one document for the count, and each loses its lines;
rows with a null id are one document for each distinct text.  An empty table
gives an empty table; input columns called like an output column are
replaced."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import appended, materialise, small_batches, with_columns

MIN_DOCS = 10
MIN_CHARS = 1
MAX_LISTED = 50_000


def line_keys(text: str) -> list[bytes]:
    """The key of every line of a text, in order."""
    # on bytes, lower() and strip() know just ASCII
    return [line.strip() for line in text.encode().lower().split(b"\n")]


def key_hash(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def distinct_hashes(text: str | None, min_chars: int) -> list[bytes]:
    """Hashes of the distinct keys of a text that may be dropped."""
    return [key_hash(k) for k in dict.fromkeys(line_keys(text or "")) if k and _long_enough(k, min_chars)]


def exploded(rows: DataFrame, owner: str, min_chars: int, without: frozenset = frozenset()) -> DataFrame:
    """(owner, ha, hb): the distinct line hashes of each (owner, text) row,
    but for those in ``without``."""
    shared = rows.sparkSession.sparkContext.broadcast(without)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        for part in small_batches(batches, 256):
            sizes, flat = [], []
            for text in part.column("text").to_pylist():
                found = distinct_hashes(text, min_chars)
                if listed:
                    found = [h for h in found if h not in listed]
                sizes.append(len(found))
                flat += found
            halves = np.frombuffer(b"".join(flat), "<i8").reshape(-1, 2)
            own = part.column(owner).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            yield pa.RecordBatch.from_arrays(
                [own, pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], names=[owner, "ha", "hb"])

    return rows.select(owner, "text").mapInArrow(run, f"{owner} long, ha long, hb long")


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(ha, hb, n): hashes of the keys found in at least ``min_docs``
    documents, and in how many."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ident = F.col(id_col).cast("long")
    known = docs.where(ident.isNotNull()).select(ident.alias("doc"), text)
    # without an id a text stands for itself
    unknown = docs.where(ident.isNull()).select(F.xxhash64(text).alias("doc"), text)
    lines = exploded(known, "doc", min_chars).withColumn("known", F.lit(True)).unionByName(
        exploded(unknown, "doc", min_chars).withColumn("known", F.lit(False)))
    return lines.groupBy("ha", "hb").agg(F.countDistinct("known", "doc").alias("n")).where(F.col("n") >= min_docs)


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                        id_col: str = "doc_id", text_col: str = "text", lines_col: str = "n_lines",
                        dropped_col: str = "n_dropped") -> DataFrame:
    """``docs`` with the frequent lines taken out of ``text_col``, the number
    of lines before, and how many were dropped."""
    frequent = materialise(frequent_lines(docs, min_docs, min_chars, id_col, text_col))
    total = frequent.agg(F.sum("n")).first()[0] or 0
    often = max(min_docs, -(-total // MAX_LISTED))  # so many documents can only MAX_LISTED hashes have
    listed = frozenset(np.array([r["ha"], r["hb"]], "<i8").tobytes()
                       for r in frequent.where(F.col("n") >= often).select("ha", "hb").collect())
    # id and text together name a row; a clash would only add hashes that are frequent anyway
    place = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.withColumn("__tw_row", place)
    lines = exploded(rows.select(F.col("__tw_row").alias("row"), F.col(text_col).alias("text")), "row", min_chars, listed)
    hits = lines.join(frequent.where(F.col("n") < often).select("ha", "hb"), ["ha", "hb"])
    # bounded by the text's own lines
    sets = hits.groupBy(F.col("row").alias("__tw_row")).agg(F.collect_set(F.struct("ha", "hb")).alias("__tw_gone"))
    shared = docs.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_batches(batches, 256):
            texts, lines, dropped = part.column(text_col).to_pylist(), [], []
            for k, (text, gone) in enumerate(zip(texts, part.column("__tw_gone").to_pylist(), strict=True)):
                own = {np.array([x["ha"], x["hb"]], "<i8").tobytes() for x in gone or ()}
                verdict = {h: h in own or h in shared.value for h in distinct_hashes(text, min_chars)}
                pieces = (text or "").split("\n")
                lines.append(len(pieces))
                if any(verdict.values()):
                    kept = [p for p, key in zip(pieces, line_keys(text), strict=True)
                            if not (key and verdict.get(key_hash(key), False))]
                    dropped.append(len(pieces) - len(kept))
                    texts[k] = "\n".join(kept)
                else:
                    dropped.append(0)
            at = part.schema.get_field_index(text_col)
            part = part.set_column(at, part.schema.field(at), pa.array(texts, pa.string()))
            yield appended(part, {lines_col: pa.array(lines, pa.int64()), dropped_col: pa.array(dropped, pa.int64())})

    joined = rows.drop(lines_col, dropped_col).join(sets, "__tw_row", "left").drop("__tw_row")
    return with_columns(joined, run, f"`{lines_col}` long, `{dropped_col}` long").drop("__tw_gone")
