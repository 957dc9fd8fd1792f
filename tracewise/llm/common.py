"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracewise.session import cut_lineage

WORD_SPLIT = r"[\x20\x09-\x0D]+"

CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (id, text); null texts become empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder."""
    return cut_lineage(df)


def few_parts(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """``df``, of about ``rows`` small rows, in no more partitions than these
    need: iterations over small tables then write few files."""
    return df.coalesce(max(1, -(-rows // each)))


def text_chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges [i, j) of consecutive texts of about ``limit`` characters
    (a longer text stands alone), so that working arrays stay bounded."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t) + 1
    if i < len(texts):
        yield i, len(texts)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def appended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def with_columns(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` that appends the columns of ``schema``; input columns of
    the same names are replaced."""
    new = StructType.fromDDL(schema)
    df = df.drop(*new.names)
    return df.mapInArrow(fn, StructType([*df.schema.fields, *new.fields]))
