"""DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import shared_dir


def stored(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. Cuts the
    lineage at a table every executor can read, so a lost executor costs no
    recomputation of what came before."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """Only (doc_id long, text string), whatever else the input carries."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def map_texts(docs: DataFrame, row_of: Callable[[str | None], tuple], fields: list[pa.Field], schema: str) -> DataFrame:
    """One output row (doc_id, *row_of(text)) per input row, in Arrow batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            made = [row_of(x.as_py()) for x in batch.column(1)]
            columns = list(zip(*made, strict=True)) if made else [[] for _ in fields]
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *(f.name for f in fields)])

    return doc_texts(docs).mapInArrow(run, f"doc_id long, {schema}")


def text_fold(doc_id: str, modulus: int):
    """crc32 of the id's decimal text modulo ``modulus``; null id: fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus, F.lit(0))


def id_sample(ids: DataFrame, n: int, seed: int) -> DataFrame:
    """At most ``n`` distinct ids, those with the smallest seeded hash. A
    top-n over partial results: no task holds more than n rows."""
    return (
        ids.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"))
        .distinct()
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(n)
    )
