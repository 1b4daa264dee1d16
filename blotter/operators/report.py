"""Report tables: feature importances with text bars, and reconciliation of
counts per key between two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.columns import text_bar


def importance_table(spark: SparkSession, pairs: Sequence[tuple[str, float]]) -> DataFrame:
    """(feature, importance, bar), highest first, ties by name. ``pairs``
    is one value per model feature (a handful), held by the fitted model."""
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return with_bar(spark.createDataFrame([(n, float(v)) for n, v in pairs], schema), "importance")


def with_bar(df: DataFrame, value: str, name: str = "bar") -> DataFrame:
    """Adds a bar of one mark per 2% of ``value``; highest value first."""
    key = [c for c in df.columns if c != value][0]
    return df.withColumn(name, text_bar(value)).orderBy(F.col(value).desc(), F.col(key).asc())


def reconcile_counts(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_count: str,
    right_count: str,
    left_name: str = "left_rows",
    right_name: str = "right_rows",
) -> DataFrame:
    """Counts per key from two runs side by side, with their difference.

    A full outer join of two aggregates on the key, NULL-safe (a NULL key
    group matches the other side's NULL group); a key missing on one side
    counts 0 there. Both inputs are per-key aggregates, so the join moves
    one row per key, not the underlying rows."""
    l = left.select(F.col(key).alias("__lk"), F.col(left_count).alias(left_name))
    r = right.select(F.col(key).alias("__rk"), F.col(right_count).alias(right_name))
    j = l.join(r, l["__lk"].eqNullSafe(r["__rk"]), "full_outer")
    lc = F.coalesce(F.col(left_name), F.lit(0))
    rc = F.coalesce(F.col(right_name), F.lit(0))
    return j.select(
        F.coalesce(F.col("__lk"), F.col("__rk")).alias(key),
        lc.alias(left_name),
        rc.alias(right_name),
        (lc - rc).alias("delta"),
    )
