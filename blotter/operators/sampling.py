"""Samples and train/test splits.

Two families:

- Bernoulli (``bernoulli_sample``, ``random_split``): Spark's seeded
  samplers, as the classic workflow uses them. Their rows depend on how the
  input is partitioned, so the same seed can give different rows on another
  cluster or after a ``repartition``.
- Hash (``hash_sample``, ``hash_split``): a row's fate is a hash uniform of
  its id and a salt, so it is the same for any partitioning, after a task
  retry, and in another engine. Both are a single narrow filter/projection:
  no shuffle, no sort, no driver round trip, and reads the id only. Rows
  without an id share one fate, unless the caller names columns (``fallback``)
  whose text decides for them; equal rows without an id then share theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.columns import hash_uniform

PART = "part"


def bernoulli_sample(df: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def labelled_random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), names: Sequence[str] = ("train", "test"), seed: int = 42
) -> DataFrame:
    """The parts of ``random_split`` as one frame with a ``part`` column."""
    parts = [p.withColumn(PART, F.lit(name)) for name, p in zip(names, random_split(df, weights, seed), strict=True)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_key(id_col: str, fallback: Sequence[str] = ()) -> Column:
    """The row's id as text or, where it is NULL, the ``fallback`` columns."""
    others = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fallback if c != id_col]
    return F.coalesce(F.col(id_col).cast("string"), F.concat_ws("|", F.lit("row"), *others))


def split_salt(seed: int | None) -> str:
    """The hash salt of a split: one for each seed."""
    return "split" if seed is None else f"split:{seed}"


def hash_sample(df: DataFrame, id_col: str, fraction: float = 0.05, salt: str = "sample", fallback: Sequence[str] = ()) -> DataFrame:
    """Rows whose id hashes below ``fraction``: a partition-independent
    sample of expected size ``fraction * rows``."""
    return df.filter(hash_uniform(row_key(id_col, fallback), salt) < F.lit(float(fraction)))


def hash_split(
    df: DataFrame,
    id_col: str,
    weights: Sequence[float] = (0.8, 0.2),
    names: Sequence[str] = ("train", "test"),
    salt: str = "split",
    fallback: Sequence[str] = (),
) -> DataFrame:
    """Adds ``part``: the name whose cumulative-weight slot holds the row's
    hash uniform. Weights are normalised to sum 1."""
    if len(weights) != len(names) or not weights:
        raise ValueError("one name per weight")
    total = float(sum(weights))
    u = hash_uniform(row_key(id_col, fallback), salt)
    expr = None
    acc = 0.0
    for w, name in zip(weights[:-1], names[:-1], strict=True):
        acc += w / total
        expr = F.when(u < F.lit(acc), F.lit(name)) if expr is None else expr.when(u < F.lit(acc), F.lit(name))
    last = F.lit(names[-1])
    return df.withColumn(PART, last if expr is None else expr.otherwise(last))


def hash_parts(df: DataFrame, id_col: str, weights=(0.8, 0.2), names=("train", "test"), salt="split", fallback: Sequence[str] = ()) -> list[DataFrame]:
    """The parts of ``hash_split`` as separate frames (one filter each)."""
    labelled = hash_split(df, id_col, weights, names, salt, fallback)
    return [labelled.filter(F.col(PART) == F.lit(n)).drop(PART) for n in names]


def part_sizes(labelled: DataFrame) -> DataFrame:
    """Rows per part of a labelled split."""
    return labelled.groupBy(PART).agg(F.count(F.lit(1)).alias("n_rows"))
