"""Classification metrics as DataFrames: confusion counts, class-weighted
precision / recall / F1, accuracy, exact area under the ROC curve, a metric
record per model, a metric x model pivot and the best model.

Inputs are scored rows (label, score, prediction), optionally with group
columns ``by`` (a model name, say) so that many models are measured in the
same passes. Everything is a lazy Spark aggregate: nothing is collected or kept, no
broadcast is forced (AQE picks one from measured sizes), and no window or
join partition grows with the number of rows per group.

Definitions follow MLlib's evaluators: precision, recall and F1 are
weighted by each true class's share of rows (so weighted recall equals
accuracy); a class never predicted has precision 0; F1 of a class is 0 when
its precision and recall are both 0; the AUC counts a tie between a positive
and a negative as one half (MLlib with ``numBins=0``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRIC_NAMES = ("auc", "accuracy", "f1", "weighted_precision", "weighted_recall")


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``small`` (one row per key) to ``df``: an equi-join
    on ``keys`` (Spark / AQE choose broadcast or shuffle from the measured
    size), or with no keys a scalar subquery of its single row. Never a
    cross join."""
    if keys:
        return df.join(small, list(keys))
    cols = small.columns
    packed = small.select(F.struct(*cols).alias("__pack")).scalar()
    return df.withColumn("__pack", packed).select(*df.columns, *[F.col("__pack")[c].alias(c) for c in cols])


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction), per group."""
    return scored.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n_rows"))


def outcome_cells(scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN, TP of a 0/1 classifier, zero when a cell is empty; rows
    with a NULL label or prediction are not counted."""
    lab, pred = F.col(label).cast("double"), F.col(prediction).cast("double")

    def cell(lv: float, pv: float) -> Column:
        return F.count_if((lab == F.lit(lv)) & (pred == F.lit(pv)))

    aggs = [cell(0.0, 0.0).alias("tn"), cell(0.0, 1.0).alias("fp"), cell(1.0, 0.0).alias("fn"), cell(1.0, 1.0).alias("tp")]
    return scored.groupBy(*by).agg(*aggs)


def class_table(scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Per (group, class): rows whose label is the class (``actual``), rows
    predicted as the class (``predicted``) and rows both (``hits``).

    Rows are counted per (label, prediction) first, with partial aggregation;
    each of those few cells then feeds two entries (its label's class and its
    predicted class). Rows with a NULL label or prediction are not counted."""
    lab, pred = F.col(label).cast("double"), F.col(prediction).cast("double")
    cells = (
        scored.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(*by, lab.alias("__l"), pred.alias("__p"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    n, zero = F.col("__n"), F.lit(0).cast("long")
    entries = F.array(
        F.struct(F.col("__l").alias("c"), n.alias("a"), zero.alias("p"), F.when(F.col("__l") == F.col("__p"), n).otherwise(zero).alias("t")),
        F.struct(F.col("__p").alias("c"), zero.alias("a"), n.alias("p"), zero.alias("t")),
    )
    return (
        cells.select(*by, F.explode(entries).alias("x"))
        .groupBy(*by, F.col("x.c").alias("cls"))
        .agg(F.sum("x.a").alias("actual"), F.sum("x.p").alias("predicted"), F.sum("x.t").alias("hits"))
    )


def weighted_metrics(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    with_confusion: bool = False,
) -> DataFrame:
    """accuracy, f1, weighted_precision, weighted_recall per group, for any
    number of classes; with ``with_confusion`` also tn, fp, fn, tp of the
    0/1 classes, from the same aggregate."""
    per = class_table(scored, label, prediction, by)
    tp, act, prd = (F.col(c).cast("double") for c in ("hits", "actual", "predicted"))
    p = F.when(prd > 0, tp / prd).otherwise(F.lit(0.0))
    r = F.when(act > 0, tp / act).otherwise(F.lit(0.0))
    per = per.select(*by, "cls", "actual", "predicted", "hits", p.alias("__prec"), r.alias("__rec"))
    p, r = F.col("__prec"), F.col("__rec")
    f1 = F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))
    total = F.sum(act)
    aggs = [
        F.try_divide(F.sum(tp), total).alias("accuracy"),
        F.try_divide(F.sum(act * f1), total).alias("f1"),
        F.try_divide(F.sum(act * p), total).alias("weighted_precision"),
        F.try_divide(F.sum(act * r), total).alias("weighted_recall"),
    ]
    if with_confusion:
        def of(cls: float, c: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("cls") == F.lit(cls), F.col(c))), F.lit(0)).cast("long")

        aggs += [
            of(0.0, "hits").alias("tn"),
            (of(1.0, "predicted") - of(1.0, "hits")).alias("fp"),
            (of(1.0, "actual") - of(1.0, "hits")).alias("fn"),
            of(1.0, "hits").alias("tp"),
        ]
    return per.groupBy(*by).agg(*aggs)


def _binary(label: str) -> Column:
    """Rows of a 0/1 classifier: the label is 0 or 1."""
    return F.col(label).cast("double").isin(0.0, 1.0)


def auc_roc(scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve per group (rank-sum form, ties half).

    AUC = sum over positives of (#negatives scored lower + 0.5 * #negatives
    scored equal) / (P * N). A distributed prefix sum in one lazy pass, without
    a sort into one task:

    1. rows -> (group, score, pos, neg): partial aggregation, so a score
       shared by a third of all rows is one row after the map side;
    2. a range exchange cuts the (group, score) axis into as many ranges of
       about equal size as there are shuffle partitions;
    3. within each range a window sums the negatives below each score, and each
       (group, range) adds up to one row;
    4. running totals over those few rows place the ranges one after the other.

    Nothing is joined back and no branch is read twice. Only rows labelled 0 or
    1 with a score count.
    """
    keys = list(by)
    df = scored.filter(_binary(label) & F.col(score).isNotNull())
    is_pos = (F.col(label).cast("double") == F.lit(1.0)).cast("long")
    d = df.groupBy(*keys, F.col(score).cast("double").alias("__s")).agg(F.sum(is_pos).alias("__pos"), F.sum(F.lit(1) - is_pos).alias("__neg"))
    return _over_ranges(d, keys).groupBy(*keys).agg(_auc_of_ranges())


def _over_ranges(d: DataFrame, keys: list[str], sums: Sequence[str] = ()) -> DataFrame:
    """One row per (group, score range) of ``d`` (keys, __s, __pos, __neg, one
    row per distinct score): __wins, the positives' negatives below them in
    their range, ties half; __p and __n, its positives and negatives; __off, the
    negatives of the ranges below; and the totals of ``sums``. Rows without a
    score only count in the latter."""
    ranged = d.repartitionByRange(*keys, "__s").withColumn("__b", F.spark_partition_id())
    has = F.col("__s").isNotNull()
    ranged = ranged.withColumn("__pos", F.when(has, F.col("__pos")).otherwise(0)).withColumn("__neg", F.when(has, F.col("__neg")).otherwise(0))
    within = Window.partitionBy(*keys, "__b").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("__neg").over(within), F.lit(0)).cast("double")
    wins = F.col("__pos").cast("double") * (F.col("__below") + F.lit(0.5) * F.col("__neg").cast("double"))
    totals = [F.sum("__pos").alias("__p"), F.sum("__neg").alias("__n"), *[F.sum(c).alias(c) for c in sums]]
    per = ranged.withColumn("__below", below).groupBy(*keys, "__b").agg(F.sum(wins).alias("__wins"), *totals)
    # a row per group and range; without groups no more rows than partitions
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("__off", F.coalesce(F.sum("__n").over(order), F.lit(0)))


def _auc_of_ranges() -> Column:
    wins, p, n, off = (F.col(c).cast("double") for c in ("__wins", "__p", "__n", "__off"))
    return F.try_divide(F.sum(wins + p * off), F.sum(p) * F.sum(n)).alias("auc")


def metrics_record(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    with_confusion: bool = False,
) -> DataFrame:
    """The five metrics (and optionally the confusion quartet) of a 0/1
    classifier, one row per group, from a single pass over ``scored``.

    One aggregate by (group, score) carries positives, negatives and the
    four confusion cells, whose totals travel with the AUC's ranges (see
    ``auc_roc``). The plan is lazy and has one branch. Rows whose label is not 0 or 1, or whose
    prediction is neither, leave every metric; a NULL score leaves the AUC, a
    NULL prediction the other metrics. (``weighted_metrics`` handles any
    number of classes.)
    """
    keys = list(by)
    lab = F.col(label).cast("double")
    pred = F.col(prediction).cast("double")

    def cell(lv: float, pv: float) -> Column:
        return F.count_if((lab == F.lit(lv)) & (pred == F.lit(pv)))

    is_pos = (lab == F.lit(1.0)).cast("long")
    d = (
        scored.filter(_binary(label) & (pred.isNull() | pred.isin(0.0, 1.0)))
        .groupBy(*keys, F.col(score).cast("double").alias("__s"))
        .agg(
            F.sum(is_pos).alias("__pos"),
            F.sum(F.lit(1) - is_pos).alias("__neg"),
            cell(0.0, 0.0).alias("tn"),
            cell(0.0, 1.0).alias("fp"),
            cell(1.0, 0.0).alias("fn"),
            cell(1.0, 1.0).alias("tp"),
        )
    )
    cells = ("tn", "fp", "fn", "tp")
    quartet = _over_ranges(d, keys, cells).groupBy(*keys).agg(_auc_of_ranges(), *[F.sum(c).alias(c) for c in cells])
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    act0, act1, prd0, prd1 = tn + fp, fn + tp, tn + fn, fp + tp
    total = act0 + act1

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    p0, p1, r0, r1 = ratio(tn, prd0), ratio(tp, prd1), ratio(tn, act0), ratio(tp, act1)

    def f1(p: Column, r: Column) -> Column:
        return F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))

    def weighted(x0: Column, x1: Column) -> Column:
        return F.try_divide(act0 * x0 + act1 * x1, total)

    return quartet.select(
        *keys,
        "auc",
        F.try_divide(tn + tp, total).alias("accuracy"),
        weighted(f1(p0, r0), f1(p1, r1)).alias("f1"),
        weighted(p0, p1).alias("weighted_precision"),
        weighted(r0, r1).alias("weighted_recall"),
        *(cells if with_confusion else []),
    )


def metrics_long(records: DataFrame, model: str = "model", metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """(model, metric, value) rows from one record per model (``stack``)."""
    pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return records.selectExpr(f"`{model}` AS model", f"stack({len(metrics)}, {pairs}) AS (metric, value)")


def metrics_pivot(long: DataFrame, models: Sequence[str]) -> DataFrame:
    """Metric x model table: one row per metric, one column per model. The
    model names are passed in, so the pivot needs no extra distinct job."""
    return long.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))


def best_by(records: DataFrame, metric: str = "auc", model: str = "model") -> DataFrame:
    """The record with the highest ``metric``; ties go to the first model
    name, so the answer is deterministic."""
    return records.orderBy(F.col(metric).desc_nulls_last(), F.col(model).asc()).limit(1)
