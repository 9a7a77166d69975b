"""Classification metrics as DataFrame aggregates.

Both metrics reduce the scored rows map-side first, so the shuffle carries
aggregated rows, not input rows, and a class or score value that holds a
third of the table is one row after the partial aggregate, not a hot task.

* weighted F1: per-class F1 weighted by the true-class count, as in MLlib's
  ``MulticlassClassificationEvaluator(metricName="f1")``.
* area under ROC: exact, as ``BinaryClassificationEvaluator`` with
  ``numBins=0``. The evaluator's default (``numBins=1000``) down-samples the
  curve; :func:`auc_roc_evaluator` gives that value when it is wanted.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct scores a range of the exact area under ROC holds, about 24 MB of rows.
SCORES_PER_RANGE = 1_000_000


def _not_null(column: str, what: str, value: Column | None = None) -> Column:
    """The column (or ``value``, read from it); NULL raises."""
    c = F.col(column) if value is None else value
    return F.when(c.isNull(), F.raise_error(F.lit(f"{what} column '{column}' holds NULL"))).otherwise(c)


def confusion_counts(
    df: DataFrame, label_col: str, prediction_col: str = "prediction"
) -> DataFrame:
    """``(label, prediction, n)``: one row per pair that occurs.

    At most ``classes²`` rows; the count is combined map-side.
    """
    return df.groupBy(
        _not_null(label_col, "label").cast("double").alias("label"),
        _not_null(prediction_col, "prediction").cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def weighted_f1(
    df: DataFrame, label_col: str, prediction_col: str = "prediction"
) -> DataFrame:
    """One row, column ``f1``: per-class F1 weighted by true-class frequency.

    For class ``k`` with ``t`` true rows, ``q`` predicted rows and ``tp``
    hits, F1 is ``2·tp / (t + q)``. A predicted class that never occurs as a
    label costs recall but adds no term. Empty input gives ``0.0``.
    """
    conf = confusion_counts(df, label_col, prediction_col)
    zero = F.lit(0).cast("long")
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    # Each confusion cell counts once for its true class and once for its
    # predicted class; a second small aggregate then gives per-class totals
    # without a join.
    sides = conf.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("k"),
                    F.col("n").alias("t"),
                    hits.alias("tp"),
                    zero.alias("q"),
                ),
                F.struct(
                    F.col("prediction").alias("k"),
                    zero.alias("t"),
                    zero.alias("tp"),
                    F.col("n").alias("q"),
                ),
            )
        ).alias("side")
    ).select("side.*")
    per_class = sides.groupBy("k").agg(
        F.sum("t").alias("t"), F.sum("tp").alias("tp"), F.sum("q").alias("q")
    )
    term = F.col("t") * (2.0 * F.col("tp") / (F.col("t") + F.col("q")))
    return per_class.agg(
        F.coalesce(F.sum(term) / F.sum("t"), F.lit(0.0)).alias("f1")
    )


def _score_column(df: DataFrame, score_col: str) -> Column:
    """A double score: slot 1 of a raw-prediction vector, or a double column."""
    if isinstance(df.schema[score_col].dataType, VectorUDT):
        return _not_null(score_col, "score", vector_to_array(F.col(score_col))[1])
    return _not_null(score_col, "score").cast("double")


def _area_parts(n_lower: Column) -> list[Column]:
    """Aggregates over score ranges (columns ``p``, ``n``): pairs of a positive
    with a negative of a lower range, then positives and negatives.

    The pairs are counted in double: a bigint product overflows from about
    six billion balanced rows on.
    """
    pairs = F.col("p").cast("double") * n_lower.cast("double")
    return [F.sum(pairs).alias("u"), F.sum("p").alias("p"), F.sum("n").alias("n")]


def score_ranges(distinct: int, scores_per_range: int = SCORES_PER_RANGE) -> int:
    """Into how many ranges ``distinct`` scores are cut: it follows from the
    data alone, not from the cluster."""
    return max(1, -(-distinct // scores_per_range))


def auc_roc(
    df: DataFrame,
    label_col: str,
    score_col: str = "rawPrediction",
    buckets: int | None = None,
) -> DataFrame:
    """One row, column ``auc``: exact area under the ROC curve.

    Labels above 0.5 are positive. Ties share half credit (mid-ranks), so
    the value is the Mann-Whitney statistic ``U / (P·N)``. Only positives
    give 1.0, only negatives 0.0, no rows 0.5 (the evaluator's values).
    ``-0.0`` and ``0.0`` are one score here, as in SQL grouping; MLlib's
    evaluator keeps them apart, the only case where the two differ.

    The rank of a score needs the count of negatives below it, a prefix sum
    in score order. A global ``ORDER BY`` would move every row to one task,
    so instead:

    1. aggregate to ``(score, pos, neg)``, combined map-side;
    2. cut the distinct scores into ranges of about a million (``buckets``
       sets their number instead) at approximate quantiles;
    3. :func:`range_parts` places the scores by range, one shuffle, and adds
       up each range where it lies;
    4. the per-range totals (one row per range) give each range the negatives
       in all lower ones.

    The aggregated scores are persisted (memory, then disk) for the few
    passes over them and released before returning. A NULL label or score
    raises. The aggregation's shuffle takes its width from the session, the
    ranges' from the number of distinct scores.
    """
    spark = df.sparkSession
    is_pos = F.when(_not_null(label_col, "label") > 0.5, 1).otherwise(0)
    aggregated = (
        df.select(_score_column(df, score_col).alias("s"), is_pos.alias("y"))
        .groupBy("s")
        .agg(F.sum("y").alias("pos"), (F.count(F.lit(1)) - F.sum("y")).alias("neg"))
    )
    by_score = aggregated.persist()
    try:
        parts = range_parts(by_score, buckets or score_ranges(by_score.count()))
        lower = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        placed = parts.withColumn("n_lower", F.coalesce(F.sum("n").over(lower), F.lit(0)))
        row = placed.agg(F.sum("u").alias("inside"), *_area_parts(F.col("n_lower"))).first()
    finally:
        by_score.unpersist()

    u = float(row["inside"] or 0.0) + float(row["u"] or 0.0)
    p = int(row["p"] or 0)
    n = int(row["n"] or 0)
    if p > 0 and n > 0:
        auc = u / (float(p) * float(n))
    elif p > 0:
        auc = 1.0
    elif n > 0:
        auc = 0.0
    else:
        auc = 0.5
    # Built in the JVM: a DataFrame from a Python list would start Python
    # workers just to read one number back.
    return spark.range(1).select(F.lit(auc).cast("double").alias("auc"))


def range_parts(by_score: DataFrame, ranges: int) -> DataFrame:
    """``b, u, p, n`` per range of the distinct scores ``s, pos, neg``: the
    range's number in score order, the pairs of a positive with a lower
    negative inside it (ties half), its positives and negatives.

    The scores are placed by range once. The window over a range and the sum
    per range both find its scores together, so neither shuffles again.
    """
    splits: list[float] = []
    if ranges > 1:
        probs = [i / ranges for i in range(1, ranges)]
        # Error bound a quarter of a range wide keeps ranges within
        # ~1.5x of each other; the floor bounds the sketch to ~1e5 entries.
        cuts = by_score.approxQuantile("s", probs, max(1.0 / (4 * ranges), 1e-5))
        splits = sorted({c for c in cuts if c is not None and c == c and abs(c) != float("inf")})
    if splits:
        cut = Bucketizer(
            splits=[float("-inf"), *splits, float("inf")], inputCol="s", outputCol="b", handleInvalid="keep"
        ).transform(by_score)
    else:  # one range (one asked for, or a single distinct score)
        cut = by_score.withColumn("b", F.lit(0.0))
    # Whole numbers: Spark normalises doubles in a window's key, and would then
    # not see that they are in place already.
    placed = cut.withColumn("b", F.col("b").cast("int")).repartitionByRange(len(splits) + 1, "b")
    below = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(below), F.lit(0))
    return (
        placed.select("b", "pos", "neg", (F.col("pos") * (neg_below + 0.5 * F.col("neg"))).alias("u"))
        .groupBy("b")
        .agg(F.sum("u").alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    )


def auc_roc_evaluator(
    df: DataFrame,
    label_col: str,
    score_col: str = "rawPrediction",
    num_bins: int = 1000,
    weight_col: str | None = None,
) -> float:
    """MLlib's evaluator, down-sampling the curve to ``num_bins`` points
    (its default, hence approximate); ``num_bins=0`` is exact. With
    ``weight_col`` a row counts that often, so equal rows may be summed first.
    """
    evaluator = BinaryClassificationEvaluator(
        labelCol=label_col,
        rawPredictionCol=score_col,
        metricName="areaUnderROC",
        numBins=num_bins,
    )
    return (evaluator.setWeightCol(weight_col) if weight_col else evaluator).evaluate(df)
