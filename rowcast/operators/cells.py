"""Tree fits over cells: rows in the same bins and with the same label, counted.

A histogram tree learner cuts every feature into at most ``maxBins`` bins and
sees nothing else of it. Rows that share their bins and their label are then
one row with a weight, so a fit over the counted cells reads a table whose size
is bounded by bins and classes (``maxBins`` to the number of features) and not
by the rows. Each row is still read: once for the bins' bounds, once for the
counts. MLlib fits the cells through its weight column, on bin numbers, and the
fitted trees get the bounds back as thresholds.

A forest's bootstrap draws every row Poisson(1) times for every tree. The rows
of a cell add up to one draw, Poisson of the cell's count, so each tree is
fitted with weights of its own. A draw follows from the cell, the tree and the
seed alone: such a forest does not depend on where rows lie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

# Smaller tables are fitted row by row: cells cost a few passes and, in a
# forest, a fit per tree.
LEAST_ROWS = 1_000_000
# Rows a cell must hold on average, or the table is fitted row by row.
LEAST_PER_CELL = 4
CELLS_PER_TASK = 50_000
# Trees of a forest that are fitted at a time.
TREES_AT_ONCE = 8


def fit_cells(estimator: Estimator, df: DataFrame) -> Model | None:
    """``estimator`` fitted over the cells of ``df``; None where only a fit over
    the rows gives its model (other learners, settings that count rows one by
    one, categorical features, values that have no bin, invalid labels) or
    where cells save nothing."""
    if not _takes_weights(estimator, df):
        return None
    label = estimator.getLabelCol()
    size = _size(df, estimator.getFeaturesCol())
    if not size:
        return None
    names = [f"x{i}" for i in range(size)]
    values = vector_to_array(F.col(estimator.getFeaturesCol()))
    rows = df.select(values.alias("_v"), F.col(label).cast("double").alias("y")).select(
        *[(F.col("_v")[i] + F.lit(0.0)).alias(n) for i, n in enumerate(names)], "y"  # -0.0 is 0.0
    )
    seen = _summary(rows, names)
    boosted = isinstance(estimator, GBTClassifier)
    if seen["n"] < LEAST_ROWS or not seen["usable"] or boosted and seen["y_max"] > 1:
        return None
    starts = bin_starts(rows, names, [seen[f"d_{n}"] for n in names], estimator.getMaxBins())
    binned = _binned(rows, names, [s for s, _ in starts])
    n_cells = binned.agg(F.approx_count_distinct(F.xxhash64(*names, "y"))).first()[0]
    if n_cells * LEAST_PER_CELL > seen["n"]:
        return None
    cells = binned.groupBy(*names, "y").agg(F.count(F.lit(1)).alias("n"))
    # Many short jobs read the cells: no more tasks than they need.
    cells = cells.coalesce(-(-max(1, n_cells) // CELLS_PER_TASK))
    bounds = [b for _, b in starts]
    if boosted:
        return _fit_boosted(estimator, _as_input(cells, names, label, 2), bounds)
    return _fit_forest(estimator, cells, names, label, int(seen["y_max"]) + 1, bounds)


def _takes_weights(estimator: Estimator, df: DataFrame) -> bool:
    if not isinstance(estimator, (GBTClassifier, RandomForestClassifier)):
        return False
    if estimator.getMinInstancesPerNode() != 1 or estimator.isDefined("weightCol") and estimator.getWeightCol():
        return False
    if isinstance(estimator, GBTClassifier) and (
        estimator.getSubsamplingRate() != 1.0
        or estimator.isDefined("validationIndicatorCol") and estimator.getValidationIndicatorCol()
    ):
        return False
    kinds = df.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return not set(kinds) & {"nominal", "binary"}


def _size(df: DataFrame, features_col: str) -> int:
    """The vectors' size: as the assembler notes it, else of the first row."""
    attrs = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    if noted := sum(map(len, attrs.values())):
        return noted
    first = df.select(F.size(vector_to_array(features_col))).first()
    return first[0] if first and first[0] and first[0] > 0 else 0


def _summary(rows: DataFrame, names: Sequence[str]) -> dict:
    """Rows, distinct values per feature (estimated), the highest label, and
    whether all values are finite and all labels whole numbers from 0."""
    whole = F.col("y").isNotNull() & ~F.isnan("y") & (F.col("y") >= 0) & (F.col("y") == F.floor("y"))
    finite = [F.col(n).isNotNull() & ~F.isnan(n) & (F.abs(n) != float("inf")) for n in names]
    good = whole
    for f in finite:
        good = good & f
    row = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~good).alias("bad"),
        F.max("y").alias("y_max"),
        *[F.approx_count_distinct(n).alias(f"d_{n}") for n in names],
    ).first()
    return {**row.asDict(), "usable": row["bad"] == 0}


def bin_starts(
    rows: DataFrame, names: Sequence[str], distinct: Sequence[int], max_bins: int
) -> list[tuple[list[float], list[float]]]:
    """Per feature the values at which bins after the first start, and the
    thresholds before them.

    A feature of at most ``max_bins`` values has a bin for each, with
    thresholds halfway between, as MLlib's. One of more values is cut at its
    quantiles over all rows (MLlib: over a sample of some 10,000).
    """
    # The estimate is some 5 % off; a set of that size is small either way.
    few = [n for n, d in zip(names, distinct) if d <= 2 * max_bins]
    found = rows.agg(*[F.collect_set(n).alias(n) for n in few]).first() if few else {}
    values = {n: sorted(found[n]) for n in few if len(found[n]) <= max_bins}
    if many := [n for n in names if n not in values]:
        probs = [i / max_bins for i in range(1, max_bins)]
        cuts = [F.percentile_approx(n, probs, F.lit(100 * max_bins)).alias(n) for n in many]
        found = rows.agg(*cuts, *[F.min(n).alias(f"{n}_min") for n in many]).first()
    out = []
    for n in names:
        if n in values:
            pairs = [(a, b, (a + b) / 2) for a, b in zip(values[n], values[n][1:])]
            out.append((values[n][1:], [m if a <= m < b else a for a, b, m in pairs]))
        else:
            starts = sorted({c for c in found[n] if c > found[f"{n}_min"]})
            out.append((starts, [math.nextafter(c, -math.inf) for c in starts]))
    return out


def _binned(rows: DataFrame, names: Sequence[str], starts: Sequence[list[float]]) -> DataFrame:
    cut = [n for n, s in zip(names, starts) if s]
    if cut:
        splits = [[-math.inf, *s, math.inf] for s in starts if s]
        rows = Bucketizer(splitsArray=splits, inputCols=cut, outputCols=[f"b_{n}" for n in cut]).transform(rows)
    # Numbers, not the categories that Bucketizer marks them as.
    return rows.select(*[F.col(f"b_{n}").alias(n, metadata={}) if s else F.lit(0.0).alias(n)
                         for n, s in zip(names, starts)], "y")


def _as_input(cells: DataFrame, names: Sequence[str], label: str, n_classes: int, weight: str = "n") -> DataFrame:
    """What MLlib fits: bin numbers as features, the label with its classes, a weight."""
    classes = {"ml_attr": {"type": "nominal", "num_vals": n_classes}}
    return VectorAssembler(inputCols=list(names), outputCol="_bins").transform(cells).select(
        "_bins", F.col("y").alias(label, metadata=classes), F.col(weight).cast("double").alias("_weight")
    )


def _fit_boosted(estimator: GBTClassifier, cells: DataFrame, bounds: Sequence[list[float]]) -> GBTClassificationModel:
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = estimator.copy({estimator.featuresCol: "_bins", estimator.weightCol: "_weight"}).fit(cells)
    finally:
        cells.unpersist()
    jvm, trees = _jvm(cells.sparkSession), list(fitted._java_obj.trees())
    cls = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    bounded = [cls(t.uid(), _bounded(jvm, t.rootNode(), bounds), t.numFeatures()) for t in trees]
    model = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        fitted.uid, _array(cells.sparkSession, cls, bounded), fitted._java_obj.treeWeights(), len(bounds), 2)
    return estimator._copyValues(GBTClassificationModel(model))


def _fit_forest(
    estimator: RandomForestClassifier, cells: DataFrame, names: Sequence[str], label: str, n_classes: int,
    bounds: Sequence[list[float]],
) -> RandomForestClassificationModel:
    n_trees, seed = estimator.getNumTrees(), estimator.getSeed()
    drawn = _drawn(cells, names, n_trees, seed, estimator.getBootstrap(), estimator.getSubsamplingRate())
    drawn = drawn.persist(StorageLevel.MEMORY_AND_DISK)
    strategy = estimator.getFeatureSubsetStrategy()
    if strategy == "auto":
        strategy = "sqrt" if n_trees > 1 else "all"
    spark = cells.sparkSession
    jvm = _jvm(spark)
    cls = jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel

    def tree(i: int):
        own = drawn.withColumn("n", F.col("draws")[i]).where("n > 0")
        one = estimator.copy({
            estimator.featuresCol: "_bins", estimator.weightCol: "_weight", estimator.numTrees: 1,
            estimator.bootstrap: False, estimator.subsamplingRate: 1.0, estimator.seed: seed + i,
            estimator.featureSubsetStrategy: strategy,
        })
        t = one.fit(_as_input(own, names, label, n_classes))._java_obj.trees()[0]
        return cls(t.uid(), _bounded(jvm, t.rootNode(), bounds), len(bounds), n_classes)

    try:
        drawn.count()
        with ThreadPool(min(TREES_AT_ONCE, n_trees)) as pool:
            trees = pool.map(inheritable_thread_target(spark)(tree), range(n_trees), chunksize=1)
    finally:
        drawn.unpersist()
    model = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
        estimator.uid, _array(spark, cls, trees), len(bounds), n_classes)
    return estimator._copyValues(RandomForestClassificationModel(model))


def _drawn(
    cells: DataFrame, names: Sequence[str], n_trees: int, seed: int, bootstrap: bool, rate: float
) -> DataFrame:
    """``cells`` with ``draws``: how many of a cell's rows each tree takes, the
    sum of MLlib's draws for each row (Poisson with replacement, else Bernoulli)."""
    keyed = cells.withColumn("_key", F.xxhash64(*names, "y"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            draws = []
            for key, n in zip(batch.pop("_key"), batch["n"]):
                rng = np.random.default_rng([int(key) % 2**64, seed % 2**64])
                if bootstrap:
                    draws.append(rng.poisson(rate * n, n_trees))
                else:
                    draws.append(rng.binomial(n, rate, n_trees))
            yield batch.assign(draws=draws)

    schema = ", ".join(f"{n} double" for n in names)
    return keyed.mapInPandas(draw, f"{schema}, y double, n long, draws array<long>")


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _array(spark: SparkSession, cls, items: Sequence):
    array = spark.sparkContext._gateway.new_array(cls, len(items))
    for i, item in enumerate(items):
        array[i] = item
    return array


def _bounded(jvm, node, bounds: Sequence[list[float]]):
    """The node with the features' own thresholds in place of bin numbers."""
    if node.subtreeDepth() == 0:
        return node
    tree, split = jvm.org.apache.spark.ml.tree, node.split()
    feature = split.featureIndex()
    # Bins up to the threshold's whole part lie left of it.
    own = tree.ContinuousSplit(feature, float(bounds[feature][math.floor(split.threshold())]))
    left, right = _bounded(jvm, node.leftChild(), bounds), _bounded(jvm, node.rightChild(), bounds)
    return tree.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, own, node.impurityStats())
