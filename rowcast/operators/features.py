"""Feature stages: vector assembly and standard scaling by the population std."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembler(
    input_cols: Sequence[str], output_col: str = "features", handle_invalid: str = "error"
) -> VectorAssembler:
    """MLlib's assembler. NULL or NaN inputs raise (``handle_invalid="error"``)
    when the vector is consumed; ``"skip"`` drops such rows, ``"keep"`` keeps NaN."""
    return VectorAssembler(
        inputCols=list(input_cols), outputCol=output_col, handleInvalid=handle_invalid
    )


def assemble(
    df: DataFrame,
    input_cols: Sequence[str],
    output_col: str = "features",
    handle_invalid: str = "error",
) -> DataFrame:
    return assembler(input_cols, output_col, handle_invalid).transform(df)


class _ScalerParams(HasInputCols, HasOutputCols):
    pass


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Centre each input column and divide by its population std.

    This is the convention of the common single-machine scaler (MLlib's own
    ``StandardScaler`` divides by the sample std and does not centre by
    default). Fitting is one aggregation pass: per column ``avg`` and
    ``stddev_pop``, combined map-side, so only one row of ``2 * k`` numbers
    reaches the driver whatever the input size. It works on scalar columns
    before assembly, so the transform is plain arithmetic inside whole-stage
    codegen. A column that holds NaN or an infinity has no mean to centre by
    and raises in ``fit``.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCols=None, outputCols=None):
        return self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        aggs = []
        for i, c in enumerate(cols):
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
        row = dataset.agg(*aggs).first()
        means = [float(row[f"m{i}"] or 0.0) for i in range(len(cols))]
        stds = [float(row[f"s{i}"] or 0.0) for i in range(len(cols))]
        unusable = [c for c, m, s in zip(cols, means, stds) if not (math.isfinite(m) and math.isfinite(s))]
        if unusable:
            raise ValueError(f"columns {unusable} hold NaN or infinite values and cannot be scaled")
        model = PopulationScalerModel(
            inputCols=cols, outputCols=self.getOutputCols(), means=means, stds=stds
        )
        return self._copyValues(model)


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted :class:`PopulationScaler`: ``(x - mean) / std``; 0.0 for a constant column."""

    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population standard deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        means: list[float] | None = None,
        stds: list[float] | None = None,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def getMeans(self) -> list[float]:
        return self.getOrDefault(self.means)

    def getStds(self) -> list[float]:
        return self.getOrDefault(self.stds)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = {}
        for src, dst, m, s in zip(
            self.getInputCols(), self.getOutputCols(), self.getMeans(), self.getStds()
        ):
            c = F.col(src).cast("double")
            if s != 0.0:
                out[dst] = (c - F.lit(m)) / F.lit(s)
            else:
                out[dst] = F.when(c.isNotNull(), F.lit(0.0))
        return dataset.withColumns(out)
