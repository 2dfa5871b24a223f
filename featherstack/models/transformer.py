"""Feature objects with fit/transform/save/load as Spark ML stages.

``RatioFeatures`` is a stateless Transformer producing named ratio columns;
``GlobalCentering`` is an Estimator that learns per-column statistics (a
bounded dict) and a Model that subtracts them.  Both persist with the
standard ML writers, replacing joblib pickles.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RatioFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``num / den`` columns (x/0 → NULL) named ``<num>_over_<den>``."""

    pairs = Param(Params._dummy(), "pairs", "list of 'num/den' strings", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, pairs=None):
        super().__init__()
        self._setDefault(pairs=[])
        self._set(**self._input_kwargs)

    def feature_names(self) -> list[str]:
        return [p.replace("/", "_over_") for p in self.getOrDefault(self.pairs)]

    def _transform(self, df: DataFrame) -> DataFrame:
        exprs = []
        for p in self.getOrDefault(self.pairs):
            num, den = p.split("/")
            exprs.append(F.try_divide(F.col(num).cast("double"), F.col(den)).alias(p.replace("/", "_over_")))
        return df.select("*", *exprs)


class GlobalCentering(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the global mean of each input column."""

    inputCols = Param(Params._dummy(), "inputCols", "columns", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "GlobalCenteringModel":
        cols = self.getOrDefault(self.inputCols)
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return GlobalCenteringModel(inputCols=cols, means=[float(row[c]) if row[c] is not None else 0.0 for c in cols])


class GlobalCenteringModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "columns", typeConverter=TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "fitted means", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, means=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, means = self.getOrDefault(self.inputCols), self.getOrDefault(self.means)
        return df.select("*", *[(F.col(c) - F.lit(m)).alias(f"{c}_centred") for c, m in zip(cols, means)])
