"""Cross-validated out-of-fold (OOF) prediction, bagging and estimators.

The fold loop runs on the driver and submits one Spark ML fit per fold; the
data never leaves the executors.  The assembled training vectors are
checkpointed once to the shared folder (reliable: survives executor loss)
and reused by every fold and bag.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml import Estimator
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

class FitSize(NamedTuple):
    """What a fit sees: its training rows and the sum of their weights."""
    rows: int
    weight: float


EstimatorFactory = Callable[[FitSize], Estimator]
Transform = Callable[[DataFrame], DataFrame]
HELD = "__held"  # marks the held-out rows for early stopping


# ---------------------------------------------------------------- estimators
def fit_gbt(max_iter: int = 50, max_depth: int = 5, step: float = 0.1, seed: int = 1001, subsample: float = 0.8,
            max_bins: int = 64, weight_col: str | None = None, validation_col: str | None = None) -> GBTClassifier:
    """Boosted trees (the gradient-boosting role); ``validation_col`` marks rows
    used for early stopping."""
    gbt = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=seed, subsamplingRate=subsample,
                        maxBins=max_bins)
    if weight_col:
        gbt.setWeightCol(weight_col)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col)
    return gbt


def fit_logistic(c: float, total_weight: float, weight_col: str | None = None, max_iter: int = 100) -> LogisticRegression:
    """L2 logistic regression without intercept, parameterised like
    sklearn's ``C``: Spark's ``regParam = 1 / (C · Σw)``, no standardisation."""
    lr = LogisticRegression(regParam=1.0 / (c * total_weight), elasticNetParam=0.0, fitIntercept=False,
                            standardization=False, maxIter=max_iter)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def fit_ridge(alpha: float, n_rows: int) -> LinearRegression:
    """Ridge without intercept: sklearn's ``alpha`` is ``regParam = alpha / n``."""
    return LinearRegression(regParam=alpha / max(n_rows, 1), elasticNetParam=0.0, fitIntercept=False,
                            standardization=False, solver="normal")


def fit_mlp(n_features: int, hidden: Sequence[int] = (128, 64), seed: int = 1001, max_iter: int = 100,
            block_size: int = 128) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], seed=seed, maxIter=max_iter,
                                          blockSize=block_size)


def score_column(model_output: DataFrame) -> Column:
    """Positive-class probability for classifiers, prediction for regressors."""
    if "probability" in model_output.columns:
        return vector_to_array(F.col("probability"))[1]
    return F.col("prediction")


# ---------------------------------------------------------------- OOF loop
def assemble(df: DataFrame, features: Sequence[str], out: str = "features", fill: float = 0.0) -> DataFrame:
    """Numeric features (missing → ``fill``) into one vector column."""
    filled = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(fill)).alias(f"__f_{i}")
                              for i, c in enumerate(features)])
    vec = VectorAssembler(inputCols=[f"__f_{i}" for i in range(len(features))], outputCol=out)
    return vec.transform(filled).drop(*[f"__f_{i}" for i in range(len(features))])


def fold_sizes(train: DataFrame, fold: str, weight_col: str | None = None) -> dict:
    """Rows and weight of every fold id in the data; a row without a fold is an
    error, because no model would ever score it."""
    weight = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    rows = train.groupBy(fold).agg(F.count(F.lit(1)).alias("rows"), weight.cast("double").alias("weight")).collect()
    sizes = {r[0]: FitSize(r["rows"], r["weight"]) for r in rows}
    if None in sizes:
        raise ValueError(f"{sizes[None].rows} training rows have no {fold}")
    if len(sizes) < 2:
        raise ValueError(f"{fold} must have two values at least")
    return dict(sorted(sizes.items()))


def _models(tr: DataFrame, fold: str, sizes: Mapping, make_estimator: Callable[[FitSize], Estimator],
            prep: Callable[[DataFrame], Transform] | None):
    """(fold id, model, transform) for each fold, fitted on the other folds.

    An estimator with a validation indicator column stops early on the
    held-out rows; every other one sees the fold's training rows only.
    """
    total = FitSize(sum(s.rows for s in sizes.values()), sum(s.weight for s in sizes.values()))
    for f, size in sizes.items():
        rest = tr.where(F.col(fold) != F.lit(f))
        change = prep(rest) if prep else (lambda df: df)
        estimator = make_estimator(FitSize(total.rows - size.rows, total.weight - size.weight))
        stops = estimator.hasParam("validationIndicatorCol") and estimator.isDefined("validationIndicatorCol")
        fit_rows = tr.withColumn(estimator.getOrDefault("validationIndicatorCol"), F.col(fold) == F.lit(f)) if stops else rest
        yield f, estimator.fit(change(fit_rows)), change


def _add_score(df: DataFrame, model, change: Transform, out: str) -> DataFrame:
    """``df`` with one more score column; the features stay as they were."""
    keep = df.columns
    scored = model.transform(change(df.withColumn("__raw", F.col("features"))))
    return scored.withColumn(out, score_column(scored)).withColumn("features", F.col("__raw")).select(*keep, out)


def oof_fit_predict(train: DataFrame, test: DataFrame | None, key: str, target: str, features: Sequence[str],
                    fold: str, make_estimator: EstimatorFactory, prep: Callable[[DataFrame], Transform] | None = None,
                    weight_col: str | None = None, checkpoint: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Fit on all folds but one, score the held-out fold, for every fold id in
    the data; test scores are the mean over the fold models.

    ``prep(fit_rows)`` fits preprocessing on the fold's training rows and
    returns a transform, which is applied to the training, the held-out and
    the test rows alike.  Every training row is scored exactly once: rows
    without a fold are refused, the others partition by their fold id.  The
    test rows are scored by all fold models in one pass.
    """
    cols = [key, target, fold, *([weight_col] if weight_col else [])]
    tr = assemble(train.select(*cols, *features), features).withColumn("label", F.col(target).cast("double"))
    if checkpoint:
        tr = materialize(tr)
    sizes = fold_sizes(tr, fold, weight_col)
    te = assemble(test.select(key, *features), features).select(key, "features") if test is not None else None
    parts, names = [], []
    for i, (f, model, change) in enumerate(_models(tr, fold, sizes, make_estimator, prep)):
        held = tr.where(F.col(fold) == F.lit(f)).select(key, fold, "features")
        parts.append(_add_score(held, model, change, "score").drop("features"))
        if te is not None:
            names.append(f"__s{i}")
            te = _add_score(te, model, change, names[-1])
    mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names) if names else None
    return reduce(DataFrame.unionByName, parts), te.select(key, mean.alias("score")) if te is not None else None


def bagged_oof(train: DataFrame, test: DataFrame | None, key: str, target: str, features: Sequence[str], fold: str,
               make_estimator: Callable[[int, FitSize], Estimator], bags: Sequence[int],
               weight_col: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Refit with each bag parameter (seed, C, alpha ...): long tables
    ``(key, fold, bag, score)`` of the held-out rows and of the test rows, which
    all models score in one pass."""
    cols = [key, target, fold, *([weight_col] if weight_col else [])]
    tr = materialize(assemble(train.select(*cols, *features), features).withColumn("label", F.col(target).cast("double")))
    te = assemble(test.select(key, *features), features).select(key, "features") if test is not None else None
    sizes = fold_sizes(tr, fold, weight_col)
    oofs, names = [], {}
    for b in bags:
        for f, model, change in _models(tr, fold, sizes, lambda size, b=b: make_estimator(b, size), None):
            held = tr.where(F.col(fold) == F.lit(f)).select(key, fold, "features")
            oofs.append(_add_score(held, model, change, "score").select(key, fold, F.lit(b).alias("bag"), "score"))
            if te is not None:
                names[b, f] = f"__s{len(names)}"
                te = _add_score(te, model, change, names[b, f])
    tests = None
    if te is not None:
        fold_type = dict(tr.dtypes)[fold]
        each = [F.struct(F.lit(f).cast(fold_type).alias(fold), F.lit(b).alias("bag"), F.col(n).alias("score")) for (b, f), n in names.items()]
        tests = te.select(key, F.explode(F.array(*each)).alias("s")).select(key, "s.*")
    return reduce(DataFrame.unionByName, oofs), tests
