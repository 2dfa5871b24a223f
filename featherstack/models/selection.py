"""Recursive feature elimination and parameter search over OOF AUC."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import auc
from ..session import materialize
from ..sources.sinks import write_table
from .gram import backward_elimination, fold_grams
from .oof import assemble, oof_fit_predict


def recursive_elimination(df: DataFrame, features: Sequence[str], target: str, keep: int, step: int = 2,
                          make_estimator: Callable[[], object] | None = None) -> list[str]:
    """Drop the ``step`` weakest features until ``keep`` remain.

    Without an estimator by their standardised ridge coefficients, from one
    pass over the rows (see ``gram.backward_elimination``); else by the
    |coefficient| or importance of a refit each step, features standardised
    once."""
    cols = list(features)
    if make_estimator is None:
        grams = fold_grams(df, cols, target)
        return backward_elimination(grams[0], cols, keep, step)[0] if grams else cols[:keep]
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    z = df.select(F.col(target).cast("double").alias("label"),
                  *[((F.coalesce(F.col(c), F.lit(stats[f"m_{c}"] or 0.0)) - F.lit(stats[f"m_{c}"] or 0.0))
                     / F.lit(stats[f"s_{c}"] or 1.0)).alias(c) for c in cols])
    z = materialize(z)
    while len(cols) > keep:
        model = make_estimator().fit(assemble(z, cols))
        weights = model.coefficients.toArray() if hasattr(model, "coefficients") else model.featureImportances.toArray()
        order = sorted(range(len(cols)), key=lambda i: (abs(weights[i]), cols[i]))
        drop = {cols[i] for i in order[:min(step, len(cols) - keep)]}
        cols = [c for c in cols if c not in drop]
    return cols


def search_params(train: DataFrame, key: str, target: str, features: Sequence[str], fold: str,
                  make_estimator: Callable[[Mapping], object], space: Mapping[str, Sequence], trials: int,
                  seed: int = 1001, workers: int = 2, test: DataFrame | None = None,
                  path: str | None = None) -> list[dict]:
    """Random search: each trial runs a full OOF fit over every fold and is
    scored by its OOF AUC.  Trials are submitted from a small thread pool so
    their Spark jobs overlap.  With ``path`` each trial's OOF (and test) scores
    are kept there, in ``trial=<i>`` folders below ``oof`` and ``test``."""
    rng = random.Random(seed)
    params = [{name: rng.choice(list(values)) for name, values in space.items()} for _ in range(trials)]
    train = materialize(train.select(key, target, fold, *features))

    def run(i_p):
        i, p = i_p
        oof, scored = oof_fit_predict(train, test, key, target, features, fold, lambda size: make_estimator(p), checkpoint=False)
        if path is not None:
            oof = train.sparkSession.read.parquet(write_table(oof, f"{path}/oof/trial={i}"))
            if scored is not None:
                write_table(scored, f"{path}/test/trial={i}")
        value = auc(oof.join(train.select(key, target), key), "score", target).first()["auc"]
        return {"trial": i, **{k_: str(v) for k_, v in p.items()}, "auc": value}

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(run, enumerate(params)))
