"""Training, selecting and applying the forecast models with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from dialwright import fixed_values as fv
from dialwright.operators import clean, timeseries
from dialwright.session import local_frame

_SEED = 7

# Boosting runs one small job per tree level, so tasks that hold next to nothing cost more than the rows.
_ROWS_PER_TASK = 20_000
_LONGEST = "gradient_boosted_trees"


def time_split(df: DataFrame, ts: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the day ``cut`` for training, later rows for testing."""
    day = F.lit(cut).cast("date")
    # A range on the raw column, so that each side prunes its files.
    edge = F.date_add(day, 1).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) < edge), df.filter(F.col(ts) >= edge)


def _means(rows: DataFrame, features: list[str]) -> dict[str, float]:
    """Mean of each feature in the training rows; 0 where it never has a value."""
    present = [F.avg(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))).alias(f) for f in features]
    found = rows.agg(*present).first().asDict()
    return {f: found[f] if found[f] is not None else 0.0 for f in features}


def _pipeline(features: list[str], regressor, means: dict[str, float]) -> Pipeline:
    """Feature vector and regressor; a missing feature takes its training mean, so every row is kept."""
    filled = ", ".join(
        f"coalesce(nanvl(cast(`{f}` as double), cast(null as double)), {means[f]!r}D) AS `__{f}`" for f in features
    )
    filling = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    assembler = VectorAssembler(inputCols=[f"__{f}" for f in features], outputCol="features", handleInvalid="error")
    return Pipeline(stages=[filling, assembler, regressor])


def _labelled(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a feature table for the several passes of a fit, in as few tasks as its rows allow.

    The number of tasks follows the row count, not the shuffle partitions that
    made the table.  Lost blocks are recomputed.
    """
    spread = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tasks = max(1, math.ceil(spread.count() / _ROWS_PER_TASK))
        kept = spread.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kept.count()
            spread.unpersist()
            yield kept
        finally:
            kept.unpersist()
    finally:
        spread.unpersist()


def boosted_trees(
    target: str, trees: int = fv.GBT_TREES, learning_rate: float = fv.GBT_LEARNING_RATE, depth: int = fv.GBT_DEPTH
) -> GBTRegressor:
    """Gradient-boosted trees with the settings of both forecasts."""
    return GBTRegressor(
        featuresCol="features", labelCol=target, maxIter=trees, stepSize=learning_rate, maxDepth=depth, seed=_SEED
    )


def train_gbt(df: DataFrame, features: list[str], target: str, **settings: object) -> PipelineModel:
    """Fit boosted trees on the rows of a feature table whose target is known."""
    with _kept(_labelled(df, target)) as rows:
        return _pipeline(features, boosted_trees(target, **settings), _means(rows, features)).fit(rows)


def predict(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    """Score every row, missing features or not; energy is never negative."""
    scored = model.transform(df).withColumnRenamed("prediction", out).select(*df.columns, out)
    return clean.clamp_min(scored, out)


def seasonal_naive(
    df: DataFrame, target: str, out: str = "naive", ts: str = "ts", season: str = "1 day", by: list[str] | None = None
) -> DataFrame:
    """Every row with the target's last known value one season earlier, the yardstick of any model.

    The value at exactly the same instant a season before, or the newest one
    before that; NULL where nothing is that old.  ``by`` names several series.
    """
    keys = by or []
    known = df.filter(F.col(target).isNotNull()).select(*keys, ts, F.col(target).alias(out))
    asked = df.withColumn("__ts", F.col(ts)).withColumn(ts, F.col(ts) - F.expr(f"INTERVAL {season}"))
    found = timeseries.asof_join(asked, known, keys, ts, [out], right_tie=[out])
    return found.withColumn(ts, F.col("__ts")).select(*df.columns, out)


def skill(scored: DataFrame, target: str, predictions: list[str], against: str) -> DataFrame:
    """One row: ``n_scored``, and ``<p>_rmse`` and ``<p>_skill`` of every prediction column.

    Errors cover the rows where target and all predictions are known, so all
    are judged on the same ones.  Skill is 1 - RMSE / RMSE of ``against``: 1 is
    perfect, 0 is no better than it, NULL if it makes no error.
    """
    known = scored.dropna(subset=list(dict.fromkeys([target, against, *predictions])))
    square = {p: F.pow(F.col(p) - F.col(target), 2) for p in dict.fromkeys([*predictions, against])}
    errors = known.agg(F.count(F.lit(1)).alias("n_scored"), *(F.sqrt(F.avg(s)).alias(f"{p}_rmse") for p, s in square.items()))
    yardstick = F.nullif(F.col(f"{against}_rmse"), F.lit(0.0))
    return errors.withColumns({f"{p}_skill": 1 - F.col(f"{p}_rmse") / yardstick for p in predictions})


def candidates(target: str, trees: int = fv.GBT_TREES) -> dict[str, object]:
    """Four regressors to choose from."""
    common = {"featuresCol": "features", "labelCol": target}
    return {
        "decision_tree": DecisionTreeRegressor(maxDepth=fv.GBT_DEPTH, seed=_SEED, **common),
        "gradient_boosted_trees": boosted_trees(target, trees),
        "linear_regression": LinearRegression(**common),
        "random_forest": RandomForestRegressor(maxDepth=fv.GBT_DEPTH, seed=_SEED, **common),
    }


def _fold_edges(rows: DataFrame, ts: str, folds: int) -> list[object]:
    """``folds + 2`` instants that cut the rows' time span into equal shares of rows, ends included."""
    seconds = F.unix_micros(F.col(ts).cast("timestamp"))
    cuts = rows.agg(F.percentile_approx(seconds, [i / (folds + 1) for i in range(folds + 2)])).first()[0]
    return cuts or []


def select_model(
    df: DataFrame,
    features: list[str],
    target: str,
    folds: int = 3,
    trees: int = fv.GBT_TREES,
    ts: str = "ts",
    parallelism: int = 4,
) -> tuple[DataFrame, object]:
    """Validate every candidate forward in time; the lowest mean RMSE wins.

    The time span is cut into ``folds + 1`` parts of about equal row counts.
    Fold i trains on the first i parts and is judged on the next one, so no
    model sees the future of what it is judged on.  ``parallelism`` fits run
    side by side, as in Spark's own cross validator.  Returns the scores (one
    row per algorithm) and the winner fitted on all rows.
    """
    evaluator = RegressionEvaluator(labelCol=target, metricName="rmse")
    spark = df.sparkSession
    with _kept(_labelled(df, target)) as rows:
        edges = _fold_edges(rows, ts, folds)
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        means = _means(rows, features)
        splits = []
        for cut, end in zip(edges[1:-1], edges[2:], strict=True):
            past = rows.filter(at < cut)
            ahead = rows.filter((at >= cut) & ((at < end) if end != edges[-1] else (at <= end)))
            splits.append((past, ahead, _means(past, features)))

        def error(fit: tuple[str, int]) -> float:
            name, fold = fit
            past, ahead, known = splits[fold]
            model = _pipeline(features, candidates(target, trees)[name], known).fit(past)
            return evaluator.evaluate(model.transform(ahead))

        names = list(candidates(target, trees))
        # The longest fits first, so that none of them starts when the others are done.
        fits = sorted(((n, i) for n in names for i in range(len(splits))), key=lambda f: f[0] != _LONGEST)
        with ThreadPool(max(1, min(parallelism, len(fits)))) as pool:
            errors = dict(zip(fits, pool.map(inheritable_thread_target(spark)(error), fits, chunksize=1), strict=True))
        scores = {n: sum(errors[n, i] for i in range(len(splits))) / len(splits) for n in names}
        best = min(scores, key=scores.get)
        winner = _pipeline(features, candidates(target, trees)[best], means).fit(rows)
    report = [(name, float(rmse), name == best) for name, rmse in scores.items()]
    return local_frame(spark, report, "algorithm string, rmse double, is_best boolean"), winner
