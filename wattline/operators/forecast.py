"""Rolling-origin forecasts.

Inputs are indexed series (``pos``, ``n``); outputs follow the forecast layout ``group_key, fold,
horizon_step, time, actual, forecast, model_type``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.time import calendar_features, horizon_steps, plus_minutes
from wattline.operators.blockwise import as_matrix, merge_statistics, per_row, sliding, summed_products
from wattline.operators.score import wape
from wattline.operators.series import SERIES_BLOCK, block_of, cadence, matched, prefix_sums, shifted, with_context
from wattline.operators.windows import fourier_terms
from wattline.schema import FORECASTS
from wattline.session import settled, sized

NAIVE = "seasonal_naive"
FALLBACK = "seasonal_naive_fallback"
LAG_MODEL = "forest_lag_features"
SEASONAL_MODEL = "seasonal_regression"
TUNED_MODEL = "seasonal_regression_tuned"

OUTPUT = ("group_key", "fold", "horizon_step", "time", "actual", "forecast", "model_type")


def cutoffs(groups: DataFrame, folds: int, n: str = "n", start: str = "start", horizon: str = "horizon") -> DataFrame:
    """Rolling-origin cutoffs of each row of ``groups``: columns ``fold`` (from 1) and ``cutoff``.

    Groups without room for one horizon after the start have none.
    """
    end = F.col(n) - F.col(horizon)
    usable = groups.filter(end > F.col(start))
    if folds <= 1:
        return usable.withColumn("fold", F.lit(1)).withColumn("cutoff", end.cast("long"))
    step = F.greatest(F.lit(1), F.floor((end - F.col(start)) / (folds - 1)))
    spread = usable.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    spread = spread.withColumn("cutoff", (F.col(start) + (F.col("fold") - 1) * step).cast("long"))
    return spread.filter(F.col("cutoff") <= end)


def fold_plan(df: DataFrame, group: str, horizon_hours: int, folds: int, extra_start: Mapping[str, int] | None = None) -> DataFrame:
    """Per group and fold: ``cutoff``, ``horizon``, ``season`` and ``cadence_minutes``.

    Folds start after one season or one horizon, whichever is longer; ``extra_start`` of ``{"days": k}`` asks
    for ``k`` days of history instead of one season.
    """
    sizes = df.groupBy(group).agg(F.max("n").alias("n"))
    plan = matched(sizes, cadence(df, group, 60), group)
    plan = plan.withColumn("horizon", horizon_steps(horizon_hours, F.col("cadence_minutes")))
    plan = plan.withColumn("season", horizon_steps(24, F.col("cadence_minutes")))
    days = (extra_start or {}).get("days", 1)
    plan = plan.withColumn("start", F.greatest(F.col("season") * days, F.col("horizon")))
    return settled(cutoffs(plan, folds).drop("start"), "folds")


def fold_targets(plan: DataFrame) -> DataFrame:
    """One row per group, fold and horizon step with the target position."""
    spread = plan.withColumn("horizon_step", F.explode(F.sequence(F.lit(1), F.col("horizon"))))
    return spread.withColumn("pos", F.col("cutoff") + F.col("horizon_step") - 1)


def _with_actuals(targets: DataFrame, df: DataFrame, group: str) -> DataFrame:
    return matched(targets, df.select(group, "pos", "time", F.col("kwh").alias("actual")), [group, "pos"])


def _output(df: DataFrame, group: str) -> DataFrame:
    named = df.withColumn("group_key", F.col(group).cast("string"))
    return named.select(*[F.col(c).cast("int") if c in ("fold", "horizon_step") else F.col(c) for c in OUTPUT])


def _naive_values(targets: DataFrame, df: DataFrame, group: str, repeat_season: bool = False) -> DataFrame:
    """Targets with ``naive``: the value one season earlier, else the last value before the cutoff."""
    seasons_back = F.lit(1)
    if repeat_season:  # step back whole seasons until the source lies before the cutoff
        seasons_back = F.ceil(F.col("horizon_step") / F.col("season"))
    source = F.col("pos") - F.col("season") * seasons_back
    asked = targets.withColumn("_src", F.when(source >= 0, source).otherwise(F.col("cutoff") - 1))
    return matched(
        asked, df.select(group, F.col("pos").alias("_src"), F.col("kwh").alias("naive")), [group, "_src"], "left"
    ).drop("_src")


def seasonal_naive(
    df: DataFrame, group: str, horizon_hours: int = 24, folds: int = 5, repeat_season: bool = False
) -> DataFrame:
    """Repeat the value one season (a day) earlier.

    With a horizon longer than a season the plain rule reads values after the cutoff; ``repeat_season=True``
    repeats the last known season instead.
    """
    targets = fold_targets(fold_plan(df, group, horizon_hours, folds))
    values = _naive_values(_with_actuals(targets, df, group), df, group, repeat_season)
    return _output(values.withColumn("forecast", F.col("naive")).withColumn("model_type", F.lit(NAIVE)), group)


LAG_COLUMNS = ("lag_1", "lag_2", "lag_3", "mean_day", "mean_6", "hour_sin", "hour_cos", "dow_sin", "dow_cos")


def direct_features(df: DataFrame, plan: DataFrame, group: str, block: int = SERIES_BLOCK) -> DataFrame:
    """Lag and calendar features known a whole horizon ahead, so all steps are forecast in one pass.

    Lags are whole days back, the nearest at least one horizon; the means cover the day and the six values
    ending there.  Positions are looked up by joins because the steps differ by group.
    """
    steps = plan.select(group, "horizon", F.col("season").alias("day")).distinct()
    nearest = F.col("day") * F.ceil(F.col("horizon") / F.col("day"))
    base = prefix_sums(df, group, {"running": F.col("kwh")}, block)
    base = matched(base, steps.withColumn("near", nearest).drop("horizon"), group)
    out = shifted(base, group, F.col("near"), {"lag_1": "kwh", "sum_near": "running"})
    past = base.select(group, "pos", "n", "near", "day", "kwh", "running")

    def look_up(shift: Column, columns: Mapping[str, str]) -> DataFrame:
        return past.select(group, (F.col("pos") + shift).alias("pos"), *[F.col(o).alias(c) for c, o in columns.items()])

    day = F.col("near") + F.col("day")
    out = matched(out, look_up(day, {"lag_2": "kwh", "sum_day": "running"}), [group, "pos"])
    out = matched(out, look_up(day + F.col("day"), {"lag_3": "kwh"}), [group, "pos"], "left")
    out = out.withColumn("lag_3", F.coalesce("lag_3", "lag_2"))
    out = matched(out, look_up(F.col("near") + 6, {"sum_6": "running"}), [group, "pos"])
    out = out.withColumn("mean_day", (F.col("sum_near") - F.col("sum_day")) / F.col("day"))
    out = out.withColumn("mean_6", (F.col("sum_near") - F.col("sum_6")) / 6)
    out = out.withColumns(calendar_features(F.col("time")))
    return out.select(group, "pos", "time", "kwh", "running", *LAG_COLUMNS)


def lag_regression(
    df: DataFrame,
    group: str,
    horizon_hours: int = 24,
    folds: int = 5,
    trees: int = 40,
    max_depth: int = 8,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Regression forest on lag and calendar features, one fit per fold over all groups.

    A forest grows all its trees level by level together, so a fit takes a handful of passes.

    Values are divided by the group's mean before the cutoff, so one model serves groups of any level and no
    group index is needed.
    """
    plan = fold_plan(df, group, horizon_hours, folds, {"days": 3})
    features = settled(direct_features(df, plan, group, block), "features")
    scaled = ["lag_1", "lag_2", "lag_3", "mean_day", "mean_6"]
    assembler = VectorAssembler(inputCols=list(LAG_COLUMNS), outputCol="features")
    out = None
    for fold in range(1, folds + 1):
        # The running sum at the last row before the cutoff gives the mean of the history.
        here = plan.filter(F.col("fold") == fold)
        level = (
            matched(here.withColumn("pos", F.col("cutoff") - 1), features.select(group, "pos", "running"), [group, "pos"])
            .select(group, "fold", "cutoff", "horizon", F.greatest(F.col("running") / F.col("cutoff"), F.lit(1e-9)).alias("level"))
        )
        rows = matched(features, level, group).withColumns({c: F.col(c) / F.col("level") for c in scaled})
        rows = assembler.transform(rows.withColumn("label", F.col("kwh") / F.col("level")))
        train = rows.filter(F.col("pos") < F.col("cutoff"))
        if train.isEmpty():
            continue
        forest = RandomForestRegressor(numTrees=trees, maxDepth=max_depth, seed=42)
        model = forest.fit(train.select("features", "label"))
        ahead = rows.filter((F.col("pos") >= F.col("cutoff")) & (F.col("pos") < F.col("cutoff") + F.col("horizon")))
        done = model.transform(ahead).select(
            group,
            "fold",
            (F.col("pos") - F.col("cutoff") + 1).alias("horizon_step"),
            "time",
            F.col("kwh").alias("actual"),
            F.greatest(F.lit(0.0), F.col("prediction") * F.col("level")).alias("forecast"),
            F.lit(LAG_MODEL).alias("model_type"),
        )
        out = done if out is None else out.unionByName(done)
    if out is None:
        return df.sparkSession.createDataFrame([], "group_key string, fold int, horizon_step int, time timestamp, actual double, forecast double, model_type string")
    return _output(out, group)


def _design(time: Column, origin: Column, daily_order: int, weekly_order: int) -> Column:
    trend = (F.unix_timestamp(time) - F.unix_timestamp(origin)) / (30 * 86_400.0)
    return F.array(F.lit(1.0), trend, *fourier_terms(time, daily_order, weekly_order))


def _stacked(pdf: pd.DataFrame) -> np.ndarray:
    return np.vstack(pdf["z"].to_numpy())


def solve_regression(products: np.ndarray, ridge: float) -> tuple:
    """Coefficients and residual deviation from ``[x, y]'[x, y]``; none when there are too few rows."""
    size = len(products) - 1
    gram, moment, total = products[:size, :size], products[:size, size], products[size, size]
    count = gram[0, 0]
    if count < 2 * size:
        return None, None
    penalty = np.full(size, ridge * np.trace(gram) / size)
    penalty[0] = 0.0
    try:
        beta = np.linalg.solve(gram + np.diag(penalty), moment)
    except np.linalg.LinAlgError:
        return None, None
    if not np.isfinite(beta).all():
        return None, None
    squares = max(total - 2 * beta @ moment + beta @ gram @ beta, 0.0)
    return beta, float(np.sqrt(squares / max(count - size, 1)))


def _fit_folds(df: DataFrame, plan: DataFrame, group: str, design: Column, ridge: float, block: int) -> DataFrame:
    """Coefficients per group and fold: rows are summed once per stretch between cutoffs, folds add stretches."""
    ends = sized(plan.groupBy(group).agg(F.array_sort(F.collect_list("cutoff")).alias("_ends")))
    rows = matched(df, ends, group).withColumn("z", F.array_append(design, F.col("kwh")))
    stretch = F.size(F.filter("_ends", lambda e: e <= F.col("pos")))
    rows = rows.withColumn("stretch", stretch).filter(F.col("stretch") < F.size("_ends"))
    rows = rows.select(group, "stretch", "z", block_of(F.col("pos"), block).alias("_block"))
    sums = summed_products(rows, [group, "stretch"], _stacked)
    upto = matched(sums, plan.select(group, "fold"), group).filter(F.col("stretch") < F.col("fold"))
    upto = upto.groupBy(group, "fold", "i").agg(F.sum("v").alias("v"))
    columns = {"beta": T.ArrayType(T.DoubleType()), "sigma": T.DoubleType()}
    return sized(per_row(as_matrix(upto), columns, lambda m: solve_regression(m, ridge)))


def _dot(x: Column, beta: Column) -> Column:
    return F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def seasonal_regression(
    df: DataFrame,
    group: str,
    horizon_hours: int = 24,
    folds: int = 5,
    ridge: float = 1e-6,
    daily_order: int = 4,
    weekly_order: int = 3,
    name: str = SEASONAL_MODEL,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Trend plus daily and weekly Fourier terms by least squares, per group and fold, with a 95 % band.

    Where no fit is possible the seasonal-naive value is given and ``model_type`` says so.
    """
    plan = fold_plan(df, group, horizon_hours, folds)
    origin = sized(df.groupBy(group).agg(F.min("time").alias("_origin")))
    design = _design(F.col("time"), F.col("_origin"), daily_order, weekly_order)
    models = _fit_folds(matched(df, origin, group), plan, group, design, ridge, block)
    targets = _naive_values(_with_actuals(fold_targets(plan), df, group), df, group)
    scored = matched(matched(targets, origin, group), models, [group, "fold"], "left")
    value = _dot(design, F.col("beta"))
    fitted = F.col("beta").isNotNull()
    scored = scored.withColumn("forecast", F.when(fitted, value).otherwise(F.col("naive")))
    scored = scored.withColumn("model_type", F.when(fitted, name).otherwise(FALLBACK))
    band = 1.96 * F.coalesce("sigma", F.lit(0.0))
    banded = scored.withColumn("lower", F.col("forecast") - band).withColumn("upper", F.col("forecast") + band)
    named = banded.withColumn("group_key", F.col(group).cast("string")).withColumn("fold", F.col("fold").cast("int"))
    return named.withColumn("horizon_step", F.col("horizon_step").cast("int")).select(*OUTPUT, "lower", "upper")


def seasonal_regression_tuned(df: DataFrame, group: str, horizon_hours: int = 24, folds: int = 5, **how: object) -> DataFrame:
    """The same model with stronger shrinkage."""
    return seasonal_regression(df, group, horizon_hours, folds, ridge=1e-2, name=TUNED_MODEL, **how)


def seasonal_outlook(
    df: DataFrame, group: str, steps: int = 7, ridge: float = 1e-6, daily_order: int = 0, weekly_order: int = 3,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Forecast after the end of each series: ``ds, yhat, yhat_lower, yhat_upper`` for ``steps`` samples.

    The daily form takes a series of daily totals; groups too short for a fit are left out.
    """
    plan = df.groupBy(group).agg(F.max("n").alias("cutoff"), F.min("time").alias("_origin"), F.max("time").alias("_last"))
    plan = settled(matched(plan, cadence(df, group, 1440), group), "outlook")
    design = _design(F.col("time"), F.col("_origin"), daily_order, weekly_order)
    with_origin = matched(df, plan.select(group, "_origin"), group)
    models = _fit_folds(with_origin, plan.withColumn("fold", F.lit(1)), group, design, ridge, block).drop("fold")
    ahead = plan.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    ahead = ahead.withColumn("time", plus_minutes(F.col("_last"), F.col("step") * F.col("cadence_minutes")))
    scored = matched(ahead, models.filter("beta IS NOT NULL"), group).withColumn("yhat", _dot(design, F.col("beta")))
    band = 1.96 * F.col("sigma")
    return scored.select(
        group,
        F.col("time").alias("ds"),
        "yhat",
        (F.col("yhat") - band).alias("yhat_lower"),
        (F.col("yhat") + band).alias("yhat_upper"),
    )


def sequence_statistics(
    df: DataFrame, group: str, window: int = 96, horizon: int = 4, value: str = "kwh", block: int = SERIES_BLOCK
) -> DataFrame:
    """Additive statistics of all ``window`` in, ``horizon`` out sequences of each group."""

    def rows_of(pdf: pd.DataFrame) -> np.ndarray:
        x = sliding(pdf.sort_values("pos")["_v"].to_numpy(dtype=float), window + horizon)
        return np.hstack([np.ones((len(x), 1)), x])

    rows = df.select(group, "pos", "n", F.col(value).cast("double").alias("_v"))
    return summed_products(with_context(rows, window + horizon - 1, block), [group], rows_of)


def update_statistics(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Refit on new data: the stored statistics plus those of the new rows, old rows are not read again."""
    return merge_statistics(stored, new)


def sequence_model(statistics: DataFrame, window: int = 96, horizon: int = 4, ridge: float = 1e-4) -> DataFrame:
    """Linear map from the last ``window`` values to the next ``horizon`` ones, flattened as ``weights``."""

    def fit(products: np.ndarray) -> tuple:
        size = window + 1
        gram, moment = products[:size, :size], products[:size, size:]
        weights = np.linalg.solve(gram + np.eye(size) * (ridge * np.trace(gram) / size + 1e-9), moment)
        return (weights.T.ravel(),)

    return per_row(as_matrix(statistics), {"weights": T.ArrayType(T.DoubleType())}, fit)


def sequence_regression(
    df: DataFrame, group: str, window: int = 96, horizon: int = 4, statistics: DataFrame | None = None,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """The next ``horizon`` values of each group from its last ``window`` values: ``(group, step, forecast)``."""
    statistics = statistics or sequence_statistics(df, group, window, horizon, block=block)
    models = sequence_model(statistics, window, horizon)
    tail = df.filter(F.col("pos") >= F.col("n") - window).groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "kwh"))), lambda r: r["kwh"]).alias("_tail")
    )
    inputs = F.concat(F.array(F.lit(1.0)), F.col("_tail"))
    ready = matched(tail.filter(F.size("_tail") == window), models, group)
    spread = ready.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    part = F.slice("weights", (F.col("step") - 1) * (window + 1) + 1, F.lit(window + 1))
    return spread.select(group, "step", _dot(inputs, part).alias("forecast"))


MODELS = {
    NAIVE: seasonal_naive,
    SEASONAL_MODEL: seasonal_regression,
    TUNED_MODEL: seasonal_regression_tuned,
    LAG_MODEL: lag_regression,
}


def benchmark_runs(
    df: DataFrame, group: str, models: Mapping[str, Callable[..., DataFrame]] = MODELS, horizon_hours: int = 24, folds: int = 5
) -> tuple[DataFrame, dict[str, str]]:
    """The stored forecasts of every model that ran, with its ``model_name``, and what each model that failed said."""
    layout = T.StructType([*FORECASTS.fields, T.StructField("model_name", T.StringType())])
    forecasts, failed = df.sparkSession.createDataFrame([], layout), {}
    for name, model in models.items():
        try:
            part = model(df, group, horizon_hours, folds).select(*OUTPUT).withColumn("model_name", F.lit(name))
            part = settled(part, "forecasts")
        except (PySparkException, ArithmeticError, ValueError, np.linalg.LinAlgError) as error:
            failed[name] = str(error).strip().split("\n", 1)[0]
            continue
        forecasts = forecasts.unionByName(part)
    return forecasts, failed


def _status(rows: Column, name: Column, failed: Mapping[str, str]) -> Column:
    state = F.when(name.isin(list(failed)), "failed") if failed else F.when(F.lit(False), "failed")
    return state.when(F.coalesce(rows, F.lit(0)) > 0, "completed").otherwise("no_folds")


def benchmark(
    df: DataFrame, group: str, models: tuple[str, ...] = tuple(MODELS), horizon_hours: int = 24, folds: int = 5
) -> tuple[DataFrame, DataFrame]:
    """All forecasts and one row per model with its error and status: completed, failed, or no_folds.

    ``primary`` marks the first completed seasonal-regression model, else the naive one if it is completed.
    """
    spark = df.sparkSession
    forecasts, failed = benchmark_runs(df, group, {name: MODELS[name] for name in models}, horizon_hours, folds)
    asked = spark.createDataFrame([(i, name) for i, name in enumerate(models)], "_order int, model_name string")
    table = asked.join(wape(forecasts, "model_name"), "model_name", "left").fillna(0, ["forecast_rows"])
    table = sized(table.withColumn("status", _status(F.col("forecast_rows"), F.col("model_name"), failed)))
    done = [row[0] for row in table.filter("status = 'completed'").orderBy("_order").select("model_name").collect()]  # a row a model
    primary = next((m for m in done if m.startswith(SEASONAL_MODEL)), NAIVE if NAIVE in done else None)
    return forecasts, table.drop("_order").withColumn("primary", F.col("model_name").eqNullSafe(F.lit(primary)))


def benchmark_status(
    df: DataFrame, group: str, models: Mapping[str, Callable[..., DataFrame]] = MODELS, horizon_hours: int = 24, folds: int = 5
) -> DataFrame:
    """One row per model and group: samples, cadence, folds asked and used, model types, errors, status and reason.

    A group without room for a fold has status ``no_folds``; a model that failed has ``failed`` in every group, and the
    first line of its message as reason.
    """
    forecasts, failed = benchmark_runs(df, group, models, horizon_hours, folds)
    groups = matched(df.groupBy(group).agg(F.max("n").alias("samples")), cadence(df, group, 60), group)
    groups = groups.select(
        F.col(group).cast("string").alias("group_key"), "samples", "cadence_minutes",
        horizon_steps(horizon_hours, F.col("cadence_minutes")).alias("horizon_steps"), F.lit(folds).alias("folds_requested"),
    )
    keys = ["model_name", "group_key"]
    used = forecasts.groupBy(*keys).agg(
        F.count_distinct("fold").cast("int").alias("folds_used"), F.array_join(F.array_sort(F.collect_set("model_type")), "+").alias("model_type")
    )
    names = df.sparkSession.createDataFrame([(name, failed.get(name)) for name in models], "model_name string, reason string")
    asked = sized(names).crossJoin(groups)  # a few models
    out = matched(matched(asked, used, keys, "left"), wape(forecasts, keys), keys, "left").fillna(0, ["folds_used", "forecast_rows"])
    return out.select(
        *keys, "samples", "cadence_minutes", "horizon_steps", "folds_requested", "folds_used", "model_type",
        "wape_1_step", "wape_horizon", _status(F.col("forecast_rows"), F.col("model_name"), failed).alias("status"), "reason",
    )
