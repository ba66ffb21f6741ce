"""Scoring of forecasts and detectors.

Detector inputs are indexed series with boolean ``truth`` and ``pred`` and, where labels matter,
``anomaly_type``.  Overall figures are sums over groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.text import label_set, min_flags
from wattline.operators.detect import exceeds
from wattline.operators.series import (
    SERIES_BLOCK,
    block_of,
    cadence,
    index_series,
    marks_from,
    marks_upto,
    matched,
    rolling,
    true_runs,
)
from wattline.session import settled, sized


def default_thresholds() -> list[float]:
    """0.5 to 5.0 in steps of a tenth."""
    return [round(0.5 + 0.1 * k, 1) for k in range(46)]


def _names(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def wape(forecasts: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Weighted absolute percentage error over the horizon and at the first step."""
    error, size = F.abs(F.col("actual") - F.col("forecast")), F.abs(F.col("actual"))
    first = F.col("horizon_step") == 1

    def ratio(condition: Column | None) -> Column:
        top = error if condition is None else F.when(condition, error)
        bottom = size if condition is None else F.when(condition, size)
        return F.sum(top) / F.greatest(F.sum(bottom), F.lit(1e-9))

    return forecasts.groupBy(*_names(by)).agg(
        F.count(F.lit(1)).alias("forecast_rows"), ratio(first).alias("wape_1_step"), ratio(None).alias("wape_horizon")
    )


def with_rates(df: DataFrame) -> DataFrame:
    """Precision, recall and F1 from ``tp``, ``fp`` and ``fn``."""
    one = F.lit(1)
    out = df.withColumn("precision", F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), one))
    out = out.withColumn("recall", F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), one))
    both = F.col("precision") + F.col("recall")
    return out.withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.greatest(both, F.lit(1e-9)))


def confusion(df: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Row-level confusion counts and rates."""
    truth, pred = F.col("truth"), F.col("pred")
    counts = df.groupBy(*_names(by)).agg(
        F.count_if(truth & pred).alias("tp"),
        F.count_if(~truth & pred).alias("fp"),
        F.count_if(truth & ~pred).alias("fn"),
        F.count_if(~truth & ~pred).alias("tn"),
    )
    return with_rates(counts)


def labels(df: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Distinct labels of the label column."""
    return df.select(*_names(by), F.explode(label_set(F.col("anomaly_type"))).alias("label")).distinct()


def confusion_by_type(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Confusion per label: a row is true when it is an anomaly carrying the label, all predictions count.

    Labelled rows are counted per label; the other cells follow from the group totals, so rows are never
    multiplied by labels.
    """
    keys = _names(by)
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.count_if("pred").alias("_pred"))
    marked = df.select(*keys, "truth", "pred", F.explode(label_set(F.col("anomaly_type"))).alias("label"))
    hits = marked.groupBy(*keys, "label").agg(
        F.count_if(F.col("truth") & F.col("pred")).alias("tp"), F.count_if(F.col("truth") & ~F.col("pred")).alias("fn")
    )
    joined = matched(hits, totals, keys)
    joined = joined.withColumn("fp", F.col("_pred") - F.col("tp"))
    joined = joined.withColumn("tn", F.col("_rows") - F.col("tp") - F.col("fn") - F.col("fp"))
    return with_rates(joined.select(*keys, "label", "tp", "fp", "fn", "tn"))


def latency(df: DataFrame, group: str | Sequence[str], tolerance: int = 2, block: int = SERIES_BLOCK) -> DataFrame:
    """Truth runs per group, those never flagged, and the mean delay to the first flag in samples and minutes."""
    return _latency(settled(df.select(*_names(group), "time", "pos", "n", "truth", "pred"), "scored"), group, tolerance, block)


def _latency(df: DataFrame, group: str | Sequence[str], tolerance: int, block: int) -> DataFrame:
    keys = _names(group)
    runs = true_runs(df, keys, "truth", block)
    flags = df.filter("pred").select(*keys, "pos")
    timed = marks_from(runs.withColumn("pos", F.col("run_start")), flags, keys, {"_next": F.lit(True)}, block)
    timed = matched(timed, df.groupBy(*keys).agg(F.max("n").alias("n")), keys)
    end = F.least(F.col("n") - 1, F.col("run_end") + tolerance)
    timed = timed.withColumn("_delay", F.when(F.col("_next") <= end, F.col("_next") - F.col("run_start")))
    per_group = timed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("_delay").isNull()).alias("missed_windows"),
        F.avg("_delay").alias("avg_latency_samples"),
    )
    out = matched(cadence(df, keys, None), per_group, keys, "left").fillna(0, ["windows", "missed_windows"])
    minutes = F.col("avg_latency_samples") * F.col("cadence_minutes")
    return out.withColumn("avg_latency_minutes", minutes).drop("cadence_minutes")


def event_scores(
    df: DataFrame,
    group: str | Sequence[str],
    tolerance: int = 2,
    event_min_flags: int = 5,
    event_min_run: int = 1,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Event-level counts and rates per group.

    An event is a run of true rows; it is detected when the run, widened by the tolerance, holds enough flags
    and a long enough unbroken stretch of them.  A run of flags untouched by any detected event's widened
    window counts as false when it is long enough.

    All counts are looked up at a few positions per event among the flagged rows, so no pairs are formed and rows that
    are neither true nor flagged are read once, for the size of their group.
    """
    slim = settled(df.select(*_names(group), "pos", "n", "truth", "pred", "anomaly_type"), "scored")
    return _event_scores(slim, group, tolerance, event_min_flags, event_min_run, block)


def _event_scores(
    slim: DataFrame, group: str | Sequence[str], tolerance: int, event_min_flags: int, event_min_run: int, block: int, by_type: bool = False
) -> DataFrame:
    keys = _names(group)
    own = [*keys, "label"] if by_type else keys
    sizes = sized(slim.groupBy(*keys).agg(F.max("n").alias("n")))
    flags = slim.filter("pred").select(*keys, "pos", "n")
    typed = slim.filter("truth").select(*keys, "pos", label_set(F.col("anomaly_type")).alias("_set"))
    if by_type:  # a true row once for each of its labels
        typed = typed.select(*keys, "pos", F.explode("_set").alias("label"))
        runs = true_runs(typed, own, F.lit(True), block).withColumn("type", F.col("label"))
        scored = matched(labels(slim, keys), sizes, keys)
    else:
        runs = _with_run_labels(true_runs(typed, own, F.lit(True), block), typed, keys, block)
        scored = sizes

    # One row per event with its type, its widened window, and the positions it asks about.
    lo = F.greatest(F.lit(0).cast("long"), F.col("run_start") - tolerance)
    hi = F.least(F.col("n") - 1, F.col("run_end") + tolerance)
    events = settled(matched(runs, sizes, keys).withColumn("lo", lo).withColumn("hi", hi).drop("n", "run_end"), "events")
    event = [*own, "run_start", "lo", "hi", "type"]

    def ask(places: dict[str, Column]) -> DataFrame:
        asked = [F.struct(F.lit(role).alias("role"), place.cast("long").alias("pos")) for role, place in places.items()]
        return events.select(*event, F.inline(F.array(*asked)))

    def at(role: str, value: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col(value)))

    counted = marks_upto(ask({"before": F.col("lo") - 1, "hi": F.col("hi")}), flags, keys, "_flags", block)
    counted = counted.groupBy(*event).agg((at("hi", "_flags") - at("before", "_flags")).alias("in_window"))
    if event_min_run > 1:  # a flagged row ends a long stretch when that many flags stand right before it
        stretch = {"_far": lambda w: F.lag("pos", event_min_run - 1).over(w)}
        flags = rolling(flags, keys, event_min_run - 1, stretch, block)
        long_enough = F.col("pos") - F.col("_far") == event_min_run - 1
    else:
        long_enough = F.lit(True)
    stretch_end = F.least(F.col("lo") + (max(event_min_run, 1) - 1), F.col("hi"))
    places = {"lo": F.col("lo"), "start": F.col("run_start"), "stretch": stretch_end}
    found = marks_from(ask(places), flags, keys, {"_next": F.lit(True), "_long": long_enough}, block)
    found = found.groupBy(*event).agg(
        at("start", "_next").alias("next_start"), at("lo", "_next").alias("next_lo"), at("stretch", "_long").alias("stretch_at")
    )
    found = matched(counted, found, event)
    needed = min_flags(F.col("type"), event_min_flags)
    # A stretch must lie in the window: one that is longer than the window cannot.
    fits = F.col("hi") - F.col("lo") + 1 >= event_min_run
    runs_ok = F.coalesce(fits & (F.col("stretch_at") <= F.col("hi")), F.lit(False)) if event_min_run >= 1 else F.lit(True)
    first = F.when(F.col("next_start") <= F.col("hi"), F.col("next_start"))
    first = F.coalesce(first, F.when(F.col("next_lo") <= F.col("hi"), F.col("next_lo")), F.col("run_start"))
    found = found.withColumn("detected", (F.col("in_window") >= needed) & runs_ok).withColumn(
        "delay", F.greatest(F.lit(0).cast("long"), first - F.col("run_start"))
    )
    found = settled(found, "found")
    per_group = found.groupBy(*own).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("detected").alias("tp"),
        F.count_if(~F.col("detected")).alias("fn"),
        F.avg(F.when(F.col("detected"), F.col("delay"))).alias("avg_latency_samples"),
    )
    flagged = true_runs(flags, keys, F.lit(True), block).filter(F.col("run_end") - F.col("run_start") + 1 >= event_min_flags)
    if by_type:
        flagged = matched(flagged, scored.drop("n"), keys)
    false_runs = _uncovered_runs(flagged, found.filter("detected"), own, block)
    false_runs = false_runs.groupBy(*own).agg(F.count(F.lit(1)).alias("fp"))
    out = matched(matched(scored.drop("n"), per_group, own, "left"), false_runs, own, "left")
    out = out.fillna(0, ["events", "tp", "fn", "fp"])
    return with_rates(out.select(*own, "tp", "fp", "fn", "events", "avg_latency_samples"))


def _with_run_labels(runs: DataFrame, typed: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Runs with their sorted label list: every labelled row finds its run through the run starts before it."""
    starts = runs.select(*keys, "run_start", F.col("run_start").alias("pos"))
    # The run of a row is the last start at or before it: mark starts, carry them forward block by block.
    marked = matched(typed, starts, [*keys, "pos"], "left").withColumn("_at", F.coalesce("run_start", F.lit(-1).cast("long")))
    carried = _carry_max(marked, keys, "_at", block)
    sets = carried.select(*keys, F.col("_at").alias("run_start"), F.explode_outer("_set").alias("_label"))
    # The label vocabulary is small and fixed, so the set per run is bounded whatever the run's length.
    types = sets.groupBy(*keys, "run_start").agg(F.array_join(F.array_sort(F.collect_set("_label")), "+").alias("type"))
    types = types.withColumn("type", F.when(F.col("type") == "", "unknown").otherwise(F.col("type")))
    return matched(runs, types, [*keys, "run_start"])


def _carry_max(df: DataFrame, keys: list[str], column: str, block: int) -> DataFrame:
    """Running maximum of a column over the whole group, block by block."""
    blocked = df.withColumn("_block", block_of(F.col("pos"), block))
    tops = blocked.groupBy(*keys, "_block").agg(F.max(column).alias("_top"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*keys, "_block", F.max("_top").over(earlier).alias("_before"))
    inside = Window.partitionBy(*keys, "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = matched(blocked, tops, [*keys, "_block"])
    return out.withColumn(column, F.greatest(F.max(column).over(inside), "_before")).drop("_block", "_before")


def _uncovered_runs(runs: DataFrame, detected: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Runs of flags that meet no detected window.

    A run is met exactly when more windows have opened up to its end than have closed before its start.
    """
    at_end = runs.withColumn("pos", F.col("run_end"))
    opened = marks_upto(at_end, detected.select(*keys, F.col("lo").alias("pos")), keys, "_opened", block)
    before = opened.withColumn("pos", F.col("run_start") - 1)
    both = marks_upto(before, detected.select(*keys, F.col("hi").alias("pos")), keys, "_closed", block)
    return both.filter(F.col("_opened") <= F.col("_closed"))


def event_scores_by_type(
    df: DataFrame,
    group: str | Sequence[str],
    tolerance: int = 2,
    event_min_flags: int = 5,
    event_min_run: int = 1,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Event scores per group and label: only rows with the label are true.

    True rows and runs of flags are taken once per label; the series itself is not multiplied.
    """
    slim = settled(df.select(*_names(group), "pos", "n", "truth", "pred", "anomaly_type"), "scored")
    return _event_scores(slim, group, tolerance, event_min_flags, event_min_run, block, by_type=True)


def overall(scores: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Counts of group scores added up, rates computed anew."""
    present = [c for c in ("tp", "fp", "fn", "tn", "events") if c in scores.columns]
    return with_rates(scores.groupBy(*_names(by)).agg(*[F.sum(c).alias(c) for c in present]))


def align(
    truth: DataFrame, pred: DataFrame, group: str, order: Sequence[str] = ("time", "meter_id"), calendar_bound: bool = False
) -> DataFrame:
    """Truth and prediction side by side by place in the ordered group; groups of different length raise."""
    left = index_series(truth, group, order, calendar_bound).select(group, "pos", *order, "truth")
    right = index_series(pred, group, order, calendar_bound).select(group, "pos", "pred")
    joined = matched(left, right, [group, "pos"], "full")
    mismatch = F.raise_error(F.lit("Prediction length mismatch")).cast("boolean")
    unpaired = F.col("truth").isNull() | F.col("pred").isNull()
    return joined.withColumns({name: F.when(unpaired, mismatch).otherwise(F.col(name)) for name in ("truth", "pred")})


def evaluate(
    df: DataFrame,
    group: str,
    tolerance: int = 2,
    event_min_flags: int = 5,
    event_min_run: int = 1,
    block: int = SERIES_BLOCK,
) -> dict[str, DataFrame]:
    """All score tables of one detector: rows, labels, events and latency by group, and the overall rows."""
    df = settled(df.select(group, "time", "pos", "n", "truth", "pred", "anomaly_type"), "scored")
    rows = confusion(df, group)
    by_type = confusion_by_type(df, group)
    events = _event_scores(df, group, tolerance, event_min_flags, event_min_run, block)
    events_by_type = _event_scores(df, group, tolerance, event_min_flags, event_min_run, block, by_type=True)
    return {
        "rows": rows,
        "rows_overall": overall(rows),
        "rows_by_type": by_type,
        "events": events,
        "events_overall": overall(events),
        "events_by_type": events_by_type,
        "latency": _latency(df, group, tolerance, block),
    }


def sweep(
    scored: DataFrame,
    thresholds: Sequence[float] | None = None,
    min_dev: float = 0.12,
    by: str | Sequence[str] = (),
) -> DataFrame:
    """Confusion at every threshold from one pass over the scores.

    ``scored`` has ``truth`` and the columns of ``robust_score``.  A row exceeds a prefix of the sorted
    thresholds, so rows are counted by how many they exceed and the small counts are spread afterwards.
    """
    keys = _names(by)
    levels = sorted(thresholds or default_thresholds())
    passed = F.lit(0)
    for level in levels:
        passed = passed + exceeds(level, min_dev).cast("int")
    counts = scored.groupBy(*keys, passed.alias("_passed")).agg(
        F.count_if("truth").alias("_true"), F.count_if(~F.col("truth")).alias("_false")
    )
    grid = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(level).alias("mad_multiplier")) for i, level in enumerate(levels)])
    spread = counts.select(*keys, "_passed", "_true", "_false", F.explode(grid).alias("_level"))
    flagged = F.col("_passed") > F.col("_level.at")
    per_level = spread.groupBy(*keys, F.col("_level.mad_multiplier").alias("mad_multiplier")).agg(
        F.sum(F.when(flagged, F.col("_true")).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, F.col("_false")).otherwise(0)).alias("fp"),
        F.sum(F.when(flagged, 0).otherwise(F.col("_true"))).alias("fn"),
        F.sum(F.when(flagged, 0).otherwise(F.col("_false"))).alias("tn"),
    )
    return with_rates(per_level)


def best_operating_point(swept: DataFrame, min_precision: float = 0.95, by: str | Sequence[str] = ()) -> DataFrame:
    """Row with the best recall, F1 and lowest threshold among those precise enough, or among all if none is."""
    eligible = (F.col("precision") >= min_precision).cast("int")
    rank = F.struct(eligible, F.col("recall"), F.col("f1"), -F.col("mad_multiplier"))
    keys = _names(by)
    columns = [c for c in swept.columns if c not in keys]
    best = F.max_by(F.struct(*columns), rank).alias("_best")
    return swept.groupBy(*keys).agg(best).select(*keys, "_best.*")


def best_detector(scores: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Detector with the best F1, then recall, then precision (then name)."""
    keys = _names(by)
    columns = [c for c in scores.columns if c not in keys]
    best = F.max_by(F.struct(*columns), F.struct("f1", "recall", "precision", "detector")).alias("_best")
    return scores.groupBy(*keys).agg(best).select(*keys, "_best.*")


def rank_detectors(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Best detector on rows and on events: inputs have one row per ``detector``."""
    columns = ["detector", "tp", "fp", "fn", "precision", "recall", "f1"]
    levels = rows.select(F.lit("row").alias("level"), *columns).unionByName(
        events.select(F.lit("event").alias("level"), *columns)
    )
    return best_detector(levels, "level")
