"""Labelled synthetic anomalies in indexed series.

Each function takes and returns a series with ``pos``, ``n``, ``kwh``, ``is_anomaly`` and ``anomaly_type``;
positions never change, so the steps compose without sorting again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.text import add_label
from wattline.functions.time import minutes_between
from wattline.operators.series import matched, rolling
from wattline.session import settled, sized

# Label names and the part of a value that a drop removes.
POINT_DROP = "point_drop"
POINT_SPIKE = "point_spike"
SWAP_LABEL = "contextual_day_night_swap"
DRIFT_LABEL = "trend_drift"
DROP_SHARE = 0.85
NIGHT_HOUR = 2
AFTERNOON_HOUR = 14

HOUR, DAY = 3_600_000_000, 86_400_000_000  # microseconds


def unlabelled(df: DataFrame) -> DataFrame:
    """Series ready for injection: flag present, labels blank on rows that are not anomalies."""
    flag = F.coalesce("is_anomaly", F.lit(False)) if "is_anomaly" in df.columns else F.lit(False)
    label = F.col("anomaly_type") if "anomaly_type" in df.columns else F.lit("")
    df = df.withColumn("is_anomaly", flag)
    return df.withColumn("anomaly_type", F.when(F.col("is_anomaly"), F.coalesce(label, F.lit(""))).otherwise(F.lit("")))


def draw(seed: int, group: Column, number: Column, salt: str) -> Column:
    """Reproducible integer from the seed, the group and a counter (leading 32 bits of an MD5)."""
    text = F.concat_ws("|", F.lit(str(seed)), group.cast("string"), number.cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _group_stats(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(
        F.max("n").alias("n"), F.avg("kwh").alias("mean_kwh"), F.stddev_pop("kwh").alias("std_kwh")
    )


def point_draws(df: DataFrame, group: str, seed: int, points: int) -> DataFrame:
    """Positions and kinds of the point anomalies: the last quarter of each group of at least eight rows."""
    stats = _group_stats(df, group).filter("n >= 8")
    low = F.floor(F.col("n") * 3 / 4).cast("long")
    width = F.greatest(low + 1, F.col("n") - 1) - low
    numbered = stats.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    place = draw(seed, F.col(group), F.col("draw"), "place")
    kind = draw(seed, F.col(group), F.col("draw"), "kind")
    return numbered.select(
        group,
        "draw",
        (low + F.pmod(place, width)).alias("pos"),
        F.when(kind % 2 == 0, POINT_DROP).otherwise(POINT_SPIKE).alias("kind"),
        F.greatest("std_kwh", F.lit(0.01)).alias("std_kwh"),
    )


def inject_points(df: DataFrame, group: str, seed: int = 42, points: int = 5, spike_k: float = 10.0) -> DataFrame:
    """Point drops and spikes; draws on one position apply one after the other.

    The spike height uses the deviation of the clean series.
    """
    if points < 1:
        return df
    draws = point_draws(df, group, seed, points)
    # At most ``points`` draws per group meet on one position.
    plan = draws.groupBy(group, "pos").agg(
        F.array_sort(F.collect_list(F.struct("draw", "kind", "std_kwh"))).alias("_plan")
    )
    hit = F.col("_plan").isNotNull()
    kwh = F.aggregate(
        "_plan",
        F.col("kwh"),
        lambda v, d: F.when(
            d["kind"] == POINT_DROP, F.greatest(F.lit(0.0), v - DROP_SHARE * v)
        ).otherwise(v + spike_k * d["std_kwh"]),
    )
    labels = F.aggregate("_plan", F.col("anomaly_type"), lambda old, d: add_label(old, d["kind"]))
    out = matched(df, sized(plan), [group, "pos"], "left")
    return out.withColumns(
        {
            "kwh": F.when(hit, F.round(kwh, 8)).otherwise(F.col("kwh")),
            "anomaly_type": F.when(hit, labels).otherwise(F.col("anomaly_type")),
            "is_anomaly": hit | F.col("is_anomaly"),
        }
    ).drop("_plan")


def swap_segments(df: DataFrame, group: str, steps: int) -> DataFrame:
    """``(group, _side, _slot, _row)``: the rows of the night and afternoon segments of the last complete late day."""
    first_gap = rolling(df.select(group, "pos", "n", "time"), group, 1, {"_before": lambda w: F.lag("time").over(w)})
    gap = minutes_between(F.col("time"), F.col("_before")).cast("long")
    first_gap = first_gap.withColumn("_gap", gap).filter("_gap > 0")
    base = df.groupBy(group).agg(F.max("n").alias("_size"))
    found = first_gap.groupBy(group).agg(F.min(F.struct("pos", "_gap"))["_gap"].alias("_found"))
    base = matched(base, found, group, "left").withColumn("_step", F.coalesce("_found", F.lit(30).cast("long")) * 60)
    base = sized(base.filter(F.col("_size") >= steps * 3).select(group, "_step"))

    # Days of a group in order: the calendar bounds this window.
    days = df.select(group, F.to_date("time").alias("day")).distinct()
    late = days.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy("day")) - 1).withColumn(
        "_days", F.count(F.lit(1)).over(Window.partitionBy(group))
    )
    late = late.filter(F.col("_rank") >= F.floor(F.col("_days") / 2)).select(group, "day")

    keyed = matched(df.select(group, "pos", "kwh", F.unix_micros("time").alias("_at")), base, group)
    step = F.col("_step") * 1_000_000
    sides = []
    for side, hour in (("night", NIGHT_HOUR), ("afternoon", AFTERNOON_HOUR)):
        # A segment belongs to the day it starts on, and a row to every segment it is a step of.
        since = F.col("_at") - hour * HOUR
        first = F.ceil((since - (steps - 1) * step) / F.lit(DAY)).cast("long")
        last = F.floor(since / F.lit(DAY)).cast("long")
        started = keyed.filter(first <= last).withColumn("_day", F.explode(F.sequence(first, last)))
        offset = since - F.col("_day") * DAY
        placed = started.withColumn("_slot", F.call_function("div", offset, step)).withColumn("_side", F.lit(side))
        sides.append(placed.filter(offset % step == 0).withColumn("day", F.date_from_unix_date(F.col("_day").cast("int"))))
    # Several rows at one time: the last one stands for the slot.
    slots = sides[0].unionByName(sides[1]).groupBy(group, "day", "_side", "_slot").agg(
        F.max(F.struct("pos", "kwh")).alias("_row")
    )
    complete = slots.groupBy(group, "day").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") == 2 * steps)
    chosen = matched(complete, late, [group, "day"]).groupBy(group).agg(F.max("day").alias("day"))
    return matched(slots, chosen, [group, "day"]).drop("day")


def swap_plan(df: DataFrame, group: str, steps: int) -> DataFrame:
    """``(group, pos, new_kwh)`` exchanging the night and afternoon segments of the last complete late day."""
    picked = swap_segments(df, group, steps)
    other = picked.select(
        group,
        F.when(F.col("_side") == "night", "afternoon").otherwise("night").alias("_side"),
        "_slot",
        F.col("_row.kwh").alias("new_kwh"),
    )
    swapped = matched(picked, other, [group, "_side", "_slot"]).select(group, F.col("_row.pos").alias("pos"), "_side", "new_kwh")
    # Where the segments overlap, the afternoon's new value is written last.
    return swapped.groupBy(group, "pos").agg(F.max_by("new_kwh", F.col("_side") == "afternoon").alias("new_kwh"))


def inject_swap(df: DataFrame, group: str, steps: int = 6) -> DataFrame:
    """Exchange the values of the segments starting at 02:00 and 14:00 on one day."""
    hit = F.col("new_kwh").isNotNull()
    out = matched(df, sized(swap_plan(df, group, steps)), [group, "pos"], "left")
    return out.withColumns(
        {
            "kwh": F.coalesce("new_kwh", "kwh"),
            "anomaly_type": F.when(hit, add_label(F.col("anomaly_type"), SWAP_LABEL)).otherwise(F.col("anomaly_type")),
            "is_anomaly": hit | F.col("is_anomaly"),
        }
    ).drop("new_kwh")


def inject_drift(df: DataFrame, group: str, steps: int = 6, percent: float = 0.5) -> DataFrame:
    """Linear rise over the last ``steps`` rows up to ``percent`` of the group mean."""
    stats = sized(_group_stats(df, group).select(group, "mean_kwh"))
    step = F.col("pos") - (F.col("n") - steps) + 1
    hit = (F.col("n") >= 2 * steps) & (step >= 1)
    raised = F.round(F.col("kwh") + F.col("mean_kwh") * percent * (step / steps), 8)
    return matched(df, stats, group).withColumns(
        {
            "kwh": F.when(hit, raised).otherwise(F.col("kwh")),
            "anomaly_type": F.when(hit, add_label(F.col("anomaly_type"), DRIFT_LABEL)).otherwise(F.col("anomaly_type")),
            "is_anomaly": hit | F.col("is_anomaly"),
        }
    ).drop("mean_kwh")


def inject(
    df: DataFrame,
    group: str,
    seed: int = 42,
    points: int = 5,
    segment_steps: int = 6,
    drift_steps: int = 6,
    spike_k: float = 10.0,
    drift_percent: float = 0.5,
) -> DataFrame:
    """Points, then the swap, then the drift, in every group."""
    out = settled(inject_points(unlabelled(df), group, seed, points, spike_k), "points")
    out = settled(inject_swap(out, group, segment_steps), "swapped")
    return inject_drift(out, group, drift_steps, drift_percent)


def injection_report(injected: DataFrame, group: str) -> DataFrame:
    """Ground-truth rows per group and label."""
    labels = F.explode(F.split("anomaly_type", r"\+"))
    marked = injected.filter("is_anomaly").select(group, labels.alias("label"))
    return marked.groupBy(group, "label").agg(F.count(F.lit(1)).alias("rows"))


def injection_events(
    df: DataFrame, group: str, seed: int = 42, points: int = 5, segment_steps: int = 6, drift_steps: int = 6
) -> DataFrame:
    """Where :func:`inject` with the same arguments puts its anomalies: one row per point, swapped segment and drift.

    ``(group, type, part, start_pos, end_pos, start_time, end_time, steps)``; ``part`` is the number of a point, or the
    segment of a swap.
    """
    layout = [group, "type", "part", "start_pos", "end_pos"]
    sizes = df.groupBy(group).agg(F.max("n").alias("n")).filter(F.col("n") >= 2 * drift_steps)
    last = F.col("n") - 1
    found = sizes.select(group, F.lit(DRIFT_LABEL).alias("type"), F.lit("").alias("part"), (last - drift_steps + 1).alias("start_pos"), last.alias("end_pos"))
    sides = swap_segments(df, group, segment_steps).groupBy(group, F.lit(SWAP_LABEL).alias("type"), F.col("_side").alias("part"))
    found = found.unionByName(sides.agg(F.min("_row.pos").alias("start_pos"), F.max("_row.pos").alias("end_pos")).select(*layout))
    if points:
        draws = point_draws(df, group, seed, points)
        found = found.unionByName(
            draws.select(group, F.col("kind").alias("type"), F.col("draw").cast("string").alias("part"), F.col("pos").alias("start_pos"), F.col("pos").alias("end_pos"))
        )
    found = sized(found)
    for side in ("start", "end"):
        times = df.select(group, F.col("pos").alias(f"{side}_pos"), F.col("time").alias(f"{side}_time"))
        found = matched(found, times, [group, f"{side}_pos"])
    steps = F.when(F.col("type") == DRIFT_LABEL, F.lit(drift_steps)).when(F.col("type") == SWAP_LABEL, F.lit(segment_steps)).otherwise(F.lit(1))
    return found.select(*layout, "start_time", "end_time", steps.alias("steps"))
