"""Profiling of readings: summaries, spikes, distributions, unit checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.series import matched
from wattline.functions.time import minutes_between
from wattline.operators.quantiles import exact_quantiles
from wattline.session import sized

NO_UTILITY = "(none)"


def iqr_spikes(df: DataFrame, by: str = "meter_id") -> DataFrame:
    """Readings with a ``candidate_spike`` flag: above the third quartile plus three quartile ranges."""
    quartiles = sized(exact_quantiles(df, by, "kwh", {"q1": 0.25, "q3": 0.75}).drop("n_values"))
    limit = F.col("q3") + 3 * (F.col("q3") - F.col("q1"))
    return matched(df, quartiles, by).withColumn("candidate_spike", F.col("kwh") > limit).drop("q1", "q3")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Surplus rows per (time, meter): copies beyond the first."""
    copies = df.groupBy("time", "meter_id").agg((F.count(F.lit(1)) - 1).alias("extra")).filter("extra > 0")
    return copies.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"))


def profile(df: DataFrame) -> DataFrame:
    """One-row dataset summary."""
    base = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("meter_id").alias("meters"),
        F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        F.count_if(F.col("kwh").isNull()).alias("missing_kwh"),
        F.avg("kwh").alias("mean_kwh"),
        F.stddev_samp("kwh").alias("std_kwh"),
        F.min("kwh").alias("min_kwh"),
        F.max("kwh").alias("max_kwh"),
    )
    span = F.unix_micros("end_time") - F.unix_micros("start_time")
    spikes = iqr_spikes(df).agg(F.count_if("candidate_spike").alias("candidate_spikes"))
    middle = exact_quantiles(df, [], "kwh", {"median_kwh": 0.5}).select("median_kwh")
    return base.withColumns(
        {
            "duration_days": F.coalesce(span / F.lit(86_400_000_000), F.lit(0.0)),
            "duplicate_rows": duplicate_rows(df).scalar(),
            "median_kwh": middle.scalar(),
            "candidate_spikes": spikes.scalar(),
        }
    )


def hourly_profile(df: DataFrame) -> DataFrame:
    """Mean reading by source and hour of day."""
    return df.groupBy("source", F.hour("time").alias("hour")).agg(F.avg("kwh").alias("kwh"))


def daily_totals(df: DataFrame) -> DataFrame:
    """Daily consumption per meter from its first to its last day, days without readings as zero.

    Rows without a time have no day; readings without a meter give days, but count for none. Only days with readings are
    shuffled: each brings the empty days up to the next one.
    """
    sums = df.groupBy("meter_id", F.to_date("time").alias("day")).agg(F.sum("kwh").alias("daily_kwh")).filter("day IS NOT NULL")
    following = F.lead("day").over(Window.partitionBy("meter_id").orderBy("day"))
    runs = sums.select("meter_id", F.col("day").alias("_own"), "daily_kwh", F.coalesce(F.date_sub(following, 1), "day").alias("_last"))
    days = runs.select("meter_id", "_own", "daily_kwh", F.explode(F.sequence("_own", "_last")).alias("day"))
    counted = F.when(F.col("meter_id").isNotNull() & (F.col("day") == F.col("_own")), F.col("daily_kwh"))
    return days.select("meter_id", "day", counted.alias("daily_kwh")).fillna(0.0, ["daily_kwh"])


def histogram(df: DataFrame, bins: int = 80) -> DataFrame:
    """Counts in equal-width bins over the value range; the last bin includes the maximum."""
    lo, hi = df.agg(F.min("kwh"), F.max("kwh")).first()
    if lo is None:
        return df.select(F.lit(0).alias("bin"), F.col("kwh").alias("lo"), F.col("kwh").alias("hi"), F.lit(0).cast("bigint").alias("n")).limit(0)
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col("kwh") - lo) / width), F.lit(bins - 1)).cast("int")
    counted = df.filter(F.col("kwh").isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "bin", (F.lit(lo) + F.col("bin") * width).alias("lo"), (F.lit(lo) + (F.col("bin") + 1) * width).alias("hi"), "n"
    )


def box_stats(df: DataFrame, by: str = "source") -> DataFrame:
    """Quartiles and whiskers (farthest values within 1.5 quartile ranges) per group."""
    quartiles = sized(exact_quantiles(df, by, "kwh", {"q1": 0.25, "median": 0.5, "q3": 0.75}))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    value = F.col("kwh")
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    whiskers = (
        matched(df, quartiles.select(by, "q1", "q3"), by)
        .groupBy(by)
        .agg(F.min(F.when(inside, value)).alias("whisker_lo"), F.max(F.when(inside, value)).alias("whisker_hi"))
    )
    return matched(quartiles, whiskers, by)


def _first_times(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` earliest times of each meter.

    Spark turns the rank filter into a group limit ahead of the shuffle, so at most ``n`` rows per meter
    and map task travel, however many readings a meter has.
    """
    ordered = Window.partitionBy("meter_id").orderBy("time")
    return df.select("meter_id", "time", F.row_number().over(ordered).alias("_rn")).filter(F.col("_rn") <= n)


def sampling_minutes(df: DataFrame) -> DataFrame:
    """Minutes between the two earliest readings of each meter that has two."""
    pair = _first_times(df, 2).groupBy("meter_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("time").alias("_t0"), F.max("time").alias("_t1")
    )
    gap = minutes_between(F.col("_t1"), F.col("_t0")).cast("int")
    return pair.filter("_n = 2").select("meter_id", gap.alias("sampling_minutes"))


def sampling_hours(df: DataFrame) -> DataFrame:
    """Median of the positive gaps among the ten earliest readings of each meter, in hours; one hour without any."""
    ordered = Window.partitionBy("meter_id").orderBy("_rn")
    early = _first_times(df, 10).withColumn("_prev", F.lag("time").over(ordered))
    gap = (F.unix_micros("time") - F.unix_micros("_prev")) / F.lit(3_600_000_000)
    middle = F.percentile(F.when(gap > 0, gap), F.lit(0.5))
    return early.groupBy("meter_id").agg(F.coalesce(middle, F.lit(1.0)).alias("sampling_hours"))


def conversion_factors(df: DataFrame, period_hours: float) -> DataFrame:
    """Implied and electrical kW-per-ampere factors: medians overall (``disco`` null) and per utility.

    Rows without a utility form a group of their own, ``NO_UTILITY``.
    """

    def known(name: str):
        return F.coalesce(F.col(name), F.lit(0.0))

    amperes, volts, factor = known("current_a"), known("voltage_v"), known("power_factor")
    valid = df.filter((amperes > 0) & (volts > 0) & (factor > 0)).select(
        F.coalesce("disco", F.lit(NO_UTILITY)).alias("disco"),
        (known("consumption_kwh") / period_hours / amperes).alias("implied"),
        (volts * amperes * factor / 1000.0 / amperes).alias("electrical"),
    )
    # Both factors in one long column, so each level needs one pass of quantiles.
    long = valid.unpivot(["disco"], ["implied", "electrical"], "factor", "value")

    def medians(keys: list[str]) -> DataFrame:
        found = exact_quantiles(long, [*keys, "factor"], "value", {"middle": 0.5})
        disco = F.col("disco") if keys else F.lit(None).cast("string")
        return found.groupBy(disco.alias("disco")).agg(
            F.max("n_values").alias("n"),
            F.max(F.when(F.col("factor") == "implied", F.col("middle"))).alias("median_implied"),
            F.max(F.when(F.col("factor") == "electrical", F.col("middle"))).alias("median_electrical"),
        )

    return medians([]).unionByName(medians(["disco"]))
