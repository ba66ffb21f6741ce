"""Exact quantiles of groups of any size by distributed selection.

A quantile sketch brackets each wanted rank. One pass over the values then counts those inside a bracket one by one and all
others by the gap they lie in, so that every bracket is checked to hold its rank; one that does not is widened to the whole
range. Brackets of more than ``FEW`` values are narrowed, for all groups and ranks at once: a sketch of their values cuts
them into parts, and the part that holds the rank is the next bracket. No task ever sorts more than ``FEW`` values of a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.series import matched
from wattline.session import settled, sized

#: Accuracy of the sketch, values of a bracket that are ranked by sorting, parts of a bracket in a narrowing round.
ACCURACY, FEW, PARTS = 10_000, 4096, 64


def exact_quantiles(
    df: DataFrame,
    by: str | Sequence[str],
    value: str | Column,
    quantiles: Mapping[str, float],
    accuracy: int = ACCURACY,
    few: int = FEW,
    margin: float | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, plus the number of values as ``n_values``; nulls and NaN are left out.

    ``margin`` is the share of ranks by which a bracket reaches to both sides; any value gives the same result.
    """
    keys = [by] if isinstance(by, str) else list(by)
    value = F.col(value) if isinstance(value, str) else value
    data = df.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    wanted = list(quantiles.items())
    bounds = _brackets(data, keys, [q for _, q in wanted], accuracy, 2.0 / accuracy if margin is None else margin)
    counted = settled(_counted(data, bounds, keys, len(wanted)), "counted")
    state = sized(_ranks(counted, bounds, keys, [q for _, q in wanted]))
    missed, most = state.agg(F.count_if(~F.col("held")), F.max(F.when(F.col("held") & (F.col("lo") < F.col("hi")), F.col("size")))).first()
    inside = counted.filter("inside").drop("inside")
    found = _selected(inside, state.filter("held"), keys, few, most or 0)
    if missed:  # the whole range surely holds the rank
        whole = matched(state.filter("NOT held").drop("lo", "hi"), bounds.select(*keys, F.col("_min").alias("lo"), F.col("_max").alias("hi")), keys)
        whole = sized(whole.withColumn("below", F.lit(0).cast("long")))
        found = found.unionByName(_selected(data.withColumn("n", F.lit(1).cast("long")), whole, keys, few, few + 1))
    picks = [F.max(F.when(F.col("rank") == i, F.col("_v"))).alias(f"_{i}") for i in range(2 * len(wanted))]
    rows = matched(bounds.select(*keys, "n_values"), found.groupBy(*keys).agg(*picks), keys, "left")
    out = []
    for i, (name, q) in enumerate(wanted):
        rank = F.lit(q) * (F.col("n_values") - 1)
        part = rank - F.floor(rank)
        a, b = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}")
        # Even halves are averaged the usual way so that a median equals the textbook one bit for bit.
        out.append(F.when(a == b, a).when(part == 0.5, (a + b) / 2).otherwise(a + (b - a) * part).alias(name))
    return rows.select(*keys, "n_values", *out)


def _brackets(data: DataFrame, keys: list[str], quantiles: list[float], accuracy: int, margin: float) -> DataFrame:
    """Per group the number of values, their range, and a bracket ``_lo``, ``_hi`` for each quantile."""
    low, high = [max(0.0, q - margin) for q in quantiles], [min(1.0, q + margin) for q in quantiles]
    bounds = data.groupBy(*keys).agg(
        F.count("_v").alias("n_values"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", low + high, accuracy).alias("_edges"),
    )
    edges = {}
    for i in range(len(quantiles)):
        edges[f"_lo{i}"] = F.col("_min") if low[i] == 0 else F.col("_edges")[i]
        edges[f"_hi{i}"] = F.col("_max") if high[i] == 1 else F.col("_edges")[len(quantiles) + i]
    return sized(bounds.select(*keys, "n_values", "_min", "_max", *[column.alias(name) for name, column in edges.items()]))


def _with_bounds(rows: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return matched(rows, bounds, keys)
    row = bounds.first()  # without groups there is one row, carried as literals
    return rows.withColumns({name: F.lit(row[name]).cast(bounds.schema[name].dataType) for name in bounds.columns})


def _counted(data: DataFrame, bounds: DataFrame, keys: list[str], brackets: int) -> DataFrame:
    """``(keys, _v, inside, n)``: values in a bracket one by one, the others by the bracket end next below them."""
    inside, gap = F.lit(False), F.lit(float("-inf"))
    for i in range(brackets):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        inside = inside | ((F.col("_v") >= lo) & (F.col("_v") <= hi))
        gap = F.greatest(gap, F.when(F.col("_v") > hi, hi).otherwise(gap))
    marked = _with_bounds(data, bounds, keys).select(*keys, F.when(inside, F.col("_v")).otherwise(gap).alias("_v"), inside.alias("inside"))
    return marked.groupBy(*keys, "_v", "inside").agg(F.count(F.lit(1)).alias("n"))


def _ranks(counted: DataFrame, bounds: DataFrame, keys: list[str], quantiles: list[float]) -> DataFrame:
    """Two ranks per quantile with their bracket, how many values lie below and inside it, and whether it holds the rank."""
    sums = []
    for i in range(len(quantiles)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        within = F.col("inside") & (F.col("_v") >= lo) & (F.col("_v") <= hi)
        sums += [
            F.coalesce(F.sum(F.when(F.col("_v") < lo, F.col("n"))), F.lit(0)).alias(f"_below{i}"),
            F.coalesce(F.sum(F.when(within, F.col("n"))), F.lit(0)).alias(f"_inside{i}"),
            F.count_if(within).alias(f"_size{i}"),
        ]
    per_group = _with_bounds(counted, bounds, keys).groupBy(*keys).agg(*sums)
    rows = matched(bounds, per_group, keys)
    asked = []
    for i, q in enumerate(quantiles):
        exact = F.lit(q) * (F.col("n_values") - 1)
        below, count = F.col(f"_below{i}"), F.col(f"_inside{i}")
        for side, k in enumerate((F.floor(exact), F.ceil(exact))):
            asked.append(
                F.struct(
                    F.lit(2 * i + side).alias("rank"), k.alias("k"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi"),
                    below.alias("below"), F.col(f"_size{i}").alias("size"), ((k >= below) & (k < below + count)).alias("held"),
                )
            )
    return rows.select(*keys, F.inline(F.array(*asked)))


def _selected(pool: DataFrame, state: DataFrame, keys: list[str], few: int, most: int) -> DataFrame:
    """``(keys, rank, _v)``: the value at each rank ``k``, from values ``_v`` that occur ``n`` times."""
    while most > few:
        state = sized(_narrowed(pool, state, keys))
        most = state.agg(F.max(F.when(F.col("lo") < F.col("hi"), F.col("size")))).first()[0] or 0
    open_ranks = state.filter("lo < hi")
    near = _within(pool, open_ranks, keys).groupBy(*keys, "rank", "k", "below", "_v").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys, "rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    reached = near.withColumn("_upto", F.col("below") + upto).filter(F.col("_upto") > F.col("k"))
    picked = reached.groupBy(*keys, "rank").agg(F.min("_v").alias("_v"))
    return picked.unionByName(state.filter("lo = hi").select(*keys, "rank", F.col("lo").alias("_v")))


def _within(pool: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    return matched(pool, state, keys).filter((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))


def _narrowed(pool: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Each bracket of more than one value replaced by the part of it that holds the rank.

    A sketch of the bracket's values cuts it into ``PARTS`` parts of about as many values each, and every cut is a part of
    its own: whatever the distribution, a round leaves about one part in ``PARTS``, and always fewer values than before.
    """
    ranks = [*keys, "rank"]
    within = _within(pool, state.filter("lo < hi"), keys)
    cuts = within.groupBy(*ranks).agg(F.percentile_approx("_v", [i / PARTS for i in range(1, PARTS)], 20 * PARTS).alias("_cuts"))
    within = matched(within, sized(cuts), ranks)
    part = F.size(F.filter("_cuts", lambda c: c < F.col("_v"))) + F.size(F.filter("_cuts", lambda c: c <= F.col("_v")))
    parts = within.groupBy(*ranks, "k", "below", part.alias("_part"))
    parts = parts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("size"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    upto = F.sum("n").over(Window.partitionBy(*ranks).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    here = parts.withColumn("_upto", F.col("below") + upto)
    here = here.filter((F.col("_upto") > F.col("k")) & (F.col("_upto") - F.col("n") <= F.col("k")))
    columns = [*ranks, "k", "lo", "hi", "below", "size"]
    return here.withColumn("below", F.col("_upto") - F.col("n")).select(*columns).unionByName(state.filter("lo = hi").select(*columns))


def median_mad(df: DataFrame, by: str | Sequence[str], value: str) -> DataFrame:
    """Median and median absolute deviation per group (both exact)."""
    keys = [by] if isinstance(by, str) else list(by)
    centre = sized(exact_quantiles(df, keys, value, {"median": 0.5}))
    spread = matched(df, centre.select(*keys, "median"), keys).select(
        *keys, F.abs(F.col(value) - F.col("median")).alias("_dev")
    )
    return matched(centre, exact_quantiles(spread, keys, "_dev", {"mad": 0.5}).drop("n_values"), keys)
