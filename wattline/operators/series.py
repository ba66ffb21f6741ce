"""Ordered series without one task per series.

A series is all rows of one group in ``(time, meter_id)`` order.  Groups may be arbitrarily large (one
source may hold a third of the table), so nothing here sorts a whole group in one task:

* ``index_series`` gives each row its position ``pos`` and the group size ``n`` through a range sort whose
  boundaries cut through large groups, and stores the result because every detector reads it several times;
* with positions known, every later step works on blocks of ``SERIES_BLOCK`` rows: bounded frames repeat the
  few rows before a block (``rolling``), running sums add the totals of the earlier blocks (``prefix_sums``),
  and lags by a per-group number of steps are equi-joins on ``(group, pos)`` (``shifted``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattline.functions.time import minutes_between
from wattline.session import settled, sized

SERIES_BLOCK = 65_536


def _names(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def global_index(df: DataFrame, order: Sequence[str], name: str = "idx", unique: bool = False) -> DataFrame:
    """Dense 0-based index in the given order: range sort, per-partition counts, prefix offsets.

    ``unique=True`` says that no two rows agree in ``order``, which spares storing them before the sort.
    """
    indexed = _range_positions(df, [], list(order), unique)
    return indexed.withColumnRenamed("pos", name).drop("n")


def index_series(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[str] = ("time", "meter_id"),
    calendar_bound: bool = False,
) -> DataFrame:
    """Add ``pos`` (0-based place in the group) and ``n`` (rows of the group).

    ``calendar_bound=True`` says the rows are unique per group and time bucket (the output of a resample):
    a group then has at most span / cadence rows and a plain window is both bounded and cheapest.
    """
    keys = _names(group)
    if not calendar_bound:
        return _range_positions(df, keys, list(order))
    ordered = Window.partitionBy(*keys).orderBy(*order)
    indexed = df.withColumn("pos", (F.row_number().over(ordered) - 1).cast("long")).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy(*keys))
    )
    return settled(indexed, "series")


def _range_positions(df: DataFrame, keys: list[str], order: list[str], unique: bool = False) -> DataFrame:
    # The running row id breaks full ties, so even a heap of copies is spread over partitions.  It is stored
    # with the rows before the sort: a repeated task then sees the same ids and the same range borders.
    rows = df if unique else settled(df.withColumn("_tie", F.monotonically_increasing_id()), "unordered")
    layout = [*keys, *order] if unique else [*keys, *order, "_tie"]
    placed = rows.repartitionByRange(*layout).sortWithinPartitions(*layout).drop("_tie")
    # Place in the sort order, also stored: ids count up inside a partition, partitions are in range order.
    placed = placed.withColumn("_row", F.monotonically_increasing_id())
    placed = settled(placed.withColumn("_part", F.shiftright("_row", 33)), "ordered")
    # One row per (partition, group): at most partitions + groups rows.
    chunks = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    all_chunks = Window.partitionBy(*keys).orderBy("_part")
    before = all_chunks.rowsBetween(Window.unboundedPreceding, -1)
    whole = all_chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chunks = chunks.withColumns(
        {"_base": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "n": F.sum("_rows").over(whole)}
    )
    return (
        matched(placed, sized(chunks.drop("_rows")), [*keys, "_part"])
        .withColumn("pos", F.col("_base") + F.col("_row") - F.col("_first"))
        .drop("_row", "_part", "_first", "_base")
    )


def matched(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null, so that rows of an unnamed group are kept."""
    keys = _names(keys)
    if not keys:
        return left.crossJoin(right)  # totals without a group: one row
    other = {key: f"_right_{key}" for key in keys}
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(name)) for key, name in other.items()])
    out = left.join(right.withColumnsRenamed(other), same, how)
    if how == "full":
        out = out.withColumns({key: F.coalesce(key, name) for key, name in other.items()})
    return out.drop(*other.values())


def block_of(pos: Column, block: int) -> Column:
    return F.floor(pos / block).cast("long")


def with_context(df: DataFrame, back: int, block: int = SERIES_BLOCK) -> DataFrame:
    """Assign rows to blocks of positions and repeat the last ``back`` rows of a block before the next one.

    Adds ``_block`` and ``_context`` (true on the repeated rows).
    """
    if back > block:
        raise ValueError(f"a block of {block} rows cannot hold a frame of {back}")
    own = block_of(F.col("pos"), block)
    in_tail = (F.pmod(F.col("pos"), F.lit(block)) >= block - back) & ((own + 1) * block < F.col("n"))
    homes = F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own)) if back else F.array(own)
    spread = df.withColumn("_own", own).withColumn("_block", F.explode(homes))
    return spread.withColumn("_context", F.col("_block") > F.col("_own")).drop("_own")


def rolling(
    df: DataFrame,
    group: str | Sequence[str],
    back: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Window expressions whose frame reaches at most ``back`` rows back, exact across block borders."""
    ordered = Window.partitionBy(*_names(group), "_block").orderBy("pos")
    out = with_context(df, back, block)
    out = out.withColumns({name: build(ordered) for name, build in columns.items()})
    return out.filter(~F.col("_context")).drop("_block", "_context")


def prefix_sums(
    df: DataFrame,
    group: str | Sequence[str],
    columns: Mapping[str, Column],
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Inclusive running sums over the whole group: sums inside a block plus the totals of earlier blocks."""
    keys = _names(group)
    blocked = df.withColumn("_block", block_of(F.col("pos"), block)).withColumns(
        {f"_add_{name}": value for name, value in columns.items()}
    )
    totals = blocked.groupBy(*keys, "_block").agg(*[F.sum(f"_add_{name}").alias(f"_tot_{name}") for name in columns])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys,
        "_block",
        *[F.coalesce(F.sum(f"_tot_{name}").over(earlier), F.lit(0)).alias(f"_base_{name}") for name in columns],
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = matched(blocked, totals, [*keys, "_block"]).withColumns(
        {name: F.col(f"_base_{name}") + F.sum(f"_add_{name}").over(inside) for name in columns}
    )
    return out.drop("_block", *[f"{kind}_{name}" for name in columns for kind in ("_add", "_base")])


def next_positions(
    df: DataFrame,
    group: str | Sequence[str],
    flags: Mapping[str, Column],
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """For each row the nearest position at or after it where a flag holds (null when there is none)."""
    keys = _names(group)
    blocked = df.withColumn("_block", block_of(F.col("pos"), block)).withColumns(
        {f"_at_{name}": F.when(flag, F.col("pos")) for name, flag in flags.items()}
    )
    firsts = blocked.groupBy(*keys, "_block").agg(*[F.min(f"_at_{name}").alias(f"_min_{name}") for name in flags])
    later = Window.partitionBy(*keys).orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    firsts = firsts.select(
        *keys, "_block", *[F.min(f"_min_{name}").over(later).alias(f"_later_{name}") for name in flags]
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("pos").rowsBetween(0, Window.unboundedFollowing)
    out = matched(blocked, firsts, [*keys, "_block"]).withColumns(
        {name: F.coalesce(F.min(f"_at_{name}").over(inside), F.col(f"_later_{name}")) for name in flags}
    )
    return out.drop("_block", *[f"{kind}_{name}" for name in flags for kind in ("_at", "_later")])


def marks_upto(
    asked: DataFrame, marks: DataFrame, group: str | Sequence[str], name: str, block: int = SERIES_BLOCK
) -> DataFrame:
    """Rows of ``asked`` with the number of ``marks`` of their group at or before their ``pos``.

    Both are sparse: they have a ``pos``, rows may share one, and a group needs no row at every position.
    """
    keys = _names(group)
    points = marks.select(*keys, (F.col("pos") * 2).alias("pos"), F.lit(1).alias("_mark"))
    both = asked.withColumn("pos", F.col("pos") * 2 + 1).withColumn("_mark", F.lit(0)).unionByName(points, allowMissingColumns=True)
    walked = prefix_sums(both, keys, {name: F.col("_mark").cast("long")}, 2 * block)
    return walked.filter("_mark = 0").drop("_mark").withColumn("pos", F.shiftright("pos", 1))


def marks_from(
    asked: DataFrame, marks: DataFrame, group: str | Sequence[str], names: Mapping[str, Column], block: int = SERIES_BLOCK
) -> DataFrame:
    """Rows of ``asked`` with the position of the first mark at or after their ``pos`` for which a condition holds.

    ``names`` maps new columns to conditions on ``marks``; sparse as :func:`marks_upto`.
    """
    keys = _names(group)
    points = marks.select(*keys, (F.col("pos") * 2 + 1).alias("pos"), F.lit(True).alias("_mark"), *[c.alias(f"_is_{n}") for n, c in names.items()])
    both = asked.withColumn("pos", F.col("pos") * 2).withColumn("_mark", F.lit(False)).unionByName(points, allowMissingColumns=True)
    walked = next_positions(both, keys, {n: F.coalesce(f"_is_{n}", F.lit(False)) for n in names}, 2 * block)
    found = walked.filter("NOT _mark").drop("_mark", *[f"_is_{n}" for n in names])
    return found.withColumns({"pos": F.shiftright("pos", 1), **{n: F.shiftright(n, 1) for n in names}})


def shifted(
    df: DataFrame, group: str | Sequence[str], steps: Column, columns: Mapping[str, str]
) -> DataFrame:
    """Values ``steps`` positions earlier, where ``steps`` may differ by group (null before the start)."""
    keys = _names(group)
    past = df.select(
        *keys, (F.col("pos") + steps).alias("pos"), *[F.col(old).alias(new) for new, old in columns.items()]
    )
    return matched(df, past, [*keys, "pos"], "left")


def true_runs(
    df: DataFrame, group: str | Sequence[str], flag: str | Column, block: int = SERIES_BLOCK
) -> DataFrame:
    """Maximal runs of true: ``run_start`` and ``run_end`` positions, one row per run."""
    keys = _names(group)
    flag = F.col(flag) if isinstance(flag, str) else flag
    hits = df.filter(flag).select(*keys, "pos", block_of(F.col("pos"), block).alias("_block"))
    inside = Window.partitionBy(*keys, "_block").orderBy("pos")
    pieces = (
        hits.withColumn("_island", F.col("pos") - F.row_number().over(inside))
        .groupBy(*keys, "_block", "_island")
        .agg(F.min("pos").alias("run_start"), F.max("pos").alias("run_end"))
        .drop("_block", "_island")
    )
    # Only pieces touching a block border can belong together; there are at most two per block.
    starts_block = F.pmod("run_start", F.lit(block)) == 0
    ends_block = F.pmod(F.col("run_end") + 1, F.lit(block)) == 0
    border = starts_block | ends_block
    ordered = Window.partitionBy(*keys).orderBy("run_start")
    joined = F.col("run_start") == F.lag("run_end").over(ordered) + 1
    merged = (
        pieces.filter(border)
        .withColumn("_new", F.when(joined, 0).otherwise(1))
        .withColumn("_run", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_run")
        .agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"))
        .drop("_run")
    )
    return pieces.filter(~border).unionByName(merged)


def longest_run(
    df: DataFrame, group: str | Sequence[str], flag: str | Column, lo: int | None = None, hi: int | None = None
) -> DataFrame:
    """Length of the longest run of true per group, optionally inside the position range ``[lo, hi]``."""
    if lo is not None:
        df = df.filter(F.col("pos") >= lo)
    if hi is not None:
        df = df.filter(F.col("pos") <= hi)
    keys = _names(group)
    best = true_runs(df, keys, flag).groupBy(*keys).agg(
        F.max(F.col("run_end") - F.col("run_start") + 1).alias("max_run")
    )
    return matched(df.select(*keys).distinct(), best, keys, "left").fillna(0, ["max_run"])


def cadence(df: DataFrame, group: str | Sequence[str], default: int | None = 60) -> DataFrame:
    """Typical step in minutes: median of the positive gaps of an indexed series, cut to an integer."""
    keys = _names(group)
    gaps = rolling(df.select(*keys, "time", "pos", "n"), keys, 1, {"_before": lambda w: F.lag("time").over(w)})
    gap = minutes_between(F.col("time"), F.col("_before"))
    # The state of an exact percentile is one entry per distinct gap in minutes, so the calendar bounds it.
    middle = F.percentile(F.when(gap > 0, gap), F.lit(0.5)).cast("int")
    found = middle if default is None else F.coalesce(middle, F.lit(default))
    return gaps.groupBy(*keys).agg(found.alias("cadence_minutes"))
