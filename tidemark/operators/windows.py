"""Ordered computations within a key: numbering, running and moving values,
neighbours, ranks, top rows and group statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.columns import as_column, exact_mean, fixed, fixed_sum, round_half_up, rounded_ratio
from tidemark.operators.groups import PART, before_part, group_sizes, join_back, split_by_range, written
from tidemark.session import max_group_rows

Order = Sequence[str | Column]


def _rows_to_here(keys: Sequence[str], order: Order) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


# --- first rows of a group ---------------------------------------------------


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Order, k: int = 1,
                    method: str = "row_number", rank_name: str | None = None) -> DataFrame:
    """The first k rows of each group; ``method='rank'`` keeps ties.

    Filtering directly on the rank lets Spark cut each group to its first k
    rows before the shuffle, so a hot group does not travel.
    """
    function = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[method]
    name = rank_name or "__rank"
    ranked = df.withColumn(name, function().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= k)
    return kept if rank_name else kept.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Order,
                   where: Column | None = None) -> DataFrame:
    """One row per key, the first by ``order``; rows failing ``where`` do not compete.

    End ``order`` with a unique column, otherwise ties are settled arbitrarily.
    """
    source = df if where is None else df.where(where)
    return top_k_per_group(source, keys, order)


# --- numbering and running values --------------------------------------------


def number_rows(df: DataFrame, keys: Sequence[str], order: Order, name: str = "row_number",
                fits: bool = False) -> DataFrame:
    """1, 2, 3, ... within each key."""
    stitched = _stitched_numbers(df, keys, order, name, fits)
    if stitched is not None:
        return stitched
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, numbered.cast("long"))


def _stitched_numbers(df: DataFrame, keys: Sequence[str], order: Order, name: str,
                      fits: bool) -> DataFrame | None:
    """Row numbers put together from parts, or None when no group needs it."""
    parts = split_by_range(df, keys, order, fits)
    if parts is None:
        return None
    offsets = (
        parts.groupBy(*keys, PART)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before_part(keys)), F.lit(0)))
        .drop("__n")
    )
    within = F.row_number().over(Window.partitionBy(*keys, PART).orderBy(*order))
    return (
        join_back(parts, offsets, [*keys, PART])
        .withColumn(name, within + F.col("__offset"))
        .drop(PART, "__offset")
    )


_COMBINE = {
    "sum": lambda a, b: F.coalesce(a + b, a, b),
    "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": F.greatest,
    "min": F.least,
}
_APPLY = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def running(df: DataFrame, keys: Sequence[str], order: Order,
            values: dict[str, tuple[str, str | Column]], fits: bool = False) -> DataFrame:
    """Running values from the first row of the key to the current one.

    ``values`` maps an output name to a function (``sum``, ``count``, ``max``,
    ``min``) and its input. Sums of doubles depend on the order of addition, so
    they are refused: cast to a decimal first.
    """
    inexact = [n for n, (f, c) in values.items() if f == "sum" and df.select(as_column(c)).dtypes[0][1] in ("double", "float")]
    if inexact:
        raise TypeError(f"running sums of doubles are not repeatable; cast the inputs of {inexact} to a decimal")
    parts = split_by_range(df, keys, order, fits)
    if parts is None:
        spec = _rows_to_here(keys, order)
        return df.withColumns({n: _APPLY[f](as_column(c)).over(spec) for n, (f, c) in values.items()})
    summary = parts.groupBy(*keys, PART).agg(
        *[_APPLY[f](as_column(c)).alias(f"__s_{n}") for n, (f, c) in values.items()]
    )
    earlier = before_part(keys)
    # a count of earlier parts is the sum of their counts
    fold = {n: (F.sum if f in ("sum", "count") else _APPLY[f]) for n, (f, _) in values.items()}
    carried = summary.withColumns(
        {f"__c_{n}": fold[n](f"__s_{n}").over(earlier) for n in values}
    ).drop(*[f"__s_{n}" for n in values])
    spec = _rows_to_here([*keys, PART], order)
    stitched = join_back(parts, carried, [*keys, PART]).withColumns(
        {n: _COMBINE[f](_APPLY[f](as_column(c)).over(spec), F.col(f"__c_{n}")) for n, (f, c) in values.items()}
    )
    return stitched.drop(PART, *[f"__c_{n}" for n in values])


def running_mean(df: DataFrame, keys: Sequence[str], order: Order, value: str, name: str,
                 digits: int = 2, *, scale: int, fits: bool = False) -> DataFrame:
    """Mean from the first row of the key to the current one.

    ``scale`` is the number of decimals that count: sums are exact decimals, so
    they are the same however a key is split over tasks. NaN counts as missing.
    """
    measure = fixed(value, scale)
    summed = running(df, keys, order, {"__sum": ("sum", measure), "__cnt": ("count", measure)}, fits)
    return summed.withColumn(
        name, rounded_ratio(F.col("__sum"), F.col("__cnt"), digits)
    ).drop("__sum", "__cnt")


def _frame_mean(value: str, frame: WindowSpec, digits: int, scale: int | None) -> Column:
    """Rounded mean over a short frame, whose rows are added in order."""
    if scale is None:
        return F.round(F.avg(value).over(frame), digits)
    measure = fixed(value, scale)
    return rounded_ratio(F.sum(measure).over(frame), F.count(measure).over(frame), digits)


def framed(df: DataFrame, keys: Sequence[str], order: Order, before: int,
           build: Callable[[WindowSpec], dict[str, Column]], fits: bool = False) -> DataFrame:
    """Columns from windows that look at most ``before`` rows back.

    A key too large for a task is cut by exact row position into equal chunks;
    the last ``before`` rows of a chunk also travel to the next one, where they
    are seen by the window and then left out.
    """
    limit = max(max_group_rows(df.sparkSession), before + 1)
    numbered = _stitched_numbers(df, keys, order, "__pos", fits)
    if numbered is None:
        return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))
    position = F.col("__pos") - 1
    chunk = F.floor(position / limit)
    reaches_next = position % limit >= limit - before
    spread = (
        numbered.withColumn("__home", chunk)
        .withColumn("__chunk", F.explode(
            F.when(reaches_next, F.array(F.col("__home"), F.col("__home") + 1)).otherwise(F.array("__home"))
        ))
    )
    spec = Window.partitionBy(*keys, "__chunk").orderBy("__pos")
    return (
        spread.withColumns(build(spec))
        .where(F.col("__chunk") == F.col("__home"))
        .drop("__pos", "__home", "__chunk")
    )


def delta_prev(df: DataFrame, keys: Sequence[str], order: Order, value: str,
               prev_name: str = "previous", delta_name: str = "change", n: int = 1,
               fits: bool = False) -> DataFrame:
    """The value n rows earlier and the change since then."""

    def build(spec: WindowSpec) -> dict[str, Column]:
        previous = F.lag(value, n).over(spec)
        return {prev_name: previous, delta_name: F.col(value) - previous}

    return framed(df, keys, order, n, build, fits)


def moving_mean(df: DataFrame, keys: Sequence[str], order: Order, value: str, n: int, name: str,
                digits: int = 2, scale: int | None = None, fits: bool = False) -> DataFrame:
    """Mean of the current row and the n-1 rows before it.

    ``scale`` is the number of decimals of the measure, if it is known; exact
    ties are then rounded up.
    """

    def build(spec: WindowSpec) -> dict[str, Column]:
        return {name: _frame_mean(value, spec.rowsBetween(-(n - 1), 0), digits, scale)}

    return framed(df, keys, order, n - 1, build, fits)


# --- group statistics on every row -------------------------------------------


def group_stat(df: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Every row with aggregates of its group.

    The aggregate is combined map-side and joined back, so no task has to hold
    a group.
    """
    summary = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return join_back(df, summary, keys)


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with its group's value at the lowest ``order``."""
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return group_stat(df, keys, {name: F.min_by(value, position)})


def deviation_from_group(df: DataFrame, keys: Sequence[str], value: str, mean_name: str = "group_mean",
                         delta_name: str = "deviation", stddev_name: str | None = None,
                         scale: int | None = None) -> DataFrame:
    """Every row with its group's mean, and how far the row lies from it.

    With ``scale``, the number of decimals of the measure, the mean is taken of
    an exact sum.
    """
    measure = F.col(value)
    stats = {mean_name: exact_mean(measure, scale)}
    if stddev_name:
        stats[stddev_name] = F.stddev_samp(measure)
    return group_stat(df.where(measure.isNotNull()), keys, stats).withColumn(
        delta_name, measure - F.col(mean_name)
    )


# --- ranks ---------------------------------------------------------------------


def rank_within(df: DataFrame, keys: Sequence[str], by: str, ascending: bool = False,
                rank_name: str | None = "rank", dense_name: str | None = None, fits: bool = False) -> DataFrame:
    """Rank and dense rank by one column within each group, NULLs last.

    Ranks depend only on how many rows hold each distinct value, so a group too
    large for a task is first reduced to its distinct values, ranked there, and
    the ranks are joined back.
    """
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    wanted = [n for n in (rank_name, dense_name) if n]
    if fits or group_sizes(df, keys)[0] <= max_group_rows(df.sparkSession):
        spec = Window.partitionBy(*keys).orderBy(order)
        ranks = {}
        if rank_name:
            ranks[rank_name] = F.rank().over(spec).cast("long")
        if dense_name:
            ranks[dense_name] = F.dense_rank().over(spec).cast("long")
        return df.withColumns(ranks)
    distinct = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running(distinct, keys, [order], {"__upto": ("sum", "__n"), "__dense": ("count", "__n")})
    columns = [*keys, by]
    if rank_name:
        ranked = ranked.withColumn(rank_name, F.col("__upto") - F.col("__n") + 1)
    if dense_name:
        ranked = ranked.withColumn(dense_name, F.col("__dense"))
    return join_back(df, ranked.select(*columns, *wanted), columns)


def rank_groups(df: DataFrame, keys: Sequence[str], value: Column, value_name: str,
                rank_name: str = "rank") -> DataFrame:
    """Groups densely ranked by an aggregate, highest first.

    The aggregate is stored before its size is checked, so that its input is
    read once.
    """
    totals = written(df.groupBy(*keys).agg(value.alias(value_name)), "totals")
    return rank_within(totals, [], value_name, rank_name=None, dense_name=rank_name)


# --- series of periods ---------------------------------------------------------


def period_over_period(df: DataFrame, keys: Sequence[str], period: str, value: str,
                       name: str = "change", digits: int = 2) -> DataFrame:
    """Change of a per-period value since the key's previous period."""

    def build(spec: WindowSpec) -> dict[str, Column]:
        return {name: round_half_up(F.col(value) - F.lag(value).over(spec), digits)}

    return framed(df, keys, [period], 1, build)


def rolling_periods(df: DataFrame, keys: Sequence[str], day: str, value: str, n: int, name: str,
                    mode: str = "rows", digits: int = 2, scale: int | None = None) -> DataFrame:
    """Mean over the last n periods: n rows, or n calendar days with ``mode='days'``; ``scale`` as in ``moving_mean``.

    A mean over days is the same for all rows of a day. Where a key has too
    many rows for a task, sums and counts are taken per day first, the frame
    runs over the days, of which a calendar has few, and its means are joined back.
    """
    if mode == "rows":
        return moving_mean(df, keys, [day], value, n, name, digits, scale)
    if mode != "days":
        raise ValueError(f"unknown mode {mode!r}")
    frame = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-(n - 1), 0)
    if group_sizes(df, keys)[0] <= max_group_rows(df.sparkSession):
        return df.withColumn(name, _frame_mean(value, frame, digits, scale))
    counted = F.col(value) if scale is None else fixed(value, scale)
    daily = df.groupBy(*keys, day).agg(fixed_sum(value, scale).alias("__sum"), F.count(counted).alias("__cnt"))
    total, count = F.sum("__sum").over(frame), F.sum("__cnt").over(frame)
    mean = F.round(F.try_divide(total, count), digits) if scale is None else rounded_ratio(total, count, digits)
    return join_back(df, daily.select(*keys, day, mean.alias(name)), [*keys, day])


def trend_report(df: DataFrame, keys: Sequence[str], period: str, value: str,
                 rank_name: str = "value_rank", peak_name: str = "running_max",
                 change_name: str = "change") -> DataFrame:
    """Rank, running maximum and change of a per-period series, in one shuffle while every series fits a task."""
    if group_sizes(df, keys)[0] > max_group_rows(df.sparkSession):
        ranked = rank_within(df, keys, value, rank_name=rank_name)
        return period_over_period(running(ranked, keys, [period], {peak_name: ("max", value)}), keys, period, value, change_name)
    by_key = Window.partitionBy(*keys)
    in_time = by_key.orderBy(period)
    return df.withColumns({
        rank_name: F.rank().over(by_key.orderBy(F.col(value).desc_nulls_last())).cast("long"),
        peak_name: F.max(value).over(in_time.rowsBetween(Window.unboundedPreceding, 0)),
        change_name: round_half_up(F.col(value) - F.lag(value).over(in_time)),
    })
