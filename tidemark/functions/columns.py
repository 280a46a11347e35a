"""Column helpers. Each returns a Column built from Spark's own functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text hashed in place of a NULL key part, and the separator
# between key parts.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# Output formats of dates and timestamps in keys.
DATE_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MILLI_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- dates and times -------------------------------------------------------


def day_of(ts: str | Column) -> Column:
    return F.to_date(as_column(ts))


def hour_floor(ts: str | Column) -> Column:
    """Start of the hour, keeping a zone-less timestamp zone-less."""
    return F.date_trunc("hour", as_column(ts)).cast("timestamp_ntz")


def date_parts(ts: str | Column) -> dict[str, Column]:
    c = as_column(ts)
    return {
        "hour": F.hour(c),
        "month": F.month(c),
        "quarter": F.quarter(c),
        "year": F.year(c),
    }


def iso_week(d: str | Column) -> Column:
    return F.weekofyear(as_column(d))


def weekday_number(d: str | Column) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(as_column(d))


def is_weekend(d: str | Column) -> Column:
    return weekday_number(d).isin(1, 7)


def short_day_name(d: str | Column) -> Column:
    return F.dayname(as_column(d))


def short_month_name(d: str | Column) -> Column:
    return F.monthname(as_column(d))


def full_day_name(d: str | Column) -> Column:
    return F.date_format(as_column(d), "EEEE")


def add_days(d: str | Column, n: int) -> Column:
    return F.date_add(as_column(d), n)


def as_of_or_now(as_of: str | None) -> Column:
    """The given instant, or the current one; pass ``as_of`` to repeat a run."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    return now.cast("timestamp_ntz")


def format_ts(ts: str | Column, pattern: str = SECOND_FORMAT) -> Column:
    return F.date_format(as_column(ts), pattern)


def date_key(ts: str | Column) -> Column:
    """Integer key yyyyMMdd."""
    c = as_column(ts)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def parse_ts(text: str | Column, pattern: str) -> Column:
    """Timestamp parsed with a pattern; NULL when the text does not fit."""
    return F.try_to_timestamp(as_column(text), F.lit(pattern)).cast("timestamp_ntz")


def run_id(as_of: str | Column, prefix: str = "") -> Column:
    instant = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return F.concat(F.lit(prefix), F.date_format(instant, "yyyyMMdd_HHmmss"))


# --- numbers ---------------------------------------------------------------


def safe_cast(c: str | Column, type_name: str) -> Column:
    """Cast that gives NULL on dirty input instead of failing the task."""
    return as_column(c).try_cast(type_name)


def c_to_f(c: str | Column) -> Column:
    """Celsius to Fahrenheit, two decimals."""
    return F.round(as_column(c) * 9.0 / 5.0 + 32, 2)


# Fixed value: keeps exact ties of fixed-point means on the upper side, so that
# every engine rounds them alike.
TIE_SHIFT = 1e-9


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    return F.round(as_column(c) + F.lit(TIE_SHIFT), digits)


def fixed(c: str | Column, scale: int) -> Column:
    """A measure as a decimal of ``scale`` decimals; NaN becomes NULL, a value of more than 18 digits is an error."""
    return as_column(c).cast(T.DecimalType(18, scale))


def fixed_sum(c: str | Column, scale: int | None = None) -> Column:
    """Order-independent sum of a measure stored with ``scale`` decimals; the plain sum of doubles for ``None``."""
    if scale is None:
        return F.sum(as_column(c).cast("double"))
    return F.sum(fixed(c, scale))


def rounded_ratio(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean from a total and a count, rounded half up; NULL for no rows."""
    return round_half_up(F.try_divide(total.cast("double"), count), digits)


def exact_mean(c: str | Column, scale: int | None = None) -> Column:
    """Unrounded mean, over an exact sum if the measure's ``scale`` is known."""
    return F.try_divide(fixed_sum(c, scale).cast("double"), F.count(as_column(c) if scale is None else fixed(c, scale)))


def rounded_mean(c: str | Column, digits: int = 2, scale: int | None = None) -> Column:
    """Mean rounded half up.

    With ``scale`` the measure is fixed-point with that many decimals and the
    sum is exact, so the result does not depend on how rows are spread over
    tasks. Without it doubles are averaged as they are.
    """
    c = as_column(c)
    if scale is None:
        return F.round(F.avg(c), digits)
    return rounded_ratio(fixed_sum(c, scale), F.count(fixed(c, scale)), digits)


def bucket(c: str | Column, cuts: Sequence[tuple[float, str]], default: str,
           null_label: str | None = None) -> Column:
    """Label of the first cut the value lies strictly above, highest cut first.

    A NULL is above no cut and takes the default, unless ``null_label`` is set.
    """
    c = as_column(c)
    ordered = sorted(cuts, key=lambda cut: -cut[0])
    label = None
    if null_label is not None:
        label = F.when(c.isNull(), null_label)
    for limit, name in ordered:
        label = F.when(c > limit, name) if label is None else label.when(c > limit, name)
    return F.lit(default) if label is None else label.otherwise(default)


# --- text and keys ---------------------------------------------------------


def normalised(c: str | Column) -> Column:
    return F.upper(F.trim(as_column(c)))


def hash_of(*parts: str | Column, sep: str = "|") -> Column:
    """md5 of the joined parts; NULL when any part is."""
    joined = as_column(parts[0])
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(sep), as_column(part))
    return F.md5(joined)


def surrogate_key(df: DataFrame, names: Sequence[str]) -> Column:
    """md5 over the named columns, NULLs replaced by a sentinel."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in names:
        c = F.col(name)
        if isinstance(types[name], (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, MILLI_FORMAT)
        parts.append(F.coalesce(c.cast("string"), F.lit(NULL_KEY_PART)))
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def blank_to_null(c: str | Column, tokens: Sequence[str] = ("NULL", "null", "")) -> Column:
    trimmed = F.trim(as_column(c))
    return F.when(~trimmed.isin(*tokens), trimmed)


def null_where(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """Blank the named cells of rows that meet the condition."""
    return df.withColumns({c: F.when(~F.coalesce(condition, F.lit(False)), F.col(c)) for c in columns})


def token_estimate(text: str | Column) -> Column:
    """Four characters to a token."""
    return F.floor(F.length(as_column(text)) / 4)
