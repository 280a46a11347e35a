"""Landing JSON payloads whose readings come as parallel arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_PATTERN = "yyyy-MM-dd'T'HH:mm"


def payload_schema(fields: dict[str, str]) -> T.StructType:
    """``hourly`` as a struct of a time array and one array per field."""
    arrays = ", ".join(f"{name}: array<{kind}>" for name, kind in fields.items())
    return T.StructType.fromDDL(f"hourly struct<time: array<string>, {arrays}>")


def ingest_payloads(df: DataFrame, json_col: str, fields: dict[str, tuple[str, str]],
                    ts_name: str = "recorded_at") -> tuple[DataFrame, DataFrame]:
    """Reading rows, and the payloads that could not be used with a reason.

    ``fields`` maps an array's name to the output name and type. A payload
    without readings, whose arrays differ in length or with a time that is not
    one, is set aside whole; the others are not held up.
    """
    types = {name: kind for name, (_, kind) in fields.items()}
    parsed = df.withColumn("__p", F.from_json(json_col, payload_schema(types)))
    hourly = F.col("__p")["hourly"]
    parsed = parsed.withColumn("__reason", _reject_reason(hourly, list(fields)))
    # chosen by exploding an array or NULL: a filter would be pushed below the
    # parse and repeat it for every condition
    reason = F.col("__reason")
    rejects = parsed.select(*df.columns, F.explode(F.when(reason.isNotNull(), F.array(reason))).alias("reason"))
    ok = flatten_hourly(parsed, hourly, fields, ts_name, reason.isNull()).drop(json_col, "__p", "__reason")
    return ok, rejects


def _reject_reason(hourly: Column, names: list[str]) -> Column:
    times = F.size(hourly["time"])
    uneven = F.lit(False)
    for name in names:
        uneven = uneven | F.coalesce(F.size(hourly[name]) != times, F.lit(True))
    bad_time = F.exists(hourly["time"], lambda t: _reading_time(t).isNull())
    return (
        F.when(hourly.isNull() | hourly["time"].isNull(), "no hourly data")
        .when(times == 0, "no hourly data")
        .when(uneven, "array lengths differ")
        .when(bad_time, "bad time")
    )


def _reading_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def flatten_hourly(df: DataFrame, hourly: Column, fields: dict[str, tuple[str, str]],
                   ts_name: str = "recorded_at", only: Column | None = None) -> DataFrame:
    """One row per position of the arrays, beside the payload's own columns.

    Payloads that fail ``only`` give no rows.
    """
    zipped = F.arrays_zip(hourly["time"].alias("time"), *[hourly[name].alias(name) for name in fields])
    rows = df.withColumn("__r", F.explode(zipped if only is None else F.when(only, zipped)))
    return rows.withColumns({
        ts_name: _reading_time(F.col("__r")["time"]),
        **{out: F.col("__r")[name] for name, (out, _) in fields.items()},
    }).drop("__r")
