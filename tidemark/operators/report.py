"""Report text from mart rows, and checks on returned reports, as column work."""

from __future__ import annotations

from collections.abc import Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_column, token_estimate
from tidemark.operators.windows import running

# Keys of a report and of each of its member entries.
REPORT_KEYS = ["overview", "cities", "alerts"]
MEMBER_KEYS = ["city", "avg_temp", "air_quality", "avg_pm25", "comment"]

# Texts of the fallback record and of the rendered report.
UNPARSED_OVERVIEW = "Report unavailable - the AI response could not be parsed."
MISSHAPEN_OVERVIEW = "Report unavailable - unexpected response shape."
NO_OVERVIEW = "No overview available."
NOT_AVAILABLE = "Not available"
REPORT_TITLE = "=== DAILY REPORT ==="
EMPTY_BLOCK = "No data available in the daily summary mart yet."

CHARS_PER_TOKEN = 4
MAX_TOKENS = 2000


# --- text blocks -------------------------------------------------------------------


def text_of(value: str | Column) -> Column:
    """Text of a value; dates and numbers as written, NULL as nan."""
    return F.coalesce(as_column(value).cast("string"), F.lit("nan"))


def render_line(template: str, fields: dict[str, str | Column]) -> Column:
    """The template with each ``{name}`` replaced by the text of its field; braces are doubled to stand for themselves."""
    pieces = []
    for fixed, name, _, _ in Formatter().parse(template):
        if fixed:
            pieces.append(F.lit(fixed))
        if name is not None:
            pieces.append(text_of(fields[name]))
    return F.concat(*pieces) if pieces else F.lit("")


def render_block(lines: DataFrame, group: Sequence[str], order: Sequence[str], line: str, header: str,
                 max_tokens: int = MAX_TOKENS, name: str = "block", fits: bool = False) -> DataFrame:
    """Each group's lines under a header as one text, cut at the token cap.

    NULL lines are no lines. Lines that start beyond the cut cannot appear, so
    they are left out before the rest is gathered: what a task gathers is
    bounded by the cut, however many lines the group has.
    """
    # a text is cut when it is a whole token longer than the cap: enough is
    # gathered to see that
    reach = (max_tokens + 1) * CHARS_PER_TOKEN + 1
    lines = lines.where(F.col(line).isNotNull())
    # the header counts in front of every line, each with its newline
    ends = running(lines, group, [F.col(c) for c in order], {"__end": ("sum", F.length(line) + 1)}, fits=fits)
    starts = F.col("__end") - F.length(line) + F.lit(len(header))
    gathered = ends.where(starts < reach).groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(*order, F.col(line).alias("__line")))).alias("__rows")
    )
    text = F.concat_ws("\n", F.lit(header), F.transform("__rows", lambda r: r["__line"]))
    # an empty mart gives the standing message
    whole = gathered.withColumn(name, F.when(F.size("__rows") == 0, EMPTY_BLOCK).otherwise(text))
    return cap_tokens(whole, name, max_tokens, "__est").select(*group, name)


def cap_tokens(df: DataFrame, column: str, max_tokens: int = MAX_TOKENS, estimate_name: str = "est_tokens") -> DataFrame:
    """The text cut to the token cap, with the estimate of the uncut text."""
    return df.withColumns({
        estimate_name: token_estimate(column),
        column: F.when(
            token_estimate(column) > max_tokens, F.substring(column, 1, max_tokens * CHARS_PER_TOKEN)
        ).otherwise(F.col(column)),
    })


# --- returned reports -----------------------------------------------------------------


def strip_fences(text: str | Column) -> Column:
    """The text from the first brace to the last, or without code fences when it has no braces.

    Fences lie outside the braces, so cutting at the braces drops them too.
    """
    text = as_column(text)
    blanks = F.lit(" \t\n\r\f\v")
    bare = F.regexp_replace(F.trim(text, blanks), r"^```(?:json)?\s*", "")
    bare = F.trim(F.regexp_replace(bare, r"\s*```$", ""), blanks)
    return F.coalesce(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")), bare)


def _members(value: Column) -> Column:
    """An object's entries, NULL for any other variant."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def parse_reports(df: DataFrame, column: str) -> DataFrame:
    """Parsed and validated reports beside their source rows.

    Adds ``parse_failed``, ``overview``, ``cities`` (array of variants, NULL if
    not a list), ``alerts``, ``problems`` and ``is_valid``. Text that is not a
    JSON object gives the fallback record, never a failed task. NaN and Infinity
    are numbers. The last of repeated keys counts where the session sets
    ``spark.sql.variant.allowDuplicateKeys``, as ``build_session`` does; elsewhere
    such text cannot be parsed.
    """
    doc, is_object = F.col("__doc"), F.col("__entries").isNotNull()
    parsed = df.withColumn("__doc", F.from_json(strip_fences(column), "variant")).withColumn("__entries", _members(doc))
    none = F.array().cast("array<string>")

    def list_at(path: str) -> Column:
        empty = F.array().cast("array<variant>")
        return F.when(is_object, F.try_variant_get(doc, path, "array<variant>")).otherwise(empty)

    def lacking(keys: Sequence[str], entries: Column) -> Column:
        return F.array_except(F.array(*[F.lit(k) for k in keys]), F.map_keys(entries))

    parsed = parsed.withColumns({
        "parse_failed": ~is_object,
        "overview": F.when(is_object, F.try_variant_get(doc, "$.overview", "string"))
        .when(doc.isNull(), UNPARSED_OVERVIEW).otherwise(MISSHAPEN_OVERVIEW),
        "cities": list_at("$.cities"),
        "alerts": list_at("$.alerts"),
        "__missing": F.when(is_object, F.array_sort(lacking(REPORT_KEYS, F.col("__entries")))).otherwise(none),
    })
    missing = F.col("__missing")
    listed = F.concat(F.lit("Missing top-level keys: ['"), F.array_join(missing, "', '"), F.lit("']"))

    def member_problems(entries: Column, i: Column) -> Column:
        place = F.concat(F.lit("cities["), i.cast("string"), F.lit("]"))
        return F.when(entries.isNull(), F.array(F.concat(place, F.lit(" is not an object")))).otherwise(
            F.transform(lacking(MEMBER_KEYS, entries), lambda k: F.concat(place, F.lit(" missing '"), k, F.lit("'")))
        )

    problems = F.concat(
        F.when(F.size(missing) > 0, F.array(listed)).otherwise(none),
        F.when(F.col("cities").isNull(), F.array(F.lit("'cities' is not a list"))).otherwise(
            F.flatten(F.transform(F.transform("cities", _members), member_problems))
        ),
        F.when(F.col("alerts").isNull(), F.array(F.lit("'alerts' is not a list"))).otherwise(none),
    )
    return parsed.withColumn("problems", problems).withColumn("is_valid", F.size("problems") == 0).drop(
        "__doc", "__entries", "__missing")


def variant_text(value: Column, path: str) -> Column:
    """A field as text: numbers with a fraction or exponent keep a decimal point (30.0 is not 30), NULL if absent.

    Numbers written with an exponent are printed as doubles are.
    """
    text = F.try_variant_get(value, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    whole_fraction = kind.startswith("DECIMAL") & ~F.contains(text, F.lit("."))
    return (
        F.when(whole_fraction, F.concat(text, F.lit(".0")))
        .when(kind == "DOUBLE", F.replace(F.replace(text, F.lit("NaN"), F.lit("nan")), F.lit("Infinity"), F.lit("inf")))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def render_reports(parsed: DataFrame, name: str = "report", title: str = REPORT_TITLE) -> DataFrame:
    """Parsed reports as text."""

    def field(member: Column, key: str) -> Column:
        return variant_text(member, f"$.{key}")

    def member_lines(member: Column) -> Column:
        temp = F.coalesce(F.concat(field(member, "avg_temp"), F.lit("C")), F.lit(NOT_AVAILABLE))
        head = F.concat(
            F.coalesce(field(member, "city"), F.lit("Unknown")), F.lit(": Avg "), temp, F.lit(" | PM2.5 "),
            F.coalesce(field(member, "avg_pm25"), F.lit(NOT_AVAILABLE)), F.lit(" | Air quality: "),
            F.coalesce(field(member, "air_quality"), F.lit(NOT_AVAILABLE)),
        )
        return F.concat(head, F.lit("\n  "), F.coalesce(field(member, "comment"), F.lit("")), F.lit("\n"))

    none = F.array().cast("array<string>")
    members = F.coalesce(F.transform("cities", member_lines), none)
    alerts = F.coalesce(
        F.transform("alerts", lambda a: F.concat(F.lit("  ! "), F.coalesce(variant_text(a, "$"), F.lit("None")))),
        none,
    )
    body = F.concat(
        F.array(F.lit(title + "\n"), F.coalesce(F.col("overview"), F.lit(NO_OVERVIEW)), F.lit("")),
        members,
        F.when(F.size(alerts) > 0, F.concat(F.array(F.lit("ALERTS:")), alerts)).otherwise(none),
    )
    return parsed.withColumn(name, F.array_join(body, "\n"))


def call_metrics(calls: DataFrame, label: str = "label") -> DataFrame:
    """Per label: calls, failures, empty outputs, sizes and time of recorded responses.

    Reads ``input_text``, ``output_text``, ``elapsed_ms`` (integer) and ``error``.
    """
    failed = F.col("error").isNotNull()
    blank = ~failed & (F.coalesce(F.trim("output_text"), F.lit("")) == "")
    return calls.groupBy(label).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(failed).alias("failed_calls"),
        F.count_if(blank).alias("empty_outputs"),
        F.sum(token_estimate("input_text")).alias("est_input_tokens"),
        F.coalesce(F.sum(F.when(~failed, F.length("output_text"))), F.lit(0)).cast("long").alias("output_chars"),
        F.sum("elapsed_ms").cast("long").alias("elapsed_ms"),
    )
