"""Mixing sources to target weights: whole copies that are certain, the rest by Pareto order sampling.

Targets in words follow the weights of the sources, up to a number of copies of
each source; what a source cannot take is shared out again. A source takes
every document as often as its target holds it whole. The remaining words are
sampled: documents compete within strata of a source and about the same size,
so that every size class keeps its share. A stratum takes a fixed number of
documents, those that come first by random odds divided by inclusion odds.

A stratum may be of any size, so it is never sorted in one task: the cut is
found by counting documents by leading digits of their rank value, digit by
digit, until few are left around the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.operators.windows import number_rows

MAX_COPIES = 3
# A rank value has this many bits, and is read in digits of so many bits.
RANK_BITS = 48
DIGIT_BITS = 8
# Documents around a cut that one task may sort.
MAX_SORTED = 4096
_HASH_BITS = 52


def words_of(text: str | Column) -> Column:
    """Maximal stretches without ASCII white space; none in a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def word_variety(words: Column) -> Column:
    """Distinct words over words: texts that repeat themselves have low odds of another copy."""
    return F.size(F.array_distinct(words)) / F.size(words)


def size_class(size: str | Column) -> Column:
    """Classes of sizes in ascending order, four to each doubling."""
    size = F.col(size) if isinstance(size, str) else size
    bits = F.length(F.bin(size))
    leading = F.call_function("shiftright", size, F.greatest(bits - 3, F.lit(0)))
    return (8 * bits + leading).cast("int")


def rank_value(ident: Column, text: Column, odds: Column, seed: int) -> Column:
    """Random odds over inclusion odds, as an integer of the same order; equal for equal ids and texts."""
    digest = F.md5(F.concat_ws(" ", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("")),
                               F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    drawn = F.conv(F.substring(digest, 1, _HASH_BITS // 4), 16, 10).cast("bigint")
    random_odds = (drawn + F.lit(0.5)) / (F.lit(2.0 ** _HASH_BITS) - drawn - F.lit(0.5))
    return F.floor(random_odds / (odds + random_odds) * F.lit(2.0 ** RANK_BITS)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_copies: int) -> DataFrame:
    """``source, source_size, target`` in words; ``sizes`` has ``source`` and ``source_size``, one row per source.

    Sources take the weights in turn, in order of their code points, null
    last. A source's target is its weight times a level common to all, or its
    size times ``max_copies`` where that is less; the level is raised until
    the targets sum to ``share`` of all words or every source is full.
    """
    ranked = number_rows(sizes, [], [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    rated = stored(ranked.select("source", "source_size", weight.alias("weight")), "mix_sources")
    level, full, total = 0.0, -1, rated.agg(F.sum("source_size")).first()[0] or 0
    while total:
        capped = F.col("source_size") * max_copies < F.col("weight") * level
        row = rated.agg(F.count_if(capped).alias("full"), F.sum(F.when(capped, F.col("source_size") * max_copies)).alias("taken"),
                        F.sum(F.when(~capped, F.col("weight"))).alias("weight")).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (share * total - (row["taken"] or 0)) / row["weight"]
    target = F.when(F.col("source_size") * max_copies < F.col("weight") * level, (F.col("source_size") * max_copies).cast("double"))
    return rated.select("source", "source_size", target.otherwise(F.col("weight") * level).alias("target"))


def _quotas(strata: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, class, n``: how many documents each stratum adds to the whole copies of its source.

    A source goes through its classes from the longest documents to the
    shortest and rounds so that the words expected so far are nearest to their
    share; what rounding leaves over is made up by shorter documents.
    """
    whole = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - whole * F.col("source_size")
    listed = strata.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("class", "docs", "words")), asc=False).alias("classes"))
    planned = listed.join(targets.where("source_size > 0").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    planned = planned.select("source", "classes", rest.alias("rest"), "source_size")
    start = F.struct(F.lit(0.0).alias("expected"), F.lit(0).cast("bigint").alias("words"),
                     F.array().cast("array<struct<class: int, n: bigint>>").alias("taken"))

    def add(so_far: Column, c: Column) -> Column:
        words, mean = so_far["words"] + c["words"], c["words"] / c["docs"]
        wanted = F.col("rest") * words / F.col("source_size") - so_far["expected"]
        n = F.least(c["docs"], F.greatest(F.lit(0).cast("bigint"), F.floor(wanted / mean + F.lit(0.5)).cast("bigint")))
        return F.struct((so_far["expected"] + n * mean).alias("expected"), words.alias("words"),
                        F.concat(so_far["taken"], F.array(F.struct(c["class"].alias("class"), n.alias("n")))).alias("taken"))

    taken = planned.select("source", F.explode(F.aggregate("classes", start, add)["taken"]).alias("t"))
    return taken.select("source", "t.class", "t.n")


def _digits(level: int) -> Column:
    """All digits of the rank value, then of the tie breaker, up to ``level``; an array compared digit by digit."""
    per = RANK_BITS // DIGIT_BITS
    return F.array(*[F.shiftright("rank" if k < per else "tie", RANK_BITS - DIGIT_BITS * (k % per + 1)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
                     for k in range(level)])


def cuts(rows: DataFrame, quotas: DataFrame, max_sorted: int = MAX_SORTED) -> DataFrame:
    """``source, class, cut_rank, cut_tie``: where the first ``n`` rows of each stratum end.

    ``rows`` has ``source, class, rank, tie`` and is written; strata with no
    row or all rows to take are left out of ``quotas``. A round counts rows by
    one more digit, at most 256 counts a stratum, and keeps those that share
    the digits of the cut. The last round sorts at most ``max_sorted`` rows of
    a stratum.
    """
    here = Window.partitionBy("source", "class").orderBy("digit")
    open_ = quotas.select(F.col("source").alias("s"), F.col("class").alias("c"), F.col("n"), F.array().cast("array<bigint>").alias("at"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c"))
    for level in range(2 * RANK_BITS // DIGIT_BITS):
        around = rows.join(open_, same & (_digits(level).cast("array<bigint>") == F.col("at")))
        digit = F.element_at(_digits(level + 1), -1).cast("bigint")
        counted = around.groupBy("source", "class", "n", "at", digit.alias("digit")).agg(F.count(F.lit(1)).alias("rows"))
        summed = counted.withColumn("up_to", F.sum("rows").over(here))
        cut = summed.where((F.col("up_to") >= F.col("n")) & (F.col("up_to") - F.col("rows") < F.col("n")))
        open_ = stored(cut.select(F.col("source").alias("s"), F.col("class").alias("c"), (F.col("n") - F.col("up_to") + F.col("rows")).alias("n"),
                                  F.concat("at", F.array("digit")).alias("at"), "rows"), "mix_cuts")
        if (open_.agg(F.max("rows")).first()[0] or 0) <= max_sorted:
            break
    around = rows.join(open_, same & (_digits(level + 1).cast("array<bigint>") == F.col("at")))
    numbered = around.withColumn("number", F.row_number().over(Window.partitionBy("source", "class").orderBy("rank", "tie")))
    return numbered.where(F.col("number") == F.col("n")).select("source", "class", F.col("rank").alias("cut_rank"), F.col("tie").alias("cut_tie"))


def mix_sources(docs: DataFrame, weights: Sequence[float], share: float = 1.0, max_copies: int = MAX_COPIES,
                doc_id: str = "doc_id", text: str = "text", source: str = "source", odds: Column | None = None,
                seed: int = 11, max_sorted: int = MAX_SORTED) -> DataFrame:
    """How often the mix takes each document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``size`` is the number of words (see ``words_of``; a null text has none),
    ``taken`` the words of all its copies. ``odds`` is a positive column of the
    documents that says how likely a document gets one of the sampled copies
    beside others of its source and size; by default the share of distinct
    words. Sources are texts; a null source is one of its own. A draw depends
    on id, text and ``seed`` alone, so runs agree. Rows without words and the
    sources that have nothing else take no words; null and repeated ids keep
    their rows, and of wholly equal rows any may be the one sampled. Further
    columns are ignored; an empty table gives no rows.
    """
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"),
                       words_of(F.col(text)).alias("words"), *([] if odds is None else [odds.cast("double").alias("odds")]))
    sized = kept.select("doc_id", "text", "source", F.size("words").cast("bigint").alias("size"),
                        (word_variety(F.col("words")) if odds is None else F.col("odds")).alias("odds"))
    ranked = sized.select("doc_id", "source", "size", F.when(F.col("size") > 0, size_class("size")).alias("class"),
                          F.when(F.col("size") > 0, rank_value(F.col("doc_id"), F.col("text"), F.col("odds"), seed)).alias("rank"),
                          F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - RANK_BITS).alias("tie"))
    # written, so that the tie breakers of equal rows stay what they are
    rows = stored(ranked, "mix_rows")
    targets = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_copies), "mix_targets")
    strata = stored(rows.where("size > 0").groupBy("source", "class").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("size").alias("words")), "mix_strata")
    quotas = strata.join(_quotas(strata, targets).withColumnsRenamed({"source": "s", "class": "c"}),
                         F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c"))).drop("s", "c")
    quotas = stored(quotas, "mix_quotas")
    ends = cuts(rows.where("size > 0"), quotas.where("n > 0 AND n < docs").select("source", "class", "n"), max_sorted)
    plan = quotas.join(ends.withColumnsRenamed({"source": "s", "class": "c"}),
                       F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c")), "left")
    plan = stored(plan.select(F.col("source").alias("s"), F.col("class").alias("c"), (F.col("n") == F.col("docs")).alias("everyone"),
                              "cut_rank", "cut_tie"), "mix_plan")
    before_cut = (F.col("rank") < F.col("cut_rank")) | ((F.col("rank") == F.col("cut_rank")) & (F.col("tie") <= F.col("cut_tie")))
    sampled = F.coalesce(F.col("everyone") | before_cut, F.lit(False)).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c")), "left").drop("s", "c")
    joined = joined.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    counted = joined.withColumn("copies", (whole + sampled).cast("bigint"))
    return counted.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
