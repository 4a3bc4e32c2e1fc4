"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Every text is measured by array expressions in its own row, so texts are never shuffled. The measures are summed up in
mergeable quantile sketches per (language, source), a few kilobytes each however many rows a source has. A group's limits
are its quartile fences; a group of fewer than ``min_group`` texts takes the merged sketch of its language, and a small
language that of all texts. The limits are then joined to the measures, and a text that leaves any fence is rejected.

Defined cases: a null or empty text has no words, all counts 0, fails the base rules and enters no sketch. Null languages and
null sources are groups of their own. Repeated rows count as often as they occur and each gets a row. Only the id,
text, language and source columns are read, so other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkapply.llm.common import WORD, words
from bulkapply.storage import materialize

SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A measure, the SQL that yields it, and the least width of its quartile range; ``low`` also guards the low side."""

    name: str
    sql: str
    least_range: float
    low: bool = False


RULES = (
    Rule("symbol_ratio", "n_symbols / word_chars", 0.01),
    Rule("mean_word", "word_chars / n_words", 0.75, low=True),
    Rule("dup_line_ratio", "n_dup_lines / n_lines", 0.1),
    Rule("repeat_ratio", "n_repeat_words / n_words", 0.05),
)


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", "lang", "source",
        words(text).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
        (F.size(F.split(text, SYMBOL)) - 1).cast("long").alias("n_symbols"),
    )
    rows = rows.withColumns({"n_words": F.size("_words").cast("long"), "n_lines": F.size("_lines").cast("long")})
    rows = rows.withColumn("_bits", F.length(F.bin("n_words")))
    rows = rows.withColumn("_keys", _window_keys(F.col("_words"), F.col("n_words"), F.col("_bits")))
    rows = rows.withColumn("_starts", _repeated_starts(F.col("_keys"), F.col("_bits")))
    rows = rows.withColumn("_windows", _windows(F.col("_words"), F.col("_starts")))
    rows = rows.withColumn("_starts", _confirmed_starts(F.col("_windows")))
    return rows.select(
        "doc_id", "lang", "source", "n_words", "n_symbols", "n_lines",
        F.aggregate("_words", F.lit(0).cast("long"), lambda total, word: total + F.length(word)).alias("word_chars"),
        (F.col("n_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _covered(F.col("_starts")).alias("n_repeat_words"),
    )


def _window_keys(word: Column, n: Column, bits: Column) -> Column:
    """For each window of three words its hash with the position in the low bits, sorted: equal windows are neighbours."""
    at = F.sequence(F.lit(0).cast("long"), n - 3)

    def key(i: Column) -> Column:
        i = i.cast("int")
        hashed = F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2))
        return F.call_function("shiftleft", F.call_function("shiftright", hashed, bits), bits).bitwiseOR(i.cast("long"))

    return F.when(n >= 3, F.sort_array(F.transform(at, key))).otherwise(F.array().cast("array<bigint>"))


def _repeated_starts(keys: Column, bits: Column) -> Column:
    """Start positions, in order, of the windows whose hash, cut by the bits of the position, occurs twice or more."""

    def window(key: Column) -> Column:
        return F.call_function("shiftright", key, bits)

    def repeated(key: Column, i: Column) -> Column:
        return window(key).eqNullSafe(window(F.get(keys, i - 1))) | window(key).eqNullSafe(window(F.get(keys, i + 1)))

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    return F.sort_array(F.transform(F.filter(keys, repeated), lambda key: key.bitwiseAND(mask)))


def _windows(word: Column, starts: Column) -> Column:
    """The windows of three words at these positions with their positions, sorted: equal windows are neighbours."""
    return F.sort_array(F.transform(starts, lambda at: F.struct(
        F.struct(*(F.get(word, at.cast("int") + i).alias(f"w{i}") for i in range(3))).alias("words"), at.alias("at"))))


def _confirmed_starts(windows: Column) -> Column:
    """Positions, in order, of those of these windows that have the same words as another."""

    def repeated(window: Column, i: Column) -> Column:
        mine = window["words"]
        return mine.eqNullSafe(F.get(windows, i - 1)["words"]) | mine.eqNullSafe(F.get(windows, i + 1)["words"])

    return F.sort_array(F.transform(F.filter(windows, repeated), lambda window: window["at"]))


def _covered(starts: Column) -> Column:
    """How many words windows of three words at these positions cover."""
    following = F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0)))
    steps = F.zip_with(starts, following, lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def thresholds(measured: DataFrame, fence: float = 6.0, min_group: int = 100, k: int = 400) -> DataFrame:
    """Per (lang, source): ``high_<rule>`` and, where the rule guards it, ``low_<rule>``.

    A sketch of size ``k`` answers a quantile within about 1 % of rank; groups of up to ``k`` texts are answered exactly.
    """
    values = measured.where("n_words > 0").select("lang", "source", *(F.expr(r.sql).alias(r.name) for r in RULES))
    groups = materialize(
        values.groupBy("lang", "source").agg(
            F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(r.name, k).alias(r.name) for r in RULES)),
        "sketches",
    )
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(r.name, k).alias(r.name) for r in RULES)]
    langs = groups.groupBy("lang").agg(*merged)
    everything = groups.groupBy(F.lit(1).alias("one")).agg(*merged)

    def limits(sketches: DataFrame, prefix: str) -> DataFrame:
        out = [F.col("n").alias(f"{prefix}_n")]
        for r in RULES:
            low, high = (F.kll_sketch_get_quantile_double(r.name, F.lit(q)) for q in (0.25, 0.75))
            width = F.greatest(high - low, F.lit(r.least_range)) * fence
            out.append((high + width).alias(f"{prefix}_high_{r.name}"))
            if r.low:
                out.append((low - width).alias(f"{prefix}_low_{r.name}"))
        return sketches.select(*(c for c in ("lang", "source", "one") if c in sketches.columns), *out)

    own, lang, every = limits(groups, "own"), limits(langs, "lang"), limits(everything, "all")
    lang = lang.withColumnRenamed("lang", "_lang")
    joined = own.join(lang, own["lang"].eqNullSafe(lang["_lang"])).withColumn("one", F.lit(1)).join(every, "one")
    names = [c[4:] for c in joined.columns if c.startswith("own_") and c != "own_n"]
    return joined.select(
        "lang", "source",
        *(F.when(F.col("own_n") >= min_group, F.col(f"own_{c}"))
          .when(F.col("lang_n") >= min_group, F.col(f"lang_{c}"))
          .otherwise(F.col(f"all_{c}")).alias(c) for c in names),
    )


def judge(docs: DataFrame, fence: float = 6.0, min_group: int = 100, k: int = 400) -> DataFrame:
    """The counts of every text with ``base_failed``, ``kept`` and ``broken``, the names of the rules it breaks."""
    measured = materialize(measures(docs), "measures")
    limit = thresholds(measured, fence, min_group, k).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = measured["lang"].eqNullSafe(limit["_lang"]) & measured["source"].eqNullSafe(limit["_source"])
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    outside = []
    for r in RULES:
        value = F.expr(f"case when n_words > 0 then {r.sql} end")
        wrong = value > F.col(f"high_{r.name}")
        outside.append(F.when(wrong | (value < F.col(f"low_{r.name}")) if r.low else wrong, F.lit(r.name)))
    judged = measured.join(limit, same, "left").withColumns(
        {"base_failed": base, "broken": F.array_compact(F.array(*outside))})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), "broken")
