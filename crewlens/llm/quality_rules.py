"""Quality rules: a threshold table compiled into one projection.

Measures of a text are computed by built-in functions on its word and line arrays, then every row
of `RULES` becomes a condition on a ratio of two measures. No user function runs, nothing is
shuffled, and a text of any length is measured whole.

Defined cases: a null or empty text has no words, fails the base rule and every ratio of it is
null, which passes the ratio's own rule; repeated rows are judged each for itself; an empty table
gives an empty result; the input's columns travel inside one struct, so their names cannot clash
with a measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.tables import NOT_SPACES, lines, words

# Frequent short words of English, French, German and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "with", "for", "as", "was", "on", "by", "it",
    "de", "la", "le", "les", "des", "et", "en", "un", "une", "du", "que", "qui", "pour", "dans",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "im",
    "el", "los", "las", "y", "se", "del", "una", "con", "por", "su", "para", "al", "lo",
]
SYMBOLS = r"[#*$%&|<>]"
BASE_WORDS = 50
BASE_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """`over` / `under` outside [least, most] rejects a text; a null ratio does not."""

    name: str
    over: str
    under: str
    least: float | None = None
    most: float | None = None

    def fails(self) -> Column:
        ratio = F.col(self.over) / F.nullif(F.col(self.under), F.lit(0))
        bounds = F.lit(False)
        if self.least is not None:
            bounds = bounds | (ratio < self.least)
        if self.most is not None:
            bounds = bounds | (ratio > self.most)
        return F.coalesce(bounds, F.lit(False))


# The threshold table.
RULES = [
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.25),
    Rule("stop_words_per_word", "n_stop_words", "n_words", least=0.01),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.6),
    Rule("shouted_lines", "n_shouted_lines", "n_lines", most=0.6),
]


def _windows(w: Column, n: Column) -> Column:
    """(hash, position) of each three-word window, sorted, so that equal windows are neighbours."""
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(at, lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))


def measure(docs: DataFrame, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """One row per input row: `row`, holding the carried input columns (all if not told), and the
    measures.

    n_repeat_words counts the words covered by three-word windows found twice or more in the text.
    Windows are told apart by a 64-bit hash of their words.
    """
    split = docs.select(
        F.struct(*(docs.columns if carry is None else carry)).alias("row"), F.col(text).alias("_text"), words(F.col(text)).alias("_w"),
        F.filter(lines(F.col(text)), lambda x: x.rlike(NOT_SPACES)).alias("_lines"),
    )
    # Each step reads an array several times: Spark then keeps it as a column of its own and does
    # not compute it again inside a lambda.
    sorted_ = split.select(
        "row", F.size("_w").alias("n_words"),
        F.length(F.array_join("_w", "")).alias("word_chars"),
        F.length(F.regexp_replace("_text", SYMBOLS.replace("[", "[^") + "+", "")).alias("n_symbols"),
        F.size(F.filter("_w", lambda w: w.isin(STOP_WORDS))).alias("n_stop_words"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.size(F.filter("_lines", lambda x: (x == F.upper(x)) & (x != F.lower(x)))).alias("n_shouted_lines"),
        _windows(F.col("_w"), F.size("_w")).alias("_s"),
    )
    pairs = F.arrays_zip(
        F.col("_s").alias("own"),
        F.slice("_s", 2, F.greatest(F.size("_s"), F.lit(1))).alias("next"),
    )
    equal = F.filter(pairs, lambda z: F.coalesce(z.own.h == z.next.h, F.lit(False)))
    positions = F.flatten(F.transform(equal, lambda z: F.array(z.own.i, z.next.i)))
    placed = sorted_.select(
        "*", F.sort_array(F.array_distinct(positions)).alias("_p")
    ).drop("_s")
    gaps = F.zip_with(F.col("_p"), F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))),
                      lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    covered = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_stop_words", "n_lines", "n_shouted_lines"]
    return placed.select(
        "row", *(F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.when(F.size("_p") > 0, covered).otherwise(0).cast("bigint").alias("n_repeat_words"),
    )


def judge(measured: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Adds base_failed, the names of the broken rules, and kept."""
    rules = RULES if rules is None else rules
    base = (F.col("n_words") < BASE_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))
    broken = F.filter(F.array(*(F.when(r.fails(), F.lit(r.name)) for r in rules)), lambda x: x.isNotNull())
    return measured.select(
        "*", base.alias("base_failed"), broken.alias("broken_rules"),
    ).select("*", (~F.col("base_failed") & (F.size("broken_rules") == 0)).alias("kept"))


def keep(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The rows that pass, with their columns as they were."""
    # Spark would move the condition below the projections and there compute the sorted windows
    # again for every element of them; it does not where a projection holds a task's number.
    judged = judge(measure(docs), rules).select("row", "kept", F.spark_partition_id().alias("task"))
    return judged.filter(F.col("kept") & (F.col("task") >= 0)).select("row.*")
