"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is built-in column expressions: no user function, no shuffle, one
row in and one row out.

Defined results: a null text has no words; an empty text neither; both fail
the base rule.  A line is what lies between line feeds; only lines with a word
count.  Ties, null keys and repeated rows do not matter, as rows stand alone; an empty table gives no rows; texts are
read whole, whatever their length.  Columns of the input other than the key and the text are ignored, whatever their names.
Windows of three words are told apart by a 64-bit hash within one text: a text of a million words has a chance of one in
forty million that two windows count as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the languages served.
STOP_WORDS = ("the and of to in is that a it for " "der die und den von zu das ist in im " "de la le et les des un une en est " "el que los y del se las por con para").split()

#: Threshold table: (name, expression over the measures, lower bound, upper bound).
#: Ratios are compared as given; a bound of None is open.
THRESHOLDS: list[tuple[str, str, float | None, float | None]] = [
    ("words", "n_words", 50, 100_000_000),
    ("repeated words", "n_repeat_words / n_words", None, 0.5),
    ("word length", "word_chars / n_words", 2.0, 20.0),
    ("symbols to words", "n_symbols / n_words", None, 0.5),
    ("stop words", "n_stop_words / n_words", 0.02, None),
    ("repeated lines", "n_dup_lines / n_lines", None, 0.3),
]


def words_of(text: Column) -> Column:
    """Words as maximal runs of other characters than ASCII white space."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed.isNull() | (trimmed == ""), F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def repeat_words(words: Column, hashes: Column) -> Column:
    """Words that lie in 3-word windows found more than once; ``hashes`` has the windows' hashes in order."""
    n = F.size(hashes)
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        found = F.transform(s, lambda e, j: F.when(F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)), e["i"]))
        return F.sort_array(F.filter(found, lambda x: x.isNotNull()))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    # nested transforms over one-element arrays bind the intermediate arrays, so each is computed once
    bound = F.transform(F.array(ordered), starts)
    counted = F.transform(bound, covered)
    return F.when(F.size(F.array_distinct(hashes)) == n, F.lit(0)).otherwise(F.element_at(counted, 1)).cast("long")


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and what the rules measure of each text."""
    body = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    body = body.withColumn("_w", words_of(F.col("_t")))
    body = body.withColumn("_n", F.size("_w"))
    body = body.withColumn("_h", F.when(F.col("_n") >= 3, F.transform(F.sequence(F.lit(0), F.greatest(F.col("_n") - 3, F.lit(0))), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).otherwise(F.array().cast("array<bigint>")))
    body = body.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    stop = F.array(*map(F.lit, dict.fromkeys(STOP_WORDS)))
    return body.select(
        key,
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w"), F.col("_h")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop_words"),
    )


def compiled(table: list[tuple[str, str, float | None, float | None]]) -> Column:
    """True where every rule of the table holds; a ratio without a base counts as broken."""
    rules = []
    for _, ratio, low, high in table:
        value = F.expr(f"try_divide({', '.join(x.strip() for x in ratio.split('/'))})" if "/" in ratio else ratio)
        rules += [value >= F.lit(low)] if low is not None else []
        rules += [value <= F.lit(high)] if high is not None else []
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & F.coalesce(rule, F.lit(False))
    return verdict


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", table: list | None = None) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for each row."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rated = measures(docs, key, text).withColumn("base_failed", base)
    return rated.withColumn("kept", ~F.col("base_failed") & compiled(THRESHOLDS if table is None else table))


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text", table: list | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were; row by row, without a join."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_x"))
    judged = judge(whole.select(F.struct("_row", "_k").alias("_both"), "_x"), "_both", "_x", table)
    return judged.filter("kept").select("_both._row.*")
