"""Lexers, scores and path predicates as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_of(record: Column, start: int, end: int) -> Column:
    """Places ``start`` to ``end``, counted from 1, both included."""
    return F.substring(record, start, end - start + 1)


def is_filler(record: Column, start: int, end: int, char: str = "~") -> Column:
    return slice_of(record, start, end) == char * (end - start + 1)


def rtrim_filler(value: Column, char: str = "~") -> Column:
    return F.rtrim(value, F.lit(char))


def escaped_fields(line: Column) -> Column:
    r"""Fields between pipes, where a backslash escapes only a pipe or a backslash; null for any other escape."""
    well_formed = line.rlike(r"^([^\\]|\\[\\|])*\z")
    cut = F.regexp_extract_all(F.concat(line, F.lit("|")), F.lit(r"((?:[^\\|]|\\[\\|])*)\|"), F.lit(1))
    return F.when(well_formed, F.transform(cut, lambda x: F.regexp_replace(x, r"\\([\\|])", "$1")))


def quoted_fields(line: Column) -> Column:
    """(value, quoted) of each field between semicolons; null where quotes are not well formed."""
    field = r'(?:"(?:[^"]|"")*"|[^";]*)'
    well_formed = line.rlike(rf"^{field}(;{field})*\z")
    cut = F.regexp_extract_all(F.concat(line, F.lit(";")), F.lit(rf"({field});"), F.lit(1))
    inner = lambda x: F.regexp_replace(x.substr(F.lit(2), F.length(x) - 2), '""', '"')
    return F.when(well_formed, F.transform(cut, lambda x: F.struct(F.when(x.startswith('"'), inner(x)).otherwise(x).alias("value"), x.startswith('"').alias("quoted"))))


def keyword_score(text: Column, query: str, word: int = 3, whole: int = 8) -> Column:
    """3 for each word of the query found in the text and 8 for the whole query."""
    body, score = F.lower(text), F.lit(0)
    for w in dict.fromkeys(query.lower().split()):
        score = score + F.when(body.contains(w), word).otherwise(0)
    return score + F.when(body.contains(query.lower()), whole).otherwise(0)


def truncated(text: Column, most: int, suffix: str = "...") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(suffix))).otherwise(text)


def path_overlap(a: Column, b: Column) -> Column:
    """Equal, or one a folder that holds the other."""
    return (a == b) | a.startswith(F.concat(b, F.lit("/"))) | b.startswith(F.concat(a, F.lit("/")))


def word_lines(df, key: str, text: str, word: str):
    """(key, line number from 1, line) of lines that hold a word, letter case aside."""
    lines = df.select(F.col(key), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    return lines.filter(F.col("line").rlike(rf"(?i)\b{word}\b")).select(key, (F.col("pos") + 1).alias("line_number"), "line")
