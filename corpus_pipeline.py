"""A filtering pipeline over ``documents``: each stage calls one operator and works on what the one before kept.

``run`` writes every stage's result as Parquet under the session's shared
checkpoint folder and reads it back as the next one's input.

Defined results: a null text is rejected as of no language, as are empty ones; null source, language or
length count as values of their own; of rows that share key and text one stays, and of ties the lesser key
then text hash; null keys are documents of their own, last in order of near copies and first in that of
sentences; an empty table gives no pieces; columns beyond the five of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyproof.llm import cotraining, line_dedup, packing, partenum, passage_dedup, string_kernel
from tallyproof.llm.queries import table, tokenizer
from tallyproof.llm.storage import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    return cotraining.score(docs, cotraining.fit(docs, table(spark, sf_dir, "labels")), rows=True)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the model knows."""
    return string_kernel.reject_unknown(docs, ~string_kernel.held_out())


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return partenum.keep_one(docs, words=5, num=80, den=100)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of sentences, short ones included, of 13 words or more, and the passages of over 50 words that an earlier document or place holds."""
    return passage_dedup.keep_first(docs, passage=passage_dedup.PASSAGE)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences of 13 words or more that an earlier document or place holds."""
    return line_dedup.keep_first(docs, sentence=line_dedup.SENTENCE, least=line_dedup.LEAST)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("passage dedup", passages),
    ("substring dedup", substring_dedup),
    ("packing", packed),
]

#: Classifiers and tokenizers can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
