"""Queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyproof.llm import cotraining, line_dedup, matroska, packing, partenum, piece_sampling, quality_rules, string_kernel, style_tree, suffix_groups


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"), sentence=line_dedup.SENTENCE, least=line_dedup.LEAST)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), digest=True)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.score(docs, cotraining.fit(docs, table(spark, sf_dir, "labels")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_groups.dedup(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = string_kernel.predict(docs, string_kernel.fit(docs, ~string_kernel.held_out()))
    return found.select("doc_id", string_kernel.held_out().alias("held_out"), "lang_pred", "score")


def op10_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.media_columns(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_ngram_jaccard_join,
        op3_substring_dedup,
        op4_quality_rules,
        op5_sentencepiece,
        op6_quality_classifier,
        op7_packing,
        op8_suffix_array_dedup,
        op9_language_id,
        op10_matroska,
    )
}

_SPACES = r"[\x20\x09-\x0D]+"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))

SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": rf"""
with recursive t as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACES}'), lambda x: x <> '') w
  from documents),
s as (
  select distinct doc_id, g from (
    select doc_id, unnest(case when len(w) > 2 then list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2])
      when len(w) > 0 then [array_to_string(w, chr(31))] else [] end) g from t)),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id x, b.doc_id y, count(*) k from s a join s b using (g) where a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join n c on c.doc_id = x join n d on d.doc_id = y where 100 * k >= 90 * (c.n + d.n - k)),
u as (select x, y from e union all select y, x from e),
r(x, y) as (select doc_id, doc_id from documents union select r.x, u.y from r join u on r.y = u.x)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, m.c component_id
from documents d left join n on n.doc_id = d.doc_id join (select x, min(y) c from r group by x) m on m.x = d.doc_id
""",
    "op3_substring_dedup": rf"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) l,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) i
  from documents),
u as (
  select doc_id, i, unnest(s) u, generate_subscripts(s, 1) j
  from (select doc_id, i, string_split(regexp_replace(l, '([.!?] )', '\1' || chr(31), 'g'), chr(31)) s from l)),
n as (
  select *, lower(trim(regexp_replace(u, '{_SPACES}', ' ', 'g'))) norm,
         len(list_filter(regexp_split_to_array(u, '{_SPACES}'), lambda w: w <> '')) n_words
  from u),
r as (
  select *, n_words >= {line_dedup.LEAST} and row_number() over (partition by n_words >= {line_dedup.LEAST}, norm order by doc_id, i, j) > 1 gone
  from n),
k as (
  select doc_id, i, count(*) filter (n_words > 0) n_units, count(*) filter (gone) n_removed,
         coalesce(sum(length(u)) filter (gone), 0) removed_chars, coalesce(string_agg(u, '' order by j) filter (not gone), '') rest
  from r group by doc_id, i)
select doc_id, sum(n_units)::bigint n_units, sum(n_removed)::bigint n_removed, sum(removed_chars)::bigint removed_chars,
       sha256(coalesce(string_agg(rest, chr(10) order by i) filter (rest <> '' or n_removed = 0), '')) kept_sha256
from k group by doc_id
""",
    "op4_quality_rules": rf"""
with t as (
  select doc_id, coalesce(text, '') x,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda w: w <> '') w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) l
  from documents),
tri as (
  select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) n
  from (select doc_id, w, unnest(range(1, len(w) - 1)) i from t)),
rep as (
  select doc_id, count(distinct p) n from (select doc_id, unnest([i, i + 1, i + 2]) p from tri where n > 1) group by doc_id),
m as (
  select t.doc_id, len(w) n_words, length(regexp_replace(x, '{_SPACES}', '', 'g')) word_chars,
         length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) n_symbols,
         len(l) - len(list_distinct(l)) n_dup_lines, coalesce(rep.n, 0) n_repeat_words, len(l) n_lines,
         len(list_filter(w, lambda y: lower(y) in ({_STOP}))) n_stop
  from t left join rep using (doc_id)),
j as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m)
select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols,
       n_dup_lines::bigint n_dup_lines, n_repeat_words::bigint n_repeat_words, base_failed,
       coalesce(not base_failed and n_words between 50 and 100000000
         and n_repeat_words::double / n_words <= 0.5
         and word_chars::double / n_words between 2.0 and 20.0
         and n_symbols::double / n_words <= 0.5
         and n_stop::double / n_words >= 0.02
         and n_dup_lines::double / n_lines <= 0.3, false) kept
from j
""",
}
