"""The named queries of the operators over the given tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from citylode.llm.common import table
from citylode.llm.exact_dedup import exact_duplicates
from citylode.llm.hard_negatives import hard_negatives
from citylode.llm.mixing import mixture
from citylode.llm.near_dedup import near_duplicates
from citylode.llm.neighbours import nearest
from citylode.llm.packing import pack_documents
from citylode.llm.quality import quality_scores
from citylode.llm.separators import document_token_counts
from citylode.llm.token_files import documents_of, token_files
from citylode.llm.topk import top_k
from citylode.llm.toxicity import toxicity_scores
from citylode.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls
from citylode.llm.whitening import whiten

# The rules of the URL query.
URL_RULES = [
    Rule(ALLOW, "com", "/"), Rule(BLOCK, "example.com", "/en/"), Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"), Rule(BLOCK, "net", "/fr/"),
]


def fold(parts: int, held: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts == held


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(3, 1))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return documents_of(token_files(spark, table(spark, sf_dir, "documents"), path, end_id=2))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return document_token_counts(spark, table(spark, sf_dir, "documents"), path)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(4, 2))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), words=2, percent=80).drop("text_sha256")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark, table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), corpus_pipeline.LANGUAGE_WEIGHTS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = table(spark, sf_dir, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(spark, moved, vec_id % 100 == 0)


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality, op2_packing, op3_token_files, op4_url_filter, op5_topk, op6_token_counts, op7_toxicity,
        op8_near_dedup, op9_exact_dedup, op10_mixing, op11_hard_negatives, op12_neighbours, op13_whitening)
} | {"pipeline": corpus_pipeline.run}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op4_url_filter": f"""
        with cut as (
            select page_id, case when position('://' in url) > 0
                then substr(url, position('://' in url) + 3) else '' end as rest
            from pages),
        parts as (
            select page_id, {LOWER.format("regexp_extract(coalesce(rest, ''), '^[^/?#]*')")} as host,
                regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
            from cut),
        rules(rank, verdict, rule_host, rule_path) as (values
            (1, 'allow', 'www.example.com', '/en/'), (2, 'block', 'example.com', '/en/'),
            (3, 'block', 'net', '/es/'), (4, 'block', 'net', '/fr/'), (5, 'allow', 'com', '/')),
        hits as (
            select page_id, host, path, min(rank) as rank
            from parts left join rules
                on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
            group by all)
        select page_id, host, path, rule_host || rule_path as rule, coalesce(verdict, 'allow') as verdict
        from hits left join rules using (rank)""",
    "op5_topk": """
        with levels as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
            from embeddings
            where embedding is not null and vec_id is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
            from levels q join levels c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 20 = 0)
        select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
        from scored
        qualify rank <= 20""",
    "op8_near_dedup": f"""
        with recursive words as (
            select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w
            from documents),
        runs as (
            select distinct doc_id, unnest(case len(w) when 0 then []::varchar[][] when 1 then [w]
                else list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) end) as run
            from words),
        sizes as (select doc_id, count(*) as n from runs group by doc_id),
        pairs as (
            select a.doc_id as a, b.doc_id as b, count(*) as common
            from runs a join runs b on a.run = b.run and a.doc_id <> b.doc_id group by all),
        links as (
            select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * common >= 80 * (x.n + y.n - common)),
        reached(doc_id, node) as (
            select doc_id, doc_id from documents
            union select doc_id, b from reached join links on node = a)
        select doc_id, coalesce(n, 0) as n_shingles, min(node) as component_id, doc_id = min(node) as kept
        from reached left join sizes using (doc_id) group by doc_id, n""",
    "op9_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
            doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents
        window same as (partition by coalesce(text, ''))""",
    "op11_hard_negatives": """
        with levels as (
            select rowid as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from (select *, row_number() over () as rowid from embeddings)
            where embedding is not null and vec_id is not null and label is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select a.row as anchor, a.vec_id as anchor_id, c.row, c.vec_id, a.label = c.label as same,
                list_dot_product(a.v, c.v)::bigint as score
            from levels a join levels c on a.row <> c.row and len(a.v) = len(c.v) and len(a.v) > 0
            where a.vec_id % 100 = 0),
        positives as (
            select anchor, anchor_id, vec_id as positive_id, score as positive_score,
                row_number() over (partition by anchor order by score desc, vec_id, row) as k
            from scored where same qualify k <= 5)
        select p.anchor_id, positive_id,
            row_number() over (partition by anchor, k order by score desc, vec_id, row)::int as rank,
            vec_id as negative_id, positive_score, score as negative_score
        from positives p join scored s using (anchor)
        where not same and 80 * positive_score <= 100 * score and score <= positive_score
        qualify rank <= 5""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
