"""The registered queries of this package, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (chunk_bpe, lexical_search, mixing, near_duplicates, neighbours, packing, quality, secrets,
                         substring_duplicates, token_counts, toxicity, url_filters, whitening)
from daybook.sources.readers import read_table


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding site rule and verdict of every page."""
    rules = url_filters.SITE_RULES + url_filters.PATTERN_RULES
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, url_filters.rules_table(spark, rules), len(rules)).select(
        "page_id", "host", "path", "rule", "pattern", "verdict")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, places and hash of the secrets in every document."""
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))

    def n(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("secrets")).alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a model fitted outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling rate and decisions for every document."""
    return mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("rate", 6).alias("rate"), "sampled",
        "copies", "chosen")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar two-word shingle sets."""
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), size=2)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document; over_limit: more than 2048 tokens."""
    return (token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())
            .withColumn("over_limit", F.col("n_tokens") > 2048))


def op8_substring_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat across documents."""
    return substring_duplicates.repeated_passages(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, score against the trusted documents, and verdict for every document."""
    trusted = quality.trusted_ids(read_table(spark, sf_dir, "labels"))
    return quality.rate(read_table(spark, sf_dir, "documents"), trusted)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 whitened components of every vector."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    coded = chunk_bpe.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_url_filters": op2_url_filters,
    "op3_secrets": op3_secrets,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_token_counts": op7_token_counts,
    "op8_substring_duplicates": op8_substring_duplicates,
    "op9_quality_rules": op9_quality_rules,
    "op10_neighbours": op10_neighbours,
    "op11_whitening": op11_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_bpe_codec": op13_bpe_codec,
}

_TERMS = (r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"""
          r""" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')""")

_EDGE = "([^a-z0-9]|^|$)"

ORACLE: dict[str, str] = {
    "op2_url_filters": f"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, url,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
     h AS (SELECT r, page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                  coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
     rules(rule, rule_host, rule_path, action) AS (VALUES
         ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
     patterns(pattern, words) AS (VALUES
         ('^cheap-pills^', 'cheap-pills'), ('^pills^', 'pills'), ('^casino^', 'casino'), ('^poker^', 'poker'),
         ('^viagra^', 'viagra'), ('^replica-watches^', 'replica-watches'), ('^payday-loans^', 'payday-loans'),
         ('^free-download^', 'free-download'), ('^adult^', 'adult'), ('^xxx^', 'xxx'), ('^porn^', 'porn'),
         ('^betting^', 'betting'), ('^click-here^', 'click-here'), ('^ads.*^banner^', 'ads[.](.|\n)*{_EDGE}banner'),
         ('^affiliate^', 'affiliate'), ('^warez^', 'warez')),
     s AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM h JOIN rules
           ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r),
     b AS (SELECT r, arg_max(pattern, lpad(length(pattern)::VARCHAR, 4, '0') || pattern) AS pattern FROM h JOIN patterns
           ON regexp_matches(low, '{_EDGE}' || words || '{_EDGE}') GROUP BY r)
SELECT page_id, host, path, rule, pattern,
       coalesce(action, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN s USING (r) LEFT JOIN b USING (r)""",
    "op12_lexical_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
     n AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
     tf AS (SELECT r, doc_id, term, count(*)::BIGINT AS tf, any_value(n)::BIGINT AS n
            FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY r, doc_id, term),
     w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
           FROM tf, n GROUP BY term),
     i AS (SELECT q, item_id, term, count(*)::BIGINT AS times
           FROM (SELECT row_number() OVER () AS q, item_id, unnest(terms) AS term
                 FROM (SELECT item_id, {_TERMS} AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark)))
           GROUP BY q, item_id, term),
     s AS (SELECT q, item_id, r, doc_id,
                  sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total))))::BIGINT AS score
           FROM i JOIN w USING (term) JOIN tf USING (term), n GROUP BY q, item_id, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
      FROM s WHERE score > 0) WHERE rank <= 20""",
}
