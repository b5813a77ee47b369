"""The registered queries of this package, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seawarden.llm import bpe, divergence, hard_negatives, jaccard_join, katz, licenses, near_dedup, packing, quality_model, quality_rules, sharding, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine; every executor has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_hamming_topk(spark, folder):
    return topk.search_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op2_pack_best_fit(spark, folder):
    return packing.pack(documents(spark, folder), tokenizer_path("word_bpe_49k.json")).drop("ids")


def op3_line_frequency(spark, folder):
    return quality_rules.judge(documents(spark, folder))


def op4_bpe_round_trip(spark, folder):
    return bpe.round_trip(documents(spark, folder), tokenizer_path("byte_bpe_50k.json"))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op5_circulant_minhash(spark, folder):
    return near_dedup.groups(documents(spark, folder), size=2).drop("content")


def op6_toxicity(spark, folder):
    docs = documents(spark, folder)
    return toxicity.score(docs, toxicity.fit(docs, labels(spark, folder)))


def op7_license_scan(spark, folder):
    return licenses.scan(documents(spark, folder))


def op8_attention_quality(spark, folder):
    docs = documents(spark, folder)
    return quality_model.score(docs, quality_model.fit(docs, labels(spark, folder)))


def op9_katz_backoff(spark, folder):
    return katz.score(documents(spark, folder))


def op10_hilbert_shards(spark, folder):
    return sharding.shard(documents(spark, folder)).drop(*sharding.TEXTS)


def op11_token_combinations(spark, folder):
    return jaccard_join.groups(documents(spark, folder))


def op12_source_divergence(spark, folder):
    return divergence.audit(documents(spark, folder))


def op13_fagin_negatives(spark, folder):
    return hard_negatives.mine(hard_negatives.prepare(spark.read.parquet(f"{folder}/embeddings.parquet")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_hamming_topk,
        op2_pack_best_fit,
        op3_line_frequency,
        op4_bpe_round_trip,
        op5_circulant_minhash,
        op6_toxicity,
        op7_license_scan,
        op8_attention_quality,
        op9_katz_backoff,
        op10_hilbert_shards,
        op11_token_combinations,
        op12_source_divergence,
        op13_fagin_negatives,
    )
}

_WORDS = r"regexp_extract_all({}, '[^ \t-\r]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_hamming_topk": """
        WITH bits AS (
            SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings
        ), pairs AS (
            SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
                   CAST(list_sum(list_transform(list_zip(q.b, v.b), lambda p: CASE WHEN p[1] = p[2] THEN 0 ELSE 1 END))
                        AS BIGINT) AS distance
            FROM bits q JOIN bits v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs
        )
        SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
    """,
    "op3_line_frequency": rf"""
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents
        ), split AS (
            SELECT *, {_WORDS.format("text")} AS w,
                   list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) AS lines
            FROM docs
        ), places AS (
            SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM split
        ), threes AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places
        ), repeats AS (
            SELECT doc_id, count(DISTINCT spot) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS spot FROM threes WHERE n > 1) GROUP BY doc_id
        ), each AS (
            SELECT doc_id, host, text, {_WORDS.format(_LOWER.format("line"))} AS words
            FROM (SELECT doc_id, host, text, unnest(lines) AS line FROM split)
        ), above AS (
            SELECT host, words FROM each GROUP BY host, words
            HAVING count(DISTINCT text) > 2 AND count(DISTINCT text)
                > least(0.1 * (SELECT count(DISTINCT text) FROM docs d WHERE d.host = each.host), 200)
        ), removed AS (
            SELECT doc_id, sum(len(words))::BIGINT AS removed_words FROM each JOIN above USING (host, words) GROUP BY doc_id
        ), counted AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed_words, 0) AS removed_words
            FROM split LEFT JOIN repeats USING (doc_id) LEFT JOIN removed USING (doc_id)
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
                   AND n_words - removed_words >= 0.3 * n_words AS kept
        FROM counted
    """,
    "op12_source_divergence": rf"""
        WITH words AS (
            SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all({_LOWER.format("coalesce(text, '')")},
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), counts AS (
            SELECT lang, source, nr, term, count(*) AS n FROM (SELECT lang, source, nr, unnest(w) AS term FROM words)
            GROUP BY ALL
        ), kept AS (
            SELECT lang, term, sum(n) AS n_lang FROM counts GROUP BY lang, term HAVING count(*) >= 30
        ), held AS (
            SELECT lang, source, term, sum(n) AS n FROM counts SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), langs AS (
            SELECT lang, count(*) AS v, sum(n_lang) AS n_all FROM kept GROUP BY lang
        ), groups AS (
            SELECT g.*, coalesce(t.n_group, 0) AS n_group FROM (SELECT DISTINCT lang, source FROM words) g
            LEFT JOIN (SELECT lang, source, sum(n) AS n_group FROM held GROUP BY ALL) t USING (lang, source)
        ), shares AS (
            SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
                   (1 + 1000000000::HUGEINT * (coalesce(h.n, 0) + 5) // (g.n_group + 5 * l.v))::BIGINT AS p,
                   (1 + 1000000000::HUGEINT * (k.n_lang + 5) // (l.n_all + 5 * l.v))::BIGINT AS q
            FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
            LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
                       FROM shares x JOIN shares y USING (lang, term) GROUP BY ALL) s
              ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        )
        SELECT lang, source, 'pair' AS part, item, value,
               row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank
        FROM pairs
        UNION ALL
        SELECT lang, source, 'term', term, p - q,
               row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term)::INT AS rank
        FROM shares WHERE n > 0 AND p > q QUALIFY rank <= 50
    """,
    "op13_fagin_negatives": """
        WITH whole AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM whole a JOIN whole r ON a.id % 100 = 0 AND a.id <> r.id
        ), positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT
                   AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5
    """,
}
