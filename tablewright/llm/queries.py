"""Queries of the operators over the test tables, and SQL of their results where SQL can say it.

Every query applies its operator to the whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    bpe,
    divergence,
    hardneg,
    jaccard,
    lm,
    ordering,
    packing,
    quality,
    simhash,
    substring,
    topk,
    toxicity,
    warc,
)
from tablewright.llm.common import shared_folder, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_warc_derivatives(spark, sf_dir):
    """Every derived record, its block as text: both types are UTF-8."""
    stored = warc.responses(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z")
    return warc.derivatives(stored, ("page_id",)).select(
        "page_id",
        "record_id",
        "refers_to",
        "type",
        "target_uri",
        "date",
        "content_type",
        "content_length",
        "block_digest",
        "source_block_digest",
        "source_payload_digest",
        F.to_json("source_headers").alias("source_headers"),
        F.col("block").cast("string").alias("block"),
    )


@query
def op2_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op3_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs).select(
        "doc_id", *quality.MEASURES, "base_failed", "kept"
    )


@query
def op4_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, BYTE_BPE_RANKS, public_tokenizers.PATTERN, ids=False)


@query
def op5_kd_tree_top_k(spark, sf_dir):
    vectors = topk.quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return topk.best(vectors, vectors.filter("vec_id % 50 = 0"))


@query
def op6_maxent_lm(spark, sf_dir):
    return lm.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(packing.pieces(docs, BYTE_BPE, remember=True))


@query
def op8_document_order(spark, sf_dir):
    """The whole corpus; a NULL id is -1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("part"), "text")
    found = ordering.sequences(docs, BYTE_BPE, keys=("doc_id", "part"))
    folder = shared_folder(spark, "document_order")
    return ordering.materialised(found, folder, key=20_240_101).select(
        F.col("a").alias("doc_id"), "piece", "used", "slot", "shard", "offset", "ids_crc32"
    )


@query
def op8_training_order(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    found = ordering.sequences(turns, BYTE_BPE)
    folder = shared_folder(spark, "training_order")
    return ordering.materialised(found, folder, key=20_240_101).select(
        F.col("a").alias("conv_id"), F.col("b").alias("turn"), "piece", "used", "slot", "shard",
        "offset", "ids_crc32",
    )


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    settings = toxicity.Settings()
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    field = toxicity.fit(toxicity.training_rows(docs, labels, settings.documents), settings)
    scored = toxicity.score(docs, field)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


@query
def op10_recompression(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op11_four_russians_negatives(spark, sf_dir):
    """Labels are shifted for every seventh id; every hundredth is an anchor."""
    vectors = hardneg.whole_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", shifted)
    return hardneg.hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))


@query
def op12_set_relation_join(spark, sf_dir):
    return jaccard.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_source_divergence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "lang", "source")
    return divergence.divergences(docs)


_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _counted(rule: quality.Rule) -> str:
    bounds = []
    if rule.least is not None:
        bounds.append(f"1000 * {rule.counted} < {rule.least} * {rule.among}")
    if rule.most is not None:
        bounds.append(f"1000 * {rule.counted} > {rule.most} * {rule.among}")
    return f"({rule.among} > 0 AND ({' OR '.join(bounds)}))"


ORACLES["op3_quality_rules"] = f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
    ), w AS (
        SELECT *, list_filter(string_split(translate(t, {_SPACES}, '     '), ' '), lambda x: x <> '') AS ws,
               list_filter(string_split(t, chr(10)),
                           lambda x: translate(x, ' ' || {_SPACES}, '') <> '') AS ls,
               list_filter(string_split(translate(lower(t), {_SPACES} || '.,;:', '         '), ' '),
                           lambda x: x <> '') AS ps
        FROM d
    ), p AS (
        SELECT r, unnest(range(1, len(ws) - {quality.WINDOW - 2})) AS p, ws FROM w
    ), g AS (
        SELECT r, p, array_to_string(ws[p:p + {quality.WINDOW - 1}], ' ') AS g FROM p
    ), c AS (
        SELECT r, count(DISTINCT p) AS n FROM (
            SELECT r, unnest(range(p, p + {quality.WINDOW})) AS p FROM (
                SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM g
            ) WHERE n > 1
        ) GROUP BY r
    ), m AS (
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
               CAST(length(translate(t, ' ' || {_SPACES}, '')) AS BIGINT) AS word_chars,
               CAST(length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
               CAST(len(ls) AS BIGINT) AS n_lines,
               CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
               CAST(len(list_filter(ps, lambda x: x IN ({", ".join(f"'{w}'" for w in quality.STOP_WORDS)})))
                    AS BIGINT) AS n_stop_words,
               CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
        FROM w LEFT JOIN c USING (r)
    ), b AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
    )
    SELECT *, NOT (base_failed OR {" OR ".join(map(_counted, quality.RULES))}) AS kept FROM b
"""

ORACLES["op5_kd_tree_top_k"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        WHERE q.vec_id % 50 = 0
    ), r AS (
        SELECT query_id,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                   AS rank,
               vec_id, score
        FROM s
    )
    SELECT * FROM r WHERE rank <= 5
"""

ORACLES["op11_four_russians_negatives"] = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
               CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
        WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
                AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT alike
        AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
"""

ORACLES["op13_source_divergence"] = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), w AS (
        SELECT r, lang, source, unnest(terms) AS term FROM d
    ), k AS (
        SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30
    ), l AS (
        SELECT g.lang, coalesce(v, 0)::HUGEINT AS v, coalesce(n, 0)::HUGEINT AS n
        FROM (SELECT DISTINCT lang FROM d) g
        LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang) USING (lang)
    ), c AS (
        SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL
    ), g AS (
        SELECT lang, source, coalesce(n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d)
        LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source) USING (lang, source)
    ), p AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS times,
               1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 5)) // (g.n + 5 * l.v) AS p,
               1 + (1000000000 * (k.n::HUGEINT + 5)) // (l.n + 5 * l.v) AS q
        FROM g JOIN l USING (lang) JOIN k USING (lang)
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), s AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL
    ), f AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE times > 0 AND p > q
    )
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)
                   AS INTEGER) AS rank
    FROM f QUALIFY part = 'pair' OR rank <= 50
"""
