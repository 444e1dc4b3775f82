"""The operators over the given tables: one query each, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .block_names import exact_groups
from .common import ROW, table
from .gam import scored_documents
from .line_rules import quality_report
from .mixing import mix_report
from .order_minhash import near_groups
from .packing import pack_documents
from .page_diff import page_report
from .phrase_mining import mine_phrases
from .ring import shard_documents
from .substring_chains import fuzzy_passages
from .suffix_blocks import repeat_report
from .value_tables import code_report
from .warc_bundles import archive_report

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages(spark, table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"), TOKENIZER, RANKS)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark, table(spark, sf_dir, "documents")).drop(ROW)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(spark, table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark, table(spark, sf_dir, "documents")).drop(ROW)


def op6_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(spark, table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(spark, table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark, table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_report(spark, table(spark, sf_dir, "pages"))


def op11_vector_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_report(spark, table(spark, sf_dir, "embeddings"))


def op12_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(spark, table(spark, sf_dir, "pages"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_best_fit_packing,
        op3_exact_dedup,
        op4_suffix_array_dedup,
        op5_minhash_near_dedup,
        op6_mixing_sources,
        op7_quality_rules,
        op8_quality_classifier,
        op9_sharding,
        op10_html_extraction,
        op11_vector_compression,
        op12_warc_bundles,
        op13_phrase_mining,
    )
}


def value_tables_sql(rounds: int = 2) -> str:
    """Codebooks of op11 round by round, as one table of integer components per round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT vec, part, min(distance * 64 + entry) % 64 AS entry, min(distance * 64 + entry) // 64 AS distance
            FROM (SELECT v.vec, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x)) AS distance
                  FROM v JOIN c{i} c ON v.part = c.part AND v.pos = c.pos GROUP BY ALL) GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""
        s{i} AS MATERIALIZED (
            SELECT a.part, a.entry, v.pos, sum(v.x) AS s, count(*) AS n
            FROM a{i} a JOIN v ON v.vec = a.vec AND v.part = a.part GROUP BY ALL),
        c{i + 1} AS MATERIALIZED (
            SELECT c.part, c.entry, c.pos,
                   cast(CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
            FROM c{i} c LEFT JOIN s{i} s ON s.part = c.part AND s.entry = c.entry AND s.pos = c.pos)""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS vec, vec_id, label, embedding FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        flat AS (SELECT vec, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i,
                        len(embedding) // 16 AS width FROM kept),
        v AS MATERIALIZED (
            SELECT vec, i // width AS part, i % width AS pos, cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT) AS x FROM flat),
        c0 AS MATERIALIZED (SELECT part, vec - 1 AS entry, pos, x FROM v WHERE vec <= 64),
        {", ".join(s.strip() for s in steps)},
        d AS (SELECT sha256(string_agg(cast(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c{rounds}),
        e AS (SELECT vec, string_agg(format('{{:02x}}', cast(entry AS INTEGER)), '' ORDER BY part) AS code,
                     cast(sum(distance) AS BIGINT) AS error FROM a{rounds} GROUP BY vec)
        SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM e JOIN kept USING (vec) CROSS JOIN d"""


ORACLES = {
    "op3_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents),
        s AS (SELECT doc_id, sha256(norm) AS text_sha256, norm FROM t)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM s WINDOW g AS (PARTITION BY norm)""",
    "op11_vector_compression": value_tables_sql(),
    "op12_warc_bundles": """
        WITH t AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM t)
        SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               cast(CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS DOUBLE) AS refers_to
        FROM f""",
    "op13_phrase_mining": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
                   string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
            FROM documents),
        p AS (SELECT lang, doc, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM t),
        w AS (SELECT lang, doc, i, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
        o AS (SELECT lang, doc, i, unnest(words) AS w1, generate_subscripts(words, 1) AS pos FROM w),
        x AS (SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
              FROM o WINDOW p AS (PARTITION BY doc, i ORDER BY pos)),
        f AS MATERIALIZED (
            SELECT lang, w1 AS phrase, 1 AS k, count(*) AS f FROM x GROUP BY ALL
            UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM x WHERE w2 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM x WHERE w3 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM x WHERE w4 IS NOT NULL
            GROUP BY ALL),
        n AS (SELECT lang, cast(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        s AS MATERIALIZED (SELECT lang, phrase, k, f, string_split(phrase, ' ') AS words FROM f WHERE f >= 30),
        c AS MATERIALIZED (SELECT s.lang, s.phrase, s.k, s.f AS a, x.f AS l, y.f AS r, cut,
                     (2000000 * cast(s.f AS HUGEINT)) // (x.f + y.f) AS score
              FROM s, (SELECT unnest([1, 2, 3]) AS cut), s x, s y
              WHERE cut < s.k AND x.lang = s.lang AND y.lang = s.lang
                AND x.phrase = array_to_string(s.words[1 : cut], ' ') AND y.phrase = array_to_string(s.words[cut + 1 : s.k], ' ')),
        b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        q AS (SELECT lang, f, array_to_string(words[start : start + m - 1], ' ') AS inner_phrase
              FROM s, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS start)
              WHERE m < k AND start + m - 1 <= k),
        g AS (SELECT lang, inner_phrase, max(f) AS f FROM q GROUP BY ALL),
        e AS (SELECT b.* FROM b LEFT JOIN g ON g.lang = b.lang AND g.inner_phrase = b.phrase
              WHERE g.f IS NULL OR 100 * g.f < 80 * b.a)
        SELECT e.lang, row_number() OVER (PARTITION BY e.lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n.n, cast(score AS BIGINT) AS score
        FROM e JOIN n ON n.lang = e.lang
        QUALIFY rank <= 2000""",
}
