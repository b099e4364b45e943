"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .bagminhash import group_near_copies
from .collocations import mine_collocations
from .ctw import score_documents
from .deploy import ship
from .langid import predict_languages
from .mixing import mix_sources
from .multi_index import search
from .packing import pack_documents
from .projection import group_vectors
from .quality import classify_quality
from .ranked import rank_documents
from .suffixes import cut_repeats
from .toxicity import rate_toxicity
from .warc import archive_round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op4_subword_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(_table(spark, sf_dir, "documents"))


def op5_deficit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op6_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(_table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))


def op7_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_near_copies(_table(spark, sf_dir, "documents"))


def op9_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_vectors(_table(spark, sf_dir, "embeddings"))


def op11_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(_table(spark, sf_dir, "documents"))


def op12_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(_table(spark, sf_dir, "documents"))


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_entropy_mixing": op1_entropy_mixing,
    "op2_multi_index": op2_multi_index,
    "op3_subword_quality": op3_subword_quality,
    "op4_subword_languages": op4_subword_languages,
    "op5_deficit_packing": op5_deficit_packing,
    "op6_dictionary_warc": op6_dictionary_warc,
    "op7_context_tree": op7_context_tree,
    "op8_bagminhash": op8_bagminhash,
    "op9_ordinal_toxicity": op9_ordinal_toxicity,
    "op10_sorted_projections": op10_sorted_projections,
    "op11_induced_suffixes": op11_induced_suffixes,
    "op12_trie_collocations": op12_trie_collocations,
    "op13_dual_tree": op13_dual_tree,
}

#: The first ten operators learn, search approximately, tokenise or write files, which SQL does
#: not express. Their tests compare with brute force instead.
ORACLE: dict[str, str] = {
    "op11_induced_suffixes": r"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h
            FROM documents),
        win AS (
            SELECT r, doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS x FROM (
                SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM doc)),
        again AS (
            SELECT r, s FROM (
                SELECT r, s, row_number() OVER (
                    PARTITION BY x ORDER BY doc_id NULLS LAST, r, s) AS n FROM win)
            WHERE n > 1),
        run AS (
            SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS k FROM (
                SELECT r, s, CASE WHEN lag(s) OVER (PARTITION BY r ORDER BY s) + 100 >= s
                    THEN 0 ELSE 1 END AS fresh
                FROM again)),
        span AS (SELECT r, min(s) AS b, max(s) + 100 AS e FROM run GROUP BY r, k),
        gap AS (
            SELECT r, b AS e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS b FROM span
            UNION ALL SELECT r, len(h) // 2, coalesce(last, 0) FROM doc LEFT JOIN (
                SELECT r, max(e) AS last FROM span GROUP BY r) USING (r)),
        kept AS (
            SELECT r, string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) AS k
            FROM gap JOIN doc USING (r) GROUP BY r),
        gone AS (
            SELECT r, sum(e - b)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
        SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes,
            coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
            sha256(unhex(k)) AS kept_sha256
        FROM doc JOIN kept USING (r) LEFT JOIN gone USING (r)
    """,
    "op12_trie_collocations": r"""
        WITH piece AS (
            SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)),
        total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM piece GROUP BY lang),
        gram AS (
            SELECT lang, k, ws[i:i + k - 1] AS g, count(*) AS f FROM (
                SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                FROM piece, (VALUES (1), (2), (3), (4)) AS t(k))
            GROUP BY ALL HAVING count(*) >= 30),
        cut AS (
            SELECT lang, k, g, f AS a, unnest(range(1, k)) AS j FROM gram WHERE k > 1),
        scored AS (
            SELECT c.lang, c.k, c.g, c.a, c.j, x.f AS l, y.f AS r,
                ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
            FROM cut c
            JOIN gram x ON x.lang = c.lang AND x.g = c.g[1:c.j]
            JOIN gram y ON y.lang = c.lang AND y.g = c.g[c.j + 1:c.k]),
        lowest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
        inner_part AS (
            SELECT lang, g[i:i + m - 1] AS g, max(f) AS most FROM (
                SELECT lang, g, f, m, unnest(range(1, k - m + 2)) AS i
                FROM gram, (VALUES (2), (3)) AS t(m) WHERE m < k)
            GROUP BY ALL),
        kept AS (
            SELECT lowest.* FROM lowest LEFT JOIN inner_part USING (lang, g)
            WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
        ranked AS (
            SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score, row_number() OVER (
                PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
            FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
    "op13_dual_tree": r"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
            FROM documents),
        total AS (
            SELECT count(*) AS nn, sum(len(terms))::BIGINT AS ll FROM doc WHERE len(terms) > 0),
        item AS (
            SELECT DISTINCT i, item_id, unnest(terms) AS term FROM (
                SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
                FROM benchmark)),
        tf AS (
            SELECT r, doc_id, n, term, count(*) AS tf FROM (
                SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc)
            GROUP BY ALL),
        weight AS (
            SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
        scored AS (
            SELECT i, item_id, r, doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))::BIGINT
                    AS score
            FROM item JOIN tf USING (term) JOIN weight USING (term), total
            GROUP BY i, item_id, r, doc_id),
        ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (
                PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS FIRST) AS rank
            FROM scored WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
