"""One query per operator, with production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillmill.llm import (
    ann_partitions, bin_slack, conversation_repair, edit_tokens, line_windows, ngram_join, sp_bpe, sp_chunks, surrogates, target_resampling,
    toxicity, va_search, zstd_quality,
)
from skillmill.llm.common import ship, table
from skillmill.llm.labelled import fold


def surrogate_key(spark: SparkSession) -> str:
    """The key the session names; one for the test tables where it names none."""
    return spark.conf.get("spark.skillmill.surrogateKey", "test tables")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(docs, surrogate_key(spark))


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann_partitions.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


def held_out(of: int, remainder: int) -> Column:
    return F.coalesce(fold("doc_id", of) == remainder, F.lit(False))


def op3_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = zstd_quality.quality(docs, table(spark, sf_dir, "labels"), ~held_out(4, 2))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


def derived_edits() -> Column:
    """Three edits of a document, placed by hashes of its text: a changed word, a deletion, an insertion.

    They stand for the edits of a text under revision and are made of the text itself.
    """
    size = F.length("text")

    def place(k: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(k), "text"), size + 1)

    changed = F.struct(place(1).alias("start"), (place(1) + 6).alias("stop"), F.substring("text", F.lit(1), F.lit(9)).alias("replacement"))
    deleted = F.struct(place(2).alias("start"), (place(2) + 40).alias("stop"), F.lit("").alias("replacement"))
    inserted = F.struct(place(3).alias("start"), place(3).alias("stop"), F.concat(F.lit(" "), F.right("text", F.lit(25))).alias("replacement"))
    return F.when(F.col("text").isNotNull(), F.array(changed, deleted, inserted))


def op4_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edit_tokens.counts(docs, derived_edits(), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_windows.drop_repeated_windows(docs)


def op6_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = va_search.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)
    return found.withColumn("score", F.col("score").cast("long"))


def op7_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sp_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_count_vector_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op9_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_slack.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op11_distinct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_chunks.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


def op13_radix_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {
    q.__name__: shipped(q)
    for q in (
        op1_surrogates, op2_learned_partitions, op3_zstd_quality, op4_edit_counts, op5_line_windows,
        op6_va_file, op7_sentencepiece_bpe, op8_count_vector_rtree, op9_bin_slack, op10_clause_grammar, op11_distinct_chunks,
        op12_prefix_doubling, op13_radix_resampling,
    )
}

SQL = {
    "op5_line_windows": """
        WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
        placed AS (
            SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM split WHERE doc_id IS NOT NULL AND len(ls) >= 3
        ),
        win AS (SELECT doc_id, i - 1 AS pos, ls[i] AS a, ls[i + 1] AS b, ls[i + 2] AS c FROM placed),
        ranked AS (
            SELECT *, doc_id::HUGEINT * 2147483648 + pos AS place FROM win WHERE NOT (a = '' AND b = '' AND c = '')
        ),
        firsts AS (SELECT a, b, c, min(place) AS place FROM ranked GROUP BY a, b, c),
        covered AS (
            SELECT DISTINCT r.doc_id, r.pos + k.k AS pos
            FROM ranked r JOIN firsts f ON r.a = f.a AND r.b = f.b AND r.c = f.c AND r.place > f.place,
                 (SELECT unnest([0, 1, 2]) AS k) k
        ),
        lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM split),
        kept AS (
            SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
                   string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL) AS text
            FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
               coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
        FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
    """,
    "op6_va_file": """
        WITH whole AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
        ),
        scored AS (
            SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score
            FROM whole q JOIN whole x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_prefix_doubling": """
        WITH RECURSIVE bytes AS (
            SELECT list_transform(range(0, 256), lambda b: list_reduce(
                range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)) AS tab
        ),
        said AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
            FROM conversations
        ),
        drawn AS (
            SELECT s.*, xor(list_reduce(
                list_transform(range(1, length(name) + 1), lambda i: ord(name[i])::BIGINT),
                lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS lot
            FROM said s, bytes
        ),
        harmed AS (
            SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
                   CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM drawn, (SELECT unnest([1, 2]) AS copy) WHERE lot <> 0 AND (copy = 1 OR lot = 3)
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen
            FROM harmed
        ),
        marked AS (
            SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
                   CASE WHEN seen = '' THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM placed
        ),
        summed AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                   count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                   count(*) FILTER (WHERE earlier IS NOT NULL AND earlier || c NOT IN ('su', 'ua', 'au')) AS illegal
            FROM marked GROUP BY conv_id
        ),
        ways AS (
            SELECT conv_id, n AS i, [
                {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}, {'cost': 10, 'audit': 'II', 'lines': ['user:', 'assistant:']},
                {'cost': 5, 'audit': 'I', 'lines': ['assistant:']}, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}] AS v
            FROM summed
            UNION ALL
            SELECT conv_id, i - 1, list_transform([1, 2, 3, 4], lambda s: list_sort([
                base[s],
                {'cost': 5 + base[CASE s WHEN 3 THEN 4 ELSE 3 END].cost, 'audit': 'I' || base[CASE s WHEN 3 THEN 4 ELSE 3 END].audit,
                 'lines': list_prepend(CASE s WHEN 3 THEN 'assistant:' ELSE 'user:' END, base[CASE s WHEN 3 THEN 4 ELSE 3 END].lines)},
                {'cost': 10 + base[CASE s WHEN 3 THEN 3 ELSE 4 END].cost, 'audit': 'II' || base[CASE s WHEN 3 THEN 3 ELSE 4 END].audit,
                 'lines': list_concat(CASE s WHEN 3 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END, base[CASE s WHEN 3 THEN 3 ELSE 4 END].lines)}
            ])[1])
            FROM (
                SELECT w.conv_id, w.i, list_transform([1, 2, 3, 4], lambda s: list_sort(list_filter([
                    {'cost': 2 + v[s].cost, 'audit': 'D' || v[s].audit, 'lines': v[s].lines},
                    CASE WHEN fault IN ('', 'truncated') THEN
                        {'cost': 1 + extra + v[CASE s WHEN 3 THEN 4 ELSE 3 END].cost, 'audit': 'R' || v[CASE s WHEN 3 THEN 4 ELSE 3 END].audit,
                         'lines': list_prepend(CASE s WHEN 3 THEN 'assistant:' ELSE 'user:' END || text, v[CASE s WHEN 3 THEN 4 ELSE 3 END].lines)} END,
                    CASE WHEN fault IN ('', 'truncated') AND ((c = 's' AND s = 1) OR (c = 'u' AND s <> 3) OR (c = 'a' AND s = 3)) THEN
                        {'cost': extra + v[CASE c WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].cost, 'audit': 'K' || v[CASE c WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].audit,
                         'lines': list_prepend(role || ':' || text, v[CASE c WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].lines)} END
                ], lambda x: x IS NOT NULL))[1]) AS base
                FROM ways w JOIN (SELECT *, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM marked) m
                  ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND w.i = m.i
            )
        ),
        best AS (SELECT conv_id, v[1] AS x FROM ways WHERE i = 0)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(x.cost, 0)::BIGINT AS cost,
               coalesce(x.audit, '') AS audit, sha256(coalesce(array_to_string(x.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN summed s ON o.conv_id IS NOT DISTINCT FROM s.conv_id LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
    """,
    "op13_radix_resampling": r"""
        WITH bytes AS (
            SELECT list_transform(range(0, 256), lambda b: list_reduce(
                range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)) AS tab
        ),
        cut AS (
            SELECT row_number() OVER () AS r, doc_id, TRUE AS own, text FROM documents
            UNION ALL SELECT -row_number() OVER (), NULL, FALSE, text FROM benchmark
        ),
        spoken AS (
            SELECT r, doc_id, own, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM cut
        ),
        found AS (
            SELECT r, own, unnest(w) AS feature FROM spoken
            UNION ALL SELECT r, own, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM spoken
        ),
        named AS (SELECT DISTINCT feature FROM found),
        hashed AS (
            SELECT feature, xor(list_reduce(
                list_transform(range(1, strlen(feature) + 1), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i - 1, 2))::BIGINT),
                lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
            FROM named, bytes
        ),
        placed AS (SELECT r, own, bucket FROM found JOIN hashed USING (feature)),
        counted AS (
            SELECT bucket, count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE NOT own) AS t FROM placed GROUP BY bucket
        ),
        gained AS (
            SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS gain
            FROM counted
        ),
        weighed AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM placed JOIN gained USING (bucket) WHERE own GROUP BY r),
        scored AS (
            SELECT p.r, p.doc_id, len(p.w) AS n_words, coalesce(n, 0) AS n_features,
                   coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
                   floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || p.doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS luck
            FROM spoken p LEFT JOIN weighed g ON p.r = g.r WHERE p.own
        ),
        ranked AS (
            SELECT *, weight + luck AS score, n_words >= 20 AND doc_id IS NOT NULL AS fit,
                   row_number() OVER (PARTITION BY n_words >= 20 AND doc_id IS NOT NULL ORDER BY weight + luck DESC, doc_id, n_features, weight) AS place,
                   count(*) FILTER (WHERE n_words >= 20 AND doc_id IS NOT NULL) OVER () AS fitting
            FROM scored
        )
        SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
               CASE WHEN fit AND place <= 25 * fitting // 100 THEN place END AS rank
        FROM ranked
    """,
}
