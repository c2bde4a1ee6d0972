"""The registered queries of this subpackage, opN_<name>, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, exact_dedup, jaccard, licenses, lm, mixing, packing, substring, vectors, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(_table(spark, sf_dir, "documents"), spans=False)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report: dict = {}
    out = vectors.near_vectors(_table(spark, sf_dir, "embeddings"), report=report)
    recall = 1.0 if report["exact"] else report["worst"]  # of the worst class of the vectors asked
    return out.withColumn("audited_recall", F.lit(float(recall)))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.lm_scores(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.round("score", 4).alias("score"), F.round("mean_score", 6).alias("mean_score"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").select("doc_id", classifier.graded().alias("grade"))
    return classifier.score(docs, classifier.train(docs, labels))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_embedding_near_dedup, op3_lm_scoring, op4_license_scan, op5_exact_dedup, op6_packing, op7_warc, op8_quality_classifier, op9_mixing, op10_jaccard_join,
    )
}


_REACH = """
        reach AS (SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
        classes AS (SELECT a, min(b) AS least_ FROM reach GROUP BY a),
        counts AS (SELECT a, count(*) AS n FROM linked GROUP BY a)"""

SQL = {
    "op1_substring_dedup": r"""
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
        again AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again),
        tokens AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM tokens ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
        cuts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id) LEFT JOIN cuts USING (doc_id)""",
    "op2_embedding_near_dedup": r"""
        WITH RECURSIVE good AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        linked AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
            WHERE list_cosine_similarity(x.v, y.v) >= 0.95),""" + _REACH + """
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least_, vec_id)) AS component_id, least(vec_id, coalesce(least_, vec_id)) = vec_id AS kept, 1.0::DOUBLE AS audited_recall
        FROM embeddings LEFT JOIN classes ON vec_id = classes.a LEFT JOIN counts ON vec_id = counts.a""",
    "op7_warc": r"""
        WITH payloads AS (SELECT page_id, coalesce(html, '') AS p, sha1(p) AS hex FROM pages),
        digests AS (
            SELECT *, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, (k // 4 * 5 + 1)::INT, 5))::INT >> (15 - k % 4 * 5)::INT) & 31) + 1, 1)), '') AS payload_digest, max(page_id) OVER (PARTITION BY p) AS last
            FROM payloads)
        SELECT page_id, strlen(p)::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to FROM digests""",
    "op10_jaccard_join": r"""
        WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
        linked AS (SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE c >= 0.8::DOUBLE * (p.n + q.n - c) - 1e-9),""" + _REACH + """
        SELECT doc_id, least(doc_id, coalesce(least_, doc_id)) AS class_id, coalesce(counts.n, 0)::BIGINT AS n_links, least(doc_id, coalesce(least_, doc_id)) = doc_id AS kept
        FROM documents LEFT JOIN classes ON doc_id = classes.a LEFT JOIN counts ON doc_id = counts.a""",
    "op3_lm_scoring": r"""
        WITH words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n_words FROM words),
        tokens AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
        placed AS (SELECT *, lag(word, 1) OVER w AS p1, lag(word, 2) OVER w AS p2 FROM tokens WINDOW w AS (PARTITION BY r ORDER BY i)),
        uni AS (SELECT word, count(*) AS c FROM tokens GROUP BY word),
        bi AS (SELECT p1, word, count(*) AS c FROM placed WHERE p1 IS NOT NULL GROUP BY p1, word),
        tri AS (SELECT p2, p1, word, count(*) AS c FROM placed WHERE p2 IS NOT NULL GROUP BY p2, p1, word),
        total AS (SELECT count(*) AS n FROM tokens),
        scored AS (
            SELECT p.r, CASE
                WHEN t.c >= 2 THEN ln(t.c / b0.c)
                WHEN b.c >= 2 THEN ln(b.c / u1.c) + CASE WHEN p.p2 IS NOT NULL THEN ln(0.4) ELSE 0 END
                ELSE ln(u.c / n) + ln(0.4) * ((p.p1 IS NOT NULL)::INT + (p.p2 IS NOT NULL)::INT) END AS s
            FROM placed p CROSS JOIN total JOIN uni u ON p.word = u.word LEFT JOIN uni u1 ON p.p1 = u1.word
            LEFT JOIN bi b ON p.p1 = b.p1 AND p.word = b.word LEFT JOIN bi b0 ON p.p2 = b0.p1 AND p.p1 = b0.word
            LEFT JOIN tri t ON p.p2 = t.p2 AND p.p1 = t.p1 AND p.word = t.word),
        sums AS (SELECT r, sum(s) AS score FROM scored GROUP BY r)
        SELECT doc_id, n_words, round(coalesce(score, 0.0), 4) AS score, round(score / nullif(n_words, 0), 6) AS mean_score FROM sizes LEFT JOIN sums USING (r)""",
    "op5_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op9_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5('7:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS place,
                   row_number() OVER (PARTITION BY source, doc_id, text) AS k,
                   CASE WHEN k = 1 THEN place ELSE md5(place || ':' || k) END AS u
            FROM documents),
        by_source AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
            FROM sized GROUP BY source),
        capped AS (
            SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
                   coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
                   sum(weight) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
            FROM by_source),
        level AS (SELECT arg_min((budget - clamped) / rest, clamped) AS lv FROM capped WHERE (budget - clamped) / rest * weight <= cap),
        targets AS (SELECT source, source_size, CASE WHEN lv IS NULL THEN cap ELSE least(cap, lv * weight) END AS target FROM capped, level),
        parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
        lefts AS (SELECT *, target - whole * source_size AS remaining FROM parts),
        ordered AS (
            SELECT s.doc_id, s.size, s.u, l.*, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u) AS upto
            FROM sized s JOIN lefts l ON s.source IS NOT DISTINCT FROM l.source),
        chosen AS (SELECT *, remaining > 0 AND upto <= remaining AS more FROM ordered),
        gaps0 AS (SELECT source, max(remaining) - coalesce(sum(size) FILTER (more), 0) AS gap, []::VARCHAR[] AS fills FROM chosen WHERE remaining > 0 GROUP BY source),
        FILL_ROUNDS
        SELECT c.doc_id, c.size, c.source_size, c.target, (c.size * (c.whole + CASE WHEN c.more OR coalesce(list_contains(g.fills, c.u), false) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM chosen c LEFT JOIN gapsLAST g ON c.source IS NOT DISTINCT FROM g.source""",
}

_ROUND = """
        best{k} AS (
            SELECT c.source, c.u, c.size FROM chosen c JOIN gaps{j} g ON c.source IS NOT DISTINCT FROM g.source
            WHERE NOT c.more AND NOT list_contains(g.fills, c.u) AND g.gap > 0 AND c.size > 0 AND {fits}
            QUALIFY row_number() OVER (PARTITION BY c.source ORDER BY abs(c.size - g.gap), c.u) = 1),
        gaps{k} AS (
            SELECT g.source, g.gap - coalesce(b.size, 0) AS gap, CASE WHEN b.u IS NULL THEN g.fills ELSE list_append(g.fills, b.u) END AS fills
            FROM gaps{j} g LEFT JOIN best{k} b ON g.source IS NOT DISTINCT FROM b.source)"""
_LAST = mixing.FILLS
_ROUNDS = ",".join(_ROUND.format(k=k, j=k - 1, fits="abs(c.size - g.gap) < g.gap" if k == _LAST else "c.size <= g.gap") for k in range(1, _LAST + 1))
SQL["op9_mixing"] = SQL["op9_mixing"].replace("FILL_ROUNDS", _ROUNDS.strip()).replace("gapsLAST", f"gaps{_LAST}")
