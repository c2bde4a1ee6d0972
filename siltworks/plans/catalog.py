"""The queries of the engine's own operators, by name, with their SQL.

Each query builds its tables with adapters.py and runs over all rows.  The SQL says the same in its own words where
it can (lists of path parts instead of patterns, window functions instead of two-level plans).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import content, extract, fixed, paths
from ..functions.regex import TRIM, engine
from ..operators import curate, discover, examples, exporting, report
from . import adapters as A
from .adapters import q

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BUDGET = 500_000
OPTIONS = {"min_stars": 50, "languages": ["TypeScript", "python"], "allowed": ["MIT", "Apache-2.0"], "require": True}
API_COLUMNS = ["full_name", "owner", "repo", "stars", "language", "license"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(x: str) -> str:
    """SQL: x without white space at both ends."""
    return f"regexp_replace({x}, {q(TRIM)}, '', 'g')"


def among(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def any_part(x: str, values: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(v)})" for v in values) + ")"


def any_end(x: str, values: list[str]) -> str:
    return "(" + " OR ".join(f"ends_with({x}, {q(v)})" for v in values) + ")"


def in_dirs(values: list[str]) -> str:
    """SQL: a directory of the path (not its last part) has one of the names."""
    return f"len(list_filter(parts[:-2], lambda x: x IN {among(values)})) > 0"


# ---- discovery ----


@query(f"""WITH {A.API_SQL}, s AS (
    SELECT 0 AS r, * FROM api WHERE src_pos % 3 = 0 UNION ALL SELECT 1, * FROM api WHERE src_pos % 2 = 0
    UNION ALL SELECT 2, * REPLACE (stars + 1 AS stars, CASE WHEN src_pos % 10 = 0 THEN upper(full_name) ELSE full_name END AS full_name) FROM api)
    SELECT full_name, owner, repo, stars, language, license, r::INT AS src_rank, src_pos FROM s QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY r, src_pos) = 1""")
def merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, c = (A.repos(spark, sf_dir, r).where(f"src_pos % {m} = 0") for r, m in ((0, 3), (1, 2), (2, 1)))
    c = c.withColumns({"stars": F.col("stars") + 1, "full_name": F.when(F.col("src_pos") % 10 == 0, F.upper("full_name")).otherwise(F.col("full_name"))})
    return discover.merge_candidates(a, b, c).select(*API_COLUMNS, "src_rank", "src_pos")


@query(f"WITH {A.API_SQL} SELECT full_name, owner, repo, stars, language, license, description, default_branch, url, 0 AS src_rank, src_pos FROM api")
def api_to_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.repos(spark, sf_dir)


@query(f"WITH {A.API_SQL} SELECT owner, full_name, stars FROM api WHERE NOT fork QUALIFY row_number() OVER (PARTITION BY owner ORDER BY stars DESC, full_name) <= 3")
def per_user_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = A.api(spark, sf_dir).select(F.col("owner.login").alias("owner"), "full_name", F.col("stargazers_count").alias("stars"), "fork")
    return discover.per_user(own, "owner", 3).select("owner", "full_name", "stars")


@query(f"WITH {A.API_SQL} SELECT full_name, stars FROM api ORDER BY stars DESC, full_name LIMIT 50")
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.search_page(A.repos(spark, sf_dir), 50).select("full_name", "stars")


@query(f"WITH {A.API_SQL} SELECT full_name, stars FROM api WHERE stars >= 50")
def stars_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.repos(spark, sf_dir).where(discover.stars_at_least(50)).select("full_name", "stars")


@query(f"WITH {A.API_SQL} SELECT full_name, language FROM api WHERE language IS NULL OR lower(language) IN ('typescript', 'python')")
def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.repos(spark, sf_dir).where(discover.language_allowed(["TypeScript", "python"])).select("full_name", "language")


@query(f"""WITH {A.API_SQL} SELECT full_name, license, coalesce(lower(license) IN ('mit', 'apache-2.0'), false) AS required,
    coalesce(lower(license) IN ('mit', 'apache-2.0'), true) AS optional, false AS none_required, true AS none_optional FROM api""")
def license_allow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lic, allow = F.col("license"), ["MIT", "Apache-2.0"]
    return A.repos(spark, sf_dir).select(
        "full_name", "license", discover.license_allowed(lic, allow, True).alias("required"), discover.license_allowed(lic, allow, False).alias("optional"),
        discover.license_allowed(lic, [], True).alias("none_required"), discover.license_allowed(lic, [], False).alias("none_optional"),
    )


def _license_text_sql(x: str) -> str:
    hits = lambda words: " + ".join(f"contains(lower({x}), {q(w)})::INT" for w in words)
    return "CASE " + " ".join(f"WHEN {hits(words)} >= 2 THEN {q(name)}" for name, words in fixed.LICENSE_KEYWORDS) + " END"


MORE_LICENSE = "Permission is hereby granted to use the software. Redistribution and use. 2-clause. GNU Lesser General Public License, version 3. ISC license."


@query(f"""WITH x AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || {q(MORE_LICENSE)} ELSE text END AS text FROM documents) SELECT doc_id, {_license_text_sql('text')} AS license FROM x""")
def license_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(MORE_LICENSE))).otherwise(F.col("text"))
    return A.table(spark, sf_dir, "documents").select("doc_id", content.license_of_text(text).alias("license"))


@query(f"""WITH {A.ORG}, api AS (SELECT full_name, 'ISC' AS api_license FROM org WHERE src_pos % 8 = 0),
    files AS (SELECT 'org/' || source AS full_name, doc_id % 4 AS file_rank, {_license_text_sql('text')} AS file_license FROM documents),
    told AS (SELECT full_name, arg_min(file_license, file_rank) AS file_license FROM (SELECT full_name, file_rank, min(file_license) AS file_license FROM files WHERE file_license IS NOT NULL GROUP BY ALL) GROUP BY full_name)
    SELECT full_name, coalesce(license, api_license, file_license) AS license FROM org LEFT JOIN api USING (full_name) LEFT JOIN told USING (full_name)""")
def license_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    repos = A.org_repos(spark, sf_dir)
    api = repos.where("src_pos % 8 = 0").select("full_name", F.lit("ISC").alias("api_license"))
    files = A.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("org/"), F.col("source")).alias("full_name"), (F.col("doc_id") % 4).alias("file_rank"), content.license_of_text(F.col("text")).alias("file_license")
    )
    files = files.where("file_license is not null").groupBy("full_name", "file_rank").agg(F.min("file_license").alias("file_license"))
    return discover.resolve_license(repos, api, files).select("full_name", "license")


@query(f"""WITH {A.API_SQL} SELECT full_name FROM api WHERE stars >= 50 AND (language IS NULL OR lower(language) IN ('typescript', 'python')) AND lower(license) IN ('mit', 'apache-2.0')""")
def eligible_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.eligible(A.repos(spark, sf_dir), **OPTIONS).select("full_name")


@query(f"WITH {A.API_SQL} SELECT full_name, stars FROM api WHERE full_name NOT IN (SELECT full_name FROM api WHERE src_pos % 4 = 1)")
def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    repos = A.repos(spark, sf_dir)
    return discover.not_completed(repos, repos.where("src_pos % 4 = 1").select("full_name")).select("full_name", "stars")


# ---- paths ----

_EXCLUDED = "len(list_filter(parts, lambda x: x IN ('node_modules', 'vendor', 'dist', 'build') OR x LIKE '%.min.js' OR x LIKE '%.lock')) > 0"


@query(f"WITH {A.FILES} SELECT doc_id, rel_path, {_EXCLUDED} AS excluded FROM paths")
def path_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.files(spark, sf_dir).select("doc_id", "rel_path", paths.path_excluded(F.col("rel_path"), fixed.DEFAULT_EXCLUDED_PATHS).alias("excluded"))


@query(f"WITH {A.FILES} SELECT doc_id, base, ext FROM paths")
def path_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("rel_path")
    return A.files(spark, sf_dir).select("doc_id", paths.basename(p).alias("base"), paths.extname(p).alias("ext"))


@query(f"WITH {A.FILES} SELECT doc_id, ext NOT IN {among(fixed.DEFAULT_EXCLUDED_EXTENSIONS)} AS allowed FROM paths")
def ext_denied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.files(spark, sf_dir).select("doc_id", paths.extension_allowed(F.col("rel_path"), fixed.DEFAULT_EXCLUDED_EXTENSIONS).alias("allowed"))


_MAP = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in fixed.EXTENSION_LANGUAGE.items()) + "}"


@query(f"""WITH {A.FILES} SELECT doc_id, coalesce({_MAP}[ext] IN ('typescript', 'cpp'), true) AS allowed, coalesce({_MAP}[ext] IN ('typescript', 'c++'), true) AS allowed_compat, true AS allowed_all FROM paths""")
def lang_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, langs = F.col("rel_path"), ["TypeScript", "C++"]
    return A.files(spark, sf_dir).select(
        "doc_id", paths.language_extension_allowed(p, langs).alias("allowed"), paths.language_extension_allowed(p, langs, compat=True).alias("allowed_compat"),
        paths.language_extension_allowed(p, None).alias("allowed_all"),
    )


@query(f"WITH {A.FILES} SELECT doc_id, size_bytes FROM files WHERE size_bytes <= 4096")
def size_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.files(spark, sf_dir).where(paths.size_allowed(F.col("size_bytes"), 4)).select("doc_id", "size_bytes")


def _reason_sql(debug: bool) -> str:
    dirs = lambda d: f"rel_path = {q(d)} OR starts_with(rel_path, {q(d + '/')}) OR contains(rel_path, {q('/' + d + '/')})"
    out = [f"WHEN {dirs(d)} THEN {q('path: ' + d)}" for d in fixed.REMOVED_DIRS]
    out += [f"WHEN ends_with(base, {q(n[1:])}) THEN {q('pattern: ' + n)}" if n.startswith("*.") else f"WHEN base = {q(n)} THEN {q('file: ' + n)}" for n in fixed.REMOVED_NAMES]
    out += [] if debug else [f"WHEN {dirs(d)} THEN {q('excluded path: ' + d)}" for d in fixed.TEST_DIRS]
    return f"CASE {' '.join(out)} END"


@query(f"WITH {A.FILES} SELECT doc_id, {_reason_sql(False)} AS reason, {_reason_sql(True)} AS debug_reason, {_reason_sql(False)} IS NOT NULL AS removed FROM paths")
def remove_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("rel_path")
    return A.files(spark, sf_dir).select("doc_id", paths.remove_reason(p).alias("reason"), paths.remove_reason(p, True).alias("debug_reason"), paths.removed(p).alias("removed"))


@query(f"WITH {A.FILES} SELECT doc_id, ext IN {among(fixed.KEPT_EXTENSIONS)} AS kept, ext IN {among(fixed.DOC_EXTENSIONS)} AS doc FROM paths")
def keep_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("rel_path")
    return A.files(spark, sf_dir).select("doc_id", paths.kept_extension(p).alias("kept"), paths.doc_extension(p).alias("doc"))


_GENERATED = f"({in_dirs(fixed.GENERATED_DIRS)} OR {any_end('rel_path', fixed.GENERATED_ENDINGS)})"
_TEST, _DOC = any_part("rel_path", fixed.TEST_PARTS), any_part("rel_path", fixed.DOC_PARTS)
_CODE_TEST = f"({any_part('rel_path', fixed.CODE_TEST_PARTS)} OR {any_end('rel_path', fixed.CODE_TEST_ENDINGS)})"
_CATEGORY = f"""CASE WHEN {_GENERATED} THEN 'generated' WHEN ext IN {among(fixed.CODE_EXTENSIONS)} THEN CASE WHEN {_TEST} THEN 'test' ELSE 'source' END
    WHEN ext IN {among(fixed.PROSE_EXTENSIONS)} THEN CASE WHEN {_DOC} THEN 'docs' WHEN {_TEST} THEN 'test' ELSE 'source' END
    WHEN ext IN {among(fixed.CONFIG_EXTENSIONS)} THEN 'config' WHEN ext IN {among(fixed.STYLE_EXTENSIONS)} THEN 'source' ELSE 'other' END"""


@query(f"WITH {A.FILES} SELECT doc_id, {_GENERATED} AS generated, {_TEST} AS test, {_DOC} AS doc, {_CODE_TEST} AS code_test FROM paths")
def path_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("rel_path")
    return A.files(spark, sf_dir).select("doc_id", paths.generated_path(p).alias("generated"), paths.test_path(p).alias("test"), paths.doc_path(p).alias("doc"), paths.code_test_path(p).alias("code_test"))


@query(f"""WITH u AS (SELECT page_id, regexp_replace(split_part(split_part(url, '?', 1), '#', 1), '^[a-z]+://', '') AS p FROM pages)
    SELECT page_id, lower(regexp_extract(list_extract(string_split(p, '/'), -1), '(?s)^.+(\\.[^.]*)$', 1)) AS ext, {any_part('p', fixed.DOC_PARTS)} AS doc, {any_part('p', fixed.TEST_PARTS)} AS test FROM u""")
def url_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.regexp_replace(F.split(F.split("url", r"\?")[0], "#")[0], "^[a-z]+://", "")
    return A.table(spark, sf_dir, "pages").select("page_id", paths.extname(p).alias("ext"), paths.doc_path(p).alias("doc"), paths.test_path(p).alias("test"))


@query("SELECT doc_id, replace('own__er__' || source, '__', '/') IS NOT NULL AS ok, 'own/er__' || source AS decoded, 'own__' || source AS encoded FROM documents")
def repo_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.concat(F.lit("own__er__"), F.col("source"))
    return A.table(spark, sf_dir, "documents").select("doc_id", d.isNotNull().alias("ok"), paths.decode_repo(d).alias("decoded"), paths.encode_repo(F.concat(F.lit("own/"), F.col("source"))).alias("encoded"))


# ---- contents ----


@query(f"SELECT doc_id FROM documents WHERE NOT regexp_matches(text, {q(content.SECRET)})")
def secret_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.secrets(A.files(spark, sf_dir)).select("doc_id")


@query(f"""WITH r AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: CASE WHEN regexp_matches(l, {q(content.SECRET)}) THEN '[REDACTED]' ELSE l END), chr(10)) AS text FROM documents)
    SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS size_bytes FROM r""")
def secret_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.hashed(curate.secrets(A.files(spark, sf_dir), "redact")).select("doc_id", "sha256", "size_bytes")


@query("""SELECT doc_id, coalesce((doc_id % 60 * 5)::DOUBLE / nullif(least(doc_id % 60 * 5 + CASE WHEN doc_id % 17 = 0 THEN 0 ELSE strlen(text) END, 8192), 0) > 0.3, false)
    OR (doc_id % 19 = 0 AND doc_id % 60 * 5 + CASE WHEN doc_id % 17 = 0 THEN 0 ELSE strlen(text) END < 8192) AS is_binary FROM documents""")
def binary_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts after some control bytes, every nineteenth with a NUL at its end."""
    d = F.col("doc_id")
    text = F.when(d % 17 == 0, F.lit("").cast("binary")).otherwise(F.col("text").cast("binary"))
    made = F.concat(F.repeat(F.lit("\x01"), (d % 60 * 5).cast("int")).cast("binary"), text, F.when(d % 19 == 0, F.lit(bytes(1))).otherwise(F.lit(b"")))
    return A.table(spark, sf_dir, "documents").select(d, content.is_binary(made).alias("is_binary"))


@query(f"""WITH x AS (SELECT doc_id, chr(160) || chr(10) || text || ' ' || chr(65279) AS s, text FROM documents)
    SELECT doc_id, {t('s')} AS trimmed, {t('s')} = '' AS blank, len(string_split(text, chr(10)))::INT AS lines, strlen(text)::INT AS bytes,
           CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS cut FROM x""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, x = F.concat(F.lit("\u00a0\n"), F.col("text"), F.lit(" \ufeff")), F.col("text")
    return A.table(spark, sf_dir, "documents").select(
        "doc_id", content.trim(s).alias("trimmed"), content.is_blank(s).alias("blank"), content.line_count(x).alias("lines"), F.octet_length(x).alias("bytes"),
        content.truncated(x, 100, "...").alias("cut"),
    )


@query("""SELECT doc_id, CASE WHEN n > 1073741824 THEN printf('%.2f GB', n / 1073741824.0::DOUBLE) WHEN n > 1048576 THEN printf('%.1f MB', n / 1048576.0::DOUBLE)
    WHEN n > 1024 THEN printf('%.0f KB', n / 1024.0::DOUBLE) ELSE n || ' B' END AS size, format('{:,}', n) AS count FROM (SELECT doc_id, doc_id * doc_id * 1001 + n_chars AS n FROM documents)""")
def number_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id") * F.col("doc_id") * 1001 + F.col("n_chars")
    return A.table(spark, sf_dir, "documents").select("doc_id", content.format_size(n).alias("size"), content.format_count(n).alias("count"))


# ---- curation ----

_HASHED = f"{A.FILES}, hashed AS (SELECT *, sha256(text) AS sha256, row_number() OVER (PARTITION BY sha256(text) ORDER BY repo_ord, rel_path, full_name) > 1 AS is_duplicate FROM files)"


@query(f"WITH {_HASHED} SELECT doc_id, sha256, is_duplicate FROM hashed")
def dedup_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.mark_duplicates(curate.hashed(A.files(spark, sf_dir))).select("doc_id", "sha256", "is_duplicate")


@query(f"WITH {_HASHED} SELECT count(DISTINCT sha256) AS unique_hashes, (count(*) - count(DISTINCT sha256))::BIGINT AS duplicates FROM hashed")
def dup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.hash_index_stats(curate.hashed(A.files(spark, sf_dir)))


_KEPT = f"""{_HASHED}, run AS (SELECT *, sum(size_bytes) OVER (ORDER BY repo_ord, rel_path, full_name ROWS UNBOUNDED PRECEDING) AS running_bytes FROM hashed WHERE NOT is_duplicate),
    kept AS (SELECT * FROM run WHERE running_bytes <= {BUDGET})"""


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.budget(curate.dedup(curate.hashed(A.files(spark, sf_dir))), BUDGET)


@query(f"WITH {_KEPT} SELECT doc_id, size_bytes FROM kept")
def budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).select("doc_id", "size_bytes")


@query(f"WITH {_KEPT} SELECT doc_id, running_bytes::BIGINT AS running_bytes FROM kept")
def budget_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.budget_window(curate.dedup(curate.hashed(A.files(spark, sf_dir))), BUDGET).select("doc_id", "running_bytes")


@query(f"WITH {_KEPT} SELECT sum(size_bytes)::BIGINT AS used_bytes, ({BUDGET} - sum(size_bytes))::BIGINT AS remaining_bytes, sum(size_bytes) * 100.0::DOUBLE / {BUDGET} AS used_percent FROM kept")
def budget_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.budget_stats(_kept(spark, sf_dir), BUDGET)


@query(f"""WITH {_KEPT}, {A.ORG} SELECT owner AS "repoOwner", repo AS "repoName", k.full_name AS "repoFullName", rel_path AS "filePath", size_bytes AS "sizeBytes", sha256, o.license, o.language, stars
    FROM kept k JOIN org o ON k.full_name = o.full_name""")
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.file_metadata(_kept(spark, sf_dir), A.org_repos(spark, sf_dir))


_MANIFEST = f"""{_KEPT}, {A.ORG}, manifest AS (SELECT o.full_name, o.stars, o.license, o.language, count(k.doc_id) AS file_count, coalesce(sum(k.size_bytes), 0)::BIGINT AS total_bytes
    FROM org o LEFT JOIN kept k ON k.full_name = o.full_name GROUP BY ALL)"""


@query(f"WITH {_MANIFEST} SELECT * FROM manifest")
def repo_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.repo_manifest(A.org_repos(spark, sf_dir), _kept(spark, sf_dir)).select("full_name", "stars", "license", "language", "file_count", "total_bytes")


@query(f"""WITH {_MANIFEST} SELECT 'set' AS name, count(*) AS total_repos, sum(file_count)::BIGINT AS total_files, sum(total_bytes)::BIGINT AS total_bytes,
    sum(total_bytes) / 1073741824.0::DOUBLE AS total_size_gb, (SELECT count(*) FROM hashed WHERE is_duplicate) AS duplicates_skipped FROM manifest""")
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = curate.mark_duplicates(curate.hashed(A.files(spark, sf_dir)))
    kept = curate.budget(marked.where(~F.col("is_duplicate")).drop("is_duplicate"), BUDGET)
    return curate.dataset_stats(curate.repo_manifest(A.org_repos(spark, sf_dir), kept), marked, "set")


@query(f"WITH {A.ORG} SELECT coalesce(nullif(license, ''), 'unknown') AS license, count(*) AS repos FROM org GROUP BY 1")
def license_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.breakdown(A.org_repos(spark, sf_dir), "license")


@query(f"WITH {A.ORG} SELECT coalesce(nullif(language, ''), 'unknown') AS language, count(*) AS repos FROM org GROUP BY 1")
def language_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.breakdown(A.org_repos(spark, sf_dir), "language")


# ---- reports ----


def _repo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.files(spark, sf_dir).withColumn("rel_path", F.concat(paths.encode_repo(F.col("full_name")), F.lit("/"), F.col("rel_path")))


_REPO_FILES = A.FILES.replace("replace(([", "'org__' || source || '/' || replace(([", 1)
_OUTCOME = f"""CASE WHEN len(list_filter(parts[2:-3], lambda x: x IN {among(fixed.REMOVED_DIRS + fixed.TEST_DIRS)})) > 0
        OR len(list_filter(parts[:-2], lambda x: {any_end('x', [n[1:] for n in fixed.REMOVED_NAMES if n[:2] == '*.'])})) > 0
        OR len(list_filter(parts[2:-2], lambda x: x IN {among([n for n in fixed.REMOVED_NAMES if n[:2] != '*.'])})) > 0 THEN 'generated'
    WHEN ext NOT IN {among(fixed.KEPT_EXTENSIONS)} THEN 'extension' WHEN {_reason_sql(False)} IS NOT NULL THEN 'generated'"""


@query(f"WITH {_REPO_FILES} SELECT doc_id, rel_path, {_OUTCOME} ELSE 'data' END AS outcome FROM paths")
def filter_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.filter_outcomes(_repo_files(spark, sf_dir)).select("doc_id", "rel_path", "outcome")


@query(f"WITH {_REPO_FILES}, o AS (SELECT size_bytes, {_OUTCOME} WHEN ext IN {among(fixed.DOC_EXTENSIONS)} THEN 'docs' ELSE 'code' END AS outcome FROM paths) SELECT outcome, count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM o GROUP BY 1")
def split_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.outcome_counts(report.filter_outcomes(_repo_files(spark, sf_dir), split_docs=True))


@query(f"WITH {_REPO_FILES}, o AS (SELECT {_OUTCOME} ELSE 'data' END AS outcome FROM paths) SELECT count(*) FILTER (outcome = 'data') AS kept, count(*) AS files, count(*) FILTER (outcome = 'data') * 100.0::DOUBLE / count(*) AS kept_percent FROM o")
def kept_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.kept_percent(report.filter_outcomes(_repo_files(spark, sf_dir)))


_EXT = f"{A.FILES}, exts AS (SELECT ext, count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM paths GROUP BY ext)"
_GROUP = "CASE " + " ".join(f"WHEN ext IN {among(v)} THEN {q(k)}" for k, v in fixed.LANGUAGE_GROUPS.items()) + " ELSE 'Other' END"


@query(f"WITH {_EXT} SELECT * FROM exts")
def ext_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by_extension(A.files(spark, sf_dir))


@query(f"WITH {_EXT} SELECT {_GROUP} AS lang_group, sum(files)::BIGINT AS files, sum(bytes)::BIGINT AS bytes FROM exts GROUP BY 1")
def lang_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by_language_group(report.by_extension(A.files(spark, sf_dir)))


@query(f"""WITH {A.FILES} SELECT count(*) FILTER (ext IN {among(fixed.TYPESCRIPT_EXTENSIONS)}) AS ts_files, coalesce(sum(size_bytes) FILTER (ext IN {among(fixed.TYPESCRIPT_EXTENSIONS)}), 0)::BIGINT AS ts_bytes,
    count(*) AS files, count(*) FILTER (ext IN {among(fixed.TYPESCRIPT_EXTENSIONS)}) * 100.0::DOUBLE / count(*) AS ts_percent FROM paths""")
def ts_subtotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.typescript_total(A.files(spark, sf_dir))


_CATEGORIES = f"{A.FILES}, cats AS (SELECT {_CATEGORY} AS category, count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM paths GROUP BY 1)"


@query(f"WITH {_CATEGORIES} SELECT * FROM cats")
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by_category(A.files(spark, sf_dir))


@query(f"""WITH {_CATEGORIES}, u AS (SELECT *, category IN ('source', 'config', 'test', 'docs') AS good FROM cats)
    SELECT sum(files) FILTER (good)::BIGINT AS useful_files, sum(bytes) FILTER (good)::BIGINT AS useful_bytes, coalesce(sum(files) FILTER (NOT good), 0)::BIGINT AS other_files,
           coalesce(sum(bytes) FILTER (NOT good), 0)::BIGINT AS other_bytes, sum(files) FILTER (good) * 100.0::DOUBLE / sum(files) AS useful_percent FROM u""")
def useful_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.useful(report.by_category(A.files(spark, sf_dir)))


@query(f"""WITH {_MANIFEST}, s AS (SELECT sum(file_count)::BIGINT AS total_files, (SELECT count(*) FROM hashed WHERE is_duplicate) AS duplicates_skipped FROM manifest)
    SELECT *, duplicates_skipped * 100.0::DOUBLE / (total_files + duplicates_skipped) AS duplicate_percent FROM s""")
def dup_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.duplicate_percent(dataset_stats(spark, sf_dir))


@query(f"WITH {_EXT} SELECT * FROM exts ORDER BY files DESC, ext LIMIT 20")
def top_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top(report.by_extension(A.files(spark, sf_dir)), "files", "ext", 20)


_REPOS = f"{A.FILES}, {A.ORG}, by_repo AS (SELECT f.full_name, count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM files f GROUP BY 1)"


@query(f"WITH {_REPOS} SELECT full_name, files, bytes FROM by_repo ORDER BY files DESC, full_name LIMIT 10")
def top_repos_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top(report.by_repo(A.files(spark, sf_dir)).drop("stars"), "files", "full_name", 10)


@query(f"WITH {_REPOS} SELECT full_name, files, bytes FROM by_repo ORDER BY bytes DESC, full_name LIMIT 10")
def top_repos_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top(report.by_repo(A.files(spark, sf_dir)).drop("stars"), "bytes", "full_name", 10)


@query(f"WITH {_REPOS} SELECT b.full_name, files, bytes, o.stars FROM by_repo b LEFT JOIN org o ON b.full_name = o.full_name AND o.src_pos % 2 = 0")
def repo_stars_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by_repo(A.files(spark, sf_dir), A.org_repos(spark, sf_dir).where("src_pos % 2 = 0"))


@query(f"WITH {_REPOS} SELECT greatest(count(*) - 10, 0) AS more FROM by_repo")
def more_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.more_than_top(report.by_repo(A.files(spark, sf_dir)), 10)


from . import catalog_examples  # noqa: E402, F401  registers its queries here


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents to chat records: size cap, secrets, dedup, budget, gate, summaries, ids, messages."""
    return QUERIES["flagship"](spark, sf_dir)
