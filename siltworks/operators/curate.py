"""From files to the kept dataset: predicates, dedup, size budget, metadata and totals.

files: full_name, repo_ord, rel_path, text (or content) and size_bytes; (repo_ord, rel_path) is the order that says
which copy is first and where the budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import content, paths

ORDER = ["repo_ord", "rel_path"]


def file_predicates(excluded_paths: list[str], excluded_extensions: list[str], languages: list[str] | None, max_kb: int) -> Column:
    """The cheap predicates, in the order in which they are to be tried."""
    path = F.col("rel_path")
    return (
        ~paths.path_excluded(path, excluded_paths)
        & paths.extension_allowed(path, excluded_extensions)
        & paths.language_extension_allowed(path, languages)
        & paths.size_allowed(F.col("size_bytes"), max_kb)
    )


def secrets(files: DataFrame, action: str = "drop") -> DataFrame:
    """Without files that hold a secret, or with their lines redacted (and the size taken anew)."""
    if action == "drop":
        return files.where(~F.coalesce(content.has_secret(F.col("text")), F.lit(False)))
    return files.withColumn("text", content.redact_secrets(F.col("text"))).withColumn("size_bytes", F.octet_length("text").cast("long"))


def hashed(files: DataFrame) -> DataFrame:
    return files.withColumn("sha256", F.sha2(F.col("text").cast("binary"), 256))


def mark_duplicates(files: DataFrame) -> DataFrame:
    """files (with sha256) and is_duplicate: not the first of its hash.

    A hash's first place is aggregated before the shuffle and files are joined by hash and place, so a content that
    is everywhere is no hot key.  A null repo_ord is before all others; files without text are of one (null) hash.  Of
    files that share hash and place one is the first.  Structs are keys because they compare nulls as equal.
    """
    place = F.struct("repo_ord", "rel_path", "full_name")
    firsts = files.groupBy("sha256").agg(F.min(place).alias("_first")).select(F.struct("sha256", "_first.*").alias("_at"), F.lit(True).alias("_is_first"))
    marked = files.withColumn("_at", F.struct("sha256", "repo_ord", "rel_path", "full_name")).join(firsts, "_at", "left")
    again = F.row_number().over(Window.partitionBy("_at").orderBy("size_bytes")) > 1
    return marked.withColumn("is_duplicate", F.col("_is_first").isNull() | again).drop("_at", "_is_first")


def dedup(files: DataFrame) -> DataFrame:
    return mark_duplicates(files).where(~F.col("is_duplicate")).drop("is_duplicate")


def budget_window(files: DataFrame, max_bytes: int) -> DataFrame:
    """The longest prefix within max_bytes, by one global window: for tables of some million rows at most."""
    run = F.sum("size_bytes").over(Window.orderBy(*ORDER, "full_name").rowsBetween(Window.unboundedPreceding, 0))
    return files.withColumn("running_bytes", run).where(F.col("running_bytes") <= max_bytes)


def budget(files: DataFrame, max_bytes: int) -> DataFrame:
    """The same prefix in two levels; files themselves are only filtered, not moved.

    The global window sees one row a repository and finds the one in which the budget ends.  The files of that one
    alone, without their texts, are put in order to find the last that fits.  Both ends are single rows that are
    broadcast; what lies before them stays.
    """
    place, order = F.struct("rel_path", "full_name"), F.coalesce("repo_ord", F.lit(-(2**63)))
    by_repo = files.groupBy(order.alias("_ord")).agg(F.sum("size_bytes").alias("_bytes"))
    upto = by_repo.withColumn("_upto", F.sum("_bytes").over(Window.orderBy("_ord").rowsBetween(Window.unboundedPreceding, 0)))
    over = F.when(F.col("_upto") > max_bytes, F.struct("_ord", (F.col("_upto") - F.col("_bytes")).alias("before")))
    edge = upto.agg(F.min(over).alias("_edge"))
    inside = files.select(order.alias("_ord"), place.alias("_place"), "size_bytes").join(F.broadcast(edge), F.col("_ord") == F.col("_edge._ord"))
    run = F.sum("size_bytes").over(Window.partitionBy("_ord").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("_run", run + F.col("_edge.before")).where(F.col("_run") <= max_bytes).agg(F.max("_place").alias("_last"))
    ends = edge.crossJoin(F.broadcast(last))
    keep = F.col("_edge").isNull() | (order < F.col("_edge._ord")) | ((order == F.col("_edge._ord")) & (place <= F.col("_last")))
    return files.crossJoin(F.broadcast(ends)).where(keep).select(*files.columns)


def file_metadata(files: DataFrame, repos: DataFrame) -> DataFrame:
    """One row per kept file, with its repository's attributes."""
    r = repos.select("full_name", F.col("owner").alias("repoOwner"), F.col("repo").alias("repoName"), "license", "language", "stars")
    return files.select("full_name", F.col("rel_path").alias("filePath"), F.col("size_bytes").alias("sizeBytes"), "sha256").join(r, "full_name").select(
        "repoOwner", "repoName", F.col("full_name").alias("repoFullName"), "filePath", "sizeBytes", "sha256", "license", "language", "stars"
    )


def repo_manifest(repos: DataFrame, files: DataFrame) -> DataFrame:
    """Every repository with its kept files' number and bytes, those without any too."""
    sums = files.groupBy("full_name").agg(F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("total_bytes"))
    return repos.join(sums, "full_name", "left").fillna(0, ["file_count", "total_bytes"])


def breakdown(repos: DataFrame, column: str) -> DataFrame:
    """Repositories by licence or language; null and empty are unknown."""
    return repos.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("unknown")).alias(column)).agg(F.count(F.lit(1)).alias("repos"))


def breakdown_map(counts: DataFrame, column: str) -> DataFrame:
    """A breakdown as one row with a map."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "repos")))).alias(f"{column}_breakdown"))


def dataset_stats(manifest: DataFrame, marked: DataFrame, name: str) -> DataFrame:
    """Totals: one row."""
    m = manifest.agg(F.count(F.lit(1)).alias("total_repos"), F.coalesce(F.sum("file_count"), F.lit(0)).alias("total_files"), F.coalesce(F.sum("total_bytes"), F.lit(0)).alias("total_bytes"))
    d = marked.agg(F.coalesce(F.count_if("is_duplicate"), F.lit(0)).alias("duplicates_skipped"))
    return m.crossJoin(F.broadcast(d)).select(
        F.lit(name).alias("name"), "total_repos", "total_files", "total_bytes", (F.col("total_bytes") / F.lit(float(1 << 30))).alias("total_size_gb"), "duplicates_skipped"
    )


def hash_index_stats(files: DataFrame) -> DataFrame:
    """unique and duplicates of a hashed table: one row."""
    return files.groupBy("sha256").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("unique_hashes"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def budget_stats(kept: DataFrame, max_bytes: int) -> DataFrame:
    used = F.coalesce(F.sum("size_bytes"), F.lit(0))
    return kept.agg(used.alias("used_bytes")).select("used_bytes", F.greatest(F.lit(0), F.lit(max_bytes) - F.col("used_bytes")).alias("remaining_bytes"), (F.col("used_bytes") * 100.0 / max_bytes).alias("used_percent"))


def curate(files: DataFrame, plan) -> DataFrame:
    """The whole chain for a plan: predicates, binary sniff, secrets, dedup, budget."""
    out = files.where(file_predicates(plan.exclude.paths, plan.exclude.extensions, plan.languages, plan.exclude.max_file_size_kb))
    if "content" in files.columns:
        out = out.where(~content.is_binary(F.col("content")))
    if plan.secret_scan.enabled:
        out = secrets(out, plan.secret_scan.action)
    out = hashed(out)
    if plan.dedupe:
        out = dedup(out)
    return budget(out, int(plan.max_size_gb * (1 << 30)))
