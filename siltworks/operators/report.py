"""Reports on a dataset and on a filter run: only paths and sizes are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import content, fixed, paths


def _sums():
    return F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes")


def by_extension(files: DataFrame) -> DataFrame:
    return files.groupBy(paths.extname(F.col("rel_path")).alias("ext")).agg(*_sums())


def by_language_group(extensions: DataFrame) -> DataFrame:
    """The second level over by_extension."""
    return extensions.groupBy(paths.language_group(F.col("ext")).alias("lang_group")).agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))


def typescript_total(files: DataFrame) -> DataFrame:
    ts = paths.extname(F.col("rel_path")).isin(fixed.TYPESCRIPT_EXTENSIONS)
    return files.agg(
        F.count_if(ts).alias("ts_files"), F.coalesce(F.sum(F.when(ts, F.col("size_bytes"))), F.lit(0)).alias("ts_bytes"), F.count(F.lit(1)).alias("files")
    ).withColumn("ts_percent", content.percent(F.col("ts_files"), F.col("files")))


def by_category(files: DataFrame) -> DataFrame:
    return files.groupBy(paths.category(F.col("rel_path")).alias("category")).agg(*_sums())


def useful(categories: DataFrame) -> DataFrame:
    good = F.col("category").isin("source", "config", "test", "docs")
    part = lambda c, x: F.coalesce(F.sum(F.when(c, F.col(x))), F.lit(0))
    out = categories.agg(part(good, "files").alias("useful_files"), part(good, "bytes").alias("useful_bytes"), part(~good, "files").alias("other_files"), part(~good, "bytes").alias("other_bytes"))
    return out.withColumn("useful_percent", content.percent(F.col("useful_files"), F.col("useful_files") + F.col("other_files")))


def duplicate_percent(stats: DataFrame) -> DataFrame:
    """Of total_files and duplicates_skipped."""
    return stats.select("total_files", "duplicates_skipped", content.percent(F.col("duplicates_skipped"), F.col("total_files") + F.col("duplicates_skipped")).alias("duplicate_percent"))


def by_repo(files: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Files and bytes of each repository, with the manifest's stars where it has them."""
    out = files.groupBy("full_name").agg(*_sums())
    if manifest is None:
        return out.withColumn("stars", F.lit(None).cast("long"))
    return out.join(manifest.select("full_name", "stars"), "full_name", "left")


def top(df: DataFrame, measure: str, name: str, k: int) -> DataFrame:
    """The k largest; ties by name.  Planned as a top-k, not as a sort."""
    return df.orderBy(F.desc(measure), name).limit(k)


def more_than_top(df: DataFrame, k: int) -> DataFrame:
    """How many rows a top-k leaves out."""
    return df.agg(F.greatest(F.count(F.lit(1)) - k, F.lit(0)).alias("more"))


def filter_outcomes(files: DataFrame, debug: bool = False, split_docs: bool = False) -> DataFrame:
    """files with outcome and reason.

    rel_path starts with the repository's directory.  A removed directory below the first level is pruned with all
    it holds (generated); then a foreign extension counts as extension, then a removal as generated.
    """
    path = F.col("rel_path")
    kept = F.when(paths.doc_extension(path), "docs").otherwise("code") if split_docs else F.lit("data")
    outcome = F.when(paths.pruned(path, debug), "generated").when(~paths.kept_extension(path), "extension").when(paths.removed(path, debug), "generated").otherwise(kept)
    return files.withColumn("outcome", outcome).withColumn("reason", paths.remove_reason(path, debug))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(*_sums())


def kept_percent(outcomes: DataFrame) -> DataFrame:
    kept = F.col("outcome").isin("data", "code", "docs")
    return outcomes.agg(F.count_if(kept).alias("kept"), F.count(F.lit(1)).alias("files")).withColumn("kept_percent", content.percent(F.col("kept"), F.col("files")))
