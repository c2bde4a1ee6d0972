"""Candidate repositories: from API records to one filtered table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import content, fixed

API_SCHEMA = (
    "full_name string, name string, owner struct<login:string>, stargazers_count long, language string, license struct<spdx_id:string>, "
    "description string, default_branch string, html_url string, fork boolean"
)


def to_records(api: DataFrame, src_rank: int, position: Column | None = None) -> DataFrame:
    """API objects as repository records, with the place that later decides which source wins."""
    return api.select(
        F.col("owner.login").alias("owner"), F.col("name").alias("repo"), "full_name", F.col("stargazers_count").alias("stars"), "language",
        F.col("license.spdx_id").alias("license"), "description", "default_branch", F.col("html_url").alias("url"), F.lit(src_rank).alias("src_rank"),
        (position if position is not None else F.col("src_pos")).cast("long").alias("src_pos"),
    )


def per_user(repos: DataFrame, user: str, limit: int) -> DataFrame:
    """The most starred repositories of each user that are no forks."""
    rank = F.row_number().over(Window.partitionBy(user).orderBy(F.desc("stars"), "full_name"))
    return repos.where(~F.coalesce(F.col("fork"), F.lit(False))).withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def search_page(repos: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of a search, most starred first."""
    return repos.orderBy(F.desc("stars"), "full_name").limit(limit)


def merge_candidates(*sources: DataFrame) -> DataFrame:
    """Union in the sources' order; of equal names (case counts) the first row stays, whole."""
    every = reduce(DataFrame.unionByName, sources)
    first = F.row_number().over(Window.partitionBy("full_name").orderBy("src_rank", "src_pos"))
    return every.withColumn("_first", first).where("_first = 1").drop("_first")


def stars_at_least(least: int) -> Column:
    return F.col("stars") >= least if least > 0 else F.lit(True)


def language_allowed(languages: list[str] | None) -> Column:
    """Unknown languages pass, and all without a list."""
    return F.lit(True) if not languages else F.col("language").isNull() | F.lower("language").isin([x.lower() for x in languages])


def license_allowed(license_: Column, allowed: list[str], require: bool) -> Column:
    if not require and not allowed:
        return F.lit(True)
    return F.when(license_.isNull(), F.lit(not require)).otherwise(F.lower(license_).isin([x.lower() for x in allowed]) if allowed else F.lit(False))


def resolve_license(repos: DataFrame, api: DataFrame, files: DataFrame) -> DataFrame:
    """license: the record's, else the licence API's (full_name, api_license), else that of the first licence file
    (full_name, file_rank, file_license) whose text tells one."""
    told = files.where("file_license is not null").groupBy("full_name").agg(F.min_by("file_license", "file_rank").alias("file_license"))
    out = repos.join(api, "full_name", "left").join(told, "full_name", "left")
    return out.withColumn("license", F.coalesce("license", "api_license", "file_license")).drop("api_license", "file_license")


def license_files(files: DataFrame) -> DataFrame:
    """What the licence files (rel_path within the repository, text) say: full_name, file_rank, file_license."""
    rank = F.array_position(F.array(*[F.lit(x) for x in fixed.LICENSE_FILES]), F.col("rel_path"))
    return files.where(F.col("rel_path").isin(fixed.LICENSE_FILES)).select("full_name", rank.alias("file_rank"), content.license_of_text(F.col("text")).alias("file_license"))


def eligible(repos: DataFrame, min_stars: int = 0, languages: list[str] | None = None, allowed: list[str] | None = None, require: bool = True) -> DataFrame:
    return repos.where(stars_at_least(min_stars) & language_allowed(languages) & license_allowed(F.col("license"), allowed or [], require))


def not_completed(repos: DataFrame, ledger: DataFrame) -> DataFrame:
    """Repositories that the ledger (full_name) does not have yet."""
    return repos.join(ledger.select("full_name").distinct(), "full_name", "left_anti")
