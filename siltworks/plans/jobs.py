"""The five commands as jobs over folders: run, inspect, filter, prepare, export."""

from __future__ import annotations

import datetime
import logging
import os
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import content, paths
from ..operators import curate, discover, examples, exporting, report
from ..sources import api, files, sinks
from ..streaming.incremental import Progress
from .config import Plan, dump_plan

LOG = logging.getLogger("siltworks")


def candidates(spark: SparkSession, plan: Plan, fixture: str | None = None, token: str | None = None) -> DataFrame:
    """Records of the plan's sources, merged; a fixture folder stands for the network.

    Each source is asked on its own and its records are held; one that fails is logged and the others go on.  If all
    fail, so does the job.
    """
    api.register(spark)
    d = plan.discovery
    if d is None:
        raise ValueError("the plan has no discovery")
    base = {k: v for k, v in {"fixture": fixture, "token": token}.items() if v} | {"concurrency": plan.concurrency}
    load = lambda **o: spark.read.format("code_repositories").options(**base, **o).load()
    asks: list[tuple[str, DataFrame]] = []
    if d.search:
        found = discover.to_records(load(kind="search", query=d.search.query, limit=d.search.limit), 0)
        asks.append(("search", discover.search_page(found, d.search.limit)))
    if d.users:
        own = load(kind="users", names=",".join(d.users), limit=d.per_user_limit).withColumn("stars", F.col("stargazers_count"))
        asks.append(("users", discover.to_records(discover.per_user(own, "asked", d.per_user_limit), 1)))
    if d.explicit_repos:
        asks.append(("explicitRepos", discover.to_records(load(kind="repos", names=",".join(d.explicit_repos)), 2)))
    if not asks:
        raise ValueError("the plan's discovery names no source")
    parts, failed = [], []
    for name, ask in asks:
        try:
            # answers are few (at most 2000 a search or user) and must not be asked for twice
            parts.append(spark.createDataFrame(ask.collect(), ask.schema))
        except PySparkException as e:
            failed.append(name)
            LOG.warning("discovery by %s failed: %s", name, str(e).split("\n")[0])
    if not parts:
        raise RuntimeError(f"discovery failed: {', '.join(failed)}")
    return discover.merge_candidates(*parts)


def files_of_archives(spark: SparkSession, source: str | DataFrame, repos: DataFrame) -> DataFrame:
    """files of archives named owner__repo.<ending> (a glob, or rows of path and content), for the given repositories, in
    their order."""
    name = F.regexp_replace(F.element_at(F.split("archive", "/"), -1), r"\.(tar\.gz|tgz|zip)$", "")
    order = repos.select("full_name", (F.col("src_rank") * (1 << 40) + F.col("src_pos")).alias("repo_ord"))
    own = files.archives(spark, source) if isinstance(source, str) else files.members(source.where("content is not null"))
    return own.withColumn("full_name", paths.decode_repo(name)).drop("archive").join(order, "full_name")


def fetched(spark: SparkSession, repos: DataFrame, folder: str) -> DataFrame:
    """The repositories' archives, fetched once into a table in folder; failures stay there as rows with an error."""
    api.fetch_archives(repos).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def with_licenses(spark: SparkSession, repos: DataFrame, source: DataFrame, fixture: str | None = None, token: str | None = None) -> DataFrame:
    """repos whose missing licences are asked of the licence API, then read from their licence files."""
    missing = [r.full_name for r in repos.where("license is null").select("full_name").toLocalIterator()]
    api.register(spark)
    options = {k: v for k, v in {"fixture": fixture, "token": token, "names": ",".join(missing), "kind": "licenses"}.items() if v}
    told = spark.read.format("code_repositories").options(**options).load().select("full_name", F.col("license.spdx_id").alias("api_license"))
    return discover.resolve_license(repos, told, discover.license_files(files.with_text(source)))


def run(spark: SparkSession, plan: Plan, repos: DataFrame, source: DataFrame, target: str, resume: bool = False, package: bool = False) -> dict:
    """Curate source (files of repos) into target: data/<owner>__<repo>/..., metadata.jsonl, manifest.json, stats.json,
    plan.me, which the other commands read.

    What is kept is a table first (_kept); the tree is written from it.  With ``resume`` the repositories that an
    earlier run into target completed are not curated again: their files stay, count for the budget and are known to
    the dedup.  With ``package`` target.zip is made of the tree and the side files.
    """
    chosen = discover.eligible(repos, plan.min_stars, plan.languages, plan.licenses.allow, plan.licenses.require_detected)
    progress = Progress(spark, f"{target}/_progress")
    earlier = spark.read.parquet(f"{target}/_kept") if resume and files.entries(spark, f"{target}/_kept") else None
    left = discover.not_completed(chosen, progress.completed()) if earlier is not None else chosen
    own = files.with_text(source.join(left.select("full_name"), "full_name", "left_semi"))
    own = own.where(curate.file_predicates(plan.exclude.paths, plan.exclude.extensions, plan.languages, plan.exclude.max_file_size_kb) & ~content.is_binary(F.col("content")))
    own = curate.hashed(curate.secrets(own, plan.secret_scan.action) if plan.secret_scan.enabled else own)
    if earlier is not None and plan.dedupe:
        known = earlier.select("sha256").distinct().withColumn("_known", F.lit(True))
        own = own.join(known, "sha256", "left")
    else:
        own = own.withColumn("_known", F.lit(None).cast("boolean"))
    marked = curate.mark_duplicates(own) if plan.dedupe else own.withColumn("is_duplicate", F.lit(False))
    marked = marked.withColumn("is_duplicate", F.col("is_duplicate") | F.coalesce("_known", F.lit(False))).drop("_known")
    marked.drop("content").write.mode("overwrite").parquet(f"{target}/_marked")
    marked = spark.read.parquet(f"{target}/_marked")
    spent = earlier.agg(F.coalesce(F.sum("size_bytes"), F.lit(0))).first()[0] if earlier is not None else 0
    fresh = curate.budget(marked.where(~F.col("is_duplicate")).drop("is_duplicate"), int(plan.max_size_gb * (1 << 30)) - spent)
    sinks.write_dataset(earlier.unionByName(fresh) if earlier is not None else fresh, f"{target}/_kept_new")
    files.move(spark, f"{target}/_kept_new", f"{target}/_kept")
    kept = spark.read.parquet(f"{target}/_kept")
    sinks.write_tree(kept, f"{target}/data")
    manifest = curate.repo_manifest(chosen, kept)
    done = manifest.select("full_name", F.col("file_count").alias("files"), F.col("total_bytes").alias("bytes"))
    progress.mark(done, 0)  # the whole state, so a run replaces that of the one before
    sinks.write_jsonl(curate.file_metadata(kept, chosen), f"{target}/metadata.jsonl")
    sinks.write_json(sinks.manifest_rows(manifest), f"{target}/manifest.json")
    stats = curate.dataset_stats(manifest, marked, plan.name).first().asDict()
    for column in ("license", "language"):
        stats[f"{column}_breakdown"] = {r[0]: r[1] for r in curate.breakdown(chosen, column).collect()}
    sinks.write_json(stats, f"{target}/stats.json")
    with open(f"{target}/plan.me", "w", encoding="utf-8") as f:
        f.write(dump_plan(plan))
    if package:
        sinks.build_zip(target, f"{os.path.abspath(target)}.zip")
    return stats


def _side(root: str, name: str) -> str:
    """A side file of a dataset folder or package."""
    return f"{root}!{name}" if files.is_zip(root) else f"{root.rstrip('/')}/{name}"


def inspect(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The reports on a dataset folder; contents are not read."""
    own = files.tree(spark, files.find_data_dir(spark, root), content=False)
    manifest = files.read_json_file(spark, _side(root, "manifest.json"))
    ext = report.by_extension(own)
    repos = report.by_repo(own, manifest)
    cats = report.by_category(own)
    return {
        "extensions": report.top(ext, "files", "ext", 20), "languages": report.by_language_group(ext).orderBy(F.desc("files"), "lang_group"), "typescript": report.typescript_total(own),
        "categories": cats, "useful": report.useful(cats), "repos_by_files": report.top(repos, "files", "full_name", 10), "repos_by_bytes": report.top(repos, "bytes", "full_name", 10),
    }


def filter_dataset(spark: SparkSession, root: str, target: str, debug: bool = False, split_docs: bool = False, passthrough: bool = False) -> DataFrame:
    """Copy what stays to target/data, or target/code and target/docs; the counts by outcome.  root is a dataset folder
    or package; folders that an earlier run left in target are removed.

    passthrough also copies the side files as they are, which then tell of files that were removed.
    """
    base = files.find_data_dir(spark, root)
    outcomes = report.filter_outcomes(files.tree(spark, base), debug, split_docs)
    parts = ("code", "docs") if split_docs else ("data",)
    for part in {"code", "docs", "data"} - set(parts):
        files.remove(spark, f"{target}/{part}")
    for part in parts:
        inner = outcomes.where(F.col("outcome") == part).withColumn("rel_path", F.regexp_replace("rel_path", "^[^/]+/", ""))
        sinks.write_tree(inner, f"{target}/{part}")
    for name in ("manifest.json", "stats.json", "metadata.jsonl", "plan.me") if passthrough else ():
        if files.is_zip(root):
            files.unpack(spark, root, name, f"{target}/{name}")
        else:
            files.copy(spark, f"{root.rstrip('/')}/{name}", f"{target}/{name}")
    return report.outcome_counts(outcomes)


def prepare(spark: SparkSession, root: str, target: str, mode: str = "all", max_kb: int = 50, most: int | None = None) -> dict:
    """Examples of a filtered dataset to target/training.jsonl and examples.jsonl, with a summary."""
    code_dir, docs_dir, _ = files.find_layout(spark, root)
    tree = lambda p: files.with_text(files.tree(spark, p)).withColumn("repo_ord", F.col("full_name"))
    gated = examples.code_gate(tree(code_dir), max_kb * 1024)
    parts = [examples.code_examples(gated.drop("processed", "eligible"), mode, max_kb * 1024)]
    if docs_dir and mode in ("explain", "all"):
        parts.append(examples.doc_examples(tree(docs_dir), max_kb * 1024))
    every = reduce(examples.all_examples, parts)
    made = examples.with_ids(examples.limited(every, most) if most else every).orderBy("seq").drop("seq")
    sinks.write_jsonl(made, f"{target}/training.jsonl")
    done = spark.read.schema(exporting.EXAMPLE_SCHEMA).json(f"{target}/training.jsonl")
    sinks.write_jsonl(done, f"{target}/examples.jsonl")
    counts = {r["type"]: r["examples"] for r in examples.by_type(done).collect()}
    c = examples.prepare_counters(gated).first()
    summary = {
        "totalExamples": sum(counts.values()), "totalFilesProcessed": c["files_processed"], "totalFilesSkipped": c["files_skipped"], "reposProcessed": c["repos_processed"],
        "mode": mode, "examplesByType": counts, "generatedAt": datetime.datetime.now(datetime.UTC).isoformat(),
    }
    sinks.write_json(summary, f"{target}/examples_summary.json")
    return summary


def export(spark: SparkSession, source: str, target: str, form: str = "messages", name: str = "dataset", license_: str | None = None) -> dict:
    """Examples to target/dataset.jsonl with stats.json, metadata.json and README.md."""
    if form not in exporting.FORMATS:
        raise ValueError(f"format must be one of {', '.join(exporting.FORMATS)}")
    every = files.read_examples(spark, source)
    kept = exporting.exportable(every)
    lines = exporting.json_lines(exporting.to_messages(kept) if form == "messages" else exporting.to_instruction(kept))
    lines.write.mode("overwrite").text(f"{target}/dataset.jsonl")
    size = exporting.output_bytes(spark.read.text(f"{target}/dataset.jsonl")).first()
    counts = {r["type"]: r["examples"] for r in exporting.type_counts(every).collect()}
    summary = files.read_json_file(spark, f"{source.rstrip('/')}/examples_summary.json", "reposProcessed long, generatedAt string")
    told = summary.first() if summary is not None else None
    repos = exporting.source_repos(every, told["reposProcessed"] if told else None).first()[0]
    languages = exporting.infer_languages(spark.createDataFrame([(k,) for k in counts] or [("",)], "type string")).first()[0]
    stats = {"totalExamples": size["examples"], "totalSizeBytes": size["bytes"], "format": form, "examplesByType": counts, "sourceRepos": repos, "languages": languages}
    created = (told["generatedAt"] if told else None) or datetime.datetime.now(datetime.UTC).isoformat()
    meta = exporting.metadata(name, size["examples"], form, languages, repos, license_, created)
    sinks.write_json(stats, f"{target}/stats.json")
    sinks.write_json(meta, f"{target}/metadata.json")
    with open(f"{target}/README.md", "w", encoding="utf-8") as f:
        f.write(exporting.card(meta, counts))
    return stats
