"""From examples to training records, with their statistics and the dataset card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import content, fixed

EXAMPLE_SCHEMA = "id string, type string, repo string, file string, instruction string, input string, output string"
FORMATS = ("messages", "instruction")


def valid(examples: DataFrame) -> DataFrame:
    """With an instruction; ``has_output`` tells whether the output is more than white space."""
    return examples.where(F.coalesce(F.col("instruction") != "", F.lit(False))).withColumn("has_output", F.coalesce(~content.is_blank(F.col("output")), F.lit(False)))


def exportable(examples: DataFrame) -> DataFrame:
    return valid(examples).where("has_output").drop("has_output")


def _input() -> Column:
    return F.when(F.coalesce(~content.is_blank(F.col("input")), F.lit(False)), F.col("input"))


def to_instruction(examples: DataFrame) -> DataFrame:
    """instruction, output and, unless blank, input."""
    return examples.select("instruction", "output", _input().alias("input"))


def to_messages(examples: DataFrame) -> DataFrame:
    user = F.concat(F.col("instruction"), F.coalesce(F.concat(F.lit("\n\n"), _input()), F.lit("")))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return examples.select(F.array(turn("user", user), turn("assistant", F.col("output"))).alias("messages"))


def json_lines(records: DataFrame) -> DataFrame:
    """One JSON text per row, in the columns' order, without null keys."""
    return records.select(F.to_json(F.struct("*")).alias("value"))


def type_counts(examples: DataFrame) -> DataFrame:
    """Kept examples by type, and those without output as skipped_no_output."""
    kind = F.when(~F.col("has_output"), "skipped_no_output").otherwise(F.coalesce(F.nullif("type", F.lit("")), F.lit("unknown")))
    return valid(examples).groupBy(kind.alias("type")).agg(F.count(F.lit(1)).alias("examples"))


def infer_languages(types: DataFrame) -> DataFrame:
    """One row: the sorted languages of the types (column type); TypeScript where none is known."""
    table = F.create_map(*[x for k, v in fixed.TYPE_LANGUAGES.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    known = types.select(F.explode(F.try_element_at(table, F.col("type"))).alias("language"))
    out = known.agg(F.array_sort(F.collect_set("language")).alias("languages"))
    return out.select(F.when(F.size("languages") > 0, F.col("languages")).otherwise(F.array(F.lit("TypeScript"))).alias("languages"))


def source_repos(examples: DataFrame, processed: int | None = None) -> DataFrame:
    """The summary's count where there is one, else the different repositories of kept examples."""
    if processed is not None:
        return examples.sparkSession.range(1).select(F.lit(processed).cast("long").alias("source_repos"))
    return exportable(examples).agg(F.countDistinct(F.nullif("repo", F.lit(""))).alias("source_repos"))


def output_bytes(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("bytes"))


def metadata(name: str, total: int, form: str, languages: list[str], repos: int, license_: str | None, created: str) -> dict:
    return {
        "name": name, "description": f"Training dataset in {form} format. {total:,} examples across {', '.join(languages)}.", "examples": total, "format": form,
        "languages": languages, "sourceRepos": repos, "license": license_ or "other", "created": created.split("T")[0], "generatedBy": "siltworks", "version": "1.0.0",
    }


def card(meta: dict, counts: dict[str, int]) -> str:
    """The dataset card: front matter, properties, types by count (with their share of all kept), files."""
    tags = [*(x.lower() for x in meta["languages"]), "code", "siltworks", "chat" if meta["format"] == "messages" else "instruction"]
    form = "Chat messages (OpenAI-compatible)" if meta["format"] == "messages" else "Instruction/Input/Output"
    rows = [
        ("Examples", f"{meta['examples']:,}"), ("Format", form), ("Languages", ", ".join(meta["languages"]) or "Mixed"), ("Source Repos", meta["sourceRepos"]),
        ("License", meta["license"]), ("Created", meta["created"]), ("Generated by", f"{meta['generatedBy']} v{meta['version']}"),
    ]
    kinds = [(k, n) for k, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if k != "skipped_no_output"]
    share = lambda n: f"{100 * n / meta['examples']:.1f}%" if meta["examples"] else "-"
    return "\n".join([
        "---", f"license: {meta['license']}", "language:", "  - en", "tags:", *(f"    - {t}" for t in tags), "task_categories:", "  - text-generation", "---", "",
        f"# {meta['name']}", "", meta["description"], "", "## Dataset Overview", "", "| Property | Value |", "|----------|-------|", *(f"| {k} | {v} |" for k, v in rows), "",
        "## Example Types", "", "| Type | Examples | Share |", "|------|----------|-------|", *(f"| {k} | {n:,} | {share(n)} |" for k, n in kinds), "",
        "## Files", "", f"- `dataset.jsonl`: examples in {meta['format']} format", "- `metadata.json`: dataset metadata", "- `stats.json`: statistics", "",
    ])
