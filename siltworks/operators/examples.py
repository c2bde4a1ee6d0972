"""Training examples from code and documentation files.

files: full_name, repo_ord, rel_path, text, size_bytes.  Examples keep the place they come from (repo_ord, rel_path,
gen_rank, match_pos) until they have an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import content, extract, fixed, paths

PLACE = ["phase", "repo_ord", "rel_path", "full_name", "gen_rank", "match_pos"]
MODES = ("explain", "debug", "all")
KINDS = ["function_explain", "type_definition", "error_context", "test_assertion", "error_handling", "file_context"]


def code_gate(files: DataFrame, max_bytes: int = 50 * 1024) -> DataFrame:
    """files with ``processed`` (right size and extension) and ``eligible`` (long enough as well)."""
    processed = (F.col("size_bytes") <= max_bytes) & paths.extname(F.col("rel_path")).isin(fixed.CODE_EXTENSIONS)
    return files.withColumn("processed", processed).withColumn("eligible", processed & (F.length("text") >= 30))


def prepare_counters(gated: DataFrame) -> DataFrame:
    """A file that is too short counts as processed and as skipped."""
    return gated.agg(F.count_if("processed").alias("files_processed"), F.count_if(~F.col("eligible")).alias("files_skipped"), F.countDistinct("full_name").alias("repos_processed"))


def doc_gate(files: DataFrame, max_bytes: int = 50 * 1024) -> DataFrame:
    return files.where((F.col("size_bytes") <= max_bytes) & (F.length("text") >= 50))


def _example(kind: str, input_: Column, output: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), input_.alias("input"), output.alias("output"))


def _if(test: Column, array: Column) -> Column:
    return F.when(test, array).otherwise(F.array().cast("array<struct<type:string,input:string,output:string>>"))


def explain(code: Column) -> Column:
    """Of all documented functions and of the first five types."""

    def function(f: Column) -> Column:
        doc = content.clean_doc(f["doc"])
        return _example("function_explain", F.concat(doc, F.lit("\n\n"), f["signature"]), doc)

    found = F.transform(extract.functions(code), function)
    types = F.transform(F.slice(extract.types(code), 1, 5), lambda t: _example("type_definition", t["definition"], t["description"]))
    return F.concat(_if(code.contains("/**"), found), types)


def debug(code: Column, path: Column) -> Column:
    """Of all suppressed type errors, of five test blocks of test files, of three error patterns."""
    errors = F.transform(extract.error_contexts(code), lambda e: _example("error_context", e["context"], extract.describe_error(e["message"], e["context"])))
    a, b = fixed.TEST_TEXT
    tests = F.transform(F.slice(extract.test_blocks(code), 1, 5), lambda t: _example("test_assertion", t, F.concat(F.lit(a), extract.test_title(t), F.lit(b))))
    handled = F.transform(F.slice(extract.error_patterns(code), 1, 3), lambda p: _example("error_handling", p, extract.describe_handling(p)))
    return F.concat(
        _if(code.contains("@ts-expect-error") | code.contains("@ts-ignore"), errors),
        _if(paths.code_test_path(path) & (code.contains("describe") | code.contains("it(") | code.contains("test(")), tests),
        _if(code.contains("catch") | code.contains("throw"), handled),
    )


def file_context(code: Column, path: Column) -> Column:
    return F.array(_example("file_context", content.truncated(code, fixed.FILE_CUT, fixed.FILE_MARK), extract.describe_file(code, paths.extname(path))))


def code_examples(files: DataFrame, mode: str = "all", max_bytes: int = 50 * 1024) -> DataFrame:
    """One row per example of the eligible code files; in mode all also one of each repository's first eligible file."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    code, path = F.col("text"), F.col("rel_path")
    own = code_gate(files, max_bytes).where("eligible")
    parts = {"explain": [explain(code)], "debug": [debug(code, path)], "all": [explain(code), debug(code, path)]}[mode]
    if mode == "all":
        place = lambda c: F.struct("full_name", c("repo_ord"), c("rel_path"))
        first = own.groupBy("full_name").agg(F.min(F.struct("repo_ord", "rel_path")).alias("_least"))
        first = first.select(place(lambda c: F.col("_least")[c].alias(c)).alias("_at"), F.lit(True).alias("_is_first"))
        own = own.withColumn("_at", place(F.col)).join(first, "_at", "left")
        again = F.row_number().over(Window.partitionBy("_at").orderBy("text"))  # of two files at one place the first
        own = own.withColumn("_first", F.col("_is_first").isNotNull() & (again == 1))
        parts.append(_if(F.col("_first"), file_context(code, path)))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("ex.type"))
    return own.select("full_name", "repo_ord", "rel_path", F.posexplode(F.concat(*parts)).alias("match_pos", "ex")).select(
        F.lit(0).alias("phase"), "full_name", "repo_ord", "rel_path", rank.cast("int").alias("gen_rank"), "match_pos", "ex.type", "ex.input", "ex.output"
    )


def doc_examples(files: DataFrame, max_bytes: int = 50 * 1024) -> DataFrame:
    text = F.col("text")
    return doc_gate(files, max_bytes).select(
        F.lit(1).alias("phase"), "full_name", "repo_ord", "rel_path", F.lit(0).alias("gen_rank"), F.lit(0).alias("match_pos"), F.lit("doc_context").alias("type"),
        content.truncated(text, fixed.DOC_CUT, fixed.DOC_MARK).alias("input"), extract.doc_summary(text).alias("output"),
    )


def all_examples(code: DataFrame, docs: DataFrame) -> DataFrame:
    """Code first, then documentation."""
    return code.unionByName(docs)


def numbered(examples: DataFrame) -> DataFrame:
    """examples with ``seq``, from 1 in canonical order, in three levels.

    Repositories are summed up in one task (a row each), files within their repository (a row each, without texts), and
    only the examples of one file are put in order as they are.  Null places come first; equal places (two files at
    one place) are in the order of their texts.  Structs are keys because they compare nulls as equal.
    """
    file = F.struct(*PLACE[:4])
    by_file = examples.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    by_file = by_file.withColumn("_repo", F.struct(*[F.col("_file")[c].alias(c) for c in PLACE[:2]]))
    by_repo = by_file.groupBy("_repo").agg(F.sum("_n").alias("_all"))
    upto = lambda n, w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = by_repo.select("_repo", upto("_all", Window.orderBy("_repo")).alias("_before"))
    starts = by_file.withColumn("_inner", upto("_n", Window.partitionBy("_repo").orderBy("_file"))).join(starts, "_repo")
    starts = starts.select("_file", (F.col("_inner") + F.col("_before")).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_file").orderBy("gen_rank", "match_pos", "type", "input", "output"))
    out = examples.withColumn("_file", file).join(starts, "_file").withColumn("_own", own)
    return out.withColumn("seq", F.col("_own") + F.col("_start")).drop("_own", "_start", "_file")


def with_ids(examples: DataFrame) -> DataFrame:
    """The seven columns of a training example; ids count over all types, with at least five digits."""
    kinds = lambda table: F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col("type"))
    numbered_ = examples if "seq" in examples.columns else numbered(examples)
    return numbered_.select(
        F.format_string("%s-%05d", kinds(fixed.ID_PREFIXES), "seq").alias("id"), "type", F.col("full_name").alias("repo"), F.col("rel_path").alias("file"),
        kinds(fixed.INSTRUCTIONS).alias("instruction"), "input", "output", "seq",
    )


def limited(examples: DataFrame, most: int, strict: bool = True) -> DataFrame:
    """The first ``most`` examples.  Not strict: documentation is without limit unless code alone reaches it."""
    n = numbered(examples)
    if strict:
        return n.where(F.col("seq") <= most)
    code = n.agg(F.count_if(F.col("phase") == 0).alias("_code"))
    return n.crossJoin(F.broadcast(code)).where(F.when(F.col("phase") == 0, F.col("seq") <= most).otherwise(F.col("_code") < most)).drop("_code")


def by_type(examples: DataFrame) -> DataFrame:
    return examples.groupBy(F.coalesce(F.nullif("type", F.lit("")), F.lit("unknown")).alias("type")).agg(F.count(F.lit(1)).alias("examples"))
