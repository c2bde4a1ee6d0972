"""The queries of extraction, generation and export, added to catalog.py's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import content, extract, fixed, paths
from ..functions.regex import engine
from ..operators import curate, examples, exporting
from . import adapters as A
from .adapters import q
from .catalog import _CODE_TEST, among, query, t

_DOC_BOUND = 50 * 1024


def _all(pattern: str, group: int = 0, x: str = "text") -> str:
    return f"regexp_extract_all({x}, {q(engine(pattern))}, {group})"


def _first(pattern: str, x: str, group: int) -> str:
    return f"regexp_extract({x}, {q(engine(pattern))}, {group})"


# ---- extraction ----

_FUNCTIONS = f"""found AS (SELECT *, unnest({_all(fixed.FUNCTION)}) AS m, generate_subscripts({_all(fixed.FUNCTION)}, 1) AS pos FROM code),
    split_ AS (SELECT *, {t("substr(m, 1, instr(m, '*/') + 1)")} AS doc, {t("substr(m, instr(m, '*/') + 2)")} AS rest FROM found),
    fns AS (SELECT *, {t("CASE WHEN instr(rest, '{') > 1 THEN substr(rest, 1, instr(rest, '{') - 1) ELSE rest END")} || ' {{ ... }}' AS signature FROM split_)""".replace("{{", "{").replace("}}", "}")


@query(f"WITH {A.CODE_SQL}, {_FUNCTIONS} SELECT doc_id, doc, signature FROM fns")
def fn_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.code(spark, sf_dir).select("doc_id", F.inline(extract.functions(F.col("text"))))


_LINES = f"list_filter(list_transform(string_split_regex({t('body')}, '[;,\\n]'), lambda l: {t('l')}), lambda l: l <> '' AND NOT starts_with(l, '//') AND NOT starts_with(l, '/*') AND NOT starts_with(l, '[') AND regexp_matches(l, {q(engine(fixed.PROPERTY))}))"
_PROPS = f"list_transform({_LINES}, lambda l: {_first(fixed.PROPERTY, 'l', 1)} || {_first(fixed.PROPERTY, 'l', 2)} || ': ' || {_first(fixed.PROPERTY, 'l', 3)})"
_TYPES = f"""raw AS (SELECT *, unnest({_all(fixed.TYPE)}) AS m, unnest({_all(fixed.TYPE, 1)}) AS name, unnest({_all(fixed.TYPE, 2)}) AS ext_, unnest({_all(fixed.TYPE, 3)}) AS body, generate_subscripts({_all(fixed.TYPE)}, 1) AS pos FROM code),
    shaped AS (SELECT *, {t('m')} AS definition, {_PROPS} AS props FROM raw),
    types AS (SELECT *, 'The `' || name || '` ' || CASE WHEN starts_with(definition, 'export interface') OR starts_with(definition, 'interface') THEN 'interface' ELSE 'type alias' END || ' defines '
        || CASE len(props) WHEN 0 THEN 'no properties' WHEN 1 THEN '1 property' ELSE len(props) || ' properties' END || '.'
        || CASE WHEN len(props) BETWEEN 1 AND 8 THEN ' Properties: ' || array_to_string(props, ', ') || '.' ELSE '' END
        || CASE WHEN {t('ext_')} <> '' THEN ' The `' || name || '` extends `' || {t('ext_')} || '`.' ELSE '' END AS description FROM shaped)"""


@query(f"WITH {A.CODE_SQL}, {_TYPES} SELECT doc_id, name, definition, description FROM types")
def type_defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.code(spark, sf_dir).select("doc_id", F.inline(extract.types(F.col("text"))))


def _marked_sql(x: str) -> str:
    """SQL: each line break after chr(2), or after chr(3) where a context ends (before a blank line, a comment, the end).

    The pattern looks ahead to such an end, which DuckDB's engine cannot; with the mark an end can be consumed instead.
    Two passes, because each consumes the break after the one that it marks.
    """
    end = q("\x02\n([\x02\x03]|//|\\z)")
    once = lambda y: f"regexp_replace({y}, {end}, chr(3) || chr(10) || '\\1', 'g')"
    return once(once(f"replace({x}, chr(10), chr(2) || chr(10))"))


_WS = engine(r"[\s\x02\x03]")
_DIRECTIVE = rf"//{_WS}*@ts-(?:expect-error|ignore)(?:{_WS}+([^\n\r\x{{2028}}\x{{2029}}\x02\x03]+?))?[\x02\x03]\n((?s:.)*?)\x03"
_UNMARKED = "replace(replace({}, chr(2), ''), chr(3), '')"
_CONTEXTS = f"""marked AS (SELECT *, {_marked_sql('text')} AS marked_text FROM FROM_TABLE),
    raw_errors AS (SELECT *, unnest(regexp_extract_all(marked_text, {q(_DIRECTIVE)}, 1)) AS said, unnest(regexp_extract_all(marked_text, {q(_DIRECTIVE)}, 2)) AS rest,
        generate_subscripts(regexp_extract_all(marked_text, {q(_DIRECTIVE)}, 1), 1) AS pos FROM marked),
    told_errors AS (SELECT *, CASE WHEN said = '' THEN {q(fixed.DEFAULT_ERROR)} ELSE {t('said')} END AS message, {t(_UNMARKED.format('rest'))} AS context FROM raw_errors),
    errors AS (SELECT * FROM told_errors WHERE length(context) BETWEEN 21 AND 1999)"""


@query(f"WITH {A.CODE_SQL}, {_CONTEXTS.replace('FROM_TABLE', 'code')} SELECT doc_id, message, context FROM errors")
def error_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.code(spark, sf_dir).select("doc_id", F.inline(extract.error_contexts(F.col("text"))))


_BLOCKS = f"list_transform(list_filter({_all(fixed.TEST_BLOCK)}, lambda m: length(m) < 3000), lambda m: {t('m')})"
_TITLE = f"CASE WHEN regexp_matches(block, {q(engine(fixed.TEST_TITLE))}) THEN {t(_first(fixed.TEST_TITLE, 'block', 1))} ELSE {q(fixed.DEFAULT_TITLE)} END"


@query(f"WITH {A.CODE_SQL}, b AS (SELECT doc_id, unnest({_BLOCKS}) AS block FROM code) SELECT doc_id, block, {_TITLE} AS title FROM b")
def test_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.code(spark, sf_dir).select("doc_id", F.explode(extract.test_blocks(F.col("text"))).alias("block"))
    return out.select("doc_id", "block", extract.test_title(F.col("block")).alias("title"))


_PATTERNS = f"list_transform(list_filter({_all(fixed.ERROR_PATTERN)}, lambda m: length(m) < 2000), lambda m: {t('m')})"


@query(f"WITH {A.CODE_SQL} SELECT doc_id, unnest({_PATTERNS}) AS pattern FROM code")
def error_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.code(spark, sf_dir).select("doc_id", F.explode(extract.error_patterns(F.col("text"))).alias("pattern"))


def _handling_sql(p: str) -> str:
    a, b, c = (q(x) for x in fixed.TRY_TYPED)
    var, kind, error = _first(fixed.CAUGHT, p, 1), _first(fixed.CAUGHT, p, 2), _first(fixed.THROWN, p, 1)
    who = f"CASE WHEN {kind} <> '' THEN {a} || {kind} || {b} || {var} || {c} WHEN {var} <> '' THEN {q(fixed.TRY_ALL[0])} || {var} || {q(fixed.TRY_ALL[1])} ELSE {q(fixed.TRY_BARE)} END"
    tried = f"CASE WHEN contains({p}, 'try') AND contains({p}, 'catch') THEN {q(fixed.TRY_START)} || {who} || {q(fixed.TRY_END)} ELSE '' END"
    what = f"CASE WHEN {error} <> '' THEN {q(fixed.THROW_TYPED[0])} || {error} || {q(fixed.THROW_TYPED[1])} ELSE {q(fixed.THROW_BARE)} END"
    return f"coalesce(nullif({tried} || CASE WHEN contains({p}, 'throw') THEN {what} || {q(fixed.THROW_END)} ELSE '' END, ''), {q(fixed.NO_HANDLING)})"


@query(f"""WITH {A.CODE_SQL}, p AS (SELECT doc_id, unnest({_PATTERNS}) AS pattern FROM code UNION ALL SELECT doc_id, text FROM documents)
    SELECT doc_id, sha256(pattern) AS pattern_sha, {_handling_sql('pattern')} AS description FROM p""")
def error_handling_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = error_patterns(spark, sf_dir).unionByName(A.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("pattern")))
    return own.select("doc_id", F.sha2("pattern", 256).alias("pattern_sha"), extract.describe_handling(F.col("pattern")).alias("description"))


_MESSAGES = ["Type 'a' is not assignable to 'b'.", "Property 'x' does not exist on type 'Y'", "module has no exported member", "Object is possibly 'undefined'.", "something else", "value is possibly undefined"]


def _error_sql() -> str:
    first = f"coalesce(list_filter(list_transform(string_split(context, chr(10)), lambda l: {t('l')}), lambda l: l <> '')[1], '')"

    def case(x: tuple[str, ...]) -> str:
        return f"{q(x[0])} || CASE WHEN {first} <> '' THEN {q(x[1])} || {first} || {q(x[2])} ELSE '' END || {q(x[3])}"

    low = "lower(message)"
    return f"""{q(fixed.ERROR_START[0])} || message || {q(fixed.ERROR_START[1])} || CASE WHEN contains({low}, 'assignable') THEN {case(fixed.ERROR_ASSIGN)}
        WHEN contains({low}, 'property') AND contains({low}, 'not exist') OR contains({low}, 'has no') THEN {case(fixed.ERROR_PROPERTY)}
        WHEN contains({low}, 'possibly ''undefined''') OR contains({low}, 'possibly undefined') THEN {case(fixed.ERROR_UNDEFINED)} ELSE {q(fixed.ERROR_GENERAL)} END"""


@query(f"WITH e AS (SELECT doc_id, {A._pick_sql(_MESSAGES, 'doc_id')} AS message, CASE WHEN doc_id % 4 = 0 THEN chr(10) || ' ' ELSE text END AS context FROM documents) SELECT doc_id, {_error_sql()} AS description FROM e")
def error_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    context = F.when(d % 4 == 0, "\n ").otherwise(F.col("text"))
    return A.table(spark, sf_dir, "documents").select("doc_id", extract.describe_error(A._pick(_MESSAGES, d), context).alias("description"))


def _count(pattern: str) -> str:
    return f"len({_all(pattern)})"


_COUNTS = {"import": fixed.IMPORTS, "export": fixed.EXPORTS, "function": fixed.FUNCTIONS, "class": fixed.CLASSES}


@query(f"WITH {A.CODE_SQL} SELECT doc_id, {', '.join(f'{_count(p)}::INT AS n_{k}' for k, p in _COUNTS.items())} FROM code")
def code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.code(spark, sf_dir).select("doc_id", *(c.alias(f"n_{k}") for k, c in extract.code_counts(F.col("text")).items()))


def _file_sql() -> str:
    told = [f"CASE WHEN {_count(p)} > 0 THEN {_count(p)} || ' {k}' || CASE WHEN {_count(p)} <> 1 THEN '{'es' if k == 'class' else 's'}' ELSE '' END END" for k, p in _COUNTS.items()]
    some = f"concat_ws(', ', {', '.join(told)})"
    return f"""'This ' || CASE WHEN ext IN ('.ts', '.tsx') THEN 'TypeScript' ELSE 'JavaScript' END || ' file (' || len(string_split(text, chr(10))) || ' lines) '
        || CASE WHEN {some} <> '' THEN 'contains ' || {some} || '.' ELSE {q(fixed.NO_COUNTS)} END"""


_ELIGIBLE = f"eligible AS (SELECT * FROM code WHERE size_bytes <= {_DOC_BOUND} AND ext IN {among(fixed.CODE_EXTENSIONS)} AND length(text) >= 30)"
_CUT = f"CASE WHEN length(text) > {fixed.FILE_CUT} THEN substr(text, 1, {fixed.FILE_CUT}) || {q(fixed.FILE_MARK)} ELSE text END"


@query(f"WITH {A.CODE_SQL}, {_ELIGIBLE} SELECT full_name, rel_path, {_CUT} AS input, {_file_sql()} AS output FROM eligible QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY repo_ord, rel_path) = 1")
def file_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = examples.code_examples(A.code(spark, sf_dir), "all").where("type = 'file_context'")
    return out.select("full_name", "rel_path", "input", "output")


_SENTENCE = t(f"replace({_first(fixed.PARAGRAPH, 'text', 0)}, chr(10), ' ')")
_LONG = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {t('l')}), lambda l: length(l) > 10)"
_SUMMARY = f"""CASE WHEN regexp_matches(text, {q(engine(fixed.HEADING))}) THEN {q(fixed.HEADING_TEXT[0])} || {t(_first(fixed.HEADING, 'text', 1))} || {q(fixed.HEADING_TEXT[1])}
    WHEN length({_SENTENCE}) > 20 AND length({_SENTENCE}) < 300 THEN 'Summary: ' || {_SENTENCE} WHEN len({_LONG}) > 0 THEN 'This document describes: ' || {_LONG}[1] ELSE {q(fixed.NO_SUMMARY)} END"""
_DOC_CUT = f"CASE WHEN length(text) > {fixed.DOC_CUT} THEN substr(text, 1, {fixed.DOC_CUT}) || {q(fixed.DOC_MARK)} ELSE text END"
_DOC_GATE = f"size_bytes <= {_DOC_BOUND} AND length(text) >= 50"


@query(f"WITH {A.DOCS} SELECT full_name, rel_path, {_DOC_CUT} AS input, {_SUMMARY} AS output FROM docs WHERE {_DOC_GATE}")
def doc_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.doc_examples(A.docs(spark, sf_dir)).select("full_name", "rel_path", "input", "output")


@query(f"WITH {A.DOCS} SELECT doc_id FROM docs WHERE {_DOC_GATE}")
def doc_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.doc_gate(A.docs(spark, sf_dir)).select("doc_id")


@query(f"""WITH {A.CODE_SQL}, p AS (SELECT *, size_bytes <= 8192 AND ext IN {among(fixed.CODE_EXTENSIONS)} AS processed FROM code)
    SELECT count(*) FILTER (processed) AS files_processed, count(*) FILTER (NOT (processed AND length(text) >= 30)) AS files_skipped, count(DISTINCT full_name) AS repos_processed FROM p""")
def prepare_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.prepare_counters(examples.code_gate(A.code(spark, sf_dir), 8192))


# ---- generation ----

_CLEAN = t(rf"regexp_replace(regexp_replace(doc, '^/\*\*|\*/\z', '', 'g'), {q(engine(r'(?m)^\s*\*\s?'))}, '', 'g')")
_EXPLAIN = f"""{_ELIGIBLE},
    {_FUNCTIONS.replace('FROM code', 'FROM eligible')}, {_TYPES.replace('FROM code', 'FROM eligible')},
    explained AS (SELECT 0 AS phase, full_name, repo_ord, rel_path, 1 AS gen_rank, pos, 'function_explain' AS type, {_CLEAN} || chr(10) || chr(10) || signature AS input, {_CLEAN} AS output FROM fns
        UNION ALL SELECT 0, full_name, repo_ord, rel_path, 2, pos, 'type_definition', definition, description FROM types WHERE pos <= 5)"""
_DOC_ROWS = f"SELECT 1 AS phase, full_name, repo_ord, rel_path, 0 AS gen_rank, 0 AS pos, 'doc_context' AS type, {_DOC_CUT} AS input, {_SUMMARY} AS output FROM docs WHERE {_DOC_GATE}"
_UNION = f"{A.CODE_SQL}, {A.DOCS}, {_EXPLAIN}, every AS (SELECT * FROM explained UNION ALL {_DOC_ROWS}), numbered AS (SELECT *, row_number() OVER (ORDER BY phase, repo_ord, rel_path, full_name, gen_rank, pos) AS seq FROM every)"


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.all_examples(examples.code_examples(A.code(spark, sf_dir), "explain"), examples.doc_examples(A.docs(spark, sf_dir)))


@query(f"WITH {_UNION} SELECT type, full_name, rel_path, input, output FROM every")
def examples_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(spark, sf_dir).select("type", "full_name", "rel_path", "input", "output")


def _map_sql(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in table.items()) + "}[type]"


@query(f"WITH {_UNION} SELECT printf('%s-%05d', {_map_sql(fixed.ID_PREFIXES)}, seq) AS id, type, full_name AS repo, rel_path AS file, {_map_sql(fixed.INSTRUCTIONS)} AS instruction, input, output FROM numbered")
def example_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.with_ids(_union(spark, sf_dir)).drop("seq")


@query(f"WITH {_UNION} SELECT seq, type, rel_path FROM numbered WHERE seq <= 700")
def max_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.limited(_union(spark, sf_dir), 700).select("seq", "type", "rel_path")


@query(f"WITH {_UNION}, c AS (SELECT count(*) FILTER (phase = 0) AS n FROM every) SELECT seq, type, rel_path FROM numbered, c WHERE CASE WHEN phase = 0 THEN seq <= 700 ELSE n < 700 END")
def max_examples_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.limited(_union(spark, sf_dir), 700, strict=False).select("seq", "type", "rel_path")


@query(f"WITH {_UNION} SELECT type, count(*) AS examples FROM every GROUP BY type")
def examples_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.by_type(_union(spark, sf_dir))


_DEBUG = f"""{_CONTEXTS.replace('FROM_TABLE', 'eligible')}, tests AS (SELECT full_name, repo_ord, rel_path, unnest(({_BLOCKS})[:5]) AS block, generate_subscripts(({_BLOCKS})[:5], 1) AS pos FROM eligible WHERE {_CODE_TEST} AND (contains(text, 'describe') OR contains(text, 'it(') OR contains(text, 'test('))),
    handled AS (SELECT full_name, repo_ord, rel_path, unnest(({_PATTERNS})[:3]) AS pattern, generate_subscripts(({_PATTERNS})[:3], 1) AS pos FROM eligible WHERE contains(text, 'catch') OR contains(text, 'throw'))"""


_DEBUGGED = f"""SELECT full_name, repo_ord, rel_path, 3 AS gen_rank, pos, 'error_context' AS type, context AS input, {_error_sql()} AS output FROM errors
    UNION ALL SELECT full_name, repo_ord, rel_path, 4, pos, 'test_assertion', block, {q(fixed.TEST_TEXT[0])} || {_TITLE} || {q(fixed.TEST_TEXT[1])} FROM tests
    UNION ALL SELECT full_name, repo_ord, rel_path, 5, pos, 'error_handling', pattern, {_handling_sql('pattern')} FROM handled"""


@query(f"WITH {A.CODE_SQL}, {_ELIGIBLE}, {_DEBUG}, made AS ({_DEBUGGED}) SELECT full_name, rel_path, type, input, output FROM made")
def debug_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.code_examples(A.code(spark, sf_dir), "debug").select("full_name", "rel_path", "type", "input", "output")


@query(f"""WITH {A.CODE_SQL}, {_EXPLAIN}, {_DEBUG},
    every AS (SELECT full_name, repo_ord, rel_path, gen_rank, pos, type, input, output FROM explained UNION ALL {_DEBUGGED}
        UNION ALL SELECT full_name, repo_ord, rel_path, 6, 0, 'file_context', {_CUT}, {_file_sql()} FROM (SELECT * FROM eligible QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY repo_ord, rel_path) = 1)),
    numbered AS (SELECT *, row_number() OVER (ORDER BY repo_ord, rel_path, full_name, gen_rank, pos) AS seq FROM every)
    SELECT printf('%s-%05d', {_map_sql(fixed.ID_PREFIXES)}, seq) AS id, type, full_name AS repo, rel_path AS file, {_map_sql(fixed.INSTRUCTIONS)} AS instruction, input, output FROM numbered""")
def all_code_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.with_ids(examples.code_examples(A.code(spark, sf_dir), "all")).drop("seq")


# ---- export ----

_OK = f"{A.EXAMPLES}, valid AS (SELECT *, {t('output')} <> '' AS has_output, CASE WHEN {t('input')} <> '' THEN input END AS real_input FROM examples WHERE instruction <> '')"


@query(f"WITH {_OK} SELECT id, has_output FROM valid")
def export_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exporting.valid(A.examples(spark, sf_dir)).select("id", "has_output")


@query(f"WITH {_OK} SELECT instruction, output, real_input AS input FROM valid WHERE has_output")
def to_instruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exporting.to_instruction(exporting.exportable(A.examples(spark, sf_dir)))


@query(f"WITH {_OK} SELECT instruction || coalesce(chr(10) || chr(10) || real_input, '') AS user_text, output AS assistant_text FROM valid WHERE has_output")
def to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exporting.to_messages(exporting.exportable(A.examples(spark, sf_dir)))
    return out.select(F.col("messages")[0]["content"].alias("user_text"), F.col("messages")[1]["content"].alias("assistant_text"))


@query(f"WITH {_OK} SELECT CASE WHEN NOT has_output THEN 'skipped_no_output' ELSE coalesce(nullif(type, ''), 'unknown') END AS type, count(*) AS examples FROM valid GROUP BY 1")
def export_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exporting.type_counts(A.examples(spark, sf_dir))


_LANGS = " UNION ALL ".join(f"SELECT {q(k)} AS type, {q(v)} AS language" for k, vs in fixed.TYPE_LANGUAGES.items() for v in vs)


@query(f"WITH {A.EXAMPLES}, l AS ({_LANGS}) SELECT array_to_string(list_sort(list(DISTINCT language)), ',') AS languages FROM examples JOIN l USING (type)")
def infer_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exporting.infer_languages(A.examples(spark, sf_dir).select("type").distinct()).select(F.array_join("languages", ",").alias("languages"))


@query(f"WITH {_OK} SELECT count(DISTINCT repo) AS source_repos FROM valid WHERE has_output")
def source_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exporting.source_repos(A.examples(spark, sf_dir))


@query(f"""WITH {_OK}, j AS (SELECT CASE WHEN real_input IS NULL THEN to_json({{'instruction': instruction, 'output': output}}) ELSE to_json({{'instruction': instruction, 'output': output, 'input': real_input}}) END AS l FROM valid WHERE has_output)
    SELECT count(*) AS examples, sum(strlen(l::VARCHAR) + 1)::BIGINT AS bytes FROM j""")
def export_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exporting.output_bytes(exporting.json_lines(exporting.to_instruction(exporting.exportable(A.examples(spark, sf_dir)))))


# ---- the flagship ----

_SECRET_FREE = f"SELECT *, sha256(text) AS sha256 FROM files WHERE size_bytes <= 512000 AND NOT regexp_matches(text, {q(content.SECRET)})"


@query(f"""WITH {A.FILES}, safe AS ({_SECRET_FREE}), once AS (SELECT * FROM safe QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY repo_ord, rel_path, full_name) = 1),
    run AS (SELECT *, sum(size_bytes) OVER (ORDER BY repo_ord, rel_path, full_name ROWS UNBOUNDED PRECEDING) AS r FROM once),
    gated AS (SELECT * FROM run WHERE r <= 1000000 AND {_DOC_GATE}),
    made AS (SELECT row_number() OVER (ORDER BY repo_ord, rel_path, full_name) AS seq, full_name, rel_path, {_DOC_CUT} AS input, {_SUMMARY} AS output FROM gated)
    SELECT printf('doc-%05d', seq) AS id, 'doc_context' AS type, full_name AS repo, rel_path AS file, {q(fixed.INSTRUCTIONS['doc_context'])} || chr(10) || chr(10) || input AS user_text, output AS assistant_text FROM made""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = A.files(spark, sf_dir).where(paths.size_allowed(F.col("size_bytes"), 500))
    kept = curate.budget(curate.dedup(curate.hashed(curate.secrets(files))), 1_000_000)
    made = examples.with_ids(examples.doc_examples(kept))
    user = F.concat("instruction", F.lit("\n\n"), "input")
    return made.select("id", "type", "repo", "file", user.alias("user_text"), F.col("output").alias("assistant_text"))
