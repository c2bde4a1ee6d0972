"""The engine's tables (files, code, repos, examples) made from the supplied ones, in Spark and in SQL.

The supplied texts hold no code and have no paths; both are put together from templates by doc_id, the same way in
both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import discover

PATHS = [
    "src/mod{d}.ts", "src/view{d}.tsx", "lib/util{d}.js", "dist/out{d}.js", "node_modules/pkg/index{d}.js", "src/__tests__/case{d}.test.ts", "docs/guide{d}.md",
    "README{d}.md", "assets/app{d}.min.js", "conf/settings{d}.json", "styles/site{d}.css", "deps{d}/yarn.lock", "deps/package{d}.lock", "spec/thing{d}.spec.js",
    "examples/demo{d}.mdx", "tools/run{d}.py", "native/core{d}.cpp", "img/logo{d}.PNG", ".github/workflows/ci{d}.yml", "Makefile{d}", "packages/a/dist/b/c{d}.mjs",
    "src/types{d}.d.mts", "test/fixtures/f{d}.json", "notes{d}.txt", "build/main{d}.map", "src/old{d}.generated.", "a{d}/.gitignore", "a{d}/x.lock/deep.js", "out{d}/../target/z.ts",
]
CODE_PATHS = ["src/mod{d}.ts", "lib/util{d}.js", "src/__tests__/case{d}.test.ts", "web/app{d}.jsx", "pkg/test/t{d}.js", "docs/x{d}.md"]
CODE = [
    "/**\n * Adds {d} to a number.\n * @param x the number\n */\nexport async function add{d}(x: number): Promise<number[]> {\n  return [x + {d}];\n}\n",
    "/** Header of file {d}. */\nconst o{d} = { a: 1 };\n/** Second. */\nfunction second{d}(a, b) {\n  return a;\n}\n",
    "export interface Shape{d} extends Base, Other {\n  // comment\n  name: string;\n  size?: number,\n  [key: string]: any;\n}\nexport type Q{d} {\n  one: 1\n}\n",
    "interface Empty{d} {}\ninterface Deep{d}<T> {\n  inner: { a: string };\n  more: T\n}\ntype Alias{d} = { x: 1 };\n",
    "import a from 'a';\nconst b = require('b');\ntry {\n  run{d}();\n} catch (err) {\n  if (err) { log(err); }\n}\nclass K{d} {}\n",
    "function f{d}() {\n  try { go(); } catch (e: Problem) { stop(); }\n  throw new RangeError('bad {d}');\n}\n",
    "// @ts-expect-error Type 'string' is not assignable to type 'number'.\nconst bad{d}: number = 'a string that is long';\n\nlet x = 1;\n",
    "// @ts-ignore\nconst first{d} = someValue.property;\nconst second = other.thing;\n\nexport default class C{d} {}\n",
    "(it('adds {d}', done => {\n  expect(1).toBe(1);\n}))\ndescribe(\"group {d}\", async x => { y(); }))\n",
    "throw TypeError(\"first {d}\");\nthrow new Oops('no');\nexport const v{d} = 1;\nexport function g{d}() {}\n",
]


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def _pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def _pick_sql(values: list[str], key: str) -> str:
    return f"([{', '.join(q(v) for v in values)}][({key} % {len(values)} + 1)::INT])"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        d, F.concat(F.lit("org/"), F.col("source")).alias("full_name"), F.substring("source", 4, 20).try_cast("bigint").alias("repo_ord"),
        F.replace(_pick(PATHS, d), F.lit("{d}"), d.cast("string")).alias("rel_path"), "text", F.octet_length("text").cast("long").alias("size_bytes"), F.col("lang").alias("language"),
    )


FILES = f"""files AS (
    SELECT doc_id, 'org/' || source AS full_name, try_cast(substr(source, 4) AS BIGINT) AS repo_ord, replace({_pick_sql(PATHS, 'doc_id')}, '{{d}}', doc_id::VARCHAR) AS rel_path,
           text, strlen(text)::BIGINT AS size_bytes, lang AS language FROM documents),
paths AS (
    SELECT *, list_extract(string_split(rel_path, '/'), -1) AS base, string_split(rel_path, '/') AS parts,
           lower(regexp_extract(list_extract(string_split(rel_path, '/'), -1), '(?s)^.+(\\.[^.]*)$', 1)) AS ext FROM files)"""


def code(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    made = F.concat(F.replace(_pick(CODE, d), F.lit("{d}"), d.cast("string")), F.lit("\n"), F.col("text"))
    out = table(spark, sf_dir, "documents").select(
        d, F.concat(F.lit("org/"), F.col("source")).alias("full_name"), F.substring("source", 4, 20).try_cast("bigint").alias("repo_ord"),
        F.replace(_pick(CODE_PATHS, (d / len(CODE)).cast("long")), F.lit("{d}"), d.cast("string")).alias("rel_path"), made.alias("text"),
    )
    return out.withColumn("size_bytes", F.octet_length("text").cast("long"))


CODE_SQL = f"""code AS (
    SELECT *, strlen(text)::BIGINT AS size_bytes, lower(regexp_extract(list_extract(string_split(rel_path, '/'), -1), '(?s)^.+(\\.[^.]*)$', 1)) AS ext FROM (
        SELECT doc_id, 'org/' || source AS full_name, try_cast(substr(source, 4) AS BIGINT) AS repo_ord,
               replace({_pick_sql(CODE_PATHS, f'(doc_id // {len(CODE)})')}, '{{d}}', doc_id::VARCHAR) AS rel_path,
               replace({_pick_sql(CODE, 'doc_id')}, '{{d}}', doc_id::VARCHAR) || chr(10) || text AS text FROM documents))"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documentation files; every third begins with a heading."""
    d = F.col("doc_id")
    head = F.when(d % 3 == 0, F.concat(F.lit("# Guide "), d.cast("string"), F.lit("\n\n"))).otherwise("")
    out = table(spark, sf_dir, "documents").select(
        d, F.concat(F.lit("org/"), F.col("source")).alias("full_name"), F.substring("source", 4, 20).try_cast("bigint").alias("repo_ord"),
        F.concat(F.lit("docs/d"), d.cast("string"), F.lit(".md")).alias("rel_path"), F.concat(head, F.col("text")).alias("text"),
    )
    return out.withColumn("size_bytes", F.octet_length("text").cast("long"))


DOCS = """docs AS (
    SELECT *, strlen(text)::BIGINT AS size_bytes FROM (
        SELECT doc_id, 'org/' || source AS full_name, try_cast(substr(source, 4) AS BIGINT) AS repo_ord, 'docs/d' || doc_id || '.md' AS rel_path,
               CASE WHEN doc_id % 3 = 0 THEN '# Guide ' || doc_id || chr(10) || chr(10) ELSE '' END || text AS text FROM documents))"""

LANGUAGES = ["TypeScript", "JavaScript", "Go", "Python"]
LICENSES = ["MIT", "apache-2.0", "GPL-3.0", "NOASSERTION", "BSD-3-Clause"]


def api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped repositories from customers."""
    k = F.col("c_custkey")
    owner = F.concat(F.lit("o"), (k % 17).cast("string"))
    name = F.concat(F.lit("r"), k.cast("string"))
    return table(spark, sf_dir, "customer").select(
        F.concat(owner, F.lit("/"), name).alias("full_name"), name.alias("name"), F.struct(owner.alias("login")).alias("owner"), (k * 37 % 500).alias("stargazers_count"),
        F.when(k % 5 != 0, _pick(LANGUAGES, k)).alias("language"), F.when(k % 6 != 0, F.struct(_pick(LICENSES, k).alias("spdx_id"))).alias("license"),
        F.col("c_mktsegment").alias("description"), F.lit("main").alias("default_branch"), F.concat(F.lit("https://example.org/"), name).alias("html_url"),
        (k % 7 == 0).alias("fork"), k.alias("src_pos"),
    )


API_SQL = f"""api AS (
    SELECT 'o' || (c_custkey % 17) AS owner, 'r' || c_custkey AS repo, 'o' || (c_custkey % 17) || '/r' || c_custkey AS full_name, c_custkey * 37 % 500 AS stars,
           CASE WHEN c_custkey % 5 <> 0 THEN {_pick_sql(LANGUAGES, 'c_custkey')} END AS language, CASE WHEN c_custkey % 6 <> 0 THEN {_pick_sql(LICENSES, 'c_custkey')} END AS license,
           c_mktsegment AS description, 'main' AS default_branch, 'https://example.org/r' || c_custkey AS url, c_custkey % 7 = 0 AS fork, c_custkey AS src_pos FROM customer)"""


def repos(spark: SparkSession, sf_dir: str, rank: int = 0) -> DataFrame:
    return discover.to_records(api(spark, sf_dir), rank)


def org_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repository for each source of the documents."""
    n = F.substring("source", 4, 20).try_cast("bigint")
    own = table(spark, sf_dir, "documents").select("source").distinct()
    return own.select(
        F.concat(F.lit("org/"), F.col("source")).alias("full_name"), F.lit("org").alias("owner"), F.col("source").alias("repo"), (n * 10).alias("stars"),
        F.when(n % 4 != 0, _pick(LICENSES, n)).alias("license"), F.when(n % 3 != 0, _pick(LANGUAGES, n)).otherwise("").alias("language"), F.lit(0).alias("src_rank"), n.alias("src_pos"),
    )


ORG = f"""org AS (
    SELECT 'org/' || source AS full_name, 'org' AS owner, source AS repo, n * 10 AS stars, CASE WHEN n % 4 <> 0 THEN {_pick_sql(LICENSES, 'n')} END AS license,
           CASE WHEN n % 3 <> 0 THEN {_pick_sql(LANGUAGES, 'n')} ELSE '' END AS language, n AS src_pos
    FROM (SELECT DISTINCT source, try_cast(substr(source, 4) AS BIGINT) AS n FROM documents))"""

KINDS = ["function_explain", "type_definition", "error_context", "test_assertion", "error_handling", "file_context", "doc_context", ""]


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training examples from neighbouring turns of a user and an assistant; some are without output or input."""
    c = table(spark, sf_dir, "conversations")
    u, a = c.where("role = 'user'"), c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    k = F.col("conv_id") * 31 + F.col("turn")
    return u.join(a, ["conv_id", "turn"]).select(
        F.format_string("ex-%05d", k).alias("id"), _pick(KINDS, k).alias("type"), F.concat(F.lit("org/c"), (F.col("conv_id") % 9).cast("string")).alias("repo"),
        F.concat(F.lit("f"), k.cast("string")).alias("file"), F.when(k % 11 != 0, F.col("text")).otherwise("").alias("instruction"),
        F.when(k % 3 != 0, F.concat(F.lit("Turn "), F.col("turn").cast("string"))).otherwise(" \u00a0\n").alias("input"), F.when(k % 5 != 0, F.col("answer")).otherwise("\ufeff \t").alias("output"),
    )


EXAMPLES = f"""examples AS (
    SELECT printf('ex-%05d', k) AS id, {_pick_sql(KINDS, 'k')} AS type, 'org/c' || (conv_id % 9) AS repo, 'f' || k AS file, CASE WHEN k % 11 <> 0 THEN text ELSE '' END AS instruction,
           CASE WHEN k % 3 <> 0 THEN 'Turn ' || turn ELSE ' ' || chr(160) || chr(10) END AS input, CASE WHEN k % 5 <> 0 THEN answer ELSE chr(65279) || ' ' || chr(9) END AS output
    FROM (SELECT u.conv_id, u.turn, u.text, a.text AS answer, u.conv_id * 31 + u.turn AS k FROM conversations u JOIN conversations a
          ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'))"""
