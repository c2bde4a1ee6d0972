"""Sources, sinks, streams and jobs over small folders."""

from __future__ import annotations

import io
import json
import os
import tarfile
import zipfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltworks.operators import curate, discover, examples, exporting
from siltworks.plans import config, jobs
from siltworks.sources import api, files, sinks
from siltworks.streaming import incremental

REPO_FILES = {
    "src/a.ts": "/**\n * Adds one.\n */\nexport function add(x: number): number {\n  return x + 1;\n}\n",
    "src/b.js": "try { run(); } catch (err) { log(err); }\nimport x from 'x';\n",
    "src/copy.js": "try { run(); } catch (err) { log(err); }\nimport x from 'x';\n",
    "dist/c.js": "var built = 1; // thirty characters and more",
    "README.md": "# Read me\n\nThis is a project about adding numbers to numbers.\n",
    "img.png": "binary",
    "secret.ts": 'const token = "0123456789abcdef0123456789";\n// and some more text here\n',
}


def archive(path, names=REPO_FILES):
    with tarfile.open(path, "w:gz") as t:
        for name, text in names.items():
            info = tarfile.TarInfo(f"root-main/{name}")
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


def repo(full_name, stars=5, license_="MIT", language="TypeScript", fork=False):
    owner, name = full_name.split("/")
    return {"full_name": full_name, "name": name, "owner": {"login": owner}, "stargazers_count": stars, "language": language, "license": license_ and {"spdx_id": license_}, "default_branch": "main", "html_url": "u", "fork": fork}


@pytest.fixture
def fixture(tmp_path):
    d = tmp_path / "api"
    d.mkdir()
    (d / "search-1.json").write_text(json.dumps({"items": [repo("a/x", 9), repo("b/y", 7, None)]}))
    (d / "user-a-1.json").write_text(json.dumps([repo("a/x", 1), repo("A/x", 2), repo("a/fork", 50, fork=True), repo("a/low", 0)]))
    (d / "repo-c__z.json").write_text(json.dumps(repo("c/z", 3, "Apache-2.0")))
    return str(d)


PLAN = {"name": "t", "discovery": {"search": {"query": "q", "limit": 5}, "users": ["a"], "perUserLimit": 2, "explicitRepos": ["c/z", "no", "d/missing"]}}


def test_discovery_order_and_first_wins(spark, fixture):
    out = jobs.candidates(spark, config.plan_from_dict(PLAN), fixture).orderBy("src_rank", "src_pos").collect()
    assert [(r.full_name, r.stars) for r in out] == [("a/x", 9), ("b/y", 7), ("A/x", 2), ("c/z", 3)]


def test_run_to_export(spark, fixture, tmp_path):
    plan = config.plan_from_dict(PLAN)
    arch = tmp_path / "arch"
    arch.mkdir()
    archive(arch / "a__x.tar.gz")
    archive(arch / "c__z.tar.gz", {"src/only.ts": "interface Only { name: string }\n// enough text to be long\n", "src/a.ts": REPO_FILES["src/a.ts"]})
    archive(arch / "b__y.tar.gz")  # without a licence: not eligible
    repos = jobs.candidates(spark, plan, fixture)
    out = str(tmp_path / "out")
    stats = jobs.run(spark, plan, repos, jobs.files_of_archives(spark, f"{arch}/*", repos), out)
    assert (stats["total_repos"], stats["total_files"], stats["duplicates_skipped"]) == (3, 4, 2)
    assert stats["license_breakdown"] == {"MIT": 2, "Apache-2.0": 1}
    manifest = json.loads(open(f"{out}/manifest.json").read())
    assert [(m["full_name"], m["file_count"]) for m in manifest] == [("a/x", 3), ("A/x", 0), ("c/z", 1)]
    again = config.parse_plan(f"{out}/plan.me")
    assert again == plan

    tree = out
    assert sorted(p.name for p in (tmp_path / "out/data").iterdir()) == ["a__x", "c__z"]
    reports = jobs.inspect(spark, tree)
    assert {r.category: r.files for r in reports["categories"].collect()} == {"source": 4}
    counts = {r.outcome: r.files for r in jobs.filter_dataset(spark, tree, f"{tmp_path}/f", split_docs=True).collect()}
    assert counts == {"code": 3, "docs": 1}
    assert sorted(os.listdir(f"{tmp_path}/f")) == ["code", "docs"]
    summary = jobs.prepare(spark, f"{tmp_path}/f", f"{tmp_path}/p")
    assert summary["examplesByType"] == {"function_explain": 1, "type_definition": 1, "error_handling": 1, "file_context": 2, "doc_context": 1}
    ids = [r.id for r in files.read_examples(spark, f"{tmp_path}/p").collect()]
    assert len(set(ids)) == 6 and "doc-00006" in ids
    stats = jobs.export(spark, f"{tmp_path}/p", f"{tmp_path}/e")
    assert stats["totalExamples"] == 6 and stats["languages"] == ["JavaScript", "Markdown", "TypeScript"] and stats["sourceRepos"] == 2
    assert "| doc_context | 1 |" in open(f"{tmp_path}/e/README.md").read()
    zipped = sinks.build_zip(f"{tmp_path}/e", f"{tmp_path}/e.zip")
    assert "stats.json" in zipfile.ZipFile(zipped).namelist()


def test_resume_and_package(spark, fixture, tmp_path):
    """A second run adds what the first did not have; its package is a dataset of its own."""
    plan, arch = config.plan_from_dict(PLAN), tmp_path / "arch"
    arch.mkdir()
    archive(arch / "a__x.tar.gz")
    repos = jobs.candidates(spark, plan, fixture)
    out = str(tmp_path / "out")
    jobs.run(spark, plan, repos.where("full_name = 'a/x'"), jobs.files_of_archives(spark, f"{arch}/*", repos), out)
    first = {p: os.path.getmtime(p) for p in [f"{out}/data/a__x/src/a.ts"]}
    assert first
    archive(arch / "a__x.tar.gz", {"src/new.ts": "const changed = 1; // not to be seen again"})
    archive(arch / "c__z.tar.gz", {"src/only.ts": "interface Only { name: string }\n// enough text\n", "src/a.ts": REPO_FILES["src/a.ts"]})
    stats = jobs.run(spark, plan, repos, jobs.files_of_archives(spark, f"{arch}/*", repos), out, resume=True, package=True)
    assert (stats["total_files"], stats["duplicates_skipped"]) == (4, 1)
    assert sorted(p.relative_to(f"{out}/data").as_posix() for p in (tmp_path / "out/data").rglob("*") if p.is_file()) == ["a__x/README.md", "a__x/src/a.ts", "a__x/src/b.js", "c__z/src/only.ts"]
    names = zipfile.ZipFile(f"{out}.zip").namelist()
    assert "data/c__z/src/only.ts" in names and "metadata.jsonl" in names and not any(n.startswith("_") for n in names)
    reports = jobs.inspect(spark, f"{out}.zip")
    assert sorted((r.full_name, r.files) for r in reports["repos_by_files"].collect()) == [("a/x", 3), ("c/z", 1)]
    counts = {r.outcome: r.files for r in jobs.filter_dataset(spark, f"{out}.zip", f"{tmp_path}/f", split_docs=True, passthrough=True).collect()}
    assert counts == {"code": 3, "docs": 1} and json.loads((tmp_path / "f/stats.json").read_text())["total_files"] == 4
    assert jobs.prepare(spark, f"{out}.zip", f"{tmp_path}/p")["totalExamples"] > 0
    jobs.filter_dataset(spark, out, f"{tmp_path}/f")
    assert sorted(x for x in os.listdir(f"{tmp_path}/f") if not x.endswith((".json", ".me", ".jsonl"))) == ["data"]


def test_one_source_may_fail(spark, fixture):
    (plan := config.plan_from_dict(PLAN))
    open(f"{fixture}/user-a-1.json", "w").write("{not json")
    out = jobs.candidates(spark, plan, fixture).orderBy("src_rank", "src_pos").collect()
    assert [r.full_name for r in out] == ["a/x", "b/y", "c/z"]


def test_readers_share_a_rate(monkeypatch):
    now, slept = [0.0], []
    monkeypatch.setattr(api.time, "monotonic", lambda: now[0])
    monkeypatch.setattr(api.time, "sleep", lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    limiter = api.shared_limiter(5, 10)
    for _ in range(3):
        limiter.take()
    assert sum(slept) == pytest.approx(4.0)  # a tenth of five a second is one in two seconds


def test_licenses_are_looked_up(spark, fixture, tmp_path):
    (tmp_path / "api/license-b__y.json").write_text(json.dumps({"license": {"spdx_id": "ISC"}}))
    repos = jobs.candidates(spark, config.plan_from_dict(PLAN), fixture).withColumn("license", F.when(F.col("full_name") == "c/z", None).otherwise(F.col("license")))
    arch = tmp_path / "arch"
    arch.mkdir()
    archive(arch / "c__z.tar.gz", {"COPYING": "GNU General Public License version 3", "LICENSE.md": "nothing", "sub/LICENSE": "Apache License version 2.0"})
    source = jobs.files_of_archives(spark, f"{arch}/*", repos)
    out = {r.full_name: r.license for r in jobs.with_licenses(spark, repos, source, fixture).collect()}
    assert out == {"a/x": "MIT", "A/x": "MIT", "b/y": "ISC", "c/z": "GPL-3.0"}


def test_fetching(spark, tmp_path):
    there = tmp_path / "o/r/tar.gz"
    there.mkdir(parents=True)
    archive(there / "main", {"a.txt": "hi"})
    repos = spark.createDataFrame([("o/r", "main"), ("o/gone", None)], "full_name string, default_branch string")
    got = api.fetch_archives(repos, base=f"file://{tmp_path}")
    assert {r.full_name: r.error is None for r in got.collect()} == {"o/r": True, "o/gone": False}
    assert [(r.archive, r.rel_path) for r in files.members(got.where("content is not null")).collect()] == [("o__r.tar.gz", "a.txt")]


def test_passthrough(spark, tmp_path):
    (tmp_path / "d/data/o__r").mkdir(parents=True)
    (tmp_path / "d/data/o__r/a.ts").write_text("x")
    (tmp_path / "d/stats.json").write_text("{}")
    jobs.filter_dataset(spark, f"{tmp_path}/d", f"{tmp_path}/f", passthrough=True)
    assert (tmp_path / "f/stats.json").read_text() == "{}" and (tmp_path / "f/data/o__r/a.ts").exists() and not (tmp_path / "f/plan.me").exists()


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/x.txt", "hi")
        z.writestr("../out.txt", "no")
    assert [(r.rel_path, bytes(r.content)) for r in files.archives(spark, f"{tmp_path}/a.zip").collect()] == [("d/x.txt", b"hi")]


def test_layouts(spark, tmp_path):
    for p in ("one/data/o__r", "two/o__r", "three/code/o__r", "three/docs/o__r", "bad/x"):
        (tmp_path / p).mkdir(parents=True)
    assert files.find_data_dir(spark, f"{tmp_path}/one").endswith("/data")
    assert files.find_data_dir(spark, f"{tmp_path}/two") == f"{tmp_path}/two"
    assert files.find_layout(spark, f"{tmp_path}/three") == (f"{tmp_path}/three/code", f"{tmp_path}/three/docs", ["o__r"])
    for probe in (files.find_data_dir, files.find_layout):
        with pytest.raises(FileNotFoundError):
            probe(spark, f"{tmp_path}/bad")


def test_tree_prunes_contents(spark, tmp_path):
    (tmp_path / "o__r/a b").mkdir(parents=True)
    (tmp_path / "o__r/a b/x+y.ts").write_text("text")
    out = files.tree(spark, str(tmp_path), content=False).where("size_bytes <= 10")
    assert [tuple(r) for r in out.collect()] == [("o__r/a b/x+y.ts", 4, "o/r")]
    assert "PushedFilters: [LessThanOrEqual(length,10)]" in out._jdf.queryExecution().executedPlan().toString() or "length" in out._jdf.queryExecution().executedPlan().toString()


def test_jsonl_passes_over_bad_lines(spark, tmp_path):
    (tmp_path / "examples.jsonl").write_text('{"id":"1","instruction":"i","output":"o"}\n\n{bad\n{"id":"2"}\n')
    assert sorted(r.id for r in files.read_examples(spark, str(tmp_path)).collect()) == ["1", "2"]
    assert files.read_json_file(spark, f"{tmp_path}/none.json") is None


def test_plan_errors(tmp_path):
    with pytest.raises(config.PlanError, match="cannot read"):
        config.parse_plan(f"{tmp_path}/none")
    (tmp_path / "a").write_text("a: [")
    with pytest.raises(config.PlanError, match="not YAML"):
        config.parse_plan(f"{tmp_path}/a")
    (tmp_path / "b").write_text("- 1")
    with pytest.raises(config.PlanError, match="must be a mapping"):
        config.parse_plan(f"{tmp_path}/b")
    with pytest.raises(config.PlanError) as e:
        config.plan_from_dict({"maxSizeGB": 0, "discovery": {"search": {"query": "", "limit": 3000}}, "secretScan": {"action": "x"}, "unknown": 1})
    assert [x.split(":")[0] for x in str(e.value).split("\n")] == ["maxSizeGB", "discovery.search.query", "discovery.search.limit", "secretScan.action"]
    assert config.plan_from_dict({}) == config.Plan()
    assert config.wizard_issues({"name": "a b", "concurrency": 21, "explicitRepos": ["x"]}) != [] and config.wizard_issues({}) == []


def test_env(tmp_path, monkeypatch):
    monkeypatch.setenv("SILT_A", "kept")
    monkeypatch.delenv("SILT_B", raising=False)
    (tmp_path / ".env").write_text("# c\n\nSILT_A=x\nSILT_B='y z'\n")
    assert config.load_env(f"{tmp_path}/.env") == {"SILT_B": "y z"}
    monkeypatch.delenv("SILT_B")
    assert config.load_env(f"{tmp_path}/none") == {}


def test_rate_limiter():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = api.RateLimiter(2, lambda: now[0], sleep)
    for _ in range(3):
        limiter.take()
    assert slept == [1.0]
    limiter.server_says(0)
    limiter.take()
    assert slept == [1.0, 1.0]


def test_forbidden_is_retried():
    answers = [api.Answer(403, None, {"x-ratelimit-reset": "107", "x-ratelimit-remaining": "0"}), api.Answer(200, [], {})]
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    assert api.get(lambda: answers.pop(0), api.RateLimiter(5, lambda: now[0], sleep), wall=lambda: 100.0).status == 200
    assert slept[0] == 8.0


def test_license_gate(spark):
    df = spark.createDataFrame([(None,), ("mit",), ("NOASSERTION",)], "l string")
    ask = lambda allow, req: [r[0] for r in df.select(discover.license_allowed(F.col("l"), allow, req)).collect()]
    assert ask(["MIT"], True) == [False, True, False] and ask(["MIT"], False) == [True, True, False] and ask([], True) == [False] * 3 and ask([], False) == [True] * 3


FILE = "full_name string, repo_ord long, rel_path string, text string, size_bytes long"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.sampled_from(["a", "bb", "ccc", ""])), max_size=12, unique_by=lambda x: x[:2]), st.integers(0, 12))
def test_dedup_and_budget(spark, given_, most):
    data = [(f"o/{r}", r, f"p{i}", t, len(t)) for r, i, t in given_]
    df = curate.hashed(spark.createDataFrame(data, FILE))
    once = curate.dedup(df)
    want, seen = [], set()
    for r in sorted(data, key=lambda x: (x[1], x[2])):
        if r[3] not in seen:
            seen.add(r[3])
            want.append(r)
    assert sorted((r.repo_ord, r.rel_path) for r in once.collect()) == [(r[1], r[2]) for r in want]
    assert curate.dedup(once).count() == len(want)
    kept, total = [], 0
    for r in want:
        total += r[4]
        if total > most:
            break
        kept.append((r[1], r[2]))
    assert sorted((r.repo_ord, r.rel_path) for r in curate.budget(once, most).collect()) == kept


def test_places_that_are_null_or_shared(spark):
    """Null repo_ord, two files at one place, rows equal in full: nothing is lost or multiplied."""
    data = [("o/n", None, "a", "x", 1), ("o/n", None, "b", "x", 1), ("o/r", 1, "a", "y", 1), ("o/r", 1, "a", "z", 1), ("o/r", 1, "a", "z", 1), ("o/q", 2, "c", None, 0), ("o/q", 2, "d", None, 0)]
    marked = curate.mark_duplicates(curate.hashed(spark.createDataFrame(data, FILE))).collect()
    assert sorted((r.full_name, r.rel_path, str(r.text), r.is_duplicate) for r in marked) == sorted([
        ("o/n", "a", "x", False), ("o/n", "b", "x", True), ("o/r", "a", "y", False), ("o/r", "a", "z", False), ("o/r", "a", "z", True), ("o/q", "c", "None", False), ("o/q", "d", "None", True),
    ])
    assert curate.secrets(spark.createDataFrame(data, FILE)).count() == 7
    place = "phase int, full_name string, repo_ord long, rel_path string, gen_rank int, match_pos int, type string, input string, output string"
    rows = [(0, "o/n", None, "a", 1, 0, "t", "1", "o"), (0, "o/r", 1, "a", 1, 0, "t", "2", "o"), (0, "o/r", 1, "a", 1, 0, "t", "3", "o"), (0, "o/r", 1, "a", 1, 0, "t", "3", "o"), (1, "o/n", None, None, 0, 0, "t", "4", "o")]
    seq = sorted((r.seq, r.input) for r in examples.numbered(spark.createDataFrame(rows, place)).collect())
    assert seq == [(1, "1"), (2, "2"), (3, "3"), (4, "3"), (5, "4")]
    code = spark.createDataFrame([("o/r", None, "a.ts", f"const a = {i}; // thirty characters and more", 50) for i in (1, 2)], FILE)
    assert [r.type for r in examples.code_examples(code).collect()] == ["file_context"]


def test_export_stream(spark, tmp_path):
    lines = [json.dumps({"id": "1", "instruction": "do", "output": "done", "input": "x"}), json.dumps({"id": "2", "instruction": "do", "output": " "})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n".join(lines))
    incremental.export_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert [r.value for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"messages":[{"role":"user","content":"do\\n\\nx"},{"role":"assistant","content":"done"}]}']


def test_dedup_and_budget_across_batches(spark, tmp_path):
    schema = FILE + ", sha256 string"
    arrive = lambda n, rows: spark.createDataFrame([(f"o/{n}", n, p, t, len(t), t) for p, t in rows], schema).coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    steps = [
        incremental.dedup_batch(incremental.Ledger(spark, f"{tmp_path}/hashes", "sha256 string")),
        incremental.budget_batch(incremental.Ledger(spark, f"{tmp_path}/spent", "bytes long, full boolean"), 6),
    ]
    for n, rows in enumerate([[("a", "xx"), ("b", "xx"), ("c", "yyy")], [("d", "xx"), ("e", "zz"), ("f", "w")], [("g", "v")]]):
        arrive(n, rows)
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        incremental.run_stream(stream, steps, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted(r.rel_path for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "c"]  # e does not fit, and nothing after it does


def test_progress(spark, tmp_path):
    p = incremental.Progress(spark, f"{tmp_path}/ledger")
    assert p.totals() == (0, 0, 0)
    p.mark(spark.createDataFrame([("a/x", 2, 10)], "full_name string, files long, bytes long"), 0)
    assert p.totals() == (1, 2, 10)
    repos = spark.createDataFrame([("a/x",), ("b/y",)], "full_name string")
    assert [r.full_name for r in discover.not_completed(repos, p.completed()).collect()] == ["b/y"]


def test_card_without_examples():
    meta = exporting.metadata("n", 0, "messages", ["TypeScript"], 0, None, "2024-01-02T03:04")
    assert "license: other" in exporting.card(meta, {}) and meta["created"] == "2024-01-02"


def test_cli(tmp_path):
    from siltworks.cli import main

    assert main(["init", "--name", "x y"]) == 2
    assert main(["init", "--name", "xy", "--query", "q", "--output", f"{tmp_path}/plan.me"]) == 0
    assert config.parse_plan(f"{tmp_path}/plan.me").discovery.search.query == "q"
