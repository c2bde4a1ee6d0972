"""What plans must and must not hold."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from siltworks.llm import common, exact_dedup, jaccard, mixing, packing

from ..conftest import SF
from . import brute
from .test_ops import docs, passage

PYTHON = ("Python", "Arrow", "Pandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_operators_run_no_python(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (exact_dedup.digests(d), exact_dedup.exact_dedup(d), exact_dedup.drop_copies(d), mixing.sizes(d, 7), mixing.mix(d), mixing.mixed_rows(d)):
        assert not any(x in plan(df) for x in PYTHON)


def test_digest_runs_are_sorted_and_merged(spark):
    """Runs are sorted, folded, exchanged, sorted again and folded; digests are read once on the way up."""
    d = common.materialise(exact_dedup.digests(spark.read.parquet(f"{SF}/documents.parquet").repartition(5)), "digests")
    up = plan(exact_dedup.fold(d, "run0", F.struct("doc_id"), F.count(F.lit(1))))
    steps = [x for line in up.splitlines() for x in ("SortAggregate", "Exchange", "Sort ", "FileScan") if x in line]
    assert steps == ["SortAggregate", "Sort ", "Exchange", "SortAggregate", "Sort ", "FileScan"] and "HashAggregate" not in up
    assert plan(exact_dedup.merge_runs(d, 2)).count("FileScan") == 5  # the four levels of 5 runs on the way down, and the rows


def test_packing_and_mixing_do_not_shuffle_texts(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    assert "Exchange hashpartitioning" not in plan(packing.pack_documents(d, "unused"))
    assert "Exchange hashpartitioning" not in plan(mixing.mixed_rows(d))


def test_scans_read_only_what_is_used(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (exact_dedup.digests(d), packing.pack_documents(d, "unused"), jaccard.sketches(d, 5, 8)):
        schema = plan(df).split("ReadSchema:")[1]
        assert "doc_id" in schema and "text" in schema and "lang" not in schema and "n_chars" not in schema


def test_shuffles_are_dropped_and_setting_kept(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    out = common.materialise(spark.range(100).groupBy("id").count(), "t")
    assert out.count() == 100 and spark.conf.get(key) == before


def test_settle_deletes_inner_tables(spark):
    import os

    since = common.tables_written()
    inner = common.materialise(spark.range(5), "inner")
    path = common._WRITTEN[-1].removeprefix("file://")
    out = common.settle(inner.where("id > 1"), "outer", since)
    assert out.count() == 3 and not os.path.exists(path) and common.tables_written() == since + 1


def test_a_large_class_meets_in_blocks(spark):
    """Near copies of one text: all links are counted though no task sees the class as a whole."""
    rng = random.Random(8)
    base = passage(rng, 80).split()
    data = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(80)] = f"x{i}"
        data.append((i, " ".join(w), "s"))
    got = sorted(tuple(r) for r in jaccard.jaccard_classes(docs(spark, data), block=20).collect())
    assert got == brute.jaccard([(d, t) for d, t, _ in data])


def test_labels_fill_all_parts(spark):
    for n in (1, 5, 51, 211):
        labels = common.even_labels(spark, n)
        df = spark.createDataFrame([(x,) for x in labels], "b long").repartition(n, "b")
        assert len(set(labels)) == n and df.rdd.glom().map(len).collect() == [1] * n
