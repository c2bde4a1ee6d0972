"""Exact dedup: a tree merge of sorted digest runs, with DataFrame functions only.

Each partition's digests are a run.  In every round the runs whose numbers differ only in their last base-``fan_in``
digit are exchanged and merged to one: a merge sorts what arrives by digest and folds neighbours of equal digest into
one row that keeps the smallest identifier and the count.  Before a run is exchanged it is folded the same way where
it lies.  The smallest identifier is a struct, which Spark only aggregates over sorted rows (SortAggregate), so runs
are sorted on both sides of each exchange.  A merged run is spread over tasks by digest, so the last run is as
parallel as the first, and each row of a round stands for at most ``fan_in`` rows of the round before, so a text that
is a third of the corpus is no hot key in any round.  Each round is a written table; the winners go back down the same
tree.  Every level compares SHA-256, a second 64-bit hash and the length together, so rows of one digest whose texts
differ in the others would stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, materialise, small

_KEY = ["digest", "second", "size"]


def _normal() -> Column:
    return F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest, second, size and the run of each row: the partition that reads it."""
    rows = docs.select("doc_id", _normal().alias("t"))
    return rows.select("doc_id", F.unhex(F.sha2("t", 256)).alias("digest"), F.xxhash64("t").alias("second"), F.length("t").alias("size"), F.spark_partition_id().cast("long").alias("run0"))


def merge_runs(rows: DataFrame, fan_in: int = 16) -> DataFrame:
    """rows (doc_id, digest, second, size, run0), written before, with keep_id and group_size for each row."""
    smallest = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")  # null ids last
    levels = [materialise(fold(rows, "run0", smallest, F.count(F.lit(1))), "digest-runs")]
    left, k = (rows.agg(F.max("run0")).first()[0] or 0) + 1, 0
    while left > 1:
        k, left = k + 1, -(-left // fan_in)
        up = levels[-1].withColumn(f"run{k}", F.floor(F.col(f"run{k - 1}") / fan_in)).drop(f"run{k - 1}")
        levels.append(materialise(fold(up, f"run{k}", F.col("keep"), F.sum("group_size")), "digest-runs"))
    won = levels[k]
    for j in range(k - 1, -1, -1):
        below = levels[j].select(f"run{j}", F.floor(F.col(f"run{j}") / fan_in).alias(f"run{j + 1}"), *_KEY)
        won = below.join(won, [f"run{j + 1}", *_KEY]).drop(f"run{j + 1}")
    won = won.select("run0", *_KEY, F.col("keep.doc_id").alias("keep_id"), "group_size")
    return rows.join(won, ["run0", *_KEY]).drop("run0")


def fold(rows: DataFrame, run: str, keep: Column, size: Column) -> DataFrame:
    """One row for each digest of each run, with the smallest identifier and the number of rows."""
    return rows.groupBy(run, *_KEY).agg(F.min(keep).alias("keep"), size.alias("group_size"))


def exact_dedup(docs: DataFrame, fan_in: int = 16) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each run of ``[\\x20\\x09-\\x0D]`` became one space, however long; null is
    empty.  The smallest doc_id of equal texts stays.  Null ids are larger than any other: they stay only in a group
    that has no other id, and then keep_id is null.  Rows that repeat one doc_id and text count in group_size and
    share its verdict.  An empty table gives an empty result; other columns, whatever their names, are not read.
    """
    out = merge_runs(materialise(digests(docs.select("doc_id", "text")), "digests"), fan_in)
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_dedup keeps, all columns as they were.

    Of rows that repeat one doc_id and text one stays, that with the smallest hash of its columns.  Texts are shuffled
    once, by keys of one row each; rows that repeat a key are folded before they are.
    """
    won = merge_runs(materialise(digests(docs.select("doc_id", "text")), "digests"))
    keys = won.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy(F.struct("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    keys = materialise(keys, "digest-winners")
    keyed = docs.select(F.struct("*").alias("_row"), F.struct("doc_id").alias("_id"), F.unhex(F.sha2(_normal(), 256)).alias("_digest"))
    on = ["_id", "_digest"]
    once = keyed.join(keys.where("_n = 1"), on, "left_semi").select("_row.*")
    many = keys.where("_n > 1").select(*on)
    if many.isEmpty():
        return once
    hashed = [F.col("_row")[f.name] for f in docs.schema if not isinstance(f.dataType, T.MapType | T.VariantType)]
    again = keyed.join(small(many), on, "left_semi").groupBy(*on).agg(F.min_by("_row", F.xxhash64(*hashed)).alias("_row")).select("_row.*")
    return once.unionByName(again)
