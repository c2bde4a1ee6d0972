"""Shared pieces: tables in the shared folder, group leaders without hot tasks, groups streamed through Arrow."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one only where all runs in one process."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    at = "file://" + tempfile.mkdtemp(prefix="siltworks-")
    spark.conf.set("spark.checkpoint.dir", at)
    spark.sparkContext.setCheckpointDir(at)
    return at


_WRITTEN: list[str] = []  # places given out by new_path, oldest first


def _there(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/siltworks/{name}-{uuid.uuid4().hex}"
    fs, there = _there(spark, path)
    fs.deleteOnExit(there)
    _WRITTEN.append(path)
    return path


def settle(df: DataFrame, name: str, since: int) -> DataFrame:
    """materialise(df), and delete what was written since ``since`` (a value of tables_written()) to compute it."""
    out = materialise(df, name)
    for path in _WRITTEN[since:-1]:
        fs, there = _there(df.sparkSession, path)
        fs.delete(there, True)
        fs.cancelDeleteOnExit(there)
    del _WRITTEN[since:-1]
    return out


def tables_written() -> int:
    return len(_WRITTEN)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write df once to the shared folder (with the options of a Parquet writer) and read it from there.

    Later steps start from the written table: its lineage is cut, it outlives lost executors, and the shuffle files
    that made it are dropped as soon as it is written.
    """
    spark = df.sparkSession
    path, schema = new_path(spark, name), df.schema
    before = spark.conf.get(_CLEANUP, None)
    try:
        spark.conf.set(_CLEANUP, "true")
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(schema).parquet(path)


def release_memory() -> None:
    """Give back to the system what this worker's allocators hold for later: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which gives its memory back at the end of each task."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return own


def small(df: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """Mark df for broadcast if it holds at most most_rows rows (counted here), else leave the choice to Spark."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def even_labels(spark: SparkSession, n: int) -> list[int]:
    """n numbers of which hash partitioning into n parts gives each part one.

    Numbers 0 .. n - 1 would leave a third of the parts empty and put several into others.  Beyond 4096 parts, where a
    part is a small share of a stage, plain numbers do.
    """
    if n > 4096:
        return list(range(n))
    ids = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("part"))
    found = {r["part"]: r["id"] for r in ids.groupBy("part").agg(F.min("id").alias("id")).collect()}
    return [found[k] for k in range(n)] if len(found) == n else list(range(n))


def with_leaders(df: DataFrame, key: list[str], member: Column, pick: Callable[[Column], Column] = F.min) -> DataFrame:
    """df with ``leader`` (the picked member of each row's group) and ``group_size``.

    The group of a key may hold a third of all rows, so each is first gathered in salted parts, then as one row a
    part, and the answer goes back the same way: no task gets more of a group than one part.  df is read twice, so
    it should be a written table.  The key's columns must not be null.
    """
    spark = df.sparkSession
    parts = max(32, partitions(spark))
    df = df.withColumn("_member", member).withColumn("_part", F.pmod(F.xxhash64("_member", *[c for c in df.columns if c not in key][:1]), F.lit(parts)))
    low = df.groupBy(*key, "_part").agg(pick("_member").alias("_low"), F.count(F.lit(1)).alias("_n"))
    top = low.groupBy(*key).agg(pick("_low").alias("leader"), F.sum("_n").alias("group_size"))
    back = low.select(*key, "_part").join(top, key)
    return df.join(back, [*key, "_part"]).drop("_part", "_member")


def stream_groups(df: DataFrame, key: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str, n: int | None = None) -> DataFrame:
    """Apply work to the rows of each key.  Groups must be bounded by the caller (see block_pairs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = np.zeros(batch.num_rows, dtype=bool)
            for k in key:
                col = batch.column(k).to_numpy(zero_copy_only=False)
                cut[1:] |= col[1:] != col[:-1]
                if held:
                    cut[0] |= col[0] != held[-1].column(k)[-1].as_py()
            if not held:
                cut[0] = True
            edges = [*np.flatnonzero(cut).tolist(), batch.num_rows]
            if edges[0] > 0:
                held.append(batch.slice(0, edges[0]))
            for lo, hi in zip(edges, edges[1:], strict=False):
                if held:
                    out = work(pa.Table.from_batches(held))
                    if out is not None and out.num_rows:
                        yield out
                held = [batch.slice(lo, hi - lo)]
        if held:
            out = work(pa.Table.from_batches(held))
            if out is not None and out.num_rows:
                yield out

    dealt = df.repartition(n, *key) if n else df.repartition(*key)
    return dealt.sortWithinPartitions(*key).mapInArrow(released(run), schema)


def block_pairs(df: DataFrame, group: str, member: str, size: Column, block: int) -> DataFrame:
    """Deal each group's rows to pairs of blocks of about ``block`` members: columns ``_lo``, ``_hi``, ``_own``.

    A group of m members has about (m / block) blocks; each row goes to the pairs that its block takes part in, so
    every two members meet in exactly one pair (the pair (b, b) for two of the same block) and no task holds more
    than two blocks of a group, however large it is.
    """
    df = df.withColumn("_blocks", F.ceil(size / F.lit(float(block))).cast("int"))
    df = df.withColumn("_own", F.pmod(F.xxhash64(member), F.col("_blocks").cast("long")).cast("int"))
    df = df.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return df.withColumn("_lo", F.least("_own", "_other")).withColumn("_hi", F.greatest("_own", "_other")).drop("_other", "_blocks")
