"""The behaviours that are streams: line export, dedup across arrivals, a budget that stays spent, and resuming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import curate, exporting
from ..sources.files import entries, parse_examples


def export_stream(spark: SparkSession, source: str, target: str, checkpoint: str, form: str = "messages") -> StreamingQuery:
    """Example lines that arrive under source, exported line by line with flat memory; ends when all is read."""
    examples = exporting.exportable(parse_examples(spark.readStream.text(source)))
    records = exporting.to_messages(examples) if form == "messages" else exporting.to_instruction(examples)
    out = exporting.json_lines(records).writeStream.format("text").option("path", target).option("checkpointLocation", checkpoint)
    return out.trigger(availableNow=True).start()


class Ledger:
    """An append-only Parquet table; rows of a batch that is run again replace those of its first run."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def read(self, before: int | None = None) -> DataFrame:
        if not entries(self.spark, self.path):  # a ledger that is there and cannot be read is an error
            return self.spark.createDataFrame([], self.schema + ", batch long")
        df = self.spark.read.parquet(self.path)
        return df if before is None else df.where(F.col("batch") < before)

    def write(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def dedup_batch(ledger: Ledger) -> Callable[[DataFrame, int], DataFrame]:
    """First arrivals of each sha256: not in the ledger, and first in their batch.

    The ledger is a table, so what is remembered is not held in a state store; its rows are hashes alone.
    """

    def run(batch: DataFrame, number: int) -> DataFrame:
        fresh = batch.join(ledger.read(before=number).select("sha256"), "sha256", "left_anti")
        kept = curate.dedup(fresh)
        ledger.write(kept.select("sha256"), number)
        return kept

    return run


def budget_batch(ledger: Ledger, max_bytes: int) -> Callable[[DataFrame, int], DataFrame]:
    """The prefix of each batch that what is left of the budget holds; once a file did not fit, nothing later does."""

    def run(batch: DataFrame, number: int) -> DataFrame:
        spent = ledger.read(before=number).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.max("full"), F.lit(False)).alias("full")).first()
        kept = batch.limit(0) if spent["full"] else curate.budget(batch, max_bytes - spent["bytes"])
        sums = kept.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("bytes"), F.count(F.lit(1)).alias("n"))
        ledger.write(sums.crossJoin(F.broadcast(batch.agg(F.count(F.lit(1)).alias("m")))).select("bytes", (F.col("n") < F.col("m")).alias("full")), number)
        return kept

    return run


def run_stream(arrivals: DataFrame, steps: list[Callable[[DataFrame, int], DataFrame]], target: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch through the steps and into its own folder under target, so that a batch run again is there once."""

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        out = batch
        for step in steps:
            out = step(out, number)
        out.write.mode("overwrite").parquet(f"{target}/batch={number}")
        batch.unpersist()

    return arrivals.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Progress:
    """Completed repositories with files and bytes: resuming a run skips them and starts from their totals."""

    def __init__(self, spark: SparkSession, path: str):
        self.ledger = Ledger(spark, path, "full_name string, files long, bytes long")

    def mark(self, repos: DataFrame, run: int) -> None:
        self.ledger.write(repos.select("full_name", "files", "bytes"), run)

    def completed(self) -> DataFrame:
        return self.ledger.read().select("full_name").distinct()

    def totals(self) -> tuple[int, int, int]:
        r = self.ledger.read().agg(F.countDistinct("full_name"), F.coalesce(F.sum("files"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        return r[0], r[1], r[2]
