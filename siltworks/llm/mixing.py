"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

DataFrame functions only.  Targets come from one row per source; documents are chosen by an order that a seed fixes,
cut by a histogram of that order, so no source is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, materialise, small

FILLS = 3  # documents that fill a source's gap
BUCKET_DIGITS = 3  # hex digits of the seeded order that make a histogram bucket: 4096 a source
RUNS = "array<struct<lo:string,hi:string,most:double>>"


def draw(seed: int) -> Column:
    """The seeded order of documents; see apart for rows that are equal."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select("doc_id", "source", words(F.col("text")).alias("size"), draw(seed).alias("u"), F.spark_partition_id().alias("part"))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"skey": F.coalesce("source", F.lit("")), "snull": F.col("source").isNull()})


def repeats(sized: DataFrame) -> DataFrame:
    """(skey, snull, u) of places that several rows share: rows of equal id, text and source."""
    return materialise(_keyed(sized).groupBy("skey", "snull", "u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "mix-repeats")


def apart(rows: DataFrame, order: Column) -> DataFrame:
    """rows (skey, snull, u, part), written before, with a place of their own for each of those that share one.

    The k-th row has the hash of the place and k as its place, the first the place itself.  Rows are counted in their
    parts first, so that a place that is a third of all rows is in no one task.
    """
    on = ["skey", "snull", "u"]
    count = rows.groupBy(*on, "part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*on).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    count = count.select(*on, "part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = rows.withColumn("_own", F.row_number().over(Window.partitionBy(*on, "part").orderBy(order)))
    k = F.col("_own") + F.col("_before")
    place = F.when(k == 1, F.col("u")).otherwise(F.md5(F.concat("u", F.lit(":"), k.cast("string"))))
    return own.join(count, [*on, "part"]).withColumn("u", place).drop("_own", "_before")


def places(docs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame | None]:
    """The written sizes of docs, each row with a place of its own, and the places that were shared, if any were."""
    sized = materialise(sizes(docs.select("doc_id", "source", "text"), seed), "mix-sizes")
    shared = repeats(sized)
    if shared.isEmpty():
        return sized, None
    on = ["skey", "snull", "u"]
    mine = small(shared)
    told = apart(materialise(_keyed(sized).join(mine, on, "left_semi"), "mix-shared"), F.lit(0))
    alone = _keyed(sized).join(mine, on, "left_anti")
    return materialise(alone.unionByName(told).select(*sized.columns), "mix-sizes"), shared


def targets(sized: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """One row per source: skey, snull, source, source_size, mean_size, target.

    Sources in code point order, null last, take the weights in turn; they are ranked within ranges.  Together they
    share ``share`` times all sizes.  In each round the sources whose part is above max_epochs times their size are
    clamped there and the excess is reshared by weight among the others, until none is above.  Sums are of whole
    numbers, so they do not depend on the order of rows; each round halves the distance to the level or the weight
    that is left, so rounds follow the logarithm of the sizes.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("size").alias("mean_size"))
    by_source = by_source.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    by_source = materialise(by_source, "mix-sources")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = by_source.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("before"))  # a row a range
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) + F.col("before")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    s = materialise(by_source.join(before, "part").withColumn("weight", turn).drop("part", "before"), "mix-weights")
    cap = F.col("source_size") * F.lit(float(max_epochs))
    budget = float(s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    level, clamped = None, -1
    while True:
        free = F.lit(True) if level is None else F.lit(level) * F.col("weight") <= cap
        r = s.agg(F.sum(F.when(free, F.col("weight"))).alias("weight"), F.coalesce(F.sum(F.when(~free, F.col("source_size"))), F.lit(0)).alias("size"), F.count_if(~free).alias("n")).first()
        if r["n"] == clamped or not r["weight"]:  # none is above any more, or all are
            break
        level, clamped = (budget - r["size"] * float(max_epochs)) / r["weight"], r["n"]
    target = F.least(cap, F.lit(level) * F.col("weight")) if r["weight"] else cap
    return s.select(F.coalesce("source", F.lit("")).alias("skey"), F.col("source").isNull().alias("snull"), "source", "source_size", "mean_size", target.alias("target"))


def choices(sized: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """targets() with what decides each document: whole (repetitions of all), cut_u, fills and runs.

    A document is taken once more if its place u is up to cut_u, so far as whole documents fit into what is left of
    the target, or if it is among fills: the largest others that fit into the gap that remains, one after another, and
    last the one that comes nearest to it.  A source that fills leave further than FILLS mean documents from its
    target, as a very long document at the cut can, carries on along the order instead (see carried).
    """
    spark = sized.sparkSession
    t = targets(sized, weights, share, max_epochs)
    t = t.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    t = materialise(t.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    keyed = _keyed(sized).withColumn("bucket", F.substring("u", 1, BUCKET_DIGITS))
    hist = keyed.groupBy("skey", "snull", "bucket").agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("skey", "snull").orderBy("bucket"))
    on = ["skey", "snull"]
    edge = hist.withColumn("upto", upto).join(small(t.select(*on, "left")), on).where("upto > left")
    edge = edge.groupBy(*on).agg(F.min("bucket").alias("bucket"), F.min(F.col("upto") - F.col("n")).alias("before"))
    edge = materialise(edge.join(t.select(*on, "left"), on), "mix-edges")
    inside = keyed.join(small(edge), [*on, "bucket"])
    inside = inside.withColumn("sum_u", F.sum("size").over(Window.partitionBy(*on, "bucket").orderBy("u")) + F.col("before"))
    inside = inside.where("sum_u <= left").groupBy(*on).agg(F.max("u").alias("in_u"), F.max("sum_u").alias("in_sum"))
    cut = edge.join(inside, on, "left").select(*on, F.coalesce("in_u", "bucket").alias("cut_u"), F.greatest(F.coalesce("in_sum", F.lit(0)), "before").alias("got"))
    t = materialise(t.join(cut, on, "left").withColumn("gap", F.when(F.col("cut_u").isNull(), 0.0).otherwise(F.col("left") - F.col("got"))), "mix-cuts")
    t = t.withColumn("fills", F.array().cast("array<string>"))
    for k in range(FILLS):
        rest = keyed.join(small(t.where("gap > 0").select(*on, "cut_u", "gap", "fills")), on).where((F.col("u") > F.col("cut_u")) & ~F.array_contains("fills", F.col("u")))
        rest = rest.withColumn("miss", F.abs(F.col("size") - F.col("gap"))).where("size > 0 and " + ("miss < gap" if k == FILLS - 1 else "size <= gap"))
        nearest = materialise(rest.groupBy(*on).agg(F.min("miss").alias("miss")), "mix-nearest")
        fill = rest.join(small(nearest), [*on, "miss"]).groupBy(*on).agg(F.min("u").alias("_u"), F.min_by("size", "u").alias("_size"))
        t = t.join(fill, on, "left").withColumns({
            "fills": F.when(F.col("_u").isNull(), F.col("fills")).otherwise(F.array_append("fills", F.col("_u"))),
            "gap": F.col("gap") - F.coalesce("_size", F.lit(0)),
        })
        t = materialise(t.drop("_u", "_size"), "mix-fills")
    stray = materialise(t.where(F.abs("gap") > FILLS * F.col("mean_size")), "mix-strays")
    if stray.isEmpty():
        return t.withColumn("runs", F.array().cast(RUNS))
    more = carried(keyed, stray)
    t = t.join(small(more), on, "left")
    nearer = F.coalesce(F.abs("run_gap") < F.abs("gap"), F.lit(False))
    return materialise(t.withColumns({
        "runs": F.when(nearer, F.col("found")).otherwise(F.array().cast(RUNS)),
        "fills": F.when(nearer, F.col("last")).otherwise(F.col("fills")),
        "gap": F.when(nearer, F.col("run_gap")).otherwise(F.col("gap")),
    }).drop("found", "last", "run_gap"), "mix-carried")


def carried(keyed: DataFrame, stray: DataFrame) -> DataFrame:
    """skey, snull, found (runs), last (fills) and run_gap of sources that go on along the seeded order after the cut.

    Documents that do not fit into what is left are skipped.  A run takes the documents with places in (lo, hi] and
    sizes up to most; the next begins behind the first document that did not fit, until none fits.  At last the
    document that comes nearest to what is left is taken, if that is nearer than none.
    """
    on = ["skey", "snull"]
    now = stray.select(*on, F.col("cut_u"), F.col("cut_u").alias("lo"), (F.col("left") - F.col("got")).alias("run_gap"), F.array().cast(RUNS).alias("found"), F.lit(True).alias("open"))
    now = materialise(now, "mix-runs")
    while not now.where("open").isEmpty():
        rest = keyed.join(small(now.where("open").select(*on, "lo", "run_gap")), on).where("u > lo and size > 0 and size <= run_gap")
        hist = rest.groupBy(*on, "bucket").agg(F.sum("size").alias("n"), F.first("run_gap").alias("run_gap"))
        upto = F.sum("n").over(Window.partitionBy(*on).orderBy("bucket"))
        hist = materialise(hist.withColumn("upto", upto), "mix-runs")
        every = hist.groupBy(*on).agg(F.max("upto").alias("every"))
        edge = hist.where("upto > run_gap").groupBy(*on).agg(F.min("bucket").alias("bucket"), F.min(F.col("upto") - F.col("n")).alias("before"))
        edge = materialise(edge, "mix-edges")
        inside = rest.join(small(edge), [*on, "bucket"])
        inside = inside.withColumn("sum_u", F.sum("size").over(Window.partitionBy(*on, "bucket").orderBy("u")) + F.col("before"))
        fits = F.col("sum_u") <= F.col("run_gap")
        inside = inside.groupBy(*on).agg(F.max(F.when(fits, F.col("u"))).alias("in_u"), F.max(F.when(fits, F.col("sum_u"))).alias("in_sum"), F.min(F.when(~fits, F.col("u"))).alias("next"))
        step = every.join(edge, on, "left").join(inside, on, "left")
        hi = F.when(F.col("next").isNull(), F.lit("g")).otherwise(F.coalesce("in_u", "bucket"))  # g is behind all hex digits
        got = F.when(F.col("next").isNull(), F.col("every")).otherwise(F.greatest(F.coalesce("in_sum", F.lit(0)), "before"))
        step = step.select(*on, hi.alias("hi"), got.alias("more"), "next")
        run = F.struct("lo", "hi", F.col("run_gap").cast("double").alias("most"))
        now = now.join(small(step), on, "left").select(
            *on,
            "cut_u",
            F.coalesce("next", "lo").alias("lo"),
            (F.col("run_gap") - F.coalesce("more", F.lit(0))).alias("run_gap"),
            F.when(F.coalesce("more", F.lit(0)) > 0, F.array_append("found", run)).otherwise(F.col("found")).alias("found"),
            F.col("next").isNotNull().alias("open"),
        )
        now = materialise(now, "mix-runs")
    rest = keyed.join(small(now.select(*on, "cut_u", "run_gap", "found")), on).where((F.col("u") > F.col("cut_u")) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("run_gap")) & ~_in_runs("found", F.col("size")))
    miss = F.abs(F.col("size") - F.col("run_gap"))
    last = rest.where(miss < F.col("run_gap")).groupBy(*on).agg(F.min(F.struct(miss.alias("miss"), "u", "size")).alias("best"))
    return materialise(now.join(last, on, "left").select(
        *on,
        "found",
        F.when(F.col("best").isNull(), F.array().cast("array<string>")).otherwise(F.array("best.u")).alias("last"),
        (F.col("run_gap") - F.coalesce("best.size", F.lit(0))).alias("run_gap"),
    ), "mix-carried")


def _in_runs(runs: str, size: Column) -> Column:
    inside = F.exists(runs, lambda r: (F.col("u") > r["lo"]) & (F.col("u") <= r["hi"]) & (size > 0) & (size <= r["most"]))
    return F.when(F.size(runs) > 0, inside).otherwise(False)


def _copies(size: Column) -> Column:
    """Repetitions of a row with place u and this size under its source's choices; a null cut_u takes all that is left."""
    more = F.when(F.col("left") > 0, F.coalesce(F.col("u") <= F.col("cut_u"), F.lit(True))).otherwise(False)
    return F.col("whole") + (more | F.array_contains("fills", F.col("u")) | _in_runs("runs", size)).cast("long")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, size, source_size, target, taken, copies.

    taken is size times copies, in words; whole texts are counted, however long.  No document is cut: a source misses
    its target by what no single document fills.  Null sources are one source, the last; null texts have size 0; a
    source without words has target 0; rows that repeat id, text and source are taken one by one (which of them is
    open, as they are equal).  An empty table gives an empty result; other columns are not read.
    """
    sized, _ = places(docs, seed)
    params = choices(sized, weights, share, max_epochs)
    out = _keyed(sized).drop("source").join(small(params), ["skey", "snull"]).withColumn("copies", _copies(F.col("size")))
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7) -> DataFrame:
    """The rows of docs, each as often as mix() takes it, columns as they were.  Texts are not shuffled, but for those
    of rows that repeat id, text and source, which are in the order of a hash of their other columns."""
    sized, shared = places(docs, seed)
    params = choices(sized, weights, share, max_epochs).drop("source")
    rows = docs.select(F.struct("*").alias("_row"), draw(seed).alias("u"), F.coalesce("source", F.lit("")).alias("skey"), F.col("source").isNull().alias("snull"))
    if shared is not None:
        on = ["skey", "snull", "u"]
        hashed = F.xxhash64(*[F.col("_row")[f.name] for f in docs.schema if not isinstance(f.dataType, T.MapType | T.VariantType)])
        part = F.struct(F.pmod(hashed, F.lit(1024)).alias("hash"), F.spark_partition_id().alias("at"))
        told = materialise(rows.join(small(shared), on, "left_semi").withColumn("part", part), "mix-shared")
        rows = rows.join(small(shared), on, "left_anti").unionByName(materialise(apart(told, hashed).drop("part"), "mix-shared"))
    out = rows.join(small(params), ["skey", "snull"]).withColumn("_copies", _copies(words(F.col("_row")["text"]))).where("_copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
