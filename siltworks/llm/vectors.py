"""Embedding near-dedup by NN-descent.

Equal vectors are one node with a weight.  Seeded sign projections give each node first neighbours; there are as many
tables of them as let two vectors at the threshold share a bucket of one with probability 0.99 (about n to the power
0.15 at 0.95).  Every round lets the neighbours of a node (forward and reverse, at least one of the two new) meet each
other, and each node keeps its nearest ``k``.  Neighbours beyond three times the threshold's angle are not kept: they
lead to no link, and most vectors have no others, so what moves in a round follows the vectors that have neighbours.
Pairs at the threshold or above are links.

A list whose ``k`` entries are all links is saturated: what lies behind its end is unknown.  Such a list is enlarged
to its whole component: members within half the threshold's angle of the component's first member are linked to each
other by the triangle inequality on angles and are only counted; the others meet all members, block by block, so no
task holds more than two blocks and no pair leaves a task.  Links that full lists pushed out may lead to other
components.  They end in full lists on both sides, so the components of full lists are compared as balls (a pivot and
the largest angle from it), and where two balls are near enough for a link, their members: components that any link
joins become one before links are counted.

The vectors whose id is divisible by 50 are compared with all others, in blocks, to audit recall: over all links, and
as the mean over the nodes of each class (about as many links, in a saturated component or not).  Below the target,
more tables and rounds follow, and after the last all components and single nodes are compared as balls, which finds
every link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import block_pairs, materialise, partitions, released, stream_groups, with_leaders
from .graph import components
from .jaccard import forest

NO_ID = -(2**63)


def unit(raw: list[bytes] | pa.Array, kind: str) -> np.ndarray:
    """Rows of equal length as double-precision unit vectors."""
    raw = [x.as_buffer() for x in raw] if isinstance(raw, pa.Array | pa.ChunkedArray) else raw
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    return unit_rows(x)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(emb: DataFrame, kind: str) -> DataFrame:
    """id and bytes of the vectors that can link: not null, all components finite, not all zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, x in zip(batch.column("vec_id").fill_null(NO_ID).to_pylist(), batch.column("embedding"), strict=True):
                if not x.is_valid or not len(x.values) or x.values.null_count:
                    continue
                v = np.asarray(x.values, dtype=kind)
                if np.isfinite(v).all() and v.any():
                    ids.append(i)
                    rows.append((v + 0).tobytes())  # -0 becomes 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], names=["id", "vec"])

    return emb.select("vec_id", "embedding").mapInArrow(released(run), "id long, vec binary")


def first_lists(nodes: DataFrame, kind: str, tables: range, bits: int, far: float, reach: int = 5, keep: int = 2) -> DataFrame:
    """(a, b, sim): of each table, the best ``keep`` of the ``reach`` next nodes in sign-projection order, both ways, with
    a cosine of at least ``far``."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            wide = np.array([len(x.as_buffer()) for x in batch.column("vec")])
            for w in np.unique(wide):
                pick = pa.array(np.flatnonzero(wide == w))
                own = batch.take(pick)
                x = unit(own.column("vec"), kind)
                for t in tables:
                    if (t, w) not in planes:
                        planes[t, w] = np.random.default_rng(1_000 + t).standard_normal((x.shape[1], bits + 1))
                    y = x @ planes[t, w]
                    bucket = (y[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    n = own.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, t * 1_000_003 + w)), pa.array(bucket), pa.array(y[:, bits]), own.column("id"), own.column("vec")],
                        names=["tab", "bucket", "place", "id", "vec"],
                    )

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("tab", "bucket")])
            ids, raw = batch.column("id").to_numpy(), batch.column("vec")
            edges = np.flatnonzero(np.append(True, np.append((key[:, 1:] != key[:, :-1]).any(axis=0), True))) if batch.num_rows else np.zeros(1, int)
            left, right, sims = [], [], []
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi - lo < 2:
                    continue
                x = unit(raw.slice(lo, hi - lo), kind)
                best = np.full((hi - lo, 2 * reach), -2.0)
                for s in range(1, min(reach, hi - lo - 1) + 1):
                    dot = (x[:-s] * x[s:]).sum(axis=1)
                    best[:-s, s - 1] = dot
                    best[s:, reach + s - 1] = dot
                top = np.argsort(-best, axis=1, kind="stable")[:, :keep]
                rows = np.repeat(np.arange(hi - lo), keep)
                col = top.ravel()
                ok = best[rows, col] >= far
                rows, col = rows[ok], col[ok]
                other = np.where(col < reach, rows + col + 1, rows - (col - reach) - 1)
                left.append(ids[lo + rows])
                right.append(ids[lo + other])
                sims.append(best[rows, col])
            if left:
                a, b, s = np.concatenate(left), np.concatenate(right), np.concatenate(sims)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a])), pa.array(np.concatenate([s, s]))], names=["a", "b", "sim"])

    keyed = nodes.select("id", "vec").mapInArrow(released(project), "tab long, bucket long, place double, id long, vec binary")
    dealt = keyed.repartitionByRange("tab", "bucket", "place").sortWithinPartitions("tab", "bucket", "place")
    return dealt.mapInArrow(released(neighbours), "a long, b long, sim double").where("a <> b")


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node's pairs (a, b, sim, new); a pair that was there before is not new."""
    once = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def descend(lists: DataFrame, nodes: DataFrame, kind: str, k: int, far: float) -> DataFrame:
    """One round: neighbours of a node meet, and what beats the end of a list (at least ``far``) enters it."""
    ends = lists.groupBy("a").agg(F.min("sim").alias("low"), F.count(F.lit(1)).alias("n")).select(F.col("a").alias("id"), F.when(F.col("n") >= k, F.col("low")).otherwise(far).alias("low"))
    known = nodes.select("id", "vec").join(ends, "id", "left").select(F.col("id").alias("b"), "vec", F.coalesce("low", F.lit(far)).alias("low"))
    back = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("new"), F.desc("sim"), "a"))
    reverse = lists.withColumn("back", back).where(F.col("back") <= k).select(F.col("b").alias("a"), F.col("a").alias("b"), "new")
    around = lists.select("a", "b", "new").unionByName(reverse).groupBy("a", "b").agg(F.max("new").alias("new"))
    fresh = F.max("new").over(Window.partitionBy("a")) & (F.count(F.lit(1)).over(Window.partitionBy("a")) > 1)
    around = around.withColumn("fresh", fresh).where("fresh").drop("fresh")  # vectors go to nodes with something new only

    def meet(rows: pa.Table) -> pa.RecordBatch | None:
        new = rows.column("new").to_numpy()
        if not new.any() or len(new) < 2:
            return None
        raw = [x.as_buffer() for x in rows.column("vec")]
        if len({len(x) for x in raw}) > 1:
            return None
        x, ids, low = unit(raw, kind), rows.column("b").to_numpy(), rows.column("low").to_numpy()
        sim = x @ x.T
        np.fill_diagonal(sim, -3)
        i, j = np.nonzero((sim > low[:, None]) & (new[:, None] | new[None, :]))
        if not len(i):
            return None
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j]), pa.array(sim[i, j])], names=["a", "b", "sim"])

    met = stream_groups(around.join(known, "b"), ["a"], meet, "a long, b long, sim double")
    pairs = lists.select("a", "b", "sim", F.lit(False).alias("new")).unionByName(met.withColumn("new", F.lit(True)))
    return nearest(pairs, k)


def block_links(members: DataFrame, kind: str, threshold: float, block: int) -> DataFrame:
    """(id, links) of the members (comp, id, vec, weight) of components whose lists were saturated."""
    spark = members.sparkSession
    half = float(np.cos(np.arccos(threshold) / 2)) + 1e-12
    first = members.groupBy("comp").agg(F.min_by("vec", "id").alias("pivot"))

    def angle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = [len(v.as_buffer()) == len(p.as_buffer()) and float((unit([v.as_buffer()], kind) @ unit([p.as_buffer()], kind).T)[0, 0]) >= half for v, p in zip(batch.column("vec"), batch.column("pivot"), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("comp", "id", "vec", "weight")), pa.array(core, pa.bool_())], names=["comp", "id", "vec", "weight", "core"])

    cored = materialise(members.join(first, "comp").select("comp", "id", "vec", "weight", "pivot").mapInArrow(released(angle), "comp long, id long, vec binary, weight long, core boolean"), "vector-cores")
    counts = cored.groupBy("comp").agg(F.sum(F.when(F.col("core"), F.col("weight")).otherwise(0)).alias("core_weight"), F.count_if("core").alias("n_core"), F.count_if(~F.col("core")).alias("n_rest"))
    sized = cored.join(counts, "comp")
    inner = sized.where("core").select("id", (F.col("core_weight") - F.col("weight")).alias("links"))
    blocks = lambda n: F.ceil(F.col(n) / F.lit(float(block))).cast("int")
    part = sized.where("n_rest > 0").withColumns({"rests": blocks("n_rest"), "cores": blocks("n_core")})
    own = F.pmod(F.xxhash64("id"), F.when(F.col("core"), F.col("cores")).otherwise(F.col("rests")).cast("long")).cast("int")
    part = part.withColumn("own", F.when(F.col("core"), own + F.col("rests")).otherwise(own))
    part = part.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("core"), F.col("rests")).otherwise(F.col("rests") + F.col("cores")) - 1)))
    part = part.select("comp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "id", "vec", "weight")

    def count(rows: pa.Table) -> pa.RecordBatch | None:
        own, w, ids = rows.column("own").to_numpy(), rows.column("weight").to_numpy(), rows.column("id").to_numpy()
        raw = [x.as_buffer() for x in rows.column("vec")]
        lo, hi = rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py()
        links = np.zeros(len(ids), np.int64)
        for wide in {len(x) for x in raw}:
            at = np.array([i for i, x in enumerate(raw) if len(x) == wide])
            x = unit([raw[i] for i in at], kind)
            near = (x @ x.T >= threshold) & (ids[at][:, None] != ids[at][None, :])
            if lo != hi:
                near &= own[at][:, None] != own[at][None, :]
            links[at] += near @ w[at]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], names=["id", "links"])

    outer = stream_groups(part, ["comp", "lo", "hi"], count, "id long, links long", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return inner.unionByName(outer).groupBy("id").agg(F.sum("links").alias("links"))


def crossing(members: DataFrame, kind: str, threshold: float, block: int) -> DataFrame:
    """Pairs (a, b) of ids of members (comp, id, vec) that join all components between which a link exists.

    A link between two components needs pivots within both radii and the threshold's angle.  Pivots meet in pairs of
    blocks; of those that are links themselves a spanning forest is kept.  Components that are near enough and not
    joined by it have their members compared, also in pairs of blocks.  The work grows with the square of the number
    of components.
    """
    spark = members.sparkSession
    members = materialise(members.select("comp", "id", "vec"), "vector-crossing")
    first = members.groupBy("comp").agg(F.min_by("vec", "id").alias("pivot"), F.min("id").alias("pid"))

    def angle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, pivot = batch.column("vec"), batch.column("pivot")
            cos = [float((unit([v.as_buffer()], kind) * unit([p.as_buffer()], kind)).sum()) for v, p in zip(raw, pivot, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("comp"), pa.array(np.arccos(np.clip(cos, -1, 1)), pa.float64())], names=["comp", "angle"])

    radius = members.join(first, "comp").select("comp", "vec", "pivot").mapInArrow(released(angle), "comp long, angle double").groupBy("comp").agg(F.max("angle").alias("radius"))
    size = members.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    balls = materialise(first.join(radius, "comp").join(size, "comp").withColumn("all", F.lit(0)), "vector-balls")
    n = balls.count()
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    dealt = lambda df: block_pairs(df, "all", "comp", F.lit(n), block)
    reach = float(np.arccos(threshold)) + 1e-6  # arc cosines near 1 lose half of the digits

    def meet(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of the pivots of one length of a pair of blocks and their cosines, each pair once, strip by strip."""
        own, raw = rows.column("_own").to_numpy(), [x.as_buffer() for x in rows.column("pivot")]
        cross = rows.column("_lo")[0].as_py() != rows.column("_hi")[0].as_py()
        for wide in {len(x) for x in raw}:
            at = np.array([i for i, x in enumerate(raw) if len(x) == wide])
            x = unit([raw[i] for i in at], kind)
            left, right = (np.flatnonzero(own[at] == own[0]), np.flatnonzero(own[at] != own[0])) if cross else (np.arange(len(at)),) * 2
            for k in range(0, len(left), 256):
                part = left[k : k + 256]
                sim = x[part] @ x[right].T
                if not cross:
                    sim[part[:, None] >= right[None, :]] = -3
                yield at[part], at[right], sim

    def linked(rows: pa.Table) -> pa.RecordBatch | None:
        ids, a, b = rows.column("pid").to_numpy(), [], []
        for left, right, sim in meet(rows):
            i, j = np.nonzero(sim >= threshold)
            a.append(left[i])
            b.append(right[j])
        a, b = forest(ids, np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keys = ["all", "_lo", "_hi"]
    joined = materialise(stream_groups(dealt(balls.select("all", "comp", "pid", "pivot")), keys, linked, "a long, b long", partitions(spark)), "vector-crossing")
    group = components(joined).select(F.col("node").alias("pid"), F.col("component").alias("joined"))
    grouped = materialise(balls.join(group, "pid", "left").withColumn("joined", F.coalesce("joined", "pid")), "vector-balls")

    def close(rows: pa.Table) -> pa.RecordBatch | None:
        comp, joined, radius = (rows.column(c).to_numpy() for c in ("comp", "joined", "radius"))
        a, b = [], []
        for left, right, sim in meet(rows):
            far = np.minimum(radius[left][:, None] + radius[right][None, :] + reach, np.pi)
            i, j = np.nonzero((sim > -3) & (sim >= np.cos(far) - 1e-9) & (joined[left][:, None] != joined[right][None, :]))
            a.append(comp[left[i]])
            b.append(comp[right[j]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], names=["c", "d"])

    parted = dealt(grouped.select("all", "comp", "pivot", "radius", "joined"))
    maybe = materialise(stream_groups(parted, keys, close, "c long, d long", partitions(spark)), "vector-close")
    blocks = lambda c: F.ceil(F.col(c) / F.lit(float(block))).cast("int")
    maybe = maybe.join(size.select(F.col("comp").alias("c"), blocks("n").alias("cs")), "c").join(size.select(F.col("comp").alias("d"), blocks("n").alias("ds")), "d")
    side = lambda c, n: members.withColumnRenamed("comp", c).join(maybe, c).withColumn("own", F.pmod(F.xxhash64("id"), F.col(n).cast("long")).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = side("c", "cs").withColumn("other", every("ds")).select("c", "d", F.col("own").alias("lo"), F.col("other").alias("hi"), F.lit(True).alias("first"), "id", "vec")
    two = side("d", "ds").withColumn("other", every("cs")).select("c", "d", F.col("other").alias("lo"), F.col("own").alias("hi"), F.lit(False).alias("first"), "id", "vec")

    def any_link(rows: pa.Table) -> pa.RecordBatch | None:
        ids, is_first = rows.column("id").to_numpy(), rows.column("first").to_numpy(zero_copy_only=False)
        if is_first.all() or not is_first.any():
            return None
        x = unit(rows.column("vec"), kind)
        sim = x[is_first] @ x[~is_first].T
        i, j = np.unravel_index(int(sim.argmax()), sim.shape)
        if sim[i, j] < threshold:
            return None
        return pa.RecordBatch.from_arrays([pa.array(ids[is_first][[i]]), pa.array(ids[~is_first][[j]])], names=["a", "b"])

    met = stream_groups(one.unionByName(two), ["c", "d", "lo", "hi"], any_link, "a long, b long", partitions(spark))
    return materialise(joined.unionByName(met), "vector-crossing")


def audit(nodes: DataFrame, links: DataFrame, asked: DataFrame, wide: DataFrame, kind: str, threshold: float, block_bytes: int = 1 << 24) -> dict:
    """Recall of the nodes asked (id), each compared with every node: found and true links, and the worst class.

    A class has the nodes whose numbers of links have the same number of binary digits and that are in a saturated
    component (wide: id) or not, so that neither large groups nor those counted exactly hide others; its recall is the
    mean of its nodes'.  The nodes asked are sent out in blocks of bounded size, one scan of the nodes for each.
    """
    asked = materialise(nodes.join(asked, "id", "left_semi").select("id", "vec"), "vector-asked")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vec")).alias("wide")).first()
    if not size["n"]:
        return {"found": 0, "true": 0, "recall": 1.0, "worst": 1.0, "asked": 0}
    blocks, counted = -(-size["n"] * size["wide"] // block_bytes), []
    for k in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()
        by_wide: dict[int, list[int]] = {}
        for i, r in enumerate(some):
            by_wide.setdefault(len(r["vec"]), []).append(i)
        queries = {w: (np.array([some[i]["id"] for i in at]), unit([bytes(some[i]["vec"]) for i in at], kind)) for w, at in by_wide.items()}

        def compare(batches: Iterator[pa.RecordBatch], queries: dict = queries) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, ids, w = [x.as_buffer() for x in batch.column("vec")], batch.column("id").to_numpy(), batch.column("weight").to_numpy()
                lens = np.array([len(x) for x in raw], dtype=np.int64)
                for wide_, (qid, q) in queries.items():
                    at, total = np.flatnonzero(lens == wide_), np.zeros(len(qid), np.int64)
                    for lo in range(0, len(at), 2048):
                        part = at[lo : lo + 2048]
                        x = unit([raw[i] for i in part], kind)
                        for c in range(0, len(qid), 2048):
                            near = (q[c : c + 2048] @ x.T >= threshold) & (qid[c : c + 2048, None] != ids[part][None, :])
                            total[c : c + 2048] += near @ w[part]
                    yield pa.RecordBatch.from_arrays([pa.array(qid), pa.array(total)], names=["id", "n"])

        counted.append(materialise(nodes.select("id", "vec", "weight").mapInArrow(released(compare), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")), "vector-audit"))
    true = reduce(DataFrame.unionByName, counted).where("n > 0")
    seen = true.join(links, "id", "left").join(wide.select("id", F.lit(True).alias("wide")), "id", "left").withColumn("got", F.least("n", F.coalesce("links", F.lit(0))))
    classes = seen.groupBy(F.floor(F.log2("n")).alias("digits"), F.coalesce("wide", F.lit(False)).alias("wide")).agg(F.sum("got").alias("got"), F.sum("n").alias("n"), F.avg(F.col("got") / F.col("n")).alias("mean"))
    rows = classes.collect()  # 64 classes of each kind at most
    found, every = sum(r["got"] for r in rows), sum(r["n"] for r in rows)
    return {"found": found, "true": every, "recall": found / every if every else 1.0, "worst": min((r["mean"] for r in rows), default=1.0), "asked": size["n"]}


def _members(comp: DataFrame, nodes: DataFrame) -> DataFrame:
    return materialise(comp.select(F.col("component").alias("comp"), F.col("node").alias("id")).join(nodes, "id"), "vector-members")


def near_vectors(
    emb: DataFrame, threshold: float = 0.95, k: int = 12, tables: int | None = None, rounds: int = 3, target: float = 0.98, block: int = 1024, every: int = 50, report: dict | None = None
) -> DataFrame:
    """One row per row of emb (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the other rows whose cosine (double precision) is at least threshold, among the pairs found; if the
    audit (of the ids divisible by ``every``) stays below target, all pairs are found.  Null and zero vectors and those
    with null or non-finite components link with nothing, and neither do vectors of different length.  Rows that share
    a vec_id share links and component; null ids are one id, the smallest, shown as null.  An empty table gives an
    empty result; other columns, whatever their names, are not read.  ``tables`` defaults to what the threshold and the
    number of vectors ask for.  ``report`` gets the audited recall, that of the worst class of nodes, how many were
    asked, and whether every pair was compared.
    """
    kind = "f4" if isinstance(emb.schema["embedding"].dataType.elementType, T.FloatType) else "f8"
    rows = materialise(usable(emb, kind).withColumn("key", F.unhex(F.sha2("vec", 256))), "vectors")
    led = materialise(with_leaders(rows.select("key", "id"), ["key"], F.col("id")).select("id", "key", "leader", "group_size"), "vector-copies")
    mine = led.where("id = leader").select("id", "key", F.col("group_size").alias("weight")).distinct()
    nodes = materialise(rows.distinct().join(mine, ["id", "key"]).select("id", "vec", "weight"), "vector-nodes")
    n = nodes.count()
    bits = int(np.clip(np.round(np.log2(max(n, 1) / 12)), 1, 40))
    angle = float(np.arccos(threshold))
    far = float(np.cos(min(3 * angle, np.pi)))
    meet = (1 - angle / np.pi) ** bits  # the chance that two vectors at the threshold share a bucket
    tables = tables or max(4, int(np.ceil(np.log(0.01) / np.log1p(-min(meet, 0.99)))))
    asked = materialise(led.where(F.pmod("id", F.lit(every)) == 0).select(F.col("leader").alias("id")).distinct(), "vector-asked")
    links, comp, lists = None, None, None
    for attempt in range(3):
        fresh = first_lists(nodes, kind, range(attempt * tables, (attempt + 1) * tables), bits, far).withColumn("new", F.lit(True))
        if lists is not None:
            fresh = fresh.unionByName(lists.select("a", "b", "sim", F.lit(False).alias("new")))
        lists = materialise(nearest(fresh, k), "vector-lists")
        for _ in range(rounds):
            lists = materialise(descend(lists, nodes, kind, k, far), "vector-lists")
            if lists.where("new").count() <= 0.02 * lists.count():
                break
        near = lists.where(F.col("sim") >= threshold)
        full = materialise(near.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select(F.col("a").alias("node")), "vector-full")
        comp = materialise(components(near.select("a", "b")), "vector-components")
        ends = comp.join(full, "node").select(F.col("component").alias("comp"), F.col("node").alias("id")).join(nodes, "id")
        more = crossing(ends, kind, threshold, block)
        if not more.isEmpty():
            comp = materialise(components(near.select("a", "b").unionByName(more)), "vector-components")
        wide = materialise(comp.join(full, "node", "left_semi").select("component").distinct(), "vector-saturated")
        pairs = near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        pairs = pairs.join(comp.join(wide, "component", "left_anti").select(F.col("node").alias("a")), "a")
        few = pairs.join(nodes.select(F.col("id").alias("b"), "weight"), "b").groupBy("a").agg(F.sum("weight").alias("links")).select(F.col("a").alias("id"), "links")
        links = materialise(few.unionByName(block_links(_members(comp.join(wide, "component"), nodes), kind, threshold, block)), "vector-links")
        seen = audit(nodes, links, asked, comp.join(wide, "component").select(F.col("node").alias("id")), kind, threshold)
        good = seen["recall"] >= target and seen["worst"] >= target
        if report is not None:
            report.update(seen, attempts=attempt + 1, exact=not good and attempt == 2)
        if good:
            break
    else:
        balls = nodes.join(comp.withColumnRenamed("node", "id"), "id", "left").select(F.coalesce("component", "id").alias("comp"), "id", "vec")
        comp = materialise(components(near.select("a", "b").unionByName(crossing(balls, kind, threshold, block))), "vector-components")
        links = materialise(block_links(_members(comp, nodes), kind, threshold, block), "vector-links")
    # a written table, so that both sides of the join have an exchange of their own: a leader of very many rows can be
    # split at run time only then
    told = comp.select(F.col("node").alias("leader"), "component").join(links.select(F.col("id").alias("leader"), "links"), "leader", "full")
    own = led.join(materialise(told, "vector-told"), "leader", "left")
    own = own.groupBy("id").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("group_size") - 1).alias("links"), F.min(F.coalesce("component", "leader")).alias("component"))
    out = emb.select("vec_id", F.coalesce("vec_id", F.lit(NO_ID)).alias("id")).join(own, "id", "left")
    component = F.coalesce("component", "id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.nullif(component, F.lit(NO_ID)).alias("component_id"), (component == F.col("id")).alias("kept"))
