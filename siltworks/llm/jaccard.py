"""N-gram Jaccard join with Bayesian candidate pruning.

1. Documents become sets of ``gram``-word shingles and a MinHash signature.  Equal word sequences are one node.
2. Nodes that agree in a band of the signature are candidates.  In a band's bucket pairs are compared MinHash by
   MinHash: after each step a pair is dropped when the posterior probability (uniform prior) that its similarity
   reaches the threshold is below the tolerance.  Of what survives, only a spanning forest leaves the task.
3. The forests' components are the possible classes.  Inside each, candidates (a common band) are pruned in the same
   way and the rest verified exactly on the shingle sets; links are counted and a spanning forest of them is kept.

Buckets and classes are dealt to pairs of blocks, so a task holds two blocks of a group, however large it is, and
pairs never leave a task; what leaves is linear in the number of members of a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, materialise, partitions, released, stream_groups, with_leaders
from .graph import components
from .textops import Chunk, chunks, grams, run_hashes, within

_U = np.uint64
NO_ID = -(2**63)  # ids from here on stand for null doc_ids inside, one for each text
NO_IDS = 1 << 60


def inner_id() -> Column:
    return F.coalesce("doc_id", F.lit(NO_ID) + F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(NO_IDS)))


def outer_id(x: Column) -> Column:
    return F.when(x >= F.lit(NO_ID + NO_IDS), x)


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest of n equal MinHash values with which a similarity >= threshold still has posterior >= tolerance.

    With a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1), whose upper tail at t is the
    probability of at most m successes in n + 1 trials of chance t.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, tolerance: float, step: int) -> np.ndarray:
    """Which pairs (i, j) of signatures are not pruned, comparing ``step`` more values each time."""
    live, same = np.arange(len(i)), np.zeros(len(i), np.int64)
    for k in range(0, sig.shape[1], step):
        same = same + (sig[i[live], k : k + step] == sig[j[live], k : k + step]).sum(axis=1)
        keep = same >= least_matches(min(k + step, sig.shape[1]), threshold, tolerance)
        live, same = live[keep], same[keep]
    return live


def shingles(c: Chunk, h: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different (document, shingle) rows of a chunk.  A text of fewer words is one shingle; none of 0 words."""
    n = np.diff(c.bounds)
    g = grams(h, gram)
    at = np.flatnonzero(within(c.bounds, gram)[: len(g)])
    short = np.flatnonzero((n > 0) & (n < gram))
    doc = np.concatenate([np.searchsorted(c.bounds, at, "right") - 1, short])
    sh = np.concatenate([g[at], run_hashes(h, c.bounds[short], c.bounds[short + 1], base=0xA24BAED4963EE407)])
    order = np.lexsort((sh, doc))
    doc, sh = doc[order], sh[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (sh[1:] != sh[:-1])
    return doc[new], sh[new]


def sketches(docs: DataFrame, gram: int, hashes: int) -> DataFrame:
    """doc, k1, k2 (128 bits of the word sequence), sig of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = np.random.default_rng(20_240_501).integers(0, 2**63, hashes, dtype=np.uint64) * _U(2) + _U(1)
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            for c in chunks(batch.column("text")):
                h = c.hashes()
                doc, sh = shingles(c, h, gram)
                own, first = np.unique(doc, return_index=True)
                sig = np.zeros((c.size, hashes), np.uint32)
                for k in range(hashes):
                    if len(sh):
                        v = sh * mult[k]
                        v ^= v >> _U(29)
                        sig[own, k] = np.minimum.reduceat((v >> _U(16)).astype(np.uint32), first)
                k1 = run_hashes(h, c.bounds[:-1], c.bounds[1:])
                k2 = run_hashes(h, c.bounds[:-1], c.bounds[1:], base=0xD1342543DE82EF95)
                flat = pa.py_buffer(sig.tobytes())
                sigs = pa.Array.from_buffers(pa.binary(), c.size, [None, pa.py_buffer((np.arange(c.size + 1) * 4 * hashes).astype(np.int32).tobytes()), flat])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[c.first : c.first + c.size]), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(np.diff(c.bounds).astype(np.int64)), sigs],
                    names=["doc", "k1", "k2", "words", "sig"],
                )

    return docs.select(inner_id().alias("doc"), "text").mapInArrow(released(run), "doc long, k1 long, k2 long, words long, sig binary")


def forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges (of ids) that span what the pairs i, j (places) connect: each id with the smallest that it reaches."""
    names, place = np.unique(ids, return_inverse=True)
    i, j, up = place[i], place[j], np.arange(len(names))
    while len(i):  # hook the larger root on the smaller, then shorten, until all pairs agree
        a, b = up[i], up[j]
        hi, lo = np.maximum(a, b), np.minimum(a, b)
        diff = hi != lo
        if not diff.any():
            break
        np.minimum.at(up, hi[diff], lo[diff])
        while (up[up] != up).any():
            up = up[up]
    at = np.flatnonzero(up != np.arange(len(names)))
    return names[at].tolist(), names[up[at]].tolist()


class Joined:
    """Sets of places (0 .. n - 1) that pairs have joined so far."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.root[left][:, None] != self.root[right][None, :]

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            diff = hi != lo
            if not diff.any():
                return
            np.minimum.at(self.root, hi[diff], lo[diff])
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def _candidates(rows: pa.Table, sig: np.ndarray, bands: int, own_only: bool, joined: Joined | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places to compare in a pair of blocks, a strip of rows at a time; with own_only, those with a common band.

    With joined, pairs that it already has in one set are left out; the caller adds to it after each strip.  The first
    strip is a single row, so most of a group of near copies is joined before any other two of it are compared.
    """
    own = rows.column("_own").to_numpy()
    cross = rows.column("_lo")[0].as_py() != rows.column("_hi")[0].as_py()
    left = np.flatnonzero(own == own[0]) if cross else np.arange(len(own))
    right = np.flatnonzero(own != own[0]) if cross else np.arange(len(own))
    wide = sig.shape[1] // bands
    key = sig.reshape(len(sig), bands, wide).astype(np.uint64)
    key = (key * np.random.default_rng(3).integers(1, 2**63, wide, dtype=np.uint64)).sum(axis=2)
    for lo, hi in zip([0, *range(1, len(left), 64)], [1, *range(65, len(left) + 64, 64)], strict=False):
        part = left[lo:hi]
        ok = np.zeros((len(part), len(right)), bool)
        if own_only:
            for b in range(bands):
                ok |= key[part, b][:, None] == key[right, b][None, :]
        else:
            ok[:] = True
        if not cross:
            ok &= part[:, None] < right[None, :]
        if joined is not None:
            ok &= joined.apart(part, right)
        i, j = np.nonzero(ok)
        if len(i):
            yield part[i], right[j]


def _sig(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in rows.column("sig")), np.uint32).reshape(rows.num_rows, -1)


def jaccard_classes(docs: DataFrame, **options) -> DataFrame:
    """similar(docs, ...) without its inner ids: doc_id, class_id, n_links, kept of each row of docs."""
    return similar(docs, **options).drop("inner")


def similar(docs: DataFrame, threshold: float = 0.8, gram: int = 5, bands: int = 24, band_rows: int = 4, tolerance: float = 1e-5, step: int = 16, block: int = 512, count: bool = True) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, class_id, n_links, kept, inner (an id that is never null).

    Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``, unchanged; similarity is the Jaccard coefficient of the
    sets of ``gram``-word shingles (a shorter text is one shingle).  class_id is the smallest doc_id that links reach,
    n_links the number of other rows linked directly, kept is doc_id = class_id.  Texts without words (null, empty)
    link with nothing.  Rows that share a doc_id share class and links.  A null id is smaller than any other; rows
    without one are documents of their own if their texts differ, and else share a verdict.  Without ``count`` pairs
    whose class is known are not verified, and n_links is only a lower bound.  Texts are read whole, however long.  An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rows = materialise(sketches(docs, gram, bands * band_rows), "jaccard-sketches")
    led = materialise(with_leaders(rows.where("words > 0").select("k1", "k2", "doc"), ["k1", "k2"], F.col("doc")).select("doc", "k1", "k2", "leader", "group_size"), "jaccard-copies")
    # 2: buckets
    mine = led.where("doc = leader").select("doc", "k1", "k2", F.col("group_size").alias("weight")).distinct()
    nodes = rows.join(mine, ["doc", "k1", "k2"]).dropDuplicates(["doc", "k1", "k2"]).select("doc", "k1", "weight", "sig")
    nodes = materialise(nodes, "jaccard-nodes")
    wide = 4 * band_rows
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", b * wide + 1, wide)) for b in range(bands)])
    member = nodes.select("doc", "k1", F.explode(keys).alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = member.join(shared, "bucket").join(nodes.select("doc", "k1", "sig"), ["doc", "k1"])

    def prune(rows: pa.Table) -> pa.RecordBatch | None:
        ids, sig = rows.column("doc").to_numpy(), _sig(rows)
        a, b, joined = [], [], Joined(len(ids))
        for i, j in _candidates(rows, sig, bands, own_only=False, joined=joined):
            live = surviving(sig, i, j, threshold, tolerance, step)
            joined.add(i[live], j[live])
            a.append(i[live])
            b.append(j[live])
        if not a:
            return None
        a, b = forest(ids, np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    parts = block_pairs(dealt, "bucket", "k1", F.col("n"), block)
    maybe = stream_groups(parts.select("bucket", "_lo", "_hi", "_own", "doc", "sig"), ["bucket", "_lo", "_hi"], prune, "a long, b long", partitions(spark))
    near = materialise(components(maybe), "jaccard-candidates")
    # 3: verification
    size = near.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    full = nodes.join(near.join(size, "component").select(F.col("node").alias("doc"), "component", "n"), "doc")
    wanted = full.select("doc", "k1", "weight", "component", "n", "sig")
    texts = docs.select(inner_id().alias("doc"), "text").join(wanted, "doc")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1 = batch.column("k1").to_numpy()
            for c in chunks(batch.column("text")):
                h = c.hashes()
                doc, sh = shingles(c, h, gram)
                at = np.searchsorted(doc, np.arange(c.size + 1))
                own = run_hashes(h, c.bounds[:-1], c.bounds[1:]).view(np.int64)
                keep = np.flatnonzero(own == k1[c.first : c.first + c.size])  # a row of this id with another text is not this node
                some = batch.slice(c.first, c.size).take(pa.array(keep))
                sets = [sh[at[i] : at[i + 1]].tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays([*(some.column(x) for x in ("doc", "k1", "weight", "component", "n", "sig")), pa.array(sets, pa.binary())], names=["doc", "k1", "weight", "component", "n", "sig", "sh"])

    sets = texts.mapInArrow(released(shingled), "doc long, k1 long, weight long, component long, n long, sig binary, sh binary")
    parts = block_pairs(sets.dropDuplicates(["doc", "k1"]), "component", "k1", F.col("n"), block)

    def verify(rows: pa.Table) -> pa.RecordBatch | None:
        ids, weight, sig = rows.column("doc").to_numpy(), rows.column("weight").to_numpy(), _sig(rows)
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("sh")]
        lens = np.array([len(x) for x in own])
        flat = np.unique(np.concatenate(own), return_inverse=True)[1]
        start = np.cumsum(lens) - lens
        mark, links, a, b = np.zeros(int(flat.max()) + 1 if len(flat) else 1, bool), np.zeros(len(ids), np.int64), [], []
        joined = None if count else Joined(len(ids))
        for i, j in _candidates(rows, sig, bands, own_only=True, joined=joined):
            live = surviving(sig, i, j, threshold, tolerance, step)
            i, j = i[live], j[live]
            ok = np.minimum(lens[i], lens[j]) >= threshold * np.maximum(lens[i], lens[j]) - 1e-9
            i, j = i[ok], j[ok]
            for x in np.unique(i):
                y = j[i == x]
                mark[flat[start[x] : start[x] + lens[x]]] = True
                n = lens[y]
                at = np.repeat(start[y] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.add.reduceat(mark[flat[at]].astype(np.int64), np.cumsum(n) - n)
                mark[flat[start[x] : start[x] + lens[x]]] = False
                y = y[(both >= threshold * (lens[x] + n - both) - 1e-9) & (ids[y] != ids[x])]
                if joined is not None:
                    joined.add(np.full(len(y), x), y)
                links[x] += weight[y].sum()
                links[y] += weight[x]
                a.append(np.full(len(y), x))
                b.append(y)
        if not a:
            return None
        hit = np.flatnonzero(links)
        s, t = forest(ids, np.concatenate(a), np.concatenate(b))
        left = np.concatenate([ids[hit], np.array(s, np.int64)])
        right = np.concatenate([ids[hit], np.array(t, np.int64)])
        number = np.concatenate([links[hit], np.zeros(len(s), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), pa.array(number)], names=["a", "b", "links"])

    found = stream_groups(parts.select("component", "_lo", "_hi", "_own", "doc", "weight", "sig", "sh"), ["component", "_lo", "_hi"], verify, "a long, b long, links long", partitions(spark))
    found = materialise(found, "jaccard-links")
    links = found.groupBy("a").agg(F.sum("links").alias("links")).select(F.col("a").alias("leader"), "links")
    classes = components(found.select("a", "b")).select(F.col("node").alias("leader"), "component")
    # a written table, so that both sides of the join have an exchange of their own: a leader of very many rows can be
    # split at run time only then
    told = materialise(classes.join(links, "leader", "full"), "jaccard-classes")
    own = led.join(told, "leader", "left")
    own = own.groupBy("doc").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("group_size") - 1).alias("links"), F.min(F.coalesce("component", "leader")).alias("component"))
    out = docs.select("doc_id", inner_id().alias("doc")).join(own, "doc", "left")
    component = F.coalesce("component", "doc")
    return out.select("doc_id", outer_id(component).alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), (component == F.col("doc")).alias("kept"), F.col("doc").alias("inner"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs whose document stays (the smallest id of its class), all columns as they were.

    Of rows that repeat id and text all stay: exact dedup is a stage of its own.
    """
    kept = similar(docs, count=False, **options).where("kept").select(F.col("inner").alias("_id")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), inner_id().alias("_id"))
    return rows.join(kept, "_id", "left_semi").select("_row.*")
