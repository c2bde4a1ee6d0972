"""Substring dedup: seed and extend over winnowed anchors.

Every window of ``length`` words holds one anchor: the first of its ``gram``-word hashes that is smallest.  Equal
windows have equal anchors at equal places, so anchors are the only seeds that must be joined, about one for every
(length - gram + 2) / 2 words.  An anchor stands for a run of windows (those it is the anchor of); the words of that
run, to the left and to the right, are its context.

1. Seeds: anchors are gathered by (seed hash, context hash); the earliest of each class is kept.  A class is a seed
   extended both ways as far as its windows reach, so all its other members lie in repeats, as a whole.
2. Only seeds with several contexts can begin or end a repeat inside a context.  For the earliest member of each of
   these contexts the windows are compared one by one, by a 128-bit hash of their words' 64-bit hashes.
3. What is left of each document are its earliest windows; every word of any other window lies in a maximal repeat
   of at least ``length`` words that also starts earlier, and goes.

Groups are only ever aggregated (with partial aggregation) or joined by a key of which each side has few rows, so a
passage in a third of all documents makes no hot task.  Nothing is paired with anything but its class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, released
from .textops import Chunk, chunks, grams, mix, run_hashes, within

_U = np.uint64
NO_ID = -(2**63)  # stands for a null doc_id inside


def first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of its first smallest one (by doubling)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    val, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        m = len(val) - step
        right = val[step:] < val[:m]
        val, at, have = np.where(right, val[step:], val[:m]), np.where(right, at[step:], at[:m]), have + step
    return at[:n]


def anchors(chunk: Chunk, hashes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: place of its seed, first and last window; and the seeds' hashes.  Places count over the chunk."""
    seeds = grams(hashes, gram)
    at = first_minima(seeds, length - gram + 1)
    windows = np.flatnonzero(within(chunk.bounds, length)[: len(at)]) if len(at) else np.zeros(0, np.int64)
    if not len(windows):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    own = at[windows]
    new = np.empty(len(own), bool)
    new[0] = True
    new[1:] = (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own)) - 1
    return own[first], windows[first], windows[last], seeds[own[first]]


def classes(hashes: np.ndarray, seed: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Context hashes: the words from the first window's first to the last window's last, and where the seed lies."""
    return mix(run_hashes(hashes, lo, hi + length) + (seed - lo).astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def _once(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Places of the first row of each (doc, keys); rows are in order."""
    order = np.lexsort((np.arange(len(doc)), *keys, doc))
    first = np.ones(len(doc), bool)
    same = doc[order][1:] == doc[order][:-1]
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    first[1:] = ~same
    return np.sort(order[first])


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)


def find_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """seed, context, doc, place of the first anchor of each class in each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            for c in chunks(batch.column("text")):
                h = c.hashes()
                seed, lo, hi, sh = anchors(c, h, length, gram)
                if not len(seed):
                    continue
                ctx = classes(h, seed, lo, hi, length)
                doc = np.searchsorted(c.bounds, seed, "right") - 1
                k = _once(doc, ctx, sh)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sh[k].view(np.int64)), pa.array(ctx[k].view(np.int64)), pa.array(ids[c.first + doc[k]]), pa.array((seed - c.bounds[doc])[k].astype(np.int32))],
                    names=["seed", "context", "doc", "place"],
                )

    return docs.mapInArrow(released(run), "seed long not null, context long not null, doc long not null, place int not null")


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    for x in column:
        yield np.sort(np.asarray(x.values)) if x.is_valid else np.zeros(0, np.int32)


def _places(c: Chunk, per_doc: list[np.ndarray]) -> np.ndarray:
    """Places in the chunk of places in its documents."""
    return np.concatenate([np.zeros(0, np.int64), *(c.bounds[i] + per_doc[c.first + i].astype(np.int64) for i in range(c.size))])


def find_windows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """docs with ``mixed`` (places of anchors): a, b (128 bits of each window's words), doc, start; once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, mixed = _ids(batch), list(_lists(batch.column("mixed")))
            for c in chunks(batch.column("text")):
                wanted = _places(c, mixed)
                h = c.hashes()
                seed, lo, hi, _ = anchors(c, h, length, gram)
                own = np.isin(seed, wanted)
                lo, n = lo[own], (hi - lo + 1)[own]
                if not len(lo):
                    continue
                w = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                a, b = run_hashes(h, w, w + length), run_hashes(h, w, w + length, base=0xD1342543DE82EF95)
                doc = np.searchsorted(c.bounds, w, "right") - 1
                k = _once(doc, a, b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[k].view(np.int64)), pa.array(b[k].view(np.int64)), pa.array(ids[c.first + doc[k]]), pa.array((w - c.bounds[doc])[k].astype(np.int32))],
                    names=["a", "b", "doc", "start"],
                )

    return docs.mapInArrow(released(run), "a long, b long, doc long, start int")


def cut(docs: DataFrame, length: int, gram: int, spans: bool) -> DataFrame:
    """docs with ``first`` and ``mixed`` (places of anchors) and ``starts`` (of windows that are the earliest)."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text", "spans"] if spans else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, mixed, starts = (list(_lists(batch.column(x))) for x in ("first", "mixed", "starts"))
            for c in chunks(batch.column("text")):
                h = c.hashes()
                seed, lo, hi, _ = anchors(c, h, length, gram)
                whole = ~np.isin(seed, _places(c, firsts))
                part = np.isin(seed, _places(c, mixed))
                kept = _places(c, starts)
                edge = np.zeros(len(h) + 1, np.int32)
                np.add.at(edge, lo[whole], 1)
                np.add.at(edge, hi[whole] + length, -1)
                n = (hi - lo + 1)[part]
                w = np.repeat(lo[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                w = w[~np.isin(w, kept)]
                np.add.at(edge, w, 1)
                np.add.at(edge, w + length, -1)
                stay = np.cumsum(edge)[:-1] == 0
                count = np.diff(c.bounds)
                total = np.concatenate([[0], np.cumsum(~stay)])
                gone = total[c.bounds[1:]] - total[c.bounds[:-1]]
                sums, texts, cuts = [], [], []
                for i in range(c.size):
                    words = c.words_of(i)
                    if gone[i]:
                        keep = stay[c.bounds[i] : c.bounds[i + 1]]
                        words = list(compress(words, keep.tolist()))
                    text = b" ".join(words)
                    sums.append(hashlib.sha256(text).hexdigest())
                    if spans:
                        texts.append(text.decode())
                        flips = np.flatnonzero(np.diff(np.concatenate([[1], stay[c.bounds[i] : c.bounds[i + 1]].astype(np.int8), [1]])))
                        cuts.append(flips.reshape(-1, 2).tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(c.first, c.size), pa.array(count.astype(np.int64)), pa.array(gone.astype(np.int64)), pa.array(sums),
                     *([pa.array(texts, pa.string()), pa.array(cuts, pa.list_(pa.list_(pa.int64())))] if spans else [])],
                    names=names,
                )

    more = ", kept_text string, spans array<array<long>>" if spans else ""
    return docs.mapInArrow(released(run), "doc_id long, n_words long, n_removed long, kept_sha256 string" + more)


def mark_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, place, several) of the earliest anchor of each class, written to the shared folder."""
    firsts = find_anchors(docs, length, gram).groupBy("seed", "context").agg(F.min_by("place", "doc").alias("place"), F.min("doc").alias("doc"))
    # asks for all columns, so that both readers of firsts share one exchange
    several = firsts.where((F.col("place") >= 0) & F.col("doc").isNotNull()).groupBy("seed")
    several = several.agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # the seed again, but a new column to the planner: both sides of the join get an exchange of their own, and only
    # then can a seed with a different context in very many documents be split at run time
    several = several.select(F.when(F.col("n") > 1, F.col("seed")).alias("seed"), F.lit(True).alias("several"))
    marks = firsts.join(several, "seed", "left").select("doc", "place", F.coalesce("several", F.lit(False)).alias("several"))
    return materialise(marks, "substring-anchors")


def substring_dedup(docs: DataFrame, length: int = 20, gram: int = 6, spans: bool = True) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256, and with spans also kept_text
    and the removed spans [from, to) in words.

    Removed is each word in a run of ``length`` words that starts earlier too: in a smaller doc_id, or earlier in the
    same document.  Runs are judged on the input.  Null text has no words; a null doc_id is smaller than any other.
    Rows that share a doc_id and text are one document and share its verdict; of rows that share a doc_id with
    different texts exactly one keeps a shared passage.  Texts are read whole, however long.  An empty table gives an
    empty result; other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    marks = mark_anchors(docs, length, gram)
    keyed = docs.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    mixed = marks.where("several").groupBy("doc").agg(F.collect_list("place").alias("mixed"))
    windows = find_windows(keyed.join(mixed, "doc").select("doc_id", "text", "mixed"), length, gram)
    earliest = windows.groupBy("a", "b").agg(F.min_by("start", "doc").alias("start"), F.min("doc").alias("doc"))
    starts = earliest.groupBy("doc").agg(F.collect_list("start").alias("starts"))
    lists = marks.groupBy("doc").agg(F.collect_list("place").alias("first"), F.collect_list(F.when(F.col("several"), F.col("place"))).alias("mixed"))
    lists = lists.join(starts, "doc", "left")
    return cut(keyed.join(lists.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "first", "mixed", "starts"), length, gram, spans)
