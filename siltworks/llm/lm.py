"""LM scoring: stupid-backoff scores from n-gram count tables, computed relationally.

1. Documents are gathered into blocks where they are read: a block is some megabytes of whole texts, compressed, and
   at least one document.  Blocks are a written table; memory follows the block, not the corpus or the partition.
2. For each n the texts of a block are exploded to n-grams and counted in the block.  The count tables are
   partitioned by the n-gram's hash: all blocks' counts of a range of hashes meet in one group, which gives each n-gram
   its count in the corpus.  The number of ranges grows with the words, so a group holds about ``range_words`` n-grams.
   Each n is a job of its own, whose shuffle files are dropped before the next.
3. The counts go back to the blocks, where they are joined to the exploded n-grams of each document and summed.

A table's rows of one block and one range travel as one row: sorted hashes as differences, bytes in planes, compressed,
at about six bytes an n-gram; as rows of their own they would take twice that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import even_labels, materialise, partitions, released, stream_groups
from .textops import Chunk, buffers, grams, spans, within

_U = np.uint64
BLOCKS = "block long, ids array<long>, sizes binary, texts binary, words long"
TABLE = "part int, deal int, block long, hashes binary, counts binary"
MOST_TASKS = 16_384


def chunk_of(sizes: bytes, texts: bytes) -> Chunk:
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(texts, max_output_size=int(offsets[-1])) if offsets[-1] else b"", np.uint8)
    starts, ends = spans(data, offsets)
    return Chunk(0, len(offsets) - 1, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def blocks_of(docs: DataFrame, block_bytes: int, most_docs: int = 1 << 16) -> DataFrame:
    """The documents in blocks of whole texts of about block_bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        first, k = (task.partitionId() if task else 0) << 32, 0
        ids, sizes, texts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            lens = np.concatenate(sizes).astype(np.int64)
            raw = b"".join(texts)
            words = len(spans(np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(lens)]))[0])
            packed = zstandard.ZstdCompressor(level=1).compress(raw) if raw else b""
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64()]
            values = [first + k, ids, lens.tobytes(), packed, words]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=[x.split()[0] for x in BLOCKS.split(", ")])

        for batch in batches:
            data, at = buffers(batch.column("text"))
            own, i = batch.column("doc_id").to_pylist(), 0
            while i < batch.num_rows:
                j = max(int(np.searchsorted(at, at[i] + block_bytes - held, "right")) - 1, i + (not ids))
                j = min(j, i + most_docs - len(ids))
                ids += own[i:j]
                sizes.append(np.diff(at[i : j + 1]))
                texts.append(data[at[i] : at[j]].tobytes())
                held += int(at[j] - at[i])
                if j < batch.num_rows or held >= block_bytes:
                    yield flush()
                    k, ids, sizes, texts, held = k + 1, [], [], [], 0
                i = j
        if ids:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(released(run), BLOCKS)


def exploded(c: Chunk, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the chunk's n-grams (h: its words') and the places of their first words."""
    if n == 1:
        return h, np.arange(len(h))
    at = np.flatnonzero(within(c.bounds, n)[: max(len(h) - n + 1, 0)])
    return grams(h, n)[at], at


def squeezed(values: np.ndarray, ascending: bool) -> bytes:
    """64-bit whole numbers as bytes, those in order as differences."""
    v = values.view(np.uint64)
    v = np.diff(v, prepend=_U(0)) if ascending else v
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T).tobytes())


def stretched(data: bytes, ascending: bool) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    v = np.ascontiguousarray(raw.T).view(np.uint64).ravel()
    return np.cumsum(v, dtype=np.uint64) if ascending else v.view(np.int64)


def count_in_blocks(blocks: DataFrame, n: int, parts: int) -> DataFrame:
    """The n-grams of each block with their counts there, in ``parts`` ranges of hashes."""
    edges = np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64)
    deal = np.array(even_labels(blocks.sparkSession, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, sizes, texts in zip(batch.column("block").to_pylist(), batch.column("sizes"), batch.column("texts"), strict=True):
                c = chunk_of(sizes.as_py(), texts.as_py())
                keys, count = np.unique(exploded(c, c.hashes(), n)[0], return_counts=True)
                cut = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                rows = [(p, int(deal[p]), b, squeezed(keys[x:y], True), squeezed(count[x:y], False)) for p, (x, y) in enumerate(zip(cut, cut[1:], strict=False)) if y > x]
                if rows:
                    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in TABLE.split(", ")])

    return blocks.select("block", "sizes", "texts").mapInArrow(released(run), TABLE)


def count_in_corpus(table: DataFrame, n: int, least: int, parts: int) -> DataFrame:
    """n, part, block, counts: for each row of the table the counts in the corpus, in the order of its hashes.

    N-grams (n > 1) that are rarer than least count 0.  The hashes do not travel back: a block has them.
    """

    def total(rows: pa.Table) -> pa.RecordBatch:
        own = [stretched(x.as_py(), True) for x in rows.column("hashes")]
        keys, inverse = np.unique(np.concatenate(own), return_inverse=True)
        sums = np.bincount(inverse, weights=np.concatenate([stretched(x.as_py(), False) for x in rows.column("counts")]), minlength=len(keys)).astype(np.int64)
        sums[sums < (least if n > 1 else 1)] = 0
        ends, m = np.cumsum([len(k) for k in own]), len(own)
        back = [squeezed(sums[inverse[e - len(k) : e]], False) for k, e in zip(own, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([n] * m, pa.int32()), rows.column("part").combine_chunks(), rows.column("block").combine_chunks(), pa.array(back, pa.binary())], names=["n", "part", "block", "counts"])

    return stream_groups(table, ["deal"], total, "n int, part int, block long, counts binary", min(parts, MOST_TASKS))


def lm_scores(docs: DataFrame, order: int = 3, alpha: float = 0.4, least: int = 2, block_bytes: int = 1 << 23, range_words: int = 1 << 21) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, score (sum of natural logarithms), mean_score.

    Counts cover all documents.  A word after up to order - 1 words of its document scores count / count of the
    context for the longest n-gram seen at least ``least`` times (words: always), times alpha for each step down; a
    word alone scores its share of all words.  Counts include the scored document, so an n-gram is seen elsewhere only
    if it is seen twice; with ``least`` 1 nothing would ever back off and texts that no other shares would score best.
    No words (null, empty): 0, 0.0 and null.  A text longer than a block is a block of its own.  Null and repeated ids
    are documents like others; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    # small row groups: a reader holds the texts of one
    blocks = materialise(blocks_of(docs, block_bytes), "lm-blocks", **{"parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 1})
    words = int(blocks.agg(F.sum("words")).first()[0] or 0)
    parts = max(partitions(spark), -(-words // range_words))
    counts = [materialise(count_in_corpus(count_in_blocks(blocks, n, parts), n, least, parts), "lm-counts") for n in range(1, order + 1)]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        n, part = right.column("n").to_numpy(), right.column("part").to_numpy()
        c = chunk_of(left.column("sizes")[0].as_py(), left.column("texts")[0].as_py())
        h = c.hashes()
        gram, seen = [exploded(c, h, k) for k in range(1, order + 1)], []
        for k in range(1, order + 1):
            own = np.flatnonzero(n == k)
            found = [stretched(right.column("counts")[i].as_py(), False) for i in own[np.argsort(part[own])]]
            inverse = np.unique(gram[k - 1][0], return_inverse=True)[1]
            seen.append(np.concatenate([np.zeros(0, np.int64), *found])[inverse])
        value = np.log(np.maximum(seen[0], 1) / max(words, 1)) + 0.0
        place = np.arange(len(value)) - np.repeat(c.bounds[:-1], np.diff(c.bounds))
        value += np.log(alpha) * np.minimum(place, order - 1)
        for k in range(2, order + 1):  # longer contexts overwrite shorter ones
            at = gram[k - 1][1]
            last = at + k - 1
            ok = seen[k - 1] >= least
            before = np.zeros(len(h) + 1, np.int64)
            before[gram[k - 2][1]] = seen[k - 2]
            down = np.minimum(place[last], order - 1) - (k - 1)
            new = np.log(np.maximum(seen[k - 1], 1) / np.maximum(before[at], 1)) + np.log(alpha) * down
            value[last[ok]] = new[ok]
        m = np.diff(c.bounds)
        s = np.array([value[a:b].sum() for a, b in zip(c.bounds, c.bounds[1:], strict=False)])
        mean = pa.array(np.where(m > 0, s / np.maximum(m, 1), 0.0), mask=m == 0)
        return pa.table([left.column("ids").combine_chunks().flatten(), pa.array(m), pa.array(s, pa.float64()), mean], names=["doc_id", "n_words", "score", "mean_score"])

    tasks = min(parts, MOST_TASKS)  # as many as ranges, so that what a task reads does not grow with the corpus
    counted = reduce(DataFrame.unionByName, counts).repartition(tasks, "block")
    dealt = blocks.select("block", "ids", "sizes", "texts").repartition(tasks, "block")
    return dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(score, "doc_id long, n_words long, score double, mean_score double")
