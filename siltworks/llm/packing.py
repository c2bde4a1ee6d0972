"""Packing: vector bin packing by the dot-product heuristic.

Each example is a vector (tokens, segments, loss-bearing tokens), each sequence has a capacity in all three.  The
open sequence takes, of the examples that fit, the one with the largest dot product with what the sequence has left;
where none fits and cutting is allowed, it takes the first part of the longest example, as much as fits.  Shards of
about ``shard_tokens`` (and at most ``shard_docs`` examples) are packed apart, within the task that read them: nothing
is shuffled, memory follows the shard, and a lost task packs the same shards again.  Equal vectors are looked at as
one, so a shard takes steps in the number of its different vectors and sequences, not in the square of its examples.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released
from .textops import Chunk, chunks

_U = np.uint64
MARK = b"\x01"
_LETTER, _STOP, _LOWER = np.zeros(256, bool), np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[[ord(x) for x in ".,;:!?"]] = True
_LOWER[65:91] += 32
_OWN: dict[tuple[str, int], WordTokenizer] = {}  # a worker's, from task to task


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 64
    loss: int = 4096
    cut: bool = True  # may an example be divided over sequences?
    min_piece: int = 1


def pack_vectors(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (example, start, length); every token of every example lies in one piece.

    The loss-bearing tokens of an example count as spread evenly over it (a piece's share is rounded up).  Without
    cut an example beyond a limit is a sequence of its own.  Examples without tokens are left out.
    """
    per = np.where(tokens > 0, loss / np.maximum(tokens, 1), 0.0)
    at = np.zeros(len(tokens), np.int64)
    left = tokens.astype(np.int64).copy()
    out: list[list[tuple[int, int, int]]] = []
    longest = np.minimum(limits.tokens, np.where(per > 0, np.floor(limits.loss / np.maximum(per, 1e-12)), limits.tokens)).astype(np.int64)
    for i in np.flatnonzero(left > longest):
        if not limits.cut:
            out.append([(int(i), 0, int(left[i]))])
            left[i] = 0
            continue
        step = max(1, int(longest[i]))
        while left[i] >= step:
            out.append([(int(i), int(at[i]), step)])
            at[i] += step
            left[i] -= step
    live = np.flatnonzero(left > 0)
    live = live[np.lexsort((live, per[live], -left[live]))]
    # examples that are the same vector are one class, so a step looks at different vectors only
    new = np.ones(len(live), bool)
    new[1:] = (left[live][1:] != left[live][:-1]) | (per[live][1:] != per[live][:-1])
    first = np.flatnonzero(new)
    t, p = left[live[first]].astype(np.float64), per[live[first]]
    held = [live[a:b][::-1].tolist() for a, b in zip(first, np.append(first[1:], len(live)), strict=True)]
    n, dead = len(live), 0
    bearing = np.ceil(t * p)
    count = np.array([len(x) for x in held], np.int64)
    place = {x: k for k, x in enumerate(zip(t.tolist(), p.tolist(), strict=True))}

    def drop_empty() -> None:
        nonlocal t, p, bearing, count, held, place, dead
        stay = np.flatnonzero(count)
        t, p, bearing, count, held, dead = t[stay], p[stay], bearing[stay], count[stay], [held[k] for k in stay], 0
        place = {x: k for k, x in enumerate(zip(t.tolist(), p.tolist(), strict=True))}

    def put_back(i: int, rest: float, share: float) -> None:
        nonlocal t, p, bearing, count, dead
        k = place.get((rest, share))
        if k is None:
            k = place[rest, share] = len(held)
            held.append([])
            t, p, bearing, count = np.append(t, rest), np.append(p, share), np.append(bearing, np.ceil(rest * share)), np.append(count, 0)
            dead += 1
        dead -= count[k] == 0
        held[k].append(i)
        count[k] += 1

    while n:
        if 2 * dead > len(t):
            drop_empty()
        room, seats, bears = limits.tokens, limits.segments, float(limits.loss)
        seq: list[tuple[int, int, int]] = []
        while n and room >= 1 and seats >= 1:
            fits = (count > 0) & (t <= room) & (bearing <= bears)
            if fits.any():
                score = t / limits.tokens * (room / limits.tokens) + seats / limits.segments / limits.segments + bearing / limits.loss * (bears / limits.loss)
                k = int(np.argmax(np.where(fits, score, -1.0)))
                take, loss_, many = int(t[k]), bearing[k], 1
                if count[k] > 1 and t[k] >= t[fits].max() and loss_ >= bearing[fits].max():  # stays the best while it fits
                    many = int(min(count[k], room // take, seats, bears // loss_ if loss_ else count[k]))
                for _ in range(many):
                    i = held[k].pop()
                    seq.append((i, int(at[i]), take))
                    at[i] += take
                count[k] -= many
                dead += count[k] == 0
                n -= many
                room, seats, bears = room - many * take, seats - many, bears - many * loss_
                continue
            k = int(np.argmax(np.where(count > 0, t, -1.0)))
            take = int(min(room, t[k], np.floor(bears / p[k]) if p[k] > 0 else room))
            if not limits.cut or take < limits.min_piece:
                break
            i, share, rest = held[k].pop(), float(p[k]), float(t[k] - take)
            seq.append((i, int(at[i]), take))
            at[i] += take
            room, seats, bears = room - take, seats - 1, bears - np.ceil(take * share)
            count[k] -= 1
            dead += count[k] == 0
            if rest > 0:
                put_back(i, rest, share)
            else:
                n -= 1
        out.append(seq)
    return out


def at_powers(seq: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A sequence cut to lengths that are powers of two, largest first, so that nothing is padded."""
    total, pieces = sum(x[2] for x in seq), list(seq)[::-1]
    while total:
        need = 1 << (total.bit_length() - 1)
        total -= need
        own = []
        while need:
            i, start, n = pieces.pop()
            own.append((i, start, min(n, need)))
            if n > need:
                pieces.append((i, start + need, n - need))
            need -= own[-1][2]
        yield own


class WordTokenizer:
    """A tokenizer whose words never reach over white space, run once per different word.

    Ids are kept in an open hash table of numpy arrays, by a 64-bit hash and, as a check, length and outer bytes of
    the word.  The table holds up to ``most`` words and is then begun anew, so memory does not follow the corpus.
    """

    def __init__(self, path: str, end: int, most: int = 1_500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.own, self.end, self.most = Tokenizer.from_file(path), end, most
        mark = self.ids(MARK.decode())
        if len(mark) != 1:
            raise ValueError("the tokenizer needs an id of its own for the mark between words")
        self.mark = mark[0]
        probe, parts = "Word, wORD. x;Yz!?", ("word", ",", "word", ".", "x", ";", "yz", "!?")
        self.folds = self.ids(probe) == [i for x in parts for i in self.ids(x)]
        self.forget()

    def ids(self, text: str) -> list[int]:
        return self.own.encode(text, add_special_tokens=False).ids

    def forget(self, need: int = 0) -> None:
        self.size = 1 << int(np.ceil(np.log2(max(self.most, need) * 2.5)))
        self.key, self.check, self.word = np.zeros(self.size, np.uint64), np.zeros(self.size, np.uint32), np.full(self.size, -1, np.int32)
        self.flat, self.held, self.known = np.zeros(1 << 16, np.uint32), 0, 0
        self.first, self.count = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def find(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The number of each word, -1 where it is not known."""
        out, live, at = np.full(len(h), -1, np.int32), np.arange(len(h)), (h & _U(self.size - 1)).astype(np.int64)
        while len(live):
            word = self.word[at]
            hit = (self.key[at] == h[live]) & (self.check[at] == check[live]) & (word >= 0)
            out[live[hit]] = word[hit]
            on = ~hit & (word >= 0)
            live, at = live[on], (at[on] + 1) & (self.size - 1)
        return out

    def place(self, h: np.ndarray, check: np.ndarray, number: np.ndarray) -> None:
        """Put in words that differ and are not known; of those that want one slot the last gets it, the others go on."""
        live, at = np.arange(len(h)), (h & _U(self.size - 1)).astype(np.int64)
        while len(live):
            free = self.word[at] < 0
            self.word[at[free]] = number[live[free]]
            mine = self.word[at] == number[live]
            self.key[at[mine]], self.check[at[mine]] = h[live[mine]], check[live[mine]]
            live, at = live[~mine], (at[~mine] + 1) & (self.size - 1)

    def learn(self, words: list[bytes], h: np.ndarray, check: np.ndarray) -> None:
        odd = [k for k, w in enumerate(words) if MARK in w]
        if odd:
            rest = [k for k in range(len(words)) if MARK not in words[k]]
            order = np.array(rest + odd, np.int64)
            words, h, check = [words[k] for k in order], h[order], check[order]
        plain = len(words) - len(odd)
        ids, n = self.together(words[:plain])
        alone = [e.ids for e in self.own.encode_batch_fast([w.decode() for w in words[plain:]], add_special_tokens=False)]
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(alone), np.uint32)])
        n = np.concatenate([n, np.array([len(x) for x in alone], np.int64)])
        for name, need in (("flat", self.held + len(ids)), ("first", self.known + len(n)), ("count", self.known + len(n))):
            own = getattr(self, name)
            if need > len(own):
                setattr(self, name, np.concatenate([own, np.zeros(max(need - len(own), len(own) // 2), own.dtype)]))
        new = slice(self.known, self.known + len(n))
        self.first[new], self.count[new] = self.held + np.cumsum(n) - n, n
        self.flat[self.held : self.held + len(ids)] = ids
        self.place(h, check, np.arange(self.known, self.known + len(n), dtype=np.int32))
        self.held, self.known = self.held + len(ids), self.known + len(n)

    def together(self, words: list[bytes], run: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of words without the mark: encoded in runs, a mark after each word."""
        end = b" " + MARK + b" "
        texts = [(end.join(words[k : k + run]) + end).decode() for k in range(0, len(words), run)]
        ids = [np.array(self.own.encode_batch_fast([x], add_special_tokens=False)[0].ids, np.uint32) for x in texts]  # one by one: an encoding is large
        ids = np.concatenate([np.zeros(0, np.uint32), *ids])
        at = np.flatnonzero(ids == self.mark)
        if len(at) != len(words):
            raise ValueError("a word has the mark's id")
        return np.delete(ids, at), np.diff(np.concatenate([[-1], at])) - 1

    def encode(self, c: Chunk) -> list[np.ndarray]:
        """The ids of each document of a chunk, with the end id."""
        if self.folds:
            c = units(c)
        h = c.hashes()
        size = c.ends - c.starts
        check = ((size & 0xFFFF) << 16).astype(np.uint32)
        if len(h):
            check |= (c.data[c.starts].astype(np.uint32) << 8) | c.data[c.ends - 1]
        number = self.find(h, check)
        new = np.flatnonzero(number < 0)
        if len(new):
            at = _different(h[new], check[new])
            if self.known and self.known + len(at) > self.most or len(at) > self.most:
                new = np.arange(len(h))
                at = _different(h, check)
                self.forget(len(at))  # larger for a single document with more different words than are kept
            raw, some = memoryview(c.data), new[at]
            self.learn([bytes(raw[a:b]) for a, b in zip(c.starts[some].tolist(), c.ends[some].tolist(), strict=True)], h[some], check[some])
            number[new] = self.find(h[new], check[new])
        n = self.count[number].astype(np.int64)
        ends = np.cumsum(n)
        upto = np.concatenate([[0], ends])[c.bounds]
        out = np.full((upto[-1] if len(upto) else 0) + c.size, self.end, np.uint32)
        shift = np.repeat(np.arange(c.size), np.diff(upto))
        out[np.arange(len(shift)) + shift] = self.flat[np.repeat(self.first[number] - (ends - n), n) + np.arange(len(shift))]
        cuts = upto + np.arange(c.size + 1)
        return [out[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def units(c: Chunk) -> Chunk:
    """The chunk in lower case, its words cut between letters and stops: there are fewer different ones.

    For tokenizers that do both themselves.  ASCII alone is touched, and no text that may name a special token.
    """
    if not len(c.data) or b"<|" in c.data.tobytes():
        return c
    letter, stop = _LETTER[c.data], _STOP[c.data]
    cuts = np.flatnonzero((letter[:-1] & stop[1:]) | (stop[:-1] & letter[1:])) + 1
    first, last = np.zeros(len(c.data), bool), np.zeros(len(c.data), bool)
    first[c.starts], first[cuts], last[c.ends - 1], last[cuts - 1] = True, True, True, True
    starts = np.flatnonzero(first)
    return Chunk(c.first, c.size, _LOWER[c.data], c.offsets, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, c.offsets))


def _different(h: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Places of one word of each kind."""
    order = np.lexsort((check, h))
    first = np.ones(len(h), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])
    return order[first]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, limits: Limits = Limits(segments=4096), shard_tokens: int = 1 << 22, shard_docs: int = 1 << 18, prompt: str | None = None
) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most limits.tokens, limits.segments pieces and limits.loss
    loss-bearing tokens.

    docs has doc_id and text; a null text is empty, so its document is the end id alone; null and repeated ids are
    documents like others, and texts may be of any length.  ``prompt`` names a column of instruction data: its ids come
    before those of the text and bear no loss; without it all tokens bear loss.  loss_tokens is what a piece bears.
    (While packing, the loss of an example that is cut counts as spread evenly over it.)  Of examples with equal
    vectors the first read goes first.  The last sequence of a shard is cut at powers of two, where no padding is
    needed, unless limits.cut is off.  Sequence ids are unique: the task's number and a count.  An empty table gives an
    empty result.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (tokenizer, end_id) not in _OWN:
            _OWN[tokenizer, end_id] = WordTokenizer(tokenizer, end_id)
        tok = _OWN[tokenizer, end_id]
        task = TaskContext.get()
        ahead = [(task.partitionId() if task else 0) << 36]
        docs_, ids_, free_, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            n, free = np.array([len(x) for x in ids_], np.int64), np.array(free_, np.int64)
            rows: list[tuple] = []
            seqs = pack_vectors(n, n - free, limits)
            for seq in seqs:
                whole = sum(x[2] for x in seq)
                for own in [seq] if whole == limits.tokens or not limits.cut else at_powers(seq):
                    off = 0
                    for i, start, length in own:
                        bears = max(0, start + length - max(start, free_[i]))
                        rows.append((docs_[i], start, length, zlib.crc32(ids_[i][start : start + length].tobytes()), len(ids_[i]), ahead[0], off, bears))
                        off += length
                    ahead[0] += 1
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for c in chunks(batch.column("text"), 1 << 20):
                docs_ += ids[c.first : c.first + c.size]
                own = tok.encode(c)
                if prompt is None:
                    free_ += [0] * c.size
                else:
                    before = [x[:-1] for d in chunks(batch.column("prompt").slice(c.first, c.size)) for x in tok.encode(d)]
                    free_ += [len(x) for x in before]
                    own = [np.concatenate(x) for x in zip(before, own, strict=True)]
                ids_ += own
                held += sum(map(len, own))
                if held >= shard_tokens or len(docs_) >= shard_docs:
                    yield flush()
                    docs_, ids_, free_, held = [], [], [], 0
        if docs_:
            yield flush()

    return docs.select("doc_id", "text", *([F.col(prompt).alias("prompt")] if prompt else [])).mapInArrow(released(run), PIECES)
