"""Operator 3: language-model scoring by a probabilistic suffix tree over words.

The tree's contexts are word sequences of length 0 to ``depth`` (3). Counts come from all training texts:

1. Words are counted by a distributed aggregation. The root predicts every token with the
   smoothed frequency ``(c + 1) / (N + V + 1)``; what is left is the unseen words' share.
2. A string is a candidate if it occurs at least ``floor`` (2) times, however large the corpus is. Strings of every
   length are counted in a shuffle; a longer string is never more frequent than its parts, so only strings whose two
   parts are candidates are counted. The parts are looked up in a bitmap of fixed size, whose false hits
   cost 16 bytes in the shuffle and no more.
3. Divergence test: a context s is retained if ``n(s) * KL(P(.|s) || P(.|suffix of s))`` is at least
   ``cutoff`` nats for every symbol it predicts itself.
4. Smoothing: a predicted symbol gets ``(n(s x) + mass * P(x|suffix)) / (n(s) + mass)``; all other symbols share
   the rest in the proportions of the suffix, so every distribution sums to one.

A text is scored by its tokens' longest retained suffix states. As the remaining symbols keep the
proportions of the root, a token's log-probability is its root term plus a correction, and the corrections
along a text are a sum over the strings in it: a context's factor wherever it stands before a token,
and what a predicted symbol has beyond that factor. These weights form a table that grows with the
corpus. The strings of relative frequency ``least`` and the words of relative frequency ``frequent`` (at most
``1 / least`` a length and ``1 / frequent``) are broadcast and added up in place, so nothing that is met in a
shuffle is hot; all others are sent to the table's part that their key belongs to, and the sums come back to the document.

Words and strings are told apart by 64-bit hashes. What goes through a shuffle goes in packs: rows of a part number (of the
hash, so that no key is hot) and a few thousand numbers as bytes, which NumPy adds up and looks up a part at a time. There
are more parts for a larger corpus, so that a part stays small. Defined results: a null text counts as empty and scores its end token; a null
id is a training row; repeated rows are learned from and scored each; an empty table gives an empty result; with no training
row every probability is one. Other columns are not read.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import byte_rows, free_shuffles, remainder, staged, table, utf8

END, CHUNK, PACK, BATCH = 0, 1 << 21, 1 << 17, 1 << 21  # bytes: of text, of a pack, of a record batch
BITMAP, HELD = 27, 1_200_000  # most bits of a position in a bitmap; strings held before they are added up
PART, ROUNDS = 1 << 20, 4  # tokens of the corpus for a part; rounds in which documents are scored
END_HASH, MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
LONG = 64  # bytes of a word that are hashed eight at a time
ROW = "part long, kind byte, size long, data binary"
LEVEL, FOUND, WEIGHT, WORD, STRING = range(5)  # kinds of packs

FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first 0 to 8 bytes


def free_all_shuffles(spark) -> None:
    """Objects that a first collection releases in the JVM are met by a second one only, a moment later."""
    for _ in range(2):
        free_shuffles(spark)
        time.sleep(0.3)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX2
    return x ^ (x >> np.uint64(32))


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a word: all but 9 to 13 and 32."""
    return (data - np.uint8(9) > 4) & (data != 32)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``data[begin:end]``; words of up to eight bytes and one length never share one.
    ``data`` ends with 16 bytes more, its length is a multiple of 8."""
    cells = data.view(np.uint64)

    def eight(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        cell, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        both = (cells[cell] >> shift) | ((cells[cell + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return both & FIRST[np.minimum(left, 8)]

    size = end - begin
    out = mixed(eight(begin, size) ^ (size.astype(np.uint64) * END_HASH))
    for done in range(8, LONG, 8):
        more = np.flatnonzero(size > done)
        if not len(more):
            return out
        out[more] = mixed(out[more] * MIX2 ^ eight(begin[more] + done, size[more] - done))
    import xxhash

    for i in np.flatnonzero(size > LONG).tolist():
        out[i] ^= np.uint64(xxhash.xxh64_intdigest(data[begin[i]:end[i]].tobytes(), seed=42))
    return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens of the texts, one after the other, each text's words (lower-cased) and its end, and where the ends stand."""
    # Every text is followed by a space.
    offsets = np.concatenate([[0], np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)])
    text = b" ".join([*texts.to_pylist(), b""]).lower()
    data = np.frombuffer(text + bytes(16 + -len(text) % 8), np.uint8)
    hashes, ends, start, document = [], [], 0, 0
    while document < len(texts):
        # As many whole texts as make about 2 MB, or a piece of one text cut between words.
        last = max(int(np.searchsorted(offsets, start + CHUNK, "right")) - 1, document)
        stop = int(offsets[last])
        whole = last > document
        if not whole:
            stop = start + CHUNK
            while stop < offsets[document + 1] and letters(data[stop:stop + 1])[0]:
                stop += 1
        low = start & ~7
        part = data[low:(stop + 7 & ~7) + 16]
        letter = np.zeros(stop - low + 2, bool)  # from the byte before on
        letter[start - low + 1:-1] = letters(data[start:stop])
        turns = np.flatnonzero(letter[1:] != letter[:-1])
        begin, end = turns[::2], turns[1::2]
        words = word_hashes(part, begin, end)
        if whole:
            at = np.searchsorted(begin, offsets[document + 1:last + 1] - low) + np.arange(last - document)
        else:
            at = np.full(int(stop >= offsets[document + 1]), len(words), np.int64)
        out = np.full(len(words) + len(at), END_HASH)
        word = np.ones(len(out), bool)
        word[at] = False
        out[word] = words
        ends.append(at + sum(map(len, hashes)))
        hashes.append(out)
        document += len(at)
        start = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(ends)


def extend(context: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The keys of the strings that begin with ``context`` and go on, one word later, as ``tail``; the key of a word is its hash."""
    return mixed(context * MIX + tail)


def strings(hashes: np.ndarray, ends: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys of the texts' strings of 1, 2, .. ``depth + 1`` words by their first word, and which of them lie in one text."""
    inside = np.ones(len(hashes), bool)
    out = hashes, inside
    yield out
    inside = inside.copy()
    inside[ends] = False
    for _ in range(depth):
        key, valid = out
        out = extend(key[:-1], key[1:]), inside[:len(key) - 1] & valid[1:] if len(key) else valid
        yield out


def in_order(x: np.ndarray, exact: bool = True) -> np.ndarray:
    """The positions of the numbers in their order, equal ones as they stand. Sorted are the numbers' first bits, with the positions below them;
    unless ``exact``, numbers that differ in later bits only (more than a position has) may stand mixed."""
    bits = max(1, len(x).bit_length())
    up, low = np.uint64(64 - int(x.max(initial=0)).bit_length()), np.uint64((1 << bits) - 1)
    both = x << up if up < 64 else x.copy()
    both &= ~low
    both |= np.arange(len(x), dtype=np.uint64)
    both.sort()
    order = (both & low).astype(np.int64)
    if exact and up < bits:  # where first bits are equal, numbers may stand in another order
        sorted_ = x[order]
        wrong = np.flatnonzero(sorted_[1:] < sorted_[:-1])
        if len(wrong):
            both &= ~low
            run = np.cumsum(np.concatenate([[False], both[1:] != both[:-1]]))
            mixed_runs = np.zeros(run[-1] + 1, bool)
            mixed_runs[run[wrong]] = True
            few = np.flatnonzero(mixed_runs[run])
            order[few] = order[few][np.lexsort((order[few], sorted_[few]))]
    return order


class Index:
    """Where values stand in sorted distinct keys, which are hashes: with eight slots a key by their first bits, a slot seldom has two."""

    def __init__(self, keys: np.ndarray):
        bits = min(22, len(keys).bit_length() + 3)
        self.keys, self.shift = keys, np.uint64(64 - bits)
        slots = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.concatenate([[0], np.cumsum(slots)]).astype(np.int32 if len(keys) < 1 << 31 else np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The position of each value; -1 if it isn't there."""
        slot = (values >> self.shift).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        out = np.full(len(values), -1, np.int64)
        todo = np.flatnonzero(at < stop)
        at, stop, wanted = at[todo], stop[todo], values[todo]
        while len(todo):
            hit = self.keys[at] == wanted
            out[todo[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < stop)
            todo, at, stop, wanted = todo[go], at[go], stop[go], wanted[go]
        return out


def planes(columns: np.ndarray) -> bytes:
    """The columns, of each the first bytes of all numbers, then the second ones and so on: what is small or in order compresses well."""
    return np.ascontiguousarray(columns.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, 8, -1).transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


def packs(columns: list[np.ndarray], by: np.ndarray, parts: int, kind: int, dealt: bool = False) -> Iterator[pa.RecordBatch]:
    """The numbers, dealt to ``parts`` by their hash ``by``, in packs of 128 KB and record batches of 2 MB at most; the order within a part is kept.
    ``dealt``: they are in the order of their parts already."""
    if not len(by):
        return
    part = (by % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    if dealt or parts == 1:
        both = np.stack([c.view(np.uint64) for c in columns])
    else:
        order = np.argsort(part, kind="stable") if parts <= 1 << 16 else in_order(part.view(np.uint64))
        both, part = np.stack([c.view(np.uint64)[order] for c in columns]), part[order]
        del order
    edges = runs(part)
    most = max(1, PACK // (8 * len(columns)))
    edges = np.unique(np.concatenate([edges, *(np.arange(a, b, most) for a, b in zip(edges, [*edges[1:], len(part)], strict=True) if b - a > most)]))
    sizes = np.diff(edges, append=len(part))
    start = 0
    while start < len(edges):
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + BATCH // (8 * len(columns)))))
        yield pa.record_batch({"part": pa.array(part[edges[start:stop]].astype(np.int64)), "kind": pa.array(np.full(stop - start, kind, np.int8)),
                               "size": pa.array(sizes[start:stop].astype(np.int64)),
                               "data": pa.array([planes(both[:, a:a + n]) for a, n in zip(edges[start:stop], sizes[start:stop], strict=True)], pa.binary())})
        start = stop


def unpacked(rows: pa.Table | pa.RecordBatch, kind: int, width: int) -> np.ndarray:
    """The ``width`` columns of the packs of ``kind``."""
    held = [from_planes(d.as_buffer(), width) for k, d in zip(rows.column("kind").to_pylist(), rows.column("data"), strict=True) if k == kind]
    return np.concatenate(held, axis=1) if held else np.zeros((width, 0), np.uint64)


def as_table(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches, pa.schema([("part", pa.int64()), ("kind", pa.int8()), ("size", pa.int64()), ("data", pa.binary())]))


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins in columns that are ordered."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))]))


def added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and the sums of their values."""
    order = in_order(keys)
    keys = keys[order]
    first = runs(keys)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def places(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where values stand in ordered numbers that hold them and are no hashes: an :class:`Index` would keep all of them in one slot."""
    return np.searchsorted(rows, values)


def word_counts(texts: DataFrame) -> DataFrame:
    """Packs of ``key, n`` over all texts, in as many parts as a shuffle has; the end of a text is counted as a word."""
    parts = max(16, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held)
            held.clear()
            keys.sort()
            first = runs(keys)
            keys, n = keys[first], np.diff(np.append(first, len(keys)))
            yield from packs([keys, n], keys, parts, WORD)

        for part in byte_rows(batches, limit=CHUNK):
            held.append(tokens(part.column("text"))[0])
            size += len(held[-1])
            if size > HELD:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    def add(rows: pa.Table) -> pa.Table:
        key, n = added(*unpacked(rows, WORD, 2))
        return as_table(packs([key, n], np.zeros(len(key), np.uint64) + np.uint64(rows.column("part")[0].as_py()), parts, WORD))

    return texts.mapInArrow(count, ROW).groupBy("part").applyInArrow(add, ROW)


class Vocabulary:
    """Frequent words by number (1..), the end as 0; -1 for every other word."""

    def __init__(self, hashes: np.ndarray):
        order = np.argsort(hashes)
        self.index, self.number, self.size = Index(hashes[order]), order, len(hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = self.index.find(hashes)
        return np.where(at >= 0, self.number[at], -1)

    def encode(self, words: list[bytes]) -> np.ndarray:
        return self.find(tokens(pa.array([b" ".join(words)], pa.binary()))[0][:-1])


def bitmap(rows: DataFrame, kind: int, width: int) -> np.ndarray:
    """Which values of the last bits the keys (first column) of the packs have: 32 to 64 positions a key, ``2^BITMAP`` at most.
    It reaches the driver in 64 blocks."""
    rows = rows.where(F.col("kind") == kind)
    bits = min(BITMAP, max(16, (32 * (rows.agg(F.sum("size")).first()[0] or 0)).bit_length()))
    block = np.uint64(bits - 6)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = unpacked(batch, kind, width)[0] & np.uint64((1 << bits) - 1)
            yield from packs([at], at >> block, 64, kind)

    def mark(rows: pa.Table) -> pa.Table:
        marked = np.zeros(1 << int(block), bool)
        marked[(unpacked(rows, kind, 1)[0] & np.uint64((1 << int(block)) - 1)).astype(np.int64)] = True
        return rows.slice(0, 1).set_column(3, "data", pa.array([np.packbits(marked, bitorder="little").tobytes()], pa.binary()))

    out = np.zeros((64, 1 << (bits - 12)), np.uint64)
    for row in rows.mapInArrow(deal, ROW).groupBy("part").applyInArrow(mark, ROW).select("part", "data").collect():
        out[row["part"]] = np.frombuffer(row["data"], np.uint64)
    return out.ravel()


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def counted(context: np.ndarray, tail: np.ndarray, n: np.ndarray | None = None, parts: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings, in the order of the parts of their keys and about in that of their contexts, and how often they stand there.
    Without ``n`` a string may come more than once."""
    key = extend(context, tail)
    left = 64 - (parts - 1).bit_length()
    half, mark = np.uint64(64 - left // 2), (context >> np.uint64(32) << np.uint64(32)) | (key >> np.uint64(32))
    if parts > 1:
        mark = key % np.uint64(parts) << np.uint64(left) | context >> half << np.uint64(left - left // 2) | key >> np.uint64(64 - left + left // 2)
    order = in_order(mark, exact=n is not None)
    strings_ = context[order], tail[order]
    first = runs(*strings_)
    if n is not None and len(first) > len(runs(mark[order])):  # two strings have one mark
        order = np.lexsort((tail, context, mark))
        strings_ = context[order], tail[order]
        first = runs(*strings_)
    n = np.diff(np.append(first, len(tail))) if n is None else np.add.reduceat(n[order], first) if len(first) else n
    return strings_[0][first], strings_[1][first], n


def string_counts(texts: DataFrame, length: int, floor: int, bits: np.ndarray, parts: int, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """Packs of ``context, tail, n`` by tail (and what deletes them) of the strings of ``length`` words that occur ``floor`` times; ``bits``
    is the bitmap of those one word shorter."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(bits.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint64)
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            both = np.concatenate(held, axis=1)
            held.clear()
            context, tail, n = counted(*both, parts=parts)
            del both
            yield from packs([context, tail, n], extend(context, tail), parts, FOUND, dealt=True)

        for part in byte_rows(batches, limit=CHUNK):
            hashes, ends = tokens(part.column("text"))
            *_, (shorter, _), (_, valid) = strings(hashes, ends, length - 1)
            hit = may_hold(bits, shorter)
            at = np.flatnonzero(valid & hit[:-1] & hit[1:])
            held.append(np.stack([shorter[at], shorter[at + 1]]))
            size += len(at)
            if size > HELD:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    def add(rows: pa.Table) -> pa.Table:
        context, tail, n = counted(*unpacked(rows, FOUND, 3))
        often = n >= np.uint64(floor)
        return as_table(packs([context[often], tail[often], n[often]], tail[often], parts, FOUND))

    found = staged(texts.mapInArrow(count, ROW).groupBy("part").applyInArrow(add, ROW), name)
    shared.destroy()
    free_all_shuffles(spark)
    return found


def predictions(found: DataFrame, drop_found: Callable[[], None], shorter: DataFrame, mass: float, cutoff: float, length: int, last: bool, whole: int,
                parts: int) -> tuple[DataFrame, Callable[[], None]]:
    """From the strings ``found``, packs of LEVEL, ``key, n, c, fix`` of each (but for the last length), and of WEIGHT, ``key, weight, factor, n, length`` of
    those that predict and of the contexts retained among theirs (and what deletes them).

    ``shorter`` has the strings one word shorter. ``c`` is the count of the last word, which makes the root's log10 of it (``base``), ``fix`` its
    correction after the rest of the string, ``weight`` what a prediction adds to the factors of the contexts before it.
    """
    def after_tail(rows: pa.Table) -> pa.Table:
        key, _, c, fix = by_key(unpacked(rows, LEVEL, 4))
        context, tail, n = unpacked(rows, FOUND, 3)
        at = Index(key).find(tail)
        context, tail, n, at = context[at >= 0], tail[at >= 0], n[at >= 0], at[at >= 0]
        return as_table(packs([context, tail, n, c[at], fix[at]], context, parts, FOUND))

    def test(rows: pa.Table) -> pa.Table:
        key, times, _, _ = by_key(unpacked(rows, LEVEL, 4))
        context, tail, n, c, less = unpacked(rows, FOUND, 5)
        order = in_order(tail)
        order = order[in_order(context[order])]
        context, tail, n, c, less = context[order], tail[order], n[order], c[order], less[order].view(np.float64)
        if not len(context):
            return as_table(iter([]))
        first = runs(context)
        k = np.diff(np.append(first, len(context)))
        every = times[Index(key).find(context[first])].astype(np.float64)
        base = root_log10(c, whole)
        parent = 10.0 ** (base + less)
        p = (n + mass * parent) / (np.repeat(every, k) + mass)
        rest, left = (np.maximum(1 - np.add.reduceat(x, first), 1e-12) for x in (p, parent))
        divergence = np.add.reduceat(p * np.log(p / parent), first) + rest * np.log(rest / left)
        kept, factor = every * divergence >= cutoff * k, np.log10(rest / left)
        own, retained = np.log10(p) - base, np.repeat(kept, k)
        string, contexts = extend(context, tail), context[first][kept]
        weight = (own - less - np.repeat(factor, k))[retained]

        def out() -> Iterator[pa.RecordBatch]:
            if not last:
                yield from packs([string, n, c, np.where(retained, own, less)], string, parts, LEVEL)
            for keys, weights, factors, ns, size in ((string[retained], weight, np.zeros(len(weight)), n[retained], length),
                                                     (contexts, np.zeros(len(contexts)), factor[kept], every[kept].astype(np.int64), length - 1)):
                yield from packs([keys, weights, factors, ns, np.full(len(keys), size)], keys, parts, WEIGHT)

        return as_table(out())

    spark, level = found.sparkSession, shorter.where(F.col("kind") == LEVEL)
    parents, drop_parents = staged(found.union(level).groupBy("part").applyInArrow(after_tail, ROW), f"parents-{length}")
    drop_found()
    free_all_shuffles(spark)
    out = staged(parents.union(level).groupBy("part").applyInArrow(test, ROW), f"strings-{length}")
    drop_parents()
    free_all_shuffles(spark)
    return out


def by_key(columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The columns of LEVEL packs in the order of the first."""
    columns = columns[:, in_order(columns[0])]
    return columns[0], columns[1], columns[2], columns[3].view(np.float64)


def root_log10(n: np.ndarray, whole: int) -> np.ndarray:
    """The root's prediction of words by their counts."""
    return np.log10((n.astype(np.float64) + 1) / whole)


@dataclass
class SuffixTree:
    """What is broadcast: the frequent words and strings, as corrections (log10) to the root's predictions."""

    vocabulary: Vocabulary
    root: np.ndarray  # log10 of the root's prediction by word number
    hashes: np.ndarray  # by word number
    index: Index  # of the frequent strings of any length
    weight: np.ndarray  # what they add as a prediction
    factor: np.ndarray  # and as a context before a token
    pairs: np.ndarray  # keys of the frequent strings of two words that are predictions
    states: np.ndarray  # keys of the frequent contexts of two words
    others: np.ndarray  # bitmap of the other strings that have a weight
    depth: int

    def corrections(self, ids: np.ndarray) -> float:
        """The sum of the corrections along a document in word numbers (-1: any other word)."""
        hashes = np.where(ids >= 0, self.hashes[ids], np.uint64(1))
        total = 0.0
        for keys, _ in strings(hashes, np.zeros(0, np.int64), self.depth):
            at = self.index.find(keys)
            total += float(self.weight[at[at >= 0]].sum() + self.factor[at[:-1][at[:-1] >= 0]].sum())
        return total


@dataclass
class Model:
    """What is learned: packs of WORD, ``key, c``, and of STRING, ``key, w``, of the corpus, in so many parts, their totals and the tree."""

    weights: DataFrame
    parts: int
    total: int
    distinct: int
    tree: SuffixTree


def chosen(rows: DataFrame, kind: int, width: int, choose: Callable[[np.ndarray], list[np.ndarray]], parts: int, to: int) -> DataFrame:
    """Packs of kind ``to``, by their first column, of what ``choose`` makes of the columns of the packs of ``kind``."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = choose(unpacked(batch, kind, width))
            yield from packs(columns, columns[0], parts, to)

    return rows.where(F.col("kind") == kind).mapInArrow(deal, ROW)


def gathered(rows: DataFrame, width: int) -> np.ndarray:
    """The columns of the packs, on the driver."""
    held = [from_planes(r["data"], width) for r in rows.select("data").collect()]
    return np.concatenate([np.zeros((width, 0), np.uint64), *held], axis=1)


def learn(texts: DataFrame, least: float = 3e-6, frequent: float = 2e-6, mass: float = 10.0, cutoff: float = 3.0,
          floor: int = 2, depth: int = 3) -> Model:
    """Learn from ``text`` (UTF-8 bytes) of every row. Strings that occur ``floor`` times are candidates. Those above ``least`` (at most
    ``1 / least`` a length) and words above ``frequent`` (at most ``1 / frequent``) are broadcast."""
    spark = texts.sparkSession
    words, drop_words = staged(word_counts(texts), "word-counts")
    free_all_shuffles(spark)
    distinct = int(words.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    total = int(gathered(chosen(words, WORD, 2, lambda c: [c[1].sum(keepdims=True)], 1, WORD), 1).sum())
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2, total // PART)

    often = np.uint64(np.ceil(max(2.0, frequent * total)))
    hashes, n = gathered(chosen(words, WORD, 2, lambda c: [*c[:, (c[1] >= often) | (c[0] == END_HASH)]], 1, WORD), 2)  # at most 1 / frequent words
    order = np.lexsort((hashes, n.max(initial=0) - n, hashes != END_HASH))
    hashes, n = hashes[order], n[order]
    if not len(hashes):
        hashes, n = np.full(1, END_HASH), np.zeros(1, np.uint64)

    def first_level(c: np.ndarray) -> list[np.ndarray]:
        key, n = c[:, c[1] >= np.uint64(floor)]
        return [key, n, n, np.zeros(len(n))]

    level, drop_level = staged(chosen(words, WORD, 2, first_level, parts, LEVEL), "strings-1")
    tables, drops = [level], [drop_level]
    for length in range(2, depth + 2):
        found, drop_found = string_counts(texts, length, floor, bitmap(tables[-1], LEVEL, 4), parts, f"counts-{length}")
        longer, drop_longer = predictions(found, drop_found, tables[-1], mass, cutoff, length, length == depth + 1, total + distinct + 1, parts)
        tables.append(longer)
        drops.append(drop_longer)
    rare = np.uint64(np.ceil(max(2.0, least * total)))
    weighted = reduce(DataFrame.union, tables[1:])
    hot = gathered(chosen(weighted, WEIGHT, 5, lambda c: [*c[:, c[3] >= rare]], 1, WEIGHT), 5)  # at most 1 / least of each length
    keys, weight, factor = added(hot[0], hot[1].view(np.float64), hot[2].view(np.float64))
    two = np.isin(keys, hot[0][hot[4] == 2])

    def cold(c: np.ndarray) -> list[np.ndarray]:
        key, weight, factor, *_ = np.ascontiguousarray(c[:, c[3] < rare])
        return [key, weight.view(np.float64) + factor.view(np.float64)]

    # Every table goes when its last reader has written.
    weights, _ = staged(chosen(weighted, WEIGHT, 5, cold, parts, STRING).union(chosen(words, WORD, 2, list, parts, WORD)), "weights")
    for drop in (*drops, drop_words):
        drop()
    tree = SuffixTree(Vocabulary(hashes), root_log10(n, total + distinct + 1), hashes, Index(keys), weight, factor,
                      keys[two & (weight != 0)], keys[two & (factor != 0)], bitmap(weights, STRING, 2), depth)
    free_all_shuffles(spark)
    return Model(weights, parts, total, distinct, tree)


OWN, ASK_WORD, ASK_STRING, ANSWER_WORD, ANSWER_STRING = range(5, 10)  # kinds of packs


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``. The documents are scored in
    rounds by their text's hash, so that the shuffles hold a part of them at a time."""
    spark, parts = docs.sparkSession, model.parts
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model.tree))
    floor = -float(np.log10(model.total + model.distinct + 1))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows_type = f"{ROW}, ids array<{id_type}>"

    def home(row: np.ndarray) -> np.ndarray:
        """Where what belongs to a document comes together: with its neighbours."""
        return mixed(row.astype(np.uint64) >> np.uint64(8))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: SuffixTree = pickle.loads(shared.value)
        both = tree.weight + tree.factor
        asked: dict[int, list[np.ndarray]] = {ASK_WORD: [], ASK_STRING: []}
        ids_type = None

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, held in asked.items():
                if held:
                    keys, rows = np.concatenate(held, axis=1)
                    held.clear()
                    for batch in packs([keys, rows], keys, parts, kind):
                        yield batch.append_column("ids", pa.nulls(batch.num_rows, ids_type))

        size = 0
        for part in byte_rows(batches, limit=CHUNK):
            rows, ids_type = part.column("row").to_numpy(), pa.list_(part.column("doc_id").type)
            hashes, ends = tokens(part.column("text"))
            n = np.diff(ends, prepend=-1)
            document = np.repeat(np.arange(len(ends)), n)
            ids = tree.vocabulary.find(hashes)
            frequent = ids >= 0
            base = np.bincount(document[frequent], tree.root[ids[frequent]], len(ends))
            known = np.bincount(document[frequent], minlength=len(ends)) - int(tree.root[END] <= floor)
            fix = np.zeros(len(ends))
            asked[ASK_WORD].append(np.stack([hashes[~frequent], rows[document[~frequent]].view(np.uint64)]))
            cold = []
            for k, (keys, valid) in enumerate(strings(hashes, ends, tree.depth)):
                at = np.flatnonzero(valid & frequent if k == 0 else valid)  # the other words are asked for already
                keys = keys[at]
                met = tree.index.find(keys)
                hit = met >= 0
                fix += np.bincount(document[at[hit]], both[met[hit]], len(ends))
                at, keys = at[~hit], keys[~hit]
                held = may_hold(tree.others, keys)
                cold.append(np.stack([keys[held], document[at[held]].view(np.uint64)]))
            keys, owner = np.concatenate(cold, axis=1)
            order = np.argsort(owner.astype(np.uint16) if len(ends) <= 1 << 16 else owner, kind="stable")
            asked[ASK_STRING].append(np.stack([keys[order], rows[owner[order].astype(np.int64)].view(np.uint64)]))
            size += len(keys) + asked[ASK_WORD][-1].shape[1]
            place = home(rows)
            edges = [*runs(place).tolist(), len(rows)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = next(packs([rows[a:b], n[a:b], known[a:b], base[a:b], fix[a:b]], place[a:b], parts, OWN))
                yield own.append_column("ids", pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), part.column("doc_id").slice(a, b - a)))
            if size > HELD:
                yield from flush()
                size = 0
        yield from flush()

    def look_up(rows: pa.Table) -> pa.Table:
        """What was asked of a part, summed up by document: the corrections, the words' terms and how many are known."""
        key, c = unpacked(rows, WORD, 2)
        order = in_order(key)
        words, c = Index(key[order]), np.append(c[order], np.zeros(1, np.uint64)).astype(np.float64)
        key, w = unpacked(rows, STRING, 2)
        key, w = added(key, w.view(np.float64))
        weighted, w = Index(key), np.append(w, 0.0)
        def out() -> Iterator[pa.RecordBatch]:
            key, row = unpacked(rows, ASK_WORD, 2)
            n = c[words.find(key)]
            row, *sums = added(row, w[weighted.find(key)], np.log10(n + 1) + floor, (n > 0).astype(np.float64))
            yield from packs([row, *sums], home(row), parts, ANSWER_WORD)
            key, row = unpacked(rows, ASK_STRING, 2)
            row, fix = added(row, w[weighted.find(key)])
            row, fix = row[fix != 0], fix[fix != 0]  # the bitmap's false hits have no weight
            yield from packs([row, fix], home(row), parts, ANSWER_STRING)

        return as_table(out())

    def add_up(rows: pa.Table) -> pa.Table:
        row, size, known, base, fix = unpacked(rows, OWN, 5)
        order = in_order(row)
        sums = np.zeros((3, len(row)))
        for kind, width in ((ANSWER_WORD, 4), (ANSWER_STRING, 2)):
            owner, *answers = unpacked(rows, kind, width)
            at = order[places(row[order], owner)]
            for k, x in enumerate(answers):
                sums[k] += np.bincount(at, x.view(np.float64), len(row))
        ids = rows.filter(pa.array(rows.column("kind").to_numpy() == OWN)).column("ids").combine_chunks().flatten()
        base = base.view(np.float64) + sums[1]
        return pa.table({"doc_id": ids, "n_tokens": pa.array(size.view(np.int64)), "n_known": pa.array(known.view(np.int64) + sums[2].astype(np.int64)),
                         "base_score": pa.array(base), "score": pa.array(base + fix.view(np.float64) + sums[0])})

    def scored(turn: int) -> DataFrame:
        mine = docs.select("doc_id", utf8(F.col("text")).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn)
        both, drop_both = staged(mine.withColumn("row", F.monotonically_increasing_id()).mapInArrow(score, rows_type), f"asked-{turn}")
        own, asked = both.where(F.col("kind") == OWN), both.where(F.col("kind") != OWN).drop("ids")
        answers = asked.union(model.weights).groupBy("part").applyInArrow(look_up, ROW).withColumn("ids", F.lit(None).cast(f"array<{id_type}>"))
        out, _ = staged(own.union(answers).groupBy("part").applyInArrow(
            add_up, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double"), f"scores-{turn}")
        drop_both()
        return out

    rounds = []
    for turn in range(ROUNDS):
        rounds.append(scored(turn))
        free_all_shuffles(spark)
    shared.destroy()
    return reduce(DataFrame.union, rounds).select("doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                                                  "base_score", "score")


def op3_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 3."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    model = learn(docs.where(~held_out).select(utf8(F.col("text")).alias("text")), depth=2)
    return score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                               "base_score", "score")
