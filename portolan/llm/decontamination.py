"""Operator 9: benchmark decontamination by SimHash windows.

Every benchmark item of L words is searched in windows of exactly L words of every document; a
document of fewer words is one window as a whole. Item and window are fingerprinted by the SimHash of their five-word shingles, repeats
counted. A multi-index over the items' fingerprints cuts the 64 bits into ``radius + 1``
blocks: an item within the radius of a window shares at least one block with it exactly, so
the index returns all items within the radius. Candidates are then verified by the exact
weighted-shingle similarity (shingle multiset: sum of minima over sum of maxima), which
must reach ``similarity``.

Two windows with a positive similarity share a shingle, so only windows around a shingle of
some item need a fingerprint: the words are hashed, shingles are looked up in the sorted
shingles of the items, and a window of n shingles is fingerprinted if at least
``2 n similarity / (1 + similarity)`` of them are found there. That test can't lose a window
(a smaller overlap cannot reach the similarity), and it keeps the cost per document near
that of splitting it into words. A whole document of m shingles against an item of n needs a similarity
of ``min(m, n) / max(m, n)`` at least, and ``(m + n) similarity / (1 + similarity)`` shared shingles; the few items
of such sizes that share one with it are compared exactly, without fingerprints.

The items are a stated query set against all documents. They are read in blocks of at most
``block_items`` items and ``block_bytes`` bytes, and each block's index is broadcast, so what is
broadcast is bounded by the two parameters however large the benchmark is: a block's index is given back when its
results are written. The documents are scanned once per block; they are shuffled only by ``decontaminate`` with several blocks, once.

Words are runs of letters, digits and marks of any script, lower-cased, so punctuation, case and
spacing don't hide a copy. Items of fewer than five words are one shingle. Defined results: null
and empty texts and items hold no words and match nothing; repeated rows are reported each;
items that repeat a text are all reported; empty tables give an empty result. Columns other than
ids and texts are not read here and ride along in ``decontaminate``.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import byte_rows, staged, table, utf8

WORDS = re.compile(r"\w+")
SHINGLE = 5
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """A 64-bit hash per word, computed when a word is first met."""

    def __missing__(self, word: str) -> int:
        import xxhash

        self[word] = value = xxhash.xxh64_intdigest(word, seed=42)
        return value


def word_hashes(text: str, known: WordHashes) -> np.ndarray:
    """The hash of every word of the text."""
    if len(known) > 500_000:
        known.clear()
    words = WORDS.findall(text.lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """The hashes of the five-word shingles, in order; a shorter text is one shingle."""
    size = min(SHINGLE, len(words))
    if not size:
        return words
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ words[i:i + len(out)]) * MIX
        out ^= out >> np.uint64(29)
    return out * MIX


def simhash(hashes: np.ndarray) -> np.uint64:
    bits = np.unpackbits(hashes.byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(bits * 2 > len(hashes)).view(">u8")[0].astype(np.uint64)


def window_simhashes(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The fingerprints of the windows of ``length`` shingles at ``starts``, from running bit sums."""
    bits = np.unpackbits(hashes.byteswap().view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits((sums[starts + length] - sums[starts]) * 2 > length, axis=1).view(">u8").ravel().astype(np.uint64)


class HammingIndex:
    """Fingerprints in ``radius + 1`` blocks of bits; within the radius at least one block is equal."""

    def __init__(self, fps: np.ndarray, radius: int):
        self.fps, self.radius = fps, radius
        cuts = np.linspace(0, 64, radius + 2).round().astype(int)
        self.blocks = []
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if high > low:
                mask = np.uint64(((1 << int(high - low)) - 1) << int(low))
                order = np.argsort(fps & mask, kind="stable")
                self.blocks.append((mask, (fps & mask)[order], order))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs ``(query, item)`` by number within the radius."""
        q, i = [], []
        for mask, values, order in self.blocks:
            left, right = (np.searchsorted(values, queries & mask, side) for side in ("left", "right"))
            n = right - left
            who = np.repeat(np.arange(len(queries)), n)
            at = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
            item = order[at]
            near = np.bitwise_count(queries[who] ^ self.fps[item]) <= self.radius
            q.append(who[near])
            i.append(item[near])
        pairs = np.unique(np.stack([np.concatenate(q), np.concatenate(i)], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


class BenchmarkIndex:
    """A block of items: their shingles, sorted, and a Hamming index of their fingerprints."""

    def __init__(self, item_ids: list, texts: list[str], radius: int, similarity: float):
        known = WordHashes()
        groups: dict[int, list[tuple]] = {}
        for item, text in zip(item_ids, texts, strict=True):
            words = word_hashes(text, known)
            if len(words):
                groups.setdefault(len(words), []).append((item, shingles(words)))
        members = [(length, item, hashes) for length, g in sorted(groups.items()) for item, hashes in g]
        self.similarity, self.lengths = similarity, sorted(groups)
        self.items, self.sizes = [m[1] for m in members], np.array([m[0] for m in members], np.int64)
        self.index = HammingIndex(np.array([simhash(m[2]) for m in members], np.uint64), radius)
        self.shingles = [Counter(m[2].tolist()) for m in members]
        self.long = self._sorted(lambda n: n >= SHINGLE)
        self.short = {n: self._sorted(lambda x, n=n: x == n) for n in groups if n < SHINGLE}

    def _sorted(self, sized) -> np.ndarray:
        return np.unique(np.array([s for n, c in zip(self.sizes.tolist(), self.shingles, strict=True) if sized(n) for s in c], np.uint64))

    def _windows(self, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(length, shingles in a window, the text's shingles, starts)`` of the windows that can reach the similarity."""
        whole = shingles(words) if len(words) >= SHINGLE else np.zeros(0, np.uint64)
        seen = self._known(whole, self.long)
        held = np.concatenate([[0], np.cumsum(seen)]) if seen.any() else None
        for length in self.lengths:
            if length > len(words):
                break  # see _whole
            if length < SHINGLE:
                hashes, span = np.array([shingles(w)[0] for w in np.lib.stride_tricks.sliding_window_view(words, length)], np.uint64), 1
                found = self._known(hashes, self.short[length])
                sums = np.concatenate([[0], np.cumsum(found)]) if found.any() else None
            else:
                hashes, span, sums = whole, length - SHINGLE + 1, held
            if sums is None:
                continue
            # Overlap / union >= s with both sides of span shingles needs an overlap of 2 s span / (1 + s).
            need = max(1.0, 2 * self.similarity * span / (1 + self.similarity) - 1e-9)
            starts = np.flatnonzero(sums[span:] - sums[:-span] >= need)
            for at in range(0, len(starts), 1 << 14):  # bounded memory for long documents
                yield length, span, hashes, starts[at:at + (1 << 14)]

    def search(self, words: np.ndarray) -> list[tuple]:
        """``(item, start word, words, distance, similarity)``, the best window of every item that is found."""
        best: dict[int, tuple] = {}
        held: list[tuple] = []
        for length, span, hashes, starts in self._windows(words):
            held.append((length, span, hashes, starts, self._fingerprints(hashes, starts, span)))
            if sum(len(h[3]) for h in held) > 1 << 14:
                self._match(held, best)
                held = []
        if held:
            self._match(held, best)
        self._whole(words, best)
        return list(best.values())

    def _whole(self, words: np.ndarray, best: dict[int, tuple]) -> None:
        """The whole text against the items of more words. A text of fewer than five words is a shingle that they don't have."""
        if len(words) < SHINGLE or not self.lengths or len(words) >= self.lengths[-1]:
            return
        hashes = shingles(words)
        n, known = len(hashes), self._known(hashes, self.long)
        # The items have over n and at most n / similarity shingles.
        if known.sum() < (2 * n + 1) * self.similarity / (1 + self.similarity) - 1e-9:
            return
        spans = self.sizes - SHINGLE + 1
        window = Counter(hashes.tolist())
        for i in np.flatnonzero((self.sizes > len(words)) & (spans * self.similarity <= n + 1e-9)).tolist():
            shared = sum((window & self.shingles[i]).values())
            similarity = shared / (n + int(spans[i]) - shared)
            if similarity >= self.similarity:
                distance = int(np.bitwise_count(simhash(hashes) ^ self.index.fps[i]))
                best[i] = (self.items[i], 0, len(words), distance, similarity)

    @staticmethod
    def _fingerprints(hashes: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
        low, high = int(starts[0]), int(starts[-1]) + span
        if high - low > 1 << 17:
            return np.array([simhash(hashes[s:s + span]) for s in starts], np.uint64)
        return window_simhashes(hashes[low:high], starts - low, span)

    def _match(self, held: list[tuple], best: dict[int, tuple]) -> None:
        """Probe the index with all windows at once; verify the items of the window's own length."""
        fps = np.concatenate([h[4] for h in held])
        part = np.repeat(np.arange(len(held)), [len(h[3]) for h in held])
        first = np.cumsum([0, *[len(h[3]) for h in held]])
        length = np.array([h[0] for h in held], np.int64)[part]
        q, i = self.index.search(fps)
        same = self.sizes[i] == length[q]
        for q_, i_ in zip(q[same].tolist(), i[same].tolist(), strict=True):
            _, span, hashes, starts, _ = held[part[q_]]
            start = int(starts[q_ - first[part[q_]]])
            window = Counter(hashes[start:start + span].tolist())
            shared = sum((window & self.shingles[i_]).values())
            similarity = shared / (2 * span - shared)
            if similarity >= self.similarity and (i_ not in best or similarity > best[i_][4]):
                best[i_] = (self.items[i_], start, int(length[q_]), int(np.bitwise_count(fps[q_] ^ self.index.fps[i_])), similarity)

    @staticmethod
    def _known(hashes: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(hashes) or not len(values):
            return np.zeros(len(hashes), bool)
        return values[np.minimum(np.searchsorted(values, hashes), len(values) - 1)] == hashes


def blocks(benchmark: DataFrame, block_items: int, block_bytes: int) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks. They stream through the driver a partition at a time; only one block is held."""
    ids, texts, held = [], [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        if ids and (len(ids) >= block_items or held + len(row["text"]) > block_bytes):
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        held += len(row["text"])
    if ids:
        yield ids, texts


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = 16,
                 block_items: int = 20_000, block_bytes: int = 16 << 20) -> DataFrame:
    """``(doc_id, item_id, start_word, words, distance, similarity)``: the best window of every item in
    every document that holds it.

    Of several blocks, each one's rows are written and its index is given back before the next block is read; only the
    last block's stay to be evaluated."""
    spark = docs.sparkSession
    kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, start_word int, words int, distance int, similarity double"
    found, last = [], None
    for ids, texts in blocks(benchmark, block_items, block_bytes):
        if last is not None:
            found[-1] = staged(found[-1], "block-hits")[0]
            last.destroy()
        last = shared = spark.sparkContext.broadcast(cloudpickle.dumps(BenchmarkIndex(ids, texts, radius, similarity)))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, known = pickle.loads(shared.value), WordHashes()
            for part in byte_rows(batches):
                rows = [(doc, *hit) for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)
                        for hit in index.search(word_hashes(text.decode("utf-8", "replace"), known))]
                if rows:
                    frame = pd.DataFrame(rows, columns=["doc_id", "item_id", "start_word", "words", "distance", "similarity"])
                    yield pa.record_batch([pa.array(frame[c].tolist(), f.type) for c, f in zip(frame, fields, strict=True)], schema=fields)

        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(spark.createDataFrame([], schema).schema)
        found.append(docs.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(search, schema))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = 16,
                  block_items: int = 20_000, block_bytes: int = 16 << 20) -> DataFrame:
    """The documents that hold no benchmark item, all columns. A benchmark of one block is searched where the documents are read; of
    several, the documents found in each are put down by id and text hash, and taken out in one join."""
    spark = docs.sparkSession
    some = list(islice(blocks(benchmark, block_items, block_bytes), 2))
    if not some:
        return docs
    if len(some) > 1:
        key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text"))
        hits = contaminated(docs.select(key.alias("doc_id"), "text"), benchmark, similarity, radius, block_items, block_bytes)
        hits = hits.select(F.col("doc_id.doc_id").alias("__i"), F.col("doc_id.text").alias("__t")).distinct()
        rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text"))
        return rows.join(hits, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__text") == F.col("__t")), "left_anti").select("__row.*")
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(BenchmarkIndex(*some[0], radius, similarity)))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = pickle.loads(shared.value), WordHashes()
        for part in byte_rows(batches):
            keep = [not index.search(word_hashes(t or "", known)) for t in part.column("text").to_pylist()]
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Operator 9 over all documents and all benchmark items."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
