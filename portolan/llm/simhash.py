"""Operator 5: SimHash near-dedup by the generalised pigeonhole principle.

Every text gets a 64-bit fingerprint of its word shingles (XXH64; a bit is set if it is set
in over half of the hashes). Equal fingerprints are merged first. To find the fingerprints
within ``radius`` bits of each other, the 64 bits are cut into m parts with thresholds
``t_1..t_m`` whose sum is ``radius - m + 1``: two fingerprints within the radius must differ in
at most ``t_i`` bits of some part i. Correlated bits are put into the same part, and m and the
thresholds are chosen by dynamic programming on the estimated cost: probe rows plus
candidate pairs, from bit frequencies counted over all fingerprints.

Probing is a Spark shuffle: each fingerprint is filed under its own value of each part and
probes the values within the part's threshold. Candidates are verified by the full Hamming
distance inside a bucket, and a bucket gives a spanning forest of its links instead of all pairs: the
components are the same and a dense group of n fingerprints costs n rows. A bucket with
more than ``cell`` rows is cut into cells (every block of its residents against every block of its
residents and probers), so no task holds an unbounded group.

Defined results: a null text counts as empty; texts without words have fingerprint zero,
linked like any other; null ids are never a ``component_id`` unless the whole component has
none; repeated rows appear each; an empty table gives an empty result. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import byte_rows, checkpoint, table, utf8
from portolan.llm.components import connected_components

BITS = 64
CHUNK = 1 << 16


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the text's word shingles, in chunks; a shorter text is one shingle."""
    import xxhash

    words = text.lower().split()
    if not words:
        return
    for start in range(0, max(1, len(words) - size + 1), CHUNK):
        part = words[start:start + CHUNK + size - 1]
        grams = [b" ".join(g) for g in zip(*(part[i:] for i in range(size)), strict=False)] or [b" ".join(part)]
        yield np.fromiter((xxhash.xxh64_intdigest(g, seed=42) for g in grams), np.uint64, len(grams))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set, most significant first."""
    return np.unpackbits(hashes.byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)


def fingerprint(text: bytes, size: int) -> int:
    """The SimHash as a signed 64-bit integer."""
    counts, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, size):
        counts += bit_counts(hashes)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n).view(">i8")[0]) if n else 0


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id`` (any kind) and ``fp`` of every row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_rows(batches):
            yield pa.record_batch({"doc_id": part.column("doc_id"),
                                   "fp": pa.array([fingerprint(t, size) for t in part.column("text").to_pylist()], pa.int64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(hashed, f"doc_id {kind}, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and the 64 x 64 matrix of how often two bits are both set, over all of
    them: every task adds up its own matrix, the driver adds the tasks' sums."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                bits = bits_of(batch.column("fp").to_numpy()[start:start + CHUNK])
                n, both = n + len(bits), both + bits.T @ bits
        if n:
            yield pa.record_batch({"n": pa.array([n], pa.int64()), "both": pa.array([both.ravel().tolist()], pa.list_(pa.float64()))})

    rows = fps.select("fp").mapInArrow(sums, "n long, both array<double>").select("n", F.posexplode("both").alias("k", "v"))
    total = rows.groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    both = np.zeros(BITS * BITS)
    for r in total:
        both[r["k"]] = r["v"]
    return (total[0]["n"] if total else 0), both.reshape(BITS, BITS)


def bits_of(fps: np.ndarray) -> np.ndarray:
    """Fingerprints to a 0/1 matrix, most significant bit first."""
    return np.unpackbits(fps.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` groups of about equal size, the most correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        pool = sorted(free)
        within = correlation[np.ix_(pool, pool)].sum(1)
        group = [pool[int(np.argmax(within))]]
        free.discard(group[0])
        while len(group) < size:
            pool = sorted(free)
            group.append(pool[int(np.argmax(correlation[np.ix_(pool, group)].sum(1)))])
            free.discard(group[-1])
        groups.append(group)
    return groups


def _close(differ: np.ndarray, most: int) -> np.ndarray:
    """Probability that at most 0, 1, .. ``most`` bits differ, for bits that differ with ``differ``."""
    odds = np.zeros(most + 2)
    odds[0] = 1.0
    for q in differ:
        odds[1:] = odds[1:] * (1 - q) + odds[:-1] * q
        odds[0] *= 1 - q
    return np.cumsum(odds[:most + 1])


def allocate(n: int, both: np.ndarray, radius: int, choices: tuple[int, ...] = (2, 3, 4, 5, 6),
             row_cost: float = 50.0) -> list[tuple[list[int], int]]:
    """The parts and their thresholds, ``[(bits, threshold)]`` (-1: a part that needs no probing).

    For every number of parts, dynamic programming spreads ``radius - m + 1`` over the parts so that
    the estimated cost is least: a shuffled probe row counts ``row_cost`` compared pairs.
    """
    from math import comb

    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in choices:
        total = radius - m + 1
        if m > 1 and total < -m:
            continue
        groups = group_bits(n, both, m)
        plan: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            most = min(radius, len(group))
            close = _close(differ[group], most)
            after: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in plan.items():
                for t in range(-1, most + 1):
                    rows = sum(comb(len(group), k) for k in range(t + 1))  # a prober's share is half of these
                    if rows > 20_000:
                        break
                    c = cost + (row_cost * n * rows / 2 + n * n / 2 * close[t] if t >= 0 else 0.0)
                    if used + t not in after or c < after[used + t][0]:
                        after[used + t] = (c, [*chosen, t])
            plan = after
        if total in plan and (best is None or plan[total][0] < best[0]):
            best = (plan[total][0], list(zip(groups, plan[total][1], strict=True)))
    return best[1]


def _flips(bits: list[int], threshold: int) -> np.ndarray:
    """All masks of one to ``threshold`` bits of a part, as signed integers."""
    from itertools import combinations

    masks = [sum(1 << (BITS - 1 - b) for b in c) for k in range(1, threshold + 1) for c in combinations(bits, k)]
    return np.array(masks, np.uint64).view(np.int64)


def filings(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """``(part, key, fp, probe)``: each fingerprint under its own value of a part, and as a probe under the
    values within the threshold that are smaller. Of two fingerprints that differ inside the
    threshold, the one with the larger value finds the other, so half of the probes do."""
    used = [(k, bits, t) for k, (bits, t) in enumerate(parts) if t >= 0]
    masks = [np.array([sum(1 << (BITS - 1 - b) for b in bits)], np.uint64).view(np.int64)[0] for _, bits, _ in used]
    flips = [_flips(bits, t) for _, bits, t in used]

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("fp").to_numpy()
            for (k, _, _), mask, flip in zip(used, masks, flips, strict=True):
                step = max(1, (1 << 19) // (len(flip) + 1))
                for start in range(0, len(whole), step):
                    fp = whole[start:start + step]
                    own = fp & mask
                    other = own[:, None] ^ flip[None, :]
                    rows, cols = np.nonzero(other.view(np.uint64) < own.view(np.uint64)[:, None])
                    key = np.concatenate([own, other[rows, cols]])
                    yield pa.record_batch({"part": pa.array(np.full(len(key), k, np.int32)), "key": pa.array(key),
                                           "fp": pa.array(np.concatenate([fp, fp[rows]])),
                                           "probe": pa.array(np.arange(len(key)) >= len(fp))})

    return fps.select("fp").mapInArrow(file, "part int, key long, fp long, probe boolean")


class Forest:
    """Union-find over the values met, kept while a cell is read."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def forest_edges(home: np.ndarray, guests: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (distance at most ``radius``) between ``home`` values and all values of a cell."""
    values = np.unique(np.concatenate([home, guests]))
    forest, edges = Forest(len(values)), []
    for a in np.unique(home):
        near = np.flatnonzero(np.bitwise_count((values ^ a).view(np.uint64)) <= radius)
        i = int(np.searchsorted(values, a))
        for j in near.tolist():
            if j != i and forest.join(i, j):
                edges.append((int(a), int(values[j])))
    return edges


def bucket_links(filed: DataFrame, radius: int, cell: int = 2048) -> DataFrame:
    """``(a, b)``: a spanning forest of the links of every bucket of ``filings``.

    Buckets are read in shuffled and sorted partitions, a group at a time; those without a second
    member are passed over. The few buckets above ``cell`` rows are found by counting and cut into
    cells of at most twice that size; those among them without a resident hold no link (0 blocks).
    """
    big = checkpoint(filed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.max(~F.col("probe")).alias("lived"))
                     .where(F.col("n") > cell)
                     .select("part", "key", F.when(F.col("lived"), F.ceil(F.col("n") / cell)).otherwise(0).cast("int").alias("blocks")))
    cut = filed.join(big, ["part", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # A resident is at home in its block's row of cells; everyone visits every row of cells in its block's column.
    home = cut.where(~F.col("probe") & (F.col("blocks") > 1)).select("part", "key", "fp", F.lit(True).alias("home"), block.alias("r"), "blocks")
    home = home.select("part", "key", "fp", "home", "r", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("c"))
    guest = cut.where("blocks > 1").select("part", "key", "fp", F.lit(False).alias("home"), block.alias("c"), "blocks")
    guest = guest.select("part", "key", "fp", "home", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("r"), "c")
    small = cut.where("blocks = 1").select("part", "key", "fp", (~F.col("probe")).alias("home"), F.lit(0).alias("r"), F.lit(0).alias("c"))
    cells = small.union(home.select(small.columns)).union(guest.select(small.columns))
    keys = ["part", "key", "r", "c"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _cells(b, radius), "a long, b long")


def _cells(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    rest = None
    for batch in _runs(batches):
        rest = [np.concatenate(x) for x in zip(rest, batch, strict=True)] if rest is not None else list(batch)
        keys, fp, home = rest
        change = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        if not len(change):
            continue
        last = change[-1]
        yield from _links(keys[:last], fp[:last], home[:last], radius)
        rest = [x[last:] for x in rest]
    if rest is not None:
        yield from _links(*rest, radius)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("part", "key", "r", "c")], axis=1)
            yield keys, batch.column("fp").to_numpy(), batch.column("home").to_numpy(zero_copy_only=False)


def _links(keys: np.ndarray, fp: np.ndarray, home: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Links of whole cells, which lie one after another."""
    starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1])
    ends = np.concatenate([starts[1:], [len(keys)]])
    edges: list[tuple[int, int]] = []
    for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
        at_home = home[s:e]
        if at_home.any():
            edges += forest_edges(fp[s:e][at_home], fp[s:e][~at_home], radius)
    if edges:
        a, b = np.array(edges, np.int64).T
        yield pa.record_batch({"a": pa.array(a), "b": pa.array(b)})


def similar_fingerprints(fps: DataFrame, radius: int) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints ``fp`` whose components are those of all links."""
    n, both = bit_statistics(fps)
    if n < 2:
        return fps.sparkSession.createDataFrame([], "a long, b long")
    return bucket_links(filings(fps, allocate(n, both, radius)), radius)


def simhash_components(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``component_id`` (smallest id reachable over links)."""
    hashed = checkpoint(fingerprints(docs, size))
    distinct = checkpoint(hashed.groupBy("fp").agg(F.min("doc_id").alias("low")))
    labels = connected_components(checkpoint(similar_fingerprints(distinct, radius)))
    named = checkpoint(distinct.join(labels, F.col("fp") == F.col("node"), "left")
                       .select("fp", "low", F.coalesce("label", "fp").alias("label")))
    lowest = named.groupBy("label").agg(F.min("low").alias("component_id"))
    classes = checkpoint(named.join(lowest, "label").select("fp", "component_id"))
    return hashed.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """One document of every component stays, all columns: the one with the smallest id (null after all others, then
    the smallest text hash). Of rows that repeat id and text one stays, the smallest.

    Only ids, hashes and fingerprints meet in the search; the texts are shuffled once, by id and text hash, with rows
    that repeat both made one in the map tasks."""
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("__id"),
           F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("__text")]
    hashed = fingerprints(docs.select(F.struct(*key).alias("doc_id"), "text"), size)
    distinct = checkpoint(hashed.groupBy("fp").agg(F.min("doc_id").alias("low")))
    labels = connected_components(checkpoint(similar_fingerprints(distinct, radius)))
    named = distinct.join(labels, F.col("fp") == F.col("node"), "left").select(F.coalesce("label", "fp").alias("label"), "low")
    keepers = checkpoint(named.groupBy("label").agg(F.min("low").alias("k"))
                         .select(F.col("k.__id").alias("__i"), F.col("k.__text").alias("__t")))
    # Maps have no order; any of the rows that differ only there will do.
    one = F.any_value if any("map<" in kind for _, kind in docs.dtypes) else F.min
    rows = docs.select(F.struct(*docs.columns).alias("__row"), *key).groupBy("__id", "__text").agg(one("__row").alias("__row"))
    return rows.join(keepers, (F.col("__id") == F.col("__i")) & (F.col("__text") == F.col("__t")), "left_semi").select("__row.*")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 5."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
