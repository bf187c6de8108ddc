"""Operator 8: exact dedup through a cuckoo-filter index of live digests.

The index is a table of shards. A shard holds the digests whose hash falls into it: a cuckoo
filter (four 16-bit fingerprints a bucket, two candidate buckets a digest) and, as stored
content, a row per live digest with its smallest id and its number of live rows. ``insert``
probes the filter first: a miss proves a new digest; a hit is verified against the stored
content of the shard, so a false hit never joins two texts. A digest that finds no slot
after a bounded chain of moves overflows the filter, which is then rebuilt at twice the size
from the stored digests. ``delete`` takes live rows away, of which the index keeps a table (digest, id, number) beside the
shards: a row that isn't live takes nothing, a digest whose smallest id goes gets the next live one, and the
fingerprint of a digest whose last live row went is removed. Shards split in two as they grow beyond ``shard_rows`` digests.

Every step is a Spark job over the shards. A batch is reduced to a row per digest and
record batch before it is shuffled, so a group of copies that holds a third of all rows
sends a few rows per task. The number of shards follows the number of such rows
(``shard_rows``), which bounds the state of a shard and so the memory of a task.

Defined results: a null text counts as empty; a null id sorts after all ids, and a group of
null ids only has a null ``keep_id``; rows that repeat id and text all count in
``group_size``, and all rows with the smallest id are ``kept``; an empty table gives an
empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import SPACE, checkpoint, table

NO_ID = (1 << 63) - 1  # stands for null while the smallest id is sought
SLOTS, MOVES = 4, 200
STATE = "shard long, filter binary, digests binary, keeps binary, counts binary"


class CuckooFilter:
    """Partial-key cuckoo filter over 32-byte digests. The digest's bytes are already uniform, so
    its fingerprint and bucket are read off them."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.buckets = buckets  # a power of two
        self.slots = [0] * (buckets * SLOTS) if slots is None else slots.tolist()

    @classmethod
    def sized(cls, digests: int) -> CuckooFilter:
        return cls(1 << max(1, (max(digests, 1) * 5 // (SLOTS * 4)).bit_length()))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[8:16], "big") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def __contains__(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        at, also = first * SLOTS, second * SLOTS
        return mark in self.slots[at:at + SLOTS] or mark in self.slots[also:also + SLOTS]

    def insert(self, digest: bytes) -> bool:
        """False on overflow; the caller then rebuilds from its stored digests."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.slots[i]:
                    self.slots[i] = mark
                    return True
        bucket = second
        for move in range(MOVES):
            i = bucket * SLOTS + (mark + move) % SLOTS
            mark, self.slots[i] = self.slots[i], mark
            bucket = self._other(bucket, mark)
            for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.slots[i]:
                    self.slots[i] = mark
                    return True
        return False

    def remove(self, digest: bytes) -> None:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[i] == mark:
                    self.slots[i] = 0
                    return


class Shard:
    """A shard's filter and stored content: digest -> [smallest live id, live rows]."""

    def __init__(self, state: dict | None = None):
        self.content: dict[bytes, list[int]] = {}
        if state is None:
            self.filter = CuckooFilter.sized(64)
            return
        packed, keeps, counts = state["digests"], np.frombuffer(state["keeps"], "<i8"), np.frombuffer(state["counts"], "<i8")
        self.content = {packed[32 * i:32 * i + 32]: [int(k), int(c)] for i, (k, c) in enumerate(zip(keeps, counts, strict=True))}
        slots = np.frombuffer(state["filter"], "<u2")
        self.filter = CuckooFilter(len(slots) // SLOTS, slots)

    def add(self, digest: bytes, keep: int, rows: int) -> None:
        if digest in self.filter:  # maybe live: the stored content decides
            live = self.content.get(digest)
            if live is not None:
                live[0], live[1] = min(live[0], keep), live[1] + rows
                return
        self.content[digest] = [keep, rows]
        if not self.filter.insert(digest):
            self._rebuild(self.filter.buckets * 2)

    def take(self, digest: bytes, rows: int, keep: int | None = None) -> None:
        """Take live rows away; ``keep`` is the smallest id that stays."""
        live = self.content.get(digest) if digest in self.filter else None
        if live is None:
            return
        live[1] -= rows
        if keep is not None:
            live[0] = keep
        if live[1] <= 0:
            del self.content[digest]
            self.filter.remove(digest)

    def _rebuild(self, buckets: int) -> None:
        self.filter = CuckooFilter(buckets)
        if not all(self.filter.insert(d) for d in self.content):
            self._rebuild(buckets * 2)

    def split(self, shard: int, shards: int) -> list[dict]:
        """The states of the two shards that take its place when their number doubles."""
        import xxhash

        parts = {shard: Shard(), shard + shards: Shard()}
        for d, (keep, rows) in self.content.items():
            # Spark's xxhash64 of bytes is XXH64 with seed 42; as a signed number.
            value = xxhash.xxh64_intdigest(d, seed=42)
            value -= (value >> 63) << 64
            parts[value % (2 * shards)].add(d, keep, rows)
        return [part.state(k) for k, part in parts.items()]

    def state(self, shard: int) -> dict:
        keeps, counts = zip(*self.content.values(), strict=True) if self.content else ((), ())
        return {"shard": shard, "filter": np.array(self.filter.slots, "<u2").tobytes(), "digests": b"".join(self.content),
                "keeps": np.array(keeps, "<i8").tobytes(), "counts": np.array(counts, "<i8").tobytes()}


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grouped = pa.Table.from_batches([batch]).group_by("digest").aggregate([("keep", "min"), ("rows", "sum")])
        yield from grouped.rename_columns(["digest", "keep", "rows"]).cast(
            pa.schema([("digest", pa.binary()), ("keep", pa.int64()), ("rows", pa.int64())])).to_batches()


def reduced(digests: DataFrame) -> DataFrame:
    """``(digest, keep, rows)``, a row per digest and record batch, from ``(doc_id, digest)``."""
    return _numbered(digests).mapInArrow(_reduce, "digest binary, keep long, rows long")


def _numbered(digests: DataFrame) -> DataFrame:
    """``(digest, keep, rows)`` of each row ``(doc_id, digest)``, null ids as ``NO_ID``."""
    return digests.select("digest", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("keep"), F.lit(1).cast("long").alias("rows"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


class CuckooIndex:
    """A sharded index: ``table`` has a row per shard, ``rows`` the rows inserted and taken (``digest``, ``keep``: the id, ``rows``: how many
    more or fewer). Operations return a new index; nothing is changed in place, so a lost executor only repeats its shards.
    ``shard_rows``, if given, is the number of digests a shard that an insert should not leave far behind."""

    def __init__(self, state: DataFrame, shards: int, rows: DataFrame | None = None, shard_rows: int | None = None):
        self.table, self.shards, self.rows, self.shard_rows = state, shards, rows, shard_rows

    @classmethod
    def empty(cls, spark, shards: int = 1, shard_rows: int | None = None) -> CuckooIndex:
        return cls(spark.createDataFrame([], STATE), shards, None, shard_rows)

    def insert(self, digests: DataFrame) -> CuckooIndex:
        """Add the rows ``(doc_id, digest)``."""
        batch = reduced(digests)
        index = self._grown(batch) if self.shard_rows else self
        rows = _numbered(digests)
        return index._apply(batch.withColumn("taken", F.lit(False)), rows if self.rows is None else self.rows.unionByName(rows))

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """Take the rows ``(doc_id, digest)`` away, each as often as it is given and live."""
        if self.rows is None:
            return self
        gone = _numbered(digests).groupBy("digest", "keep").agg(F.sum("rows").alias("gone"))
        # Only rows of the digests that the batch names are looked at.
        touched = gone.select(F.col("digest").alias("__d")).distinct()
        live = self.rows.join(touched, F.col("digest") == F.col("__d"), "left_semi").groupBy("digest", "keep").agg(F.sum("rows").alias("rows"))
        taken = live.where("rows > 0").join(gone, ["digest", "keep"], "left").select(
            "digest", "keep", "rows", F.least("rows", F.coalesce("gone", F.lit(0))).alias("gone"))
        taken = checkpoint(taken)
        stays = F.min(F.when(F.col("rows") > F.col("gone"), F.col("keep")))
        batch = taken.groupBy("digest").agg(stays.alias("keep"), F.sum("gone").alias("rows")).where("rows > 0")
        rows = self.rows.unionByName(taken.where("gone > 0").select("digest", "keep", (-F.col("gone")).alias("rows")))
        return self._apply(batch.select("digest", F.coalesce("keep", F.lit(NO_ID)).alias("keep"), "rows", F.lit(True).alias("taken")), checkpoint(rows))

    def _apply(self, batch: DataFrame, live: DataFrame) -> CuckooIndex:
        batch = batch.withColumn("shard", _shard(self.shards))

        def step(key, state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            shard = Shard(state.iloc[0].to_dict() if len(state) else None)
            for d, keep, n, taken in zip(rows["digest"], rows["keep"], rows["rows"], rows["taken"], strict=True):
                shard.take(d, n, keep) if taken else shard.add(d, keep, n)
            return pd.DataFrame([shard.state(int(key[0]))])

        merged = self.table.groupBy("shard").cogroup(batch.groupBy("shard")).applyInPandas(step, STATE)
        return CuckooIndex(checkpoint(merged), self.shards, live, self.shard_rows)

    def _grown(self, batch: DataFrame) -> CuckooIndex:
        """The index with its shards doubled until the batch leaves them within about ``shard_rows`` digests."""
        held = self.table.agg(F.coalesce(F.sum(F.octet_length("digests")), F.lit(0))).first()[0] // 32
        index, expected = self, held + batch.count()
        while expected > index.shards * self.shard_rows:
            shards = index.shards

            def split(batches: Iterator[pa.RecordBatch], shards=shards) -> Iterator[pa.RecordBatch]:
                for part in batches:
                    for row in part.to_pylist():
                        states = pd.DataFrame(Shard(row).split(row["shard"], shards))
                        yield pa.RecordBatch.from_pandas(states, preserve_index=False)

            index = CuckooIndex(index.table.mapInArrow(split, STATE), 2 * shards, self.rows, self.shard_rows)
        return CuckooIndex(checkpoint(index.table), index.shards, index.rows, self.shard_rows) if index is not self else self

    def content(self) -> DataFrame:
        """The live digests: ``digest``, ``keep_id``, ``group_size``."""
        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    keeps = np.frombuffer(row["keeps"], "<i8")
                    yield pa.record_batch({
                        "digest": pa.array([row["digests"][i:i + 32] for i in range(0, len(row["digests"]), 32)], pa.binary()),
                        "keep_id": pa.array(keeps, pa.int64(), mask=keeps == NO_ID),
                        "group_size": pa.array(np.frombuffer(row["counts"], "<i8"), pa.int64())})

        return self.table.mapInArrow(unpack, "digest binary, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, shard_rows: int = 20_000) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    digests = checkpoint(docs.select("doc_id", digest(F.col("text")).alias("digest")))
    shards = -(-digests.count() // shard_rows) or 1
    live = checkpoint(CuckooIndex.empty(docs.sparkSession, shards).insert(digests).content())
    # Both sides are read from files and dealt by digest, so a hot digest's rows are split by AQE.
    return digests.join(live, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 8."""
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""
