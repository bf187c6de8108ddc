"""Operator 11: fill-in-the-middle transformation.

A text is cut at two allowed places into prefix, middle and suffix, which are put out in another
order with markers between them. The allowed places of a text are a boundary set: the byte offsets of its UTF-8
form at which a unit starts. Units are code points, words (a word with the white space after it) or
lines. The set is kept as a Roaring bitmap is: the offsets of each block of 65,536 bytes form one
container, an array of 16-bit offsets, a bitmap of 65,536 bits, or a list of runs, whichever is
smallest, and the containers carry cumulative cardinalities. ``select(k)``, the offset of unit ``k``, is a search for
the container among the cumulative cardinalities and a select inside it (array: index; runs: search among
the runs' cumulative lengths; bitmap: search among the words' cumulative popcounts, then in the word's bits). A long ASCII text is a run a container, so its
cuts cost two searches however long it is.

Texts travel as bytes in slices of bounded size and never leave their row: no shuffle.

Cut places and forms come from the sha256 of ``<seed>:<doc_id>``, so reruns agree: its first three
8-digit groups of hex digits give the two cuts, modulo units + 1, and whether the text is
rearranged, the fourth the order (``spm``: suffix first).

Defined results: a null text counts as empty and is ``plain``; an empty text is ``plain``; a text that holds a marker is ``plain``, so
every output can be restored; equal cuts give an empty middle; a null ``doc_id`` hashes
as the empty string; repeated rows come out alike; an empty table gives an empty result; extra columns are
not read. Bytes that are not UTF-8 start no code point unless they look like a first byte, and are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import byte_rows, table, utf8

BLOCK = 1 << 16
MARKERS = ("<P>", "<S>", "<M>")
UNITS = ("codepoint", "word", "line")


def unit_starts(data: np.ndarray, unit: str) -> np.ndarray:
    """Booleans: which bytes of a UTF-8 text start a unit. The first byte always does."""
    if unit == "codepoint":
        starts = (data & 0xC0) != 0x80
    elif unit == "word":
        space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        starts = np.concatenate([[True], space[:-1] & ~space[1:]])
    elif unit == "line":
        starts = np.concatenate([[True], data[:-1] == 0x0A])
    else:
        raise ValueError(f"unit must be one of {UNITS}: {unit}")
    return starts


@dataclass(frozen=True)
class Run:
    """Offsets as runs: first offset of each and the number of offsets before it."""

    first: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


@dataclass(frozen=True)
class Array:
    """Offsets as a sorted array of 16-bit numbers."""

    offsets: np.ndarray

    def select(self, k: int) -> int:
        return int(self.offsets[k])


@dataclass(frozen=True)
class Bitmap:
    """Offsets as bits, eight to a byte, and the number of offsets before each 64-bit word."""

    bits: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        ones = np.flatnonzero(np.unpackbits(self.bits[8 * word:8 * word + 8], bitorder="little"))
        return 64 * word + int(ones[k - int(self.before[word])])


def container(starts: np.ndarray) -> Run | Array | Bitmap:
    """The smallest container of the offsets at which ``starts`` (up to 65,536 booleans, one true at
    least) is true: 4 bytes a run, 2 an offset, 8,192 for a bitmap."""
    edges = np.flatnonzero(starts[1:] != starts[:-1]) + 1
    if starts[0]:
        edges = np.concatenate([[0], edges])
    first, last = edges[::2], edges[1::2]
    if len(last) < len(first):
        last = np.append(last, len(starts))
    cardinality = int((last - first).sum())
    if 4 * len(first) <= min(2 * cardinality, BLOCK // 8):
        return Run(first.astype(np.uint16), np.cumsum(last - first) - (last - first))
    if 2 * cardinality <= BLOCK // 8:
        return Array(np.flatnonzero(starts).astype(np.uint16))
    bits = np.packbits(starts, bitorder="little")
    bits = np.append(bits, np.zeros(-len(bits) % 8, np.uint8))
    counts = np.bitwise_count(bits.view(np.uint64)).astype(np.int64)
    return Bitmap(bits, np.cumsum(counts) - counts)


class BoundarySet:
    """The places at which a text may be cut: the starts of its units, and its end."""

    def __init__(self, data: bytes | np.ndarray, unit: str = "codepoint"):
        data = np.frombuffer(data, np.uint8) if isinstance(data, (bytes, memoryview)) else data
        self.size, self.keys, self.parts, self.before = len(data), [], [], []
        starts = unit_starts(data, unit) if len(data) else np.zeros(0, bool)
        n = 0
        for block in range(0, len(starts), BLOCK):
            part = starts[block:block + BLOCK]
            count = int(np.count_nonzero(part))
            if count:
                self.keys.append(block)
                self.parts.append(container(part))
                self.before.append(n)
                n += count
        self.units = n
        self.before = np.array(self.before, np.int64)

    def select(self, k: int) -> int:
        """Byte offset of unit ``k``; ``units`` is the end of the text."""
        if not 0 <= k <= self.units:
            raise IndexError(k)
        if k == self.units:
            return self.size
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return self.keys[at] + self.parts[at].select(k - int(self.before[at]))

    def cuts(self, a: int, b: int) -> tuple[int, int]:
        """Byte offsets of two units, the smaller first."""
        return self.select(min(a, b)), self.select(max(a, b))


def draws(doc_id: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits, fixed by seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))


def rearrange(data: bytes, doc_id: object, seed: int, unit: str, plain_percent: int, spm_percent: int,
              markers: tuple[bytes, bytes, bytes]) -> tuple[int, str, int | None, int | None, bytes]:
    """``(units, form, prefix units, middle units, output)`` of one text."""
    cut = BoundarySet(data, unit)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not data or h3 % 100 >= 100 - plain_percent or any(m in data for m in markers):
        return cut.units, "plain", None, None, data
    a, b = sorted((h1 % (cut.units + 1), h2 % (cut.units + 1)))
    i, j = cut.cuts(a, b)
    pre, suf, mid = markers
    if h4 % 100 < spm_percent:
        return cut.units, "spm", a, b - a, b"".join([suf, data[j:], pre, data[:i], mid, data[i:j]])
    return cut.units, "psm", a, b - a, b"".join([pre, data[:i], suf, data[j:], mid, data[i:j]])


def fill_in_middle(docs: DataFrame, seed: int = 1, unit: str = "codepoint", plain_percent: int = 10, spm_percent: int = 20,
                   markers: tuple[str, str, str] = MARKERS, slice_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` (units), ``form`` (plain, psm, spm), ``prefix_units``, ``middle_units``
    (null if plain) and ``output``, the rearranged text. ``plain_percent`` of the texts stay plain.
    ``markers`` stand before prefix, suffix and middle."""
    if any(not m or any(m.endswith(other[:k]) for other in markers for k in range(1, len(m))) for m in markers) or len(set(markers)) < 3:
        raise ValueError("markers must differ, and no end of one may begin another")
    marks = tuple(m.encode() for m in markers)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_rows(batches, "text", slice_bytes):
            ids, texts = part.column("doc_id").to_pylist(), part.column("text")
            rows = [rearrange(text.as_py(), i, seed, unit, plain_percent, spm_percent, marks) for i, text in zip(ids, texts, strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()),
                                   "prefix_units": pa.array(prefix, pa.int64()), "middle_units": pa.array(middle, pa.int64()),
                                   "output": pa.array(output, pa.binary())})

    done = docs.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_units long, middle_units long, output binary")
    return done.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text from which ``output`` was made. Outputs that aren't plain hold every marker once."""
    pre, suf, mid = (F.lit(m) for m in markers)

    def between(first: Column | None, last: Column | None) -> Column:
        text = output if first is None else F.split_part(output, first, F.lit(2))
        return text if last is None else F.split_part(text, last, F.lit(1))

    psm = F.concat(between(pre, suf), between(mid, None), between(suf, mid))
    spm = F.concat(between(pre, mid), between(mid, None), between(suf, pre))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Operator 11 over all documents, cut between code points."""
    done = fill_in_middle(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
             sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
h AS (SELECT doc_id, t, n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) for i in range(4)] AS h FROM d),
c AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
             WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM o"""
