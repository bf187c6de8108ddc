"""Operator 13: byte-level BPE encoding and decoding.

Encoding takes a text's pre-tokens (matches of a pattern) one by one and merges the bytes of each by
ranks. A text longer than ``stride`` characters is cut into overlapping chunks, which Spark deals over the tasks:

1. *Pre-tokenise* every chunk by itself. The pattern looks ahead but never back, so two scans that
   share a boundary agree from there on. Each chunk reports the boundaries in its two overlaps (the last
   ``LOOK`` characters before its end aside, where the pattern could not look ahead).
2. *Stitch*: the first boundary that both neighbours found in their overlap is where they are in step; a chunk owns the pre-tokens
   from there to the next such place. The first chunk starts right, so by induction all do. This joins narrow rows,
   numbers only. A text with neighbours that share no boundary (a pre-token longer than the overlap) is
   scanned whole, by one task.
3. *Encode* the pieces that each chunk owns, and put a text's pieces together in order.

A shorter text is one chunk: it is encoded where it is read and meets no shuffle. Distinct pre-tokens are merged once per
worker and kept, up to ``keep`` of them.

Decoding concatenates the ids' bytes. Ids are kept packed, as little-endian unsigned 32-bit integers
(``tokens``), the form in which training reads them; :func:`token_ids` unpacks them.

Letters, numbers and white space are those of the installed tiktoken library, whose Unicode version differs from
that of the regular expressions used here: the library itself is asked which characters it counts (:func:`splitter`).

Defined results: a null text counts as empty and has no tokens; repeated rows come out alike, long ones are encoded
once; null ids are a value; bytes that are not UTF-8 count as U+FFFD; an empty table gives an empty result; extra columns
are not read; an id that the vocabulary lacks raises when it is decoded.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.common import byte_rows, table, utf8
from portolan.session import stage

#: Characters before a chunk's end at which a boundary isn't trusted: the pattern's longest look beyond the end of
#: a match is two characters (contractions), beyond a run one.
LOOK = 4
CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _spans(numbers: list[int]) -> str:
    """Code points as ranges of a character class."""
    out, start = [], None
    for i, n in enumerate(numbers):
        start = n if start is None else start
        if i + 1 == len(numbers) or numbers[i + 1] != n + 1:
            out.append(f"\\U{start:08X}-\\U{n:08X}")
            start = None
    return "".join(out)


def splitter(pattern: str, ranks: dict[bytes, int]) -> tuple[str, str, str]:
    """``(plain, odd, exact)``, regular expressions: the pattern; what finds a character that this library and tiktoken class differently (empty: none
    does); and the pattern with tiktoken's classes spelt out, for texts that hold one."""
    import tiktoken

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text, exact, odd = "".join(every), pattern, set()
    for name in CLASSES:
        # Only what the pattern matches is encoded, so decoding gives back the members of the class.
        theirs = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks, special_tokens={})
        members = set(theirs.decode(theirs.encode_ordinary(text)))
        differ = members ^ set(regex.findall(name, text))
        if differ:
            odd |= differ
            ours = _spans(sorted(map(ord, members)))
            # Inside a class the members stand as they are, elsewhere as a class of their own.
            exact = regex.sub(r"(\[[^\]]*)" + regex.escape(name), lambda m: m[1] + ours, exact, count=0)  # noqa: B023
            exact = exact.replace(name, f"[{ours}]")
    return pattern, f"[{_spans(sorted(map(ord, odd)))}]" if odd else "", exact


class Pretokenizer:
    """Cuts texts into pre-tokens by the expressions of :func:`splitter`."""

    def __init__(self, patterns: tuple[str, str, str]):
        self.plain, self.exact = regex.compile(patterns[0]), regex.compile(patterns[2])
        self.odd = regex.compile(patterns[1]) if patterns[1] else None

    def _pattern(self, text: str) -> regex.Pattern:
        return self.plain if self.odd is None or text.isascii() or not self.odd.search(text) else self.exact

    def split(self, text: str) -> list[str]:
        return self._pattern(text).findall(text)

    def boundaries(self, text: str) -> list[int]:
        """Starts of the pre-tokens, and the end of the last."""
        ends = [m.end() for m in self._pattern(text).finditer(text)]
        return [0, *ends]


class Encoder:
    """Pre-tokens to packed ids, in a worker; keeps the ids of those it has met."""

    def __init__(self, ranks: dict[bytes, int], keep: int):
        import tiktoken

        # Each piece is one match of this pattern, so all of its bytes are merged together.
        self.merge = tiktoken.Encoding("piece", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.keep, self.known = keep, {}

    def encode(self, pieces: list[str]) -> bytes:
        known = self.known
        new = set(pieces).difference(known)
        if new:
            if len(known) + len(new) > self.keep:
                known.clear()
                new = set(pieces)
            for piece in new:
                known[piece] = np.array(self.merge(piece), "<u4").tobytes()
        return b"".join(map(known.__getitem__, pieces))


def chunks_of(text: str, stride: int, overlap: int) -> list[str]:
    """The overlapping chunks of a text; the last holds its end."""
    last = max(0, -(-(len(text) - overlap) // stride) - 1)
    return [text[i * stride:(i + 1) * stride + overlap] if i < last else text[i * stride:] for i in range(last + 1)]


def _text(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def _whole(docs: DataFrame, keys: str, names: list[str], patterns: tuple[str, str, str], path: str, keep: int, slice_bytes: int) -> DataFrame:
    """Texts encoded where they are: ``names`` and ``tokens``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        cut, encoder = Pretokenizer(patterns), Encoder(ranks, keep)
        for part in byte_rows(batches, "text", slice_bytes):
            tokens = [encoder.encode(cut.split(_text(t.as_py()))) for t in part.column("text")]
            yield pa.record_batch({**{n: part.column(n) for n in names}, "tokens": pa.array(tokens, pa.binary())})

    return docs.select(*names, "text").mapInArrow(run, f"{keys}, tokens binary")


def _pieces(long: DataFrame, kind: str, stride: int, overlap: int, slice_bytes: int) -> DataFrame:
    """``(doc_id, key, chunk, last, piece, copies)``: the chunks of long texts, dealt over the tasks. Rows that
    repeat id and text (``key`` is its sha256) are one, with a number of copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_rows(batches, "text", slice_bytes):
            for row in range(part.num_rows):
                parts = chunks_of(_text(part.column("text")[row].as_py()), stride, overlap)
                at = pa.array([row] * len(parts))
                yield pa.record_batch({"doc_id": part.column("doc_id").take(at), "key": part.column("key").take(at),
                                       "chunk": pa.array(range(len(parts)), pa.int32()), "last": pa.array([len(parts) - 1] * len(parts), pa.int32()),
                                       "piece": pa.array([p.encode() for p in parts], pa.binary())})

    cut = long.mapInArrow(run, f"doc_id {kind}, key string, chunk int, last int, piece binary")
    return cut.groupBy("doc_id", "key", "chunk", "last").agg(F.any_value("piece").alias("piece"), F.count(F.lit(1)).alias("copies"))


def _overlaps(pieces: DataFrame, kind: str, stride: int, overlap: int, patterns: tuple[str, str, str], slice_bytes: int) -> DataFrame:
    """``(doc_id, key, chunk, last, copies, head, tail)``: the boundaries of each chunk in the overlap with its predecessor
    and its successor, from the overlap's start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Pretokenizer(patterns)
        for part in byte_rows(batches, "piece", slice_bytes):
            heads, tails = [], []
            for piece, chunk, last in zip(part.column("piece"), part.column("chunk").to_pylist(), part.column("last").to_pylist(), strict=True):
                text = _text(piece.as_py())
                found = np.array(cut.boundaries(text))
                if chunk < last:
                    found = found[found <= len(text) - LOOK]
                heads.append(found[found < overlap])
                tails.append(found[found >= stride] - stride if chunk < last else [])
            yield pa.record_batch({**{n: part.column(n) for n in ("doc_id", "key", "chunk", "last", "copies")},
                                   "head": pa.array(heads, pa.list_(pa.int32())), "tail": pa.array(tails, pa.list_(pa.int32()))})

    return pieces.mapInArrow(run, f"doc_id {kind}, key string, chunk int, last int, copies long, head array<int>, tail array<int>")


def _stitched(overlaps: DataFrame, stride: int) -> DataFrame:
    """``(doc_id, key, chunk, last, copies, from, to, whole)``: what each chunk owns, in its own characters (``to`` null: to its end), and
    whether its text has neighbours out of step. By windows over the chunks of a text, a few numbers each."""
    of_text = Window.partitionBy("doc_id", "key")
    order = of_text.orderBy("chunk")
    common = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
    own = overlaps.select("doc_id", "key", "chunk", "last", "copies", F.when(F.col("chunk") == 0, 0).otherwise(common).alias("from"))
    out = F.max(F.col("from").isNull()).over(of_text)
    return own.select("*", (F.lead("from").over(order) + stride).alias("to"), out.alias("whole"))


def _encoded(owned: DataFrame, kind: str, patterns: tuple[str, str, str], path: str, keep: int, slice_bytes: int) -> DataFrame:
    """``(doc_id, key, chunk, copies, tokens)`` of the chunks' own pieces."""
    names = ("doc_id", "key", "chunk", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        cut, encoder = Pretokenizer(patterns), Encoder(ranks, keep)
        for part in byte_rows(batches, "piece", slice_bytes):
            tokens = []
            for piece, start, end in zip(part.column("piece"), part.column("from").to_pylist(), part.column("to").to_pylist(), strict=True):
                # From a boundary on the scan is the whole text's; it may look past the end of what is owned.
                text = _text(piece.as_py())[start:]
                found = cut.split(text)
                if end is not None:
                    at, n = 0, 0
                    while at < end - start:
                        at += len(found[n])
                        n += 1
                    found = found[:n]
                tokens.append(encoder.encode(found))
            yield pa.record_batch({**{n: part.column(n) for n in names}, "tokens": pa.array(tokens, pa.binary())})

    return owned.mapInArrow(run, f"doc_id {kind}, key string, chunk int, copies long, tokens binary")


def encode(docs: DataFrame, path: str, pattern: str, stride: int = 32_768, overlap: int = 512, keep: int = 300_000,
           slice_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens`` and ``tokens``, the packed ids. ``path`` names the rank file on every executor,
    ``pattern`` the pre-tokens."""
    if not LOOK < overlap < stride:
        raise ValueError("overlap must lie between the pattern's look-ahead and the stride")
    kind = docs.schema["doc_id"].dataType.simpleString()
    patterns = splitter(pattern, read_ranks(path))
    texts = docs.select("doc_id", utf8(F.col("text")).alias("text"))
    is_long = F.octet_length("text") > stride + overlap
    short = _whole(texts.where(~is_long), f"doc_id {kind}", ["doc_id"], patterns, path, keep, slice_bytes)
    long = texts.where(is_long).select("doc_id", F.sha2("text", 256).alias("key"), "text")
    pieces = stage(_pieces(long, kind, stride, overlap, slice_bytes), "bpe-pieces")
    places = stage(_stitched(_overlaps(pieces, kind, stride, overlap, patterns, slice_bytes), stride), "bpe-places")

    in_step = places.where(~F.col("whole"))
    owned = pieces.select("doc_id", "key", "chunk", "piece").join(
        in_step.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("chunk").alias("__chunk"), "copies", "from", "to"),
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")) & (F.col("chunk") == F.col("__chunk")))
    parts = _encoded(owned.select("doc_id", "key", "chunk", "copies", "piece", "from", "to"), kind, patterns, path, keep, slice_bytes)
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("chunk", "tokens"))), F.lit(b""), lambda done, p: F.concat(done, p["tokens"]))
    stitched = (parts.groupBy("doc_id", "key").agg(F.any_value("copies").alias("copies"), joined.alias("tokens"))
                .select("doc_id", "tokens", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", "tokens"))
    rest = places.where(F.col("whole") & (F.col("chunk") == 0)).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    unstitched = long.join(rest, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left_semi")
    unstitched = _whole(unstitched, f"doc_id {kind}", ["doc_id"], patterns, path, keep, slice_bytes)
    done = short.unionByName(stitched).unionByName(unstitched)
    return done.select("doc_id", (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"), "tokens")


def token_ids(tokens: bytes) -> list[int]:
    """Packed ids as numbers."""
    return np.frombuffer(tokens, "<u4").tolist()


def decode(encoded: DataFrame, path: str, slice_bytes: int = 4 << 20) -> DataFrame:
    """``encoded`` (with ``tokens``, packed ids) and ``data``: the bytes that the ids stand for."""
    names = list(encoded.columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Callable[[int], bytes] = {rank: token for token, rank in read_ranks(path).items()}.__getitem__
        for part in byte_rows(batches, "tokens", slice_bytes):
            data = [b"".join(map(known, token_ids(t.as_py() or b""))) for t in part.column("tokens")]
            yield pa.record_batch({**{n: part.column(n) for n in names}, "data": pa.array(data, pa.binary())})

    return encoded.mapInArrow(run, f"{kinds}, data binary")


def op13_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Operator 13 over all documents: encode, then decode."""
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    done = decode(encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return done.select("doc_id", "n_tokens", F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))
