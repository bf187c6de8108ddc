"""Operator 10: token counts by a public tokenizer, lengths only.

Texts go to Arrow functions in slices of about equal bytes (``slice_bytes``), so a batch of
long documents takes no more memory than one of short ones. A text is split at safe
boundaries: for a byte-level vocabulary that pre-tokenises by its pattern, a single space
between two characters that are not white space always starts a new pre-token (no pattern
alternative crosses it, and added tokens hold no white space), so the text's count is the
sum of its pieces' counts. Pieces repeat a lot, so a worker encodes each distinct piece
once, in batches balanced by bytes, and keeps the counts in a table of at most
``cache_pieces`` entries. Vocabularies without that property are given whole texts.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows are counted
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import byte_rows, table, utf8

# A single space whose neighbours are not white space; Python's \s covers every Unicode white space.
SAFE = re.compile(r"(?<=\S) (?=\S)")


def _balanced(pieces: list[str], limit: int = 1 << 18) -> Iterator[list[str]]:
    """Batches of about ``limit`` characters."""
    batch, held = [], 0
    for piece in pieces:
        batch.append(piece)
        held += len(piece)
        if held >= limit:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def pieces_of(text: str) -> list[str]:
    """The text cut at its safe boundaries; every piece but the first starts with its space."""
    parts = text.split(" ")
    if len(parts) > 1 and all(p and not p[0].isspace() and not p[-1].isspace() for p in parts):
        return [parts[0], *[" " + p for p in parts[1:]]]
    first, *rest = SAFE.split(text)
    return [first, *[" " + p for p in rest]]


def splits_safely(path: str) -> bool:
    """Byte-level vocabularies that pre-tokenise by the pattern, without a normaliser, and whose
    added tokens hold no white space and take none from their neighbours."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, post = spec.get("pre_tokenizer") or {}, spec.get("post_processor") or {"type": "ByteLevel"}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None and post.get("type") == "ByteLevel"
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                        for t in spec.get("added_tokens", [])))


def encoder(path: str) -> Callable[[list[str]], list[int]]:
    """Texts to numbers of tokens, without begin, end or added special tokens."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]


class Counter:
    """Counts texts in a worker; keeps the counts of the pieces it has met."""

    def __init__(self, path: str, cache_pieces: int):
        self.encode, self.split, self.most, self.known = encoder(path), splits_safely(path), cache_pieces, {}

    def count(self, texts: list[str]) -> list[int]:
        if not self.split:
            return [n for batch in _balanced(texts) for n in self.encode(batch)]
        return [self._pieces(pieces_of(t)) if t else 0 for t in texts]

    def _pieces(self, pieces: list[str]) -> int:
        known = self.known
        new = set(pieces).difference(known)
        if new:
            if len(known) + len(new) > self.most:
                known.clear()
                new = set(pieces)
            for batch in _balanced(list(new)):
                known.update(zip(batch, self.encode(batch), strict=True))
        return sum(map(known.__getitem__, pieces))


def token_counts(docs: DataFrame, path: str, limit: int = 512, slice_bytes: int = 8 << 20,
                 cache_pieces: int = 300_000) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = Counter(path, cache_pieces)
        for part in byte_rows(batches, "text", slice_bytes):
            raw = part.column("text").to_pylist()
            tokens = counter.count([b.decode("utf-8", "replace") for b in raw])
            yield pa.record_batch({"doc_id": part.column("doc_id"), "n_bytes": pa.array(map(len, raw), pa.int64()),
                                   "n_tokens": pa.array(tokens, pa.int64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", utf8(F.col("text")).alias("text"))
            .mapInArrow(lengths, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 10."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))
