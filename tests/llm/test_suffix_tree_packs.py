"""Operator 3, round 3 (F1): strings go through the shuffles in packs, not in a row each."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from portolan.llm import suffix_tree


def test_weights_are_packs(spark):
    """20,000 distinct words: the table that is met with the documents has a few hundred rows."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(20_000)}" for _ in range(400)) for _ in range(100)]
    model = suffix_tree.learn(spark.createDataFrame([(t.encode(),) for t in texts], "text binary"), depth=1)
    distinct = len({w for t in texts for w in t.split()}) + 1
    assert model.distinct == distinct and model.total == 100 * 401
    assert model.weights.count() < distinct / 10
    assert model.weights.where(F.col("kind") == suffix_tree.WORD).agg(F.sum("size")).first()[0] == distinct


def test_tokens_of_odd_texts(monkeypatch):
    """Words are cut and told apart as by bytes.lower().split(), wherever a piece of the texts ends."""
    rng = random.Random(6)
    texts = [b"", b" \t\n", b"One", b"a\x00", b"a", b"x" * 70, b"x" * 71, "ÄÖ ä b".encode(), b"tail ", b" head", b"12345678", b"123456789", b"12345678 9"]
    texts += [bytes(rng.choice(b"aAbB \n\x0b\x00\xc3") for _ in range(rng.randrange(60))) for _ in range(300)]
    for size in (1, 7, 16, 1 << 21):
        monkeypatch.setattr(suffix_tree, "CHUNK", size)
        hashes, ends = suffix_tree.tokens(pa.array(texts, pa.binary()))
        words = [w for t in texts for w in (*t.lower().split(), None)]
        assert [i for i, w in enumerate(words) if w is None] == ends.tolist()
        pairs = {*zip(words, hashes.tolist(), strict=True)}
        assert len(pairs) == len(set(words)) == len(set(hashes.tolist()))


def test_packs_keep_all_numbers():
    keys = np.random.default_rng(7).integers(0, 1 << 63, 100_000).astype(np.uint64)
    batches = [*suffix_tree.packs([keys, keys.astype(np.float64)], keys, 3, suffix_tree.WORD)]
    key, value = suffix_tree.unpacked(pa.Table.from_batches(batches), suffix_tree.WORD, 2)
    assert sorted(key) == sorted(keys) and (value.view(np.float64) == key.astype(np.float64)).all()
    assert max(len(d.as_py()) for b in batches for d in b.column("data")) <= suffix_tree.PACK
    index = suffix_tree.Index(np.unique(keys))
    assert (index.keys[index.find(keys)] == keys).all() and (index.find(keys + np.uint64(1 << 63)) == -1).all()
