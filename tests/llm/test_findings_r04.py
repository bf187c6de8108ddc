"""Findings of round 4: the suffix tree's helpers by brute force, and what grew faster than the corpus."""

import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from portolan.llm import suffix_tree as st


@pytest.mark.parametrize("kind", ["hashes", "few", "rows", "last bits", "equal"])
def test_in_order_is_a_stable_sort(kind):
    r = np.random.default_rng(4)
    x = {"hashes": r.integers(0, 1 << 63, 5000) * 2 + 1, "few": r.integers(0, 9, 5000), "equal": np.full(5000, 7),
         "rows": (r.integers(0, 40, 5000) << 33) + r.integers(0, 900, 5000), "last bits": (r.integers(0, 3, 5000) << 61) + r.integers(0, 900, 5000)}[kind].astype(np.uint64)
    assert np.array_equal(st.in_order(x), np.argsort(x, kind="stable"))
    assert len(st.in_order(x[:0])) == 0


@pytest.mark.parametrize("parts", [1, 2, 81, 1300])
def test_strings_are_counted_and_dealt_in_one_sort(parts):
    r = np.random.default_rng(5)
    words = r.integers(0, 1 << 63, 60).astype(np.uint64)
    context, tail, n = r.choice(words, 20_000), r.choice(words, 20_000), r.integers(1, 5, 20_000).astype(np.uint64)
    wanted = Counter()
    for c, t, k in zip(context.tolist(), tail.tolist(), n.tolist(), strict=True):
        wanted[c, t] += k
    c, t, k = st.counted(context, tail, n, parts)
    assert len(c) == len(wanted) and dict(zip(zip(c.tolist(), t.tolist(), strict=True), k.tolist(), strict=True)) == wanted
    by = st.extend(c, t)
    rows = pa.Table.from_batches(list(st.packs([c, t, k], by, parts, st.FOUND, dealt=True)))
    plain = pa.Table.from_batches(list(st.packs([c, t, k], by, parts, st.FOUND)))
    assert rows.equals(plain) and np.array_equal(st.unpacked(rows, st.FOUND, 3)[2], k)


def test_every_white_space_byte_and_only_those_ends_a_word():
    text = bytes(b for b in range(256))
    words = [w for w in text.lower().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    alone = [int(st.tokens(pa.array([w], pa.binary()))[0][0]) for w in words]
    assert st.tokens(pa.array([text, b"", text], pa.binary()))[0].tolist() == [*alone, int(st.END_HASH), int(st.END_HASH), *alone, int(st.END_HASH)]


def test_answers_find_their_documents_in_one_step_each():
    """Row numbers share their first bits; looked up by these, every answer passed all documents of its part."""
    rows = np.arange(30_000, dtype=np.uint64) + (np.uint64(3) << np.uint64(33))
    owner = np.random.default_rng(6).choice(rows, 300_000)
    began = time.process_time()
    at = st.places(rows, owner)
    assert time.process_time() - began < 2 and np.array_equal(rows[at], owner)
