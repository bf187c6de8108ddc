"""Operators 11 to 13: against plain versions, on whole tables and on hard rows."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from portolan.llm import bpe, fill_middle, whitening
from portolan.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_frame

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def sha(data):
    return hashlib.sha256(data).hexdigest()


# --- operator 11 ---------------------------------------------------------------------------

TEXTS = ["", "x", "ascii only " * 9000, "é" * 70_000, "aé漢😀" * 30_000, "a" * 65_536, "漢" + "b" * 70_000, "a\x00b", "a" * 131_072 + "é"]


@pytest.mark.parametrize("text", TEXTS)
def test_boundary_set_selects_code_points(text):
    found = fill_middle.BoundarySet(text.encode())
    assert found.units == len(text)
    rng = np.random.default_rng(len(text))
    for k in {0, len(text), len(text) // 2, *rng.integers(0, len(text) + 1, 40).tolist()}:
        assert found.select(k) == len(text[:k].encode())
    for k in (-1, len(text) + 1):
        with pytest.raises(IndexError):
            found.select(k)


def test_boundary_set_uses_every_container():
    starts = np.zeros(65_536, bool)
    starts[::40] = True
    assert isinstance(fill_middle.container(starts), fill_middle.Array)
    starts[::3] = True
    assert isinstance(fill_middle.container(starts), fill_middle.Bitmap)
    starts[:] = True
    assert isinstance(fill_middle.container(starts), fill_middle.Run)
    rng = np.random.default_rng(1)
    for share in (0.001, 0.01, 0.3, 0.9, 0.999):
        for size in (1, 63, 64, 65, 4097, 65_536):
            starts = rng.random(size) < share
            starts[rng.integers(size)] = True
            offsets = np.flatnonzero(starts)
            part = fill_middle.container(starts)
            assert [part.select(k) for k in range(0, len(offsets), 17)] == offsets[::17].tolist()


def test_boundary_set_of_words_and_lines():
    words = fill_middle.BoundarySet(b"  one two\t\nthree", "word")
    assert [words.select(k) for k in range(words.units + 1)] == [0, 2, 6, 11, 16]
    lines = fill_middle.BoundarySet(b"a\n\nb\n", "line")
    assert [lines.select(k) for k in range(lines.units + 1)] == [0, 2, 3, 5]
    with pytest.raises(ValueError, match="unit"):
        fill_middle.BoundarySet(b"a", "page")


def fim(doc_id, text, seed=1):
    """The transformation by string slices."""
    text = text or ""
    h = sha(f"{seed}:{'' if doc_id is None else doc_id}".encode())
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


HARD = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "holds <S> a marker"), (None, "no id, 漢字 and 😀"), (None, None), (5, "<P"), (6, "M><S"),
        (7, "<" * 50), (8, "long 漢 " * 60_000), (9, " \t\n"), *[(i, f"text {i} <é> " * (i % 7)) for i in range(10, 60)]]


def test_fill_in_middle_takes_hard_rows(spark):
    docs = docs_frame(spark, HARD, extra=["n", "form", "output", "h"])
    done = fill_middle.fill_in_middle(docs, slice_bytes=1000)
    rows = done.withColumn("restored", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in rows))) == sorted(repr(fim(*r)) for r in HARD)
    assert sorted(r["restored"] for r in rows) == sorted(t or "" for _, t in HARD)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).collect() == []


def test_fill_in_middle_of_words_cuts_between_words(spark):
    docs = docs_frame(spark, [(i, "eins zwei drei vier") for i in range(40)])
    rows = fill_middle.fill_in_middle(docs, unit="word", plain_percent=0, markers=("{1}", "{2}", "{3}")).collect()
    for r in rows:
        parts = r["output"].replace("{1}", "|").replace("{2}", "|").replace("{3}", "|").split("|")
        assert r["n"] == 4 and all(p == "" or p.rstrip() in "eins zwei drei vier" and (p.endswith(" ") or p.endswith("vier")) for p in parts)
    with pytest.raises(ValueError, match="markers"):
        fill_middle.fill_in_middle(docs, markers=("ab", "ba", "c"))


# --- operator 12 ---------------------------------------------------------------------------

def whitened_plainly(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = ((n * x - s) / np.longdouble(n)).astype(np.longdouble)
    v = (y.T @ y / n).astype(np.float64)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    deviation = [sum(int(d) ** 2 for d in row) for row in (n * x - s).tolist()]
    return e, u, (y.astype(np.float64) @ u)[:, :components] / np.sqrt(np.abs(e[:components])), deviation, e[:components] / np.trace(v)


def test_op12_agrees_with_numpy(spark):
    rows = QUERIES["op12_whitening"](spark, SF_SMALL).toPandas()
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    e, _, w, deviation, explained = whitened_plainly(np.stack(table["embedding"]))
    assert len(rows) == 8 * len(table) and set(rows["n"]) == {len(table)}
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    for k in range(8):
        sign = np.sign((got[:, k] * w[:, k]).sum())
        assert np.allclose(got[:, k], sign * w[:, k], rtol=0, atol=1e-9)
    assert dict(zip(rows["vec_id"], rows["deviation"])) == dict(zip(table["vec_id"], deviation))
    assert np.allclose(rows.drop_duplicates("component").sort_values("component")["explained"], explained, rtol=1e-10)
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"][0] < 1e-10


def clustered(d):
    close = np.concatenate([[1e6] * 5, [1e6 * (1 + 1e-9)] * 2, 1e6 * (1 + 1e-12 * np.arange(3)), np.linspace(1, 30, 130)])
    return {"apart": np.arange(1.0, d + 1), "close": close[:d], "deficient": np.concatenate([[1, 2, 3, 3, 5], np.zeros(d)])[:d],
            "wide": 10.0 ** np.linspace(-8, 8, d), "equal": np.full(d, 7.0), "blurred": 1 + 1e-8 * np.random.default_rng(2).normal(size=d)}


@pytest.mark.parametrize("kind", sorted(clustered(8)))
@pytest.mark.parametrize("d", [1, 2, 60])
def test_refined_eigenvectors_are_exact_to_double_precision(d, kind):
    values = clustered(d)[kind]
    q, _ = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))
    a = (q * values) @ q.T
    a = ((a + a.T) / 2).astype(np.longdouble)
    e, x = whitening.eigen(a)
    assert np.all(np.diff(e) <= 1e-14 * np.abs(e).max())
    assert np.abs(x.T @ x - np.eye(d)).max() < 2e-15
    assert np.abs(a @ x - x * e).max() < 1e-15 * np.abs(values).max()


def test_exact_products_of_any_size():
    rng = np.random.default_rng(3)
    for bits in (1, 10, 21, 22, 25, 40, 47):
        y = rng.integers(-(1 << bits), 1 << bits, (300, 3))
        assert (whitening.exact_products(y) == y.astype(object).T @ y.astype(object)).all()


VECTORS = [(1, [0.5, -0.25, 1.0]), (2, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (None, [-1.0, 0.0, 0.7]), (3, None), (4, [1.0, None, 2.0]),
           (5, [float("nan"), 1.0, 2.0]), (6, [float("inf"), 1.0, 2.0]), (7, []), (8, [1.0, 2.0]), (9, [0.33, 0.9, -0.4])]


def test_whitening_takes_hard_rows(spark):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>").withColumn("n", F.lit(1)).withColumn("v", F.lit(2))
    rows = whitening.finite_vectors(df, "embedding", ["vec_id"])
    model = whitening.fit(rows)
    out = whitening.whiten(rows, model, 0.0).collect()
    kept = [v for i, v in VECTORS if v and len(v) == 3 and None not in v and np.isfinite(v).all()]
    assert len(out) == 3 * len(kept) and {r["component"] for r in out} == {1, 2, 3}
    _, _, w, deviation, _ = whitened_plainly(np.array(kept, np.float32))
    assert sorted(int(r["deviation"]) for r in out if r["component"] == 1) == sorted(deviation)
    for k in range(3):
        got = sorted(abs(r["whitened"]) for r in out if r["component"] == k + 1)
        assert np.allclose(got, sorted(np.abs(w[:, k])), atol=1e-9)
    assert whitening.identity_error(rows.where(F.size("v") == 3), model) < 1e-9


def test_whitening_without_variance_or_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    rows = whitening.finite_vectors(same, "embedding", ["vec_id"])
    model = whitening.fit(rows)
    out = whitening.whiten(rows, model, whitening.identity_error(rows, model)).collect()
    assert len(out) == 10 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in out)
    assert whitening.fit(rows.limit(0)) is None
    # Beyond the range of a long the sum is still exact; entries out of all bounds count as the limit.
    big = spark.createDataFrame([(1, [1e8, 3.0]), (2, [-1e8, 3e38]), (3, [0.0, -3e38])], "vec_id long, embedding array<float>")
    rows = whitening.finite_vectors(big, "embedding", ["vec_id"])
    out = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(rows, whitening.fit(rows)).collect()}
    x = np.clip(np.floor(1024 * np.array([[1e8, 3.0], [-1e8, 3e38], [0, -3e38]])) + 100_000, -2.0 ** 47, 2.0 ** 47).astype(np.int64).astype(object)
    assert out == {i + 1: sum(int(d) ** 2 for d in 3 * x[i] - x.sum(axis=0)) for i in range(3)}


# --- operator 13 ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_op13_agrees_with_the_library(spark, library):
    rows = {r["doc_id"]: r for r in QUERIES["op13_byte_bpe"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for i, text in docs:
        ids = library.encode_ordinary(text or "")
        assert tuple(rows[i]) == (i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode()))


def test_classes_are_those_of_the_library(library):
    cut = bpe.Pretokenizer(bpe.splitter(public_tokenizers.PATTERN, bpe.read_ranks(RANKS)))
    encoder = bpe.Encoder(bpe.read_ranks(RANKS), 1 << 20)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for form in ("{}", "a{0} {0}1", "{0}{0}\n{0} x"):
        text = "".join(form.format(c) for c in every[::7])
        assert bpe.token_ids(encoder.encode(cut.split(text))) == library.encode_ordinary(text)


HARD_TEXTS = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "it's they'll we've 'tis ''s"), (4, " \n \t  x   "), (5, "<|endoftext|> is text"),
              (6, "wort " * 400), (6, "wort " * 400), (None, "wort " * 400), (7, "a" * 3000), (8, " " * 3000 + "x"), (9, "x" + "\n" * 2500),
              (10, "漢字かな交じり文。" * 200), (11, "we've 're'll " * 150 + "'" * 700 + "s"), (12, "1234567890" * 200), (13, "😀 ߊ ₏ \U00011de0" * 200)]


@pytest.mark.parametrize(("stride", "overlap"), [(100, 30), (64, 6), (997, 64)])
def test_chunks_stitch_to_the_whole_text(spark, library, stride, overlap):
    rng = np.random.default_rng(stride)
    alphabet = list("ab '\n\t.,!12é漢") + ["'s", "'re", "   ", " \n", "word"]
    texts = [*HARD_TEXTS, *[(100 + i, "".join(rng.choice(alphabet, 400))) for i in range(60)]]
    docs = docs_frame(spark, texts, extra=["tokens", "key", "chunk", "piece"])
    done = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, stride=stride, overlap=overlap, keep=500, slice_bytes=2000), RANKS).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], bpe.token_ids(r["tokens"]), bytes(r["data"]))) for r in done)
    assert all(r["n_tokens"] == len(r["tokens"]) // 4 for r in done)


def test_encode_of_nothing(spark):
    assert bpe.decode(bpe.encode(docs_frame(spark, []), RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def test_cut_places_are_fixed_by_the_id():
    assert fill_middle.draws(7, 1) == fill_middle.draws("7", 1) != fill_middle.draws(7, 2)
    assert zlib.crc32(repr(fill_middle.draws(None, 1)).encode()) == zlib.crc32(repr(fill_middle.draws("", 1)).encode())
