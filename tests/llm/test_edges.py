"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from portolan.llm import (decontamination, exact_dedup, line_dedup, mixing, quality, simhash, suffix_tree, token_counts,
                          urls, warc)
from portolan.llm.common import utf8
from portolan.session import scratch_path
from tests.llm.helpers import docs_frame

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
CLASH = ("size", "score", "component_id", "fp", "label", "__id", "rows", "target", "position", "keep_id")
ROWS = [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, " \t\n"),
        (None, "alpha beta gamma delta epsilon zeta"), (None, None), (5, LONG), (6, LONG), (7, "Ünï© ✓ " * 5)]


@pytest.fixture(scope="module")
def edge(spark):
    return docs_frame(spark, ROWS, CLASH).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_frame(spark, [])


def _by(rows, *columns):
    return sorted([tuple(r[c] for c in columns) for r in rows], key=repr)


def test_mixing(spark, edge, empty):
    docs = edge.drop("size").withColumn("source", F.when(F.col("doc_id") < 5, F.col("source")))
    sized = mixing.sized(docs)
    totals = mixing.source_totals(sized)
    assert [r.source for r in totals.orderBy("rank").collect()] == ["s", None]
    schedule = mixing.cyclic_schedule(totals, mixing.WEIGHTS, mixing.SHAPES)
    plan = mixing.plan_mix(sized, schedule).collect()
    assert len(plan) == len(ROWS) and {r["score"] for r in plan} == {"mine"}
    assert all(r.taken == 0 and r.copies == 0 for r in plan if not (r.text or "").strip())
    assert all(r.taken <= 2 * r.size for r in plan)
    mix = mixing.mix_documents(sized, schedule).collect()
    assert len(mix) == sum(r.copies for r in plan) and [r.position for r in mix] == sorted(r.position for r in mix)
    none = mixing.sized(empty)
    assert mixing.mix_documents(none, mixing.cyclic_schedule(mixing.source_totals(none), (1.0,), ((1.0, 1.0),))).count() == 0


def test_curriculum_order(spark):
    """An early source stands before a late one; documents of a flat source are spread evenly."""
    docs = mixing.sized(docs_frame(spark, [(i, "a b c d", "abc"[i % 3]) for i in range(3000)]))
    schedule = spark.createDataFrame([("a", 0.0, 2.0), ("a", 1.0, 0.0), ("b", 0.0, 1.0), ("b", 1.0, 1.0), ("c", 0.0, 0.0), ("c", 0.5, 1.0),
                                      ("c", 1.0, 2.0)], "source string, t double, weight double")
    mix = mixing.mix_documents(docs, schedule, share=0.9).toPandas()
    total = 0.9 * 12000
    mean = mix.groupby("source").position.mean() / total
    assert abs(mean["a"] - 1 / 3) < 0.02 and abs(mean["b"] - 0.5) < 0.02 and abs(mean["c"] - 2 / 3) < 0.02
    assert abs(4 * len(mix) - total) < 20


def test_targets_are_water_filled(spark):
    totals = spark.createDataFrame([("a", 1, 100, 0, 5.0), ("b", 1, 1000, 1, 2.0), ("c", 1, 900, 2, 1.0), ("d", 1, 0, 3, 5.0)],
                                   "source string, n_docs long, source_size long, rank long, weight double")
    got = {r.source: r.target for r in mixing.targets(totals, 1.5, 2).collect()}
    # 3000 words: a is capped at 200 and d at 0, the rest is 2800 by 2 : 1.
    assert got == {"a": 200.0, "b": pytest.approx(2800 * 2 / 3), "c": pytest.approx(2800 / 3), "d": 0.0}


def test_quality(spark, edge, empty):
    good = [(i, f"The {i} houses stand near a river, and people walk there often. It is quiet.") for i in range(100, 140)]
    bad = [(i, f"BUY {i}!! NOW!! $$$ CHEAP!! ### WIN!!") for i in range(140, 160)]
    train = docs_frame(spark, good + bad)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(100, 0), (None, 1), (999, 7)], "doc_id long, label int")
    model = quality.fit(train, labels)
    scored = quality.quality_scores(docs_frame(spark, [(1, good[3][1]), (2, bad[3][1])]), model).collect()
    assert [r.predicted for r in sorted(scored)] == [1, 0]
    rows = quality.quality_scores(edge, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1  # null as empty
    assert quality.keep_good(train, model).columns == train.columns
    assert set(quality.keep_good(edge, model).columns) == set(edge.columns)
    one_sided = quality.fit(train, labels.where("label = 1"))
    assert {r.score for r in quality.quality_scores(edge, one_sided).collect()} == {0.5}
    assert quality.quality_scores(empty, model).count() == 0 and quality.fit(empty, labels) == one_sided


def test_suffix_tree(spark, edge, empty):
    model = suffix_tree.learn(edge.select(utf8(F.col("text")).alias("text")))
    rows = suffix_tree.score_documents(edge, model).collect()
    assert _by(rows, "n_tokens") == _by([{"n_tokens": 1 + len((t or "").encode().split())} for _, t in ROWS], "n_tokens")
    assert all(r.n_known == r.n_tokens for r in rows)
    assert suffix_tree.score_documents(empty, model).count() == 0
    nothing = suffix_tree.learn(empty.select(utf8(F.col("text")).alias("text")))
    assert {(r.base_score, r.score, r.n_known) for r in suffix_tree.score_documents(edge.where("doc_id = 3"), nothing).collect()} == {(0.0, 0.0, 0)}


def test_suffix_tree_distributions_sum_to_one(spark):
    """After any context the probabilities of all words, the end and the unseen rest sum to one."""
    import numpy as np
    lines = ["the cat sat on the mat", "the cat ate the rat", "a dog sat on a log", "der hund sass auf der bank"] * 30
    texts = spark.createDataFrame([(t.encode(),) for t in lines], "text binary")
    model = suffix_tree.learn(texts, least=1e-3, frequent=1e-6, cutoff=0.5)
    tree, v = model.tree, model.tree.vocabulary
    assert len(tree.pairs) and len(tree.states)
    rest = 1 / (model.total + model.distinct + 1)
    assert np.isclose((10 ** tree.root).sum() + rest, 1)
    for context in (["the"], ["cat"], ["on", "the"], ["the", "cat"], ["der"], ["sat", "on"]):
        ids = v.encode([w.encode() for w in context])
        before = tree.corrections(ids) if len(ids) > 1 else 0.0
        total = rest * 10 ** (tree.corrections(np.append(ids, -1)) - before)
        total += sum(10 ** (tree.root[x] + tree.corrections(np.append(ids, x)) - before) for x in range(v.size))
        assert np.isclose(total, 1), context


def test_line_dedup(spark, edge, empty):
    passage = ("This sentence belongs to a long passage that stands in many documents. It goes on with a second sentence of many words. "
               "Then a third one follows and the passage is still not over yet. A fourth sentence closes it for good at this place.")
    rows = [(1, f"Own words of the first document, nothing else here.\n{passage}\nEnd one."), (2, passage),
            (3, f"Other beginning, which is not in any document but this.\n{passage}"), (4, "short"), (5, "A b.\n" * 2)]
    out = {r.doc_id: r for r in line_dedup.line_report(docs_frame(spark, rows)).collect()}
    assert out[1].text == rows[0][1] and out[1].n_removed == 0
    assert out[2].text == "" and out[3].text == "Other beginning, which is not in any document but this.\n"
    assert out[4].text == "short" and out[5].n_removed == 0
    # One document that repeats itself keeps its first occurrence.
    again = line_dedup.line_report(docs_frame(spark, [(1, (passage + "\n") * 3)])).first()
    assert again.text == passage + "\n"
    report = line_dedup.line_report(edge).collect()
    assert len(report) == len(ROWS) and [r.text for r in report if r.doc_id == 2] == [None]
    assert [r.text for r in report if r.doc_id == 4] == [" \t\n"] and [r.n_removed for r in report if r.doc_id == 1] == [0, 0]
    by_id = {r.doc_id: r for r in report}
    assert by_id[5].text.startswith(LONG[:2000]) and by_id[6].text == "" and by_id[6].n_removed == by_id[6].n_lines
    cleaned = line_dedup.dedup_lines(edge)
    assert cleaned.columns == edge.columns and {r.n_chars for r in cleaned.where("doc_id = 6").collect()} == {0}
    assert line_dedup.dedup_lines(edge, drop_emptied=True).where("doc_id = 6").count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0


def test_simhash(spark, edge, empty):
    rows = simhash.simhash_components(edge).collect()
    got = _by(rows, "doc_id", "component_id")
    assert got == _by([{"doc_id": d, "c": 1 if t and t.startswith("alpha") else 2 if not (t or "").strip() else 5 if t == LONG else 7}
                       for d, t in ROWS], "doc_id", "c")
    assert {r.fp for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert simhash.simhash_components(empty).count() == 0


def test_simhash_links_of_a_dense_group(spark):
    """Cells and spanning forests lose no link: a random cloud against brute force, with tiny cells."""
    import numpy as np
    from portolan.llm.components import connected_components
    from tests.llm.helpers import components
    rng = np.random.RandomState(3)
    centre = [int(x) for x in rng.randint(0, 2**62, 6)]
    values = sorted({int(np.int64(c ^ (1 << int(a)) ^ (1 << int(b)))) for c in centre for a, b in rng.randint(0, 22, (120, 2))})
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3]
    want = [values[c] for c in components(len(values), pairs)]
    for parts in ([(list(range(32)), 1), (list(range(32, 64)), 1)], [(list(range(20)), 1), (list(range(20, 40)), 0), (list(range(40, 64)), 0)],
                  [(list(range(16)), 2), (list(range(16, 32)), 0), (list(range(32, 64)), -1)]):
        links = simhash.bucket_links(simhash.filings(fps, parts), 3, cell=16)
        label = {r.node: r.label for r in connected_components(links).collect()}
        got = [label.get(v, v) for v in values]
        assert [got.index(x) for x in got] == [want.index(x) for x in want], parts


def test_allocation_keeps_the_pigeonhole(spark):
    import numpy as np
    rng = np.random.RandomState(0)
    bits = rng.rand(500, 64) < np.linspace(0.1, 0.9, 64)
    bits[:, 7] = bits[:, 3]  # two bits that always agree stay together
    both = bits.T.astype(float) @ bits
    for radius in (0, 1, 3, 7):
        for n in (500, 10**9):
            parts = simhash.allocate(n, both, radius)
            assert sorted(b for g, _ in parts for b in g) == list(range(64))
            assert sum(t for _, t in parts) == radius - len(parts) + 1
            assert any({3, 7} <= set(g) for g, _ in parts)


def test_near_dedup(spark, edge, empty):
    out = simhash.drop_near_duplicates(edge)
    assert out.columns == edge.columns
    # Null, empty and blank texts are one component, so are the rows of equal texts.
    assert _by(out.collect(), "doc_id") == [(1,), (2,), (5,), (7,)]
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame([(1, "HTTP://WWW.Example.ORG/es/x?q#f", "a"), (2, None, "b"), (3, "no-scheme.org/x", "c"), (4, "http://a.org", "d"),
                                   (5, "x://sub.example.org/en/12#a", "e"), (6, "http://org/", "f"), (7, "http://corg/", "g"),
                                   (7, "http://corg/", "g"), (8, "a://b://c/d", "h")], "page_id long, url string, verdict string")
    out = urls.filter_urls(pages, urls.labelled_urls(spark)).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in out}
    assert len(out) == 9 and got == {
        1: ("www.example.org", "/es/x", "example.org/es/"), 2: ("", "", None), 3: ("", "", None), 4: ("a.org", "", None),
        5: ("sub.example.org", "/en/12", "example.org/en/1"), 6: ("org", "/", "org/"), 7: ("corg", "/", None), 8: ("b:", "//c/d", None)}
    assert {r.verdict for r in out} <= {"allow", "block"}
    assert urls.filter_urls(pages.limit(0), urls.labelled_urls(spark)).count() == 0
    unknown = urls.filter_urls(pages, urls.labelled_urls(spark).limit(0)).where("rule is null").collect()
    assert {r.verdict for r in unknown} == {"allow"}


def test_url_model_generalises(spark):
    """Names that share n-grams with blocked ones are blocked, ordinary new names are not."""
    pages = spark.createDataFrame([(1, "https://super-casino.example.net/en/1"), (2, "http://casinos-online.example.net/x"),
                                   (3, "http://pills-cheap.example.net/de/1"), (4, "http://gardens.example.net/en/1"),
                                   (5, "http://mathsite.example.net/fr/1"), (6, "http://the-weather.example.net/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.filter_urls(pages, urls.labelled_urls(spark), rules=()).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


def test_warc_round_trip(spark):
    html = ["<p>ä✓</p>" * 3000, None, "", "x\r\n\r\ny", "<p>ä✓</p>" * 3000, "x\r\n\r\ny"]
    rows = [(i, f"http://h/{i}\n%0A" if i else None, t) for i, t in enumerate(html)] + [(None, "u", "x\r\n\r\ny"), (5, "again", "x\r\n\r\ny")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("mine"))
    path = scratch_path(spark, "warc-test")
    warc.write_warc(warc.records(pages), path)
    got = warc.read_warc(spark, path)
    back = got.collect()
    by_payload = {}
    for _, _, t in rows:
        by_payload.setdefault((t or "").encode(), None)
    assert len(back) == len(rows)
    for r in back:
        if r.record_type == "response":
            payload = bytes(r.payload)
            assert payload in by_payload and r.payload_digest == warc.sha1_base32(payload) and r.payload_bytes == len(payload)
    kinds = sorted(((r.page_id, r.url, r.record_type, r.refers_to) for r in back), key=repr)
    url = lambda i: f"http://h/{i}\n%0A" if i else None
    assert kinds == sorted([(0, url(0), "revisit", 4), (1, url(1), "revisit", 2), (2, url(2), "response", None), (3, url(3), "revisit", 5),
                            (4, url(4), "response", None), (5, url(5), "response", None), (None, "u", "revisit", 5),
                            (5, "again", "response", None)], key=repr)
    # Pushed filters and header-only reads.
    some = got.where((F.col("record_type") == "revisit") & F.col("page_id").isin(0, 3))
    assert {r.page_id for r in some.collect()} == {0, 3}
    assert {r.payload for r in warc.read_warc(spark, path, payload=False).collect()} == {None}
    assert warc.records(pages, least_bytes=10**6).where("record_type = 'revisit'").count() == 0
    none = scratch_path(spark, "warc-none")
    warc.write_warc(warc.records(pages.limit(0)), none)
    assert warc.read_warc(spark, none).count() == 0


def test_warc_filters_reach_the_reader():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In
    reader = warc.WarcReader("unused", None, True)
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("page_id",), (1, 2)), GreaterThan(("page_id",), 1),
                                    EqualTo(("payload",), b"x")]))
    assert [type(f).__name__ for f in left] == ["GreaterThan", "EqualTo"]
    assert reader.wanted == {"record_type": {"response"}, "page_id": {1, 2}}


def test_warc_reads_foreign_archives(spark, tmp_path):
    """Plain gzip members without the length field, an uncompressed file, several records each; a wrong digest raises."""
    import gzip
    row = {"record_type": "response", "payload": b"abc" * 5000, "page_id": 1, "payload_digest": warc.sha1_base32(b"abc" * 5000), "record_id": "r"}
    data = [warc.record({**row, "page_id": i}) for i in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(d) for d in data))
    (tmp_path / "b.warc").write_bytes(b"".join(data))
    back = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in back) == [0, 0, 1, 1, 2, 2] and {bytes(r.payload) for r in back} == {b"abc" * 5000}
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "c.warc").write_bytes(warc.record({**row, "payload": b"other"}))
    with pytest.raises(Exception, match="digest"):
        warc.read_warc(spark, str(bad)).collect()


def test_exact_dedup(spark, edge, empty):
    rows = exact_dedup.exact_dedup(edge, shard_rows=3).collect()
    got = _by(rows, "doc_id", "keep_id", "group_size", "kept")
    want = []
    for d, t in ROWS:
        text = (t or "") if t not in (" \t\n",) else " "
        same = [i for i, x in ROWS if ((x or "") if x != " \t\n" else " ") == text]
        keep = min((i for i in same if i is not None), default=None)
        want.append({"doc_id": d, "keep_id": keep, "group_size": len(same), "kept": d == keep})
    assert got == _by(want, "doc_id", "keep_id", "group_size", "kept")
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_cuckoo_index_inserts_deletes_and_resizes(spark):
    digests = lambda ids: spark.createDataFrame([(i, hashlib.sha256(str(i % 50).encode()).digest()) for i in ids],
                                                "doc_id long, digest binary")
    index = exact_dedup.CuckooIndex.empty(spark, shards=3).insert(digests(range(100))).insert(digests(range(100, 150)))
    live = {bytes(r.digest): (r.keep_id, r.group_size) for r in index.content().collect()}
    assert live == {hashlib.sha256(str(i).encode()).digest(): (i, 3) for i in range(50)}
    index = index.delete(digests([*range(10), *range(50, 60), *range(100, 110), 11]))
    sizes = {r.keep_id: r.group_size for r in index.content().collect()}
    assert sizes == {61 if i == 11 else i: 2 if i == 11 else 3 for i in range(10, 50)}  # 11 went, 61 is the next live id


def test_cuckoo_index_follows_live_rows(spark):
    """Random inserts and deletes, of repeated, unknown and null ids too, against a plain multiset; shards split on the way."""
    import random
    from collections import Counter
    rng, live = random.Random(4), Counter()
    index = exact_dedup.CuckooIndex.empty(spark, shards=1, shard_rows=16)
    name = lambda k: hashlib.sha256(str(k).encode()).digest()
    for step in range(4):
        rows = [(rng.choice([None, *range(30)]), name(rng.randrange(60))) for _ in range(80)]
        frame = spark.createDataFrame(rows, "doc_id long, digest binary")
        if step % 2:
            index = index.delete(frame)
            for r in rows:
                live[r] -= live[r] > 0
        else:
            index = index.insert(frame)
            live.update(rows)
        want = {}
        for (i, d), n in live.items():
            if n:
                keep, size = want.get(d, (None, 0))
                want[d] = (min((x for x in (keep, i) if x is not None), default=None), size + n)
        assert {bytes(r.digest): (r.keep_id, r.group_size) for r in index.content().collect()} == want
    assert index.shards > 2 and index.delete(spark.createDataFrame([(1, name("none"))], "doc_id long, digest binary")).content().count() == len(want)


def test_cuckoo_filter_overflow_keeps_every_digest():
    shard = exact_dedup.Shard()
    small = shard.filter.buckets
    all_ = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    for i, d in enumerate(all_):
        shard.add(d, i, 1)
    assert shard.filter.buckets > small and all(d in shard.filter for d in all_)
    for d in all_[:2500]:
        shard.take(d, 1)
    assert all(d in shard.filter for d in all_[2500:]) and len(shard.content) == 2500
    assert sum(d in shard.filter for d in all_[:2500]) < 50  # false hits only
    again = exact_dedup.Shard(shard.state(0))
    assert again.content == shard.content and all(d in again.filter for d in all_[2500:])


def test_decontamination(spark, edge, empty):
    item = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny item"), (5, item)], "item_id long, text string")
    docs = docs_frame(spark, [(1, f"before. {item.upper().replace(' ', ', ')} after it"), (2, "one two three four five and no more of it here at all"),
                              (3, "a TINY item!"), (4, None), (5, ""), (1, f"x {item}")], CLASH)
    got = _by(decontamination.contaminated(docs, bench).collect(), "doc_id", "item_id")
    assert got == _by([{"d": d, "i": i} for d, i in ((1, 1), (1, 5), (1, 1), (1, 5), (3, 4))], "d", "i")
    for block in (1, 2, 100):  # blocks of items give the same
        clean = decontamination.decontaminate(docs, bench, block_items=block)
        assert clean.columns == docs.columns and _by(clean.collect(), "doc_id") == [(2,), (4,), (5,)]
    assert decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.decontaminate(edge, bench).count() == len(ROWS)
    middle = docs_frame(spark, [(1, LONG + " " + item + " " + LONG)])
    assert decontamination.contaminated(middle, bench).first().start_word == 60_000


def test_hamming_index_finds_all_within_the_radius():
    import numpy as np
    rng = np.random.RandomState(1)
    items = rng.randint(0, 2**63, 300).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.randint(0, 20, 300)], np.uint64)
    queries = items ^ flips
    q, i = decontamination.HammingIndex(items, 16).search(queries)
    want = {(a, b) for a in range(300) for b in range(300) if int(queries[a] ^ items[b]).bit_count() <= 16}
    assert set(zip(q.tolist(), i.tolist())) == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, edge, empty, name):
    import public_tokenizers
    path = str(public_tokenizers.path(name))
    texts = [*(t for _, t in ROWS if t != LONG), "a  b   c ", " lead", "x\u00a0 y \u2003z", "<|endoftext|> a <|endoftext|>b", "don't we'll  'S",
             "中文 字\n\n end", "tab\t x\r\n y", LONG[:3000], "e\u0301 \x1f x \x85 y", "1 2 ,, . \n \n z"]
    whole = token_counts.encoder(path)
    rows = token_counts.token_counts(docs_frame(spark, list(enumerate(texts)), CLASH), path, slice_bytes=64, cache_pieces=7).collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows}
    assert got == {i: (len((t or "").encode()), whole([t])[0] if t else 0) for i, t in enumerate(texts)}
    assert token_counts.token_counts(empty, path).count() == 0


def test_near_dedup_keeps_the_smallest_id_of_each_component(spark):
    """Against brute force over all pairs; no two linked documents stay, and a document without a link does."""
    import random
    from tests.llm.helpers import components
    from tests.llm.helpers import simhash as fingerprint
    rng, texts = random.Random(5), []
    for g in range(6):
        base = [f"w{g}x{i}" for i in range(300)]
        for _ in range(40):
            t = list(base)
            for _ in range(rng.randint(0, 6)):
                t[rng.randrange(len(t))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(t))
    rng.shuffle(texts)
    fps = [fingerprint(t) for t in texts]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    low = components(len(texts), linked)
    assert 6 < len(set(low)) < len(texts) - 40 and any(texts[i] != texts[j] for i, j in linked)
    docs = docs_frame(spark, list(enumerate(texts)) + [(3, texts[3]), (None, texts[5])], CLASH)
    kept = sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == sorted(set(low))
    assert not [(i, j) for i, j in linked if i in kept and j in kept]
