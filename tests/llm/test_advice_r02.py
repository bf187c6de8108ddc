"""Whole jobs: what round 2 found cut short."""

import math
from collections import Counter

from portolan.llm import decontamination, line_dedup, suffix_tree
from portolan.llm.common import utf8
from tests.llm.helpers import docs_frame, words


def brute_scores(texts, mass=10.0, cutoff=3.0, floor=2, depth=3):
    """Corrections (log10) of every text by a plain suffix tree without hashes, bitmaps or frequent strings."""
    docs = [[*words(t), None] for t in texts]
    n = Counter(tuple(d[i:i + k]) for d in docs for k in range(1, depth + 2) for i in range(len(d) - k + 1))
    total, distinct = sum(map(len, docs)), len({w for d in docs for w in d})
    base = {s[0]: (c + 1) / (total + distinct + 1) for s, c in n.items() if len(s) == 1}
    kept = {}

    def fix(context, word):
        while context:
            if context in kept:
                own, factor = kept[context]
                return own[word] if word in own else factor + fix(context[1:], word)
            context = context[1:]
        return 0.0

    for k in range(2, depth + 2):
        after = {}
        for s, c in n.items():
            if len(s) == k and c >= floor:
                after.setdefault(s[:-1], {})[s[-1]] = c
        found = {}
        for context, symbols in after.items():
            parent = {x: base[x] * 10 ** fix(context[1:], x) for x in symbols}
            p = {x: (c + mass * parent[x]) / (n[context] + mass) for x, c in symbols.items()}
            rest, left = max(1 - sum(p.values()), 1e-12), max(1 - sum(parent.values()), 1e-12)
            kl = sum(p[x] * math.log(p[x] / parent[x]) for x in symbols) + rest * math.log(rest / left)
            if n[context] * kl >= cutoff * len(symbols):
                found[context] = ({x: math.log10(p[x] / base[x]) for x in symbols}, math.log10(rest / left))
        kept.update(found)
    return [sum(fix(tuple(d[max(0, i - depth):i]), d[i]) for i in range(1, len(d))) for d in docs], kept


def test_suffix_tree_keeps_rare_strings_in_a_large_corpus(spark):
    """A passage seen five times makes contexts however large the rest is, and scores don't depend on what is broadcast."""
    import random
    rng = random.Random(2)
    passage = "seven grey herons wait beside the frozen mill pond"
    texts = [" ".join(rng.choice(["a", "b", "c", "d", "the", f"x{rng.randrange(300)}"]) for _ in range(60)) for _ in range(100)]
    texts += [f"{passage} n{i}" for i in range(5)] + ["red sky over hills", "blue sky over lakes"] * 30
    want, kept = brute_scores(texts)
    assert (b"red", b"sky", b"over") in kept and (b"grey",) in kept
    docs = docs_frame(spark, list(enumerate(texts)))
    for least in (0.01, 3e-6):  # as many frequent strings as in a corpus of a million words, and all of them
        model = suffix_tree.learn(docs.select(utf8(docs.text).alias("text")), least=least, frequent=least)
        rows = suffix_tree.score_documents(docs, model).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert math.isclose(r.score - r.base_score, want[r.doc_id], rel_tol=1e-6, abs_tol=1e-6)


def test_decontamination_compares_short_documents_whole(spark):
    """A document that is an item less a few words, against brute force over all windows and whole texts."""
    import random
    rng = random.Random(4)
    items = [[f"v{rng.randrange(400)}" for _ in range(rng.choice([6, 15, 30, 50, 59]))] for _ in range(20)]
    texts = [w[a:len(w) - b] for w in items for a, b in ((0, 1), (0, 2), (3, 0), (1, 4), (0, 9), (6, 6))]
    texts += [["start", *w[:-1]] for w in items] + [[*w[:20], "changed", *w[21:-2]] for w in items] + [["v1"], []]
    grams = lambda w: Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    want = set()
    for j, w in enumerate(items):
        for i, t in enumerate(texts):
            for s in range(max(1, len(t) - len(w) + 1)) if t else ():
                a, b = grams(w), grams(t[s:s + len(w)])
                shared = sum((a & b).values())
                if shared >= 0.8 * (a.total() + b.total() - shared):
                    want.add((i, j))
    assert sum(len(texts[i]) < len(items[j]) for i, j in want) > 40
    docs = docs_frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id long, text string")
    found = decontamination.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    kept = decontamination.decontaminate(docs, bench, block_items=7).collect()
    assert {r.doc_id for r in kept} == set(range(len(texts))) - {i for i, _ in want}


def test_line_dedup_finds_unpunctuated_passages_at_any_offset(spark):
    """Planted passages of 51 to 80 words in text without punctuation: brute force on words counts those that stay."""
    import random
    rng = random.Random(6)
    ends = ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "his", "but", "at"]
    word = lambda: rng.choice(ends) if rng.random() < 0.4 else f"{rng.choice('bcdfglmpst')}{rng.randrange(10**4)}{rng.choice(ends)}"
    some = lambda n: [word() for _ in range(n)]
    passages = [some(rng.randint(51, 80)) for _ in range(200)]
    texts = [some(rng.randint(0, 30)) + p + some(rng.randint(0, 30)) for _ in range(2) for p in passages]
    out = {r.doc_id: r.text.split() for r in line_dedup.line_report(docs_frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])).collect()}
    assert all(out[i] == texts[i] for i in range(200))
    left = 0
    for i, p in enumerate(passages):
        t = out[200 + i]
        runs = {tuple(p[k:k + 50]) for k in range(len(p) - 49)}
        left += any(tuple(t[k:k + 50]) in runs for k in range(len(t) - 49))
    assert left <= 0.1 * len(passages), left
