"""Rows and brute-force versions shared by the tests of the training-data operators."""

import re

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def docs_frame(spark, rows, extra=None):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``; ``extra`` adds clashing columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in extra or ():
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit("mine"))
    return df


def words(text):
    return (text or "").encode().lower().split()


def simhash(text, size=3):
    w = words(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + size]), seed=42) for i in range(max(1, len(w) - size + 1))]
    a = np.array(hashes, np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((a >> np.uint64(b)) & np.uint64(1)).sum()) > len(a))


def components(n, linked):
    """Smallest member of each item's component under the pairs ``linked``."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingle_set(text, size=5):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
