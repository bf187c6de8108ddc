"""The line pattern that Spark runs cuts like the plain one that the SQL uses."""

import re

import numpy as np
from pyspark.sql import functions as F

from portolan.llm.line_dedup import line_hashes, line_pattern, lines
from tests.llm.helpers import docs_frame


def test_possessive_lines_are_the_plain_lines(spark):
    rng = np.random.default_rng(5)
    parts = ["a", "on", "be.", "the", "xx!", " ", "  ", "\t", "\n", " \n ", "\r\n", "\v", "\f", "é", " ", " ", "ש", "word"]
    texts = [None, "", " \n\t ", "a", " a ", "a b \nfoo", "a b c d e f g h i k l m p q", "be be be be \n\n be", *["".join(rng.choice(parts, k)) for k in rng.integers(1, 120, 400)]]
    df = docs_frame(spark, list(enumerate(texts)))
    got = df.select("doc_id", lines(F.col("text")).alias("l"), line_hashes(F.col("text")).alias("h"),
                    F.transform(lines(F.col("text")), lambda x: F.xxhash64(F.btrim(x, F.lit(" \t\n\v\f\r")))).alias("want")).collect()
    plain = re.compile(line_pattern())
    for r in got:
        assert r["l"] == plain.findall(texts[r["doc_id"]] or "")
        assert r["h"] == r["want"]
