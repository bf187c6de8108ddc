"""Operator 4: line dedup by overlapping three-line windows.

A text is read as wrapped lines: a line ends at a line feed, at the first word from the ``least``-th (4) on that
closes a sentence or whose last character is one of ``CUTS``, or after ``most`` words (12). So one long paragraph is
several lines, and with or without punctuation the same passage is cut alike wherever it
stands from a few words after its start. The
choice is not exact: a passage whose lines don't fall into step soon enough stays (measured in the README). All windows of three consecutive lines are
hashed; windows that occur more than once in the corpus are found by counting; of each, the
first occurrence (by id, text hash, line) stays and all later ones cover their three lines,
except lines that the first occurrence itself covers. Covered lines are merged per document
and removed.

Built-in functions only. The texts are read once to hash their lines, which are written as numbers and read for both window
passes, and shuffled once, by document, to remove lines. Windows travel as two 64-bit hashes of
their lines' hashes; only those that repeat are written. A passage that a third of all documents share is one
row per task in the counting, and in the joins its rows are split by AQE: both sides are
read from files and dealt anew.

Defined results: a null text stays null and has no lines; a text without words stays as it
is; fewer than three lines make no window; rows that repeat id and text are one document
delivered twice and all come out alike; a document whose lines all go has an empty text.
Null ids come after all others. Extra columns ride along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import free_shuffles, staged, table

_S, _W, _B = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]", r"[\x20\x09\x0B-\x0D]"
KEYS = ["__h1", "__h2"]
#: Last characters that end a line: besides sentence ends about a quarter of those of words and numbers, in Latin, Greek, Cyrillic, Hebrew
#: and Arabic script. A choice by character is a condition on the word that Java's and DuckDB's expressions both can say.
CUTS = ".!?,gnoryGNORY258\u03b1\u03b5\u03b9\u0430\u0435\u043c\u044b\u05d4\u05dd\u0629\u0646\u064a"


def line_pattern(least: int = 4, most: int = 12) -> str:
    """One wrapped line with its white space: up to ``least - 1`` words, then words up to one that ends in ``CUTS``,
    ``most`` in all; a line feed ends it anywhere."""
    return (f"{_S}*(?:{_W}+{_B}+){{0,{least - 1}}}(?:{_W}*[^\\x20\\x09-\\x0D{CUTS}]{_B}+){{0,{most - least}}}{_W}+{_S}*")


def _line(least: int = 4, most: int = 12) -> str:
    """The line of :func:`line_pattern` without the white space around it, for Java: no step takes back what it has matched, because
    a word is passed over only if another follows."""
    blank = r"[ \t\x0B\f\r]++"
    return (rf"(?:\S++{blank}(?=\S)){{0,{least - 1}}}+(?:\S++(?<![{CUTS}]){blank}(?=\S)){{0,{most - least}}}+\S++")


def lines(text: Column, least: int = 4, most: int = 12) -> Column:
    """The wrapped lines; joined they are the text. A text without words has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\s*+{_line(least, most)}\s*+"), F.lit(0))


def line_hashes(text: Column, least: int = 4, most: int = 12) -> Column:
    """The hashes of the lines without the white space around them."""
    bare = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\s*+({_line(least, most)})"), F.lit(1))
    return F.transform(bare, lambda line: F.xxhash64(line))


def _names() -> tuple[Column, Column]:
    """What tells documents apart and orders them: the id (for null a hash of the text, after all ids) and 31 bits
    of the text's hash, for rows that share an id."""
    hashed = F.xxhash64("text")
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1) - F.shiftrightunsigned(hashed, 2))
    return number.alias("__id"), F.pmod(hashed, F.lit(1 << 31)).alias("__text")


def _hashed(docs: DataFrame) -> DataFrame:
    """``(__id, __text, __l)``: the hashes of every document's lines."""
    return docs.select(*_names(), line_hashes(F.col("text")).alias("__l"))


def _windows(docs: DataFrame) -> DataFrame:
    return _window_rows(_hashed(docs))


def _window_rows(hashed: DataFrame) -> DataFrame:
    """``(__id, __at, __h1, __h2)``, a row per window of three lines, by two hashes of its three line hashes.
    ``__at`` holds the window's line number above the 31 bits of the text's hash."""
    parts = hashed.where(F.size("__l") >= 3)
    # The lines meet themselves one and two further on; past the end there is null.
    threes = F.arrays_zip(F.col("__l").alias("a"), F.slice("__l", 2, F.size("__l")).alias("b"), F.slice("__l", 3, F.size("__l")).alias("c"))
    rows = parts.select("__id", "__text", F.posexplode(threes).alias("__pos", "__w")).where("__w.c is not null")
    three = [F.col("__w.a"), F.col("__w.b"), F.col("__w.c")]
    return rows.select("__id", (F.shiftleft(F.col("__pos").cast("long"), 31) + F.col("__text")).alias("__at"),
                       F.xxhash64(*three).alias("__h1"), F.xxhash64(F.lit(4), *three).alias("__h2"))


def covered_lines(docs: DataFrame) -> DataFrame:
    """``(__id, __text, __gone)``: per document with repeated windows the sorted line numbers to remove.

    The first pass counts by one hash, which finds all that may repeat; among those, both hashes decide.
    """
    spark = docs.sparkSession
    free_shuffles(spark)
    # The texts are split once: a condition on the lines here would split them twice.
    hashed, delete = staged(_hashed(docs), "line-hashes")
    windows = _window_rows(hashed)
    repeated, forget = staged(windows.groupBy("__h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__h1"), "repeated")
    free_shuffles(spark)
    found, _ = staged(windows.join(repeated, "__h1"), "repeated-windows")
    delete()
    forget()
    free_shuffles(spark)
    text, pos = F.col("__at").bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright("__at", 31).cast("int")
    place = F.struct("__id", text.alias("__text"), pos.alias("__pos"))
    first, _ = staged(found.groupBy(*KEYS).agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first-windows")
    free_shuffles(spark)
    later = (found.select(*KEYS, place.alias("__p")).join(first, KEYS).where(F.col("__p") != F.col("__first"))
             .select("__p.*", "__first"))
    same = (F.col("__id") == F.col("__first.__id")) & (F.col("__text") == F.col("__first.__text"))
    start = F.when(same, F.greatest(F.col("__pos"), F.col("__first.__pos") + 3)).otherwise(F.col("__pos"))
    spans = later.select("__id", "__text", start.alias("__from"), (F.col("__pos") + 2).alias("__to")).where("__from <= __to")
    return (spans.select("__id", "__text", F.explode(F.sequence("__from", "__to")).alias("__line"))
            .groupBy("__id", "__text").agg(F.sort_array(F.collect_set("__line")).alias("__gone")))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``__row`` (all columns but the text), ``__n`` lines, ``__gone`` line numbers (empty: none) and ``__clean`` text.

    The text travels to the join once, as its lines; only a text without lines travels as it is.
    """
    rest = [F.col(c) for c in docs.columns if c != "text"] or [F.lit(None).alias("none")]
    keyed = docs.select(F.struct(*rest).alias("__row"), *_names(), lines(F.col("text")).alias("__lines"), "text")
    keyed = keyed.select("__row", "__id", "__text", "__lines", F.when(F.size("__lines") == 0, F.col("text")).alias("__bare"))
    gone = covered_lines(docs)
    whole = keyed.join(gone.withColumnsRenamed({"__id": "__i", "__text": "__t"}),
                       (F.col("__id") == F.col("__i")) & (F.col("__text") == F.col("__t")), "left")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone"), lambda i: F.get(F.col("__lines"), i))
    clean = (F.when(F.size("__lines") == 0, F.col("__bare")).when(F.col("__gone").isNull(), F.array_join("__lines", ""))
             .otherwise(F.array_join(kept, "")))
    return whole.select("__row", F.size("__lines").alias("__n"), F.coalesce("__gone", F.array().cast("array<int>")).alias("__gone"),
                        clean.alias("__clean"))


def dedup_lines(docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """The documents with repeated passages removed, all columns; ``n_chars``, where there is one, follows the text.
    ``drop_emptied`` drops the documents whose lines all went."""
    done = remove_repeats(docs)
    if drop_emptied:
        done = done.where((F.size("__gone") == 0) | (F.size("__gone") < F.col("__n")))
    new = {"text": F.col("__clean"), "n_chars": F.when(F.size("__gone") > 0, F.length("__clean").cast("long"))}
    return done.select(*[F.coalesce(new[c], F.col("__row")[c]).alias(c) if c == "n_chars" else
                         new[c].alias(c) if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_removed``, ``removed_lines`` (from 0, comma-separated), ``text``."""
    done = remove_repeats(docs.select("doc_id", "text"))
    return done.select(F.col("__row")["doc_id"].alias("doc_id"), F.col("__n").alias("n_lines"), F.size("__gone").alias("n_removed"),
                       F.array_join(F.col("__gone").cast("array<string>"), ",").alias("removed_lines"), F.col("__clean").alias("text"))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents."""
    return line_report(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{line_pattern()}') AS l FROM documents),
u AS (SELECT doc_id, text, l, unnest(range(len(l) - 2)) AS pos FROM d WHERE len(l) >= 3),
t AS (SELECT doc_id, text, pos, list_transform(l[pos + 1:pos + 3],
        lambda x: regexp_replace(x, '^{_S}+|{_S}+$', '', 'g')) AS w FROM u),
f AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(text) OVER o AS ft, first_value(pos) OVER o AS fp,
        row_number() OVER o AS rn FROM t WINDOW o AS (PARTITION BY w ORDER BY doc_id NULLS LAST, text, pos)),
g AS (SELECT DISTINCT doc_id, text, unnest(range(CASE WHEN doc_id IS NOT DISTINCT FROM fd AND text = ft
        THEN greatest(pos, fp + 3) ELSE pos END, pos + 3)) AS line FROM f WHERE rn > 1),
h AS (SELECT doc_id, text, list_sort(list(line)) AS gone FROM g GROUP BY doc_id, text)
SELECT d.doc_id, CAST(len(l) AS INTEGER) AS n_lines, CAST(coalesce(len(gone), 0) AS INTEGER) AS n_removed,
       coalesce(array_to_string(gone, ','), '') AS removed_lines,
       CASE WHEN gone IS NULL THEN d.text ELSE array_to_string([l[i + 1] for i in range(len(l)) if NOT list_contains(gone, i)], '') END AS text
FROM d LEFT JOIN h ON d.doc_id IS NOT DISTINCT FROM h.doc_id AND d.text = h.text"""
