"""Text helpers as native expressions (no Python worker in the plan)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of cased letters and runs of everything else. Title case capitalises the
# first letter of every cased run and lowers the rest, the rule of Python's
# ``str.title`` ("PEOPLE'S REP" -> "People'S Rep", "1ST" -> "1St").
_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def title_case(text: Column) -> Column:
    runs = F.regexp_extract_all(text, F.lit(_CASED_RUNS), 1)
    titled = F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))),
                                                    F.lower(F.substr(run, F.lit(2)))))
    return F.array_join(titled, "")


def clean_label(text: Column) -> Column:
    """Labels of the code lookups use no-break spaces in places; make them plain spaces."""
    return F.regexp_replace(text, "\u00a0", " ")


def label_fallback(name: Column, label: Column) -> Column:
    """A name, or the title-cased lookup label where the name is missing."""
    return F.coalesce(name, title_case(label))
