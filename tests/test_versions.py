"""Published versions: switching at once, conflicts, rolling back, cleaning up."""

import os

import pytest

from portolan.session import scratch_path
from portolan.sources import versions
from portolan.sources.io import read_partitioned
from pyspark.sql.types import IntegerType, StructField, StructType

SCHEMA = StructType([StructField(c, IntegerType()) for c in "vym"])


def _rows(spark, root, **kwargs):
    return sorted(tuple(r) for r in versions.read_version(spark, root, SCHEMA, **kwargs).collect())


def _df(spark, *rows):
    return spark.createDataFrame(rows, "v int, y int, m int")


def test_unpublished_versions_are_not_read(spark):
    root = scratch_path(spark, "versions")
    assert versions.current(spark, root) == versions.Publication() and _rows(spark, root) == []
    first = versions.write_version(_df(spark, (1, 1, 1), (2, 1, 2), (3, None, 2)), root, ["y", "m"], "a")
    assert sorted(first) == ["y=1/m=1", "y=1/m=2", f"y={versions.NULL_PARTITION}/m=2"]
    assert _rows(spark, root) == []
    one = versions.publish(spark, root, versions.current(spark, root), first)
    second = versions.write_version(_df(spark, (5, 1, 1)), root, ["y", "m"], "b")
    assert sorted(r[0] for r in _rows(spark, root)) == [1, 2, 3]
    two = versions.publish(spark, root, one, second)
    got = read_partitioned(spark, root, SCHEMA)
    assert got.columns == ["v", "y", "m"] and sorted(r.v for r in got.collect()) == [2, 3, 5]
    assert _rows(spark, root, only=["y=1/m=1", "y=7/m=7"]) == [(5, 1, 1)]
    # Only the folders that count are listed, and a condition on a partition prunes.
    files = got.where("m = 1").inputFiles()
    assert files and all("_version=" in f for f in files) and not any("_version=a" in f and "m=1" in f for f in files)
    assert versions.current(spark, root) == two
    assert versions.publish(spark, root, two, {}, dropped=["y=1/m=2"]).partitions.keys() == set(first) - {"y=1/m=2"}


def test_of_two_loads_from_one_basis_the_second_fails(spark):
    root = scratch_path(spark, "conflict")
    basis = versions.current(spark, root)
    a = versions.write_version(_df(spark, (1, 1, 1)), root, ["y", "m"], "a")
    b = versions.write_version(_df(spark, (2, 1, 1)), root, ["y", "m"], "b")
    versions.publish(spark, root, basis, a)
    with pytest.raises(versions.PublicationConflict):
        versions.publish(spark, root, basis, b)
    assert _rows(spark, root) == [(1, 1, 1)]
    assert not [f for f in os.listdir(f"{root}/_published") if f.startswith(".0") and not f.endswith(".crc")]


def test_roll_back_and_vacuum(spark):
    root = scratch_path(spark, "vacuum")
    for k, name in enumerate("abc"):
        written = versions.write_version(_df(spark, (k, 1, 1), (k, 1, 2)) if k < 2 else _df(spark, (k, 1, 1)), root, ["y", "m"], name)
        versions.publish(spark, root, versions.current(spark, root), written)
    assert _rows(spark, root) == [(1, 1, 2), (2, 1, 1)]
    assert versions.vacuum(spark, root, keep=2) == 2  # both folders of version a
    versions.roll_back(spark, root)
    assert _rows(spark, root) == [(1, 1, 1), (1, 1, 2)]
    assert versions.vacuum(spark, root, keep=1) == 1 and _rows(spark, root) == [(1, 1, 1), (1, 1, 2)]
    with pytest.raises(ValueError, match="earlier"):
        versions.roll_back(spark, root)
