"""Versions of a partitioned parquet folder: write aside, switch at once, keep what was there before.

A version of a partition is a folder of its own, ``<root>/<p>=<value>/.../_version=<name>``. Which versions count
is said by the newest file in ``<root>/_published``, a small JSON document per publication. Publishing is one
rename onto a new number, so readers see all partitions of a load or none, a load that fails half-way leaves only
folders that nobody reads, and of two loads that started from the same publication the second one fails
(:class:`PublicationConflict`) instead of undoing the first.

Readers give Spark the folders that count, below the common ``basePath``, so partition values are found and pruned as in
any partitioned folder. Only names of partitions pass the driver, as many as there are months.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSION = "_version"
PUBLISHED = "_published"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a null partition value


class PublicationConflict(RuntimeError):
    """Another load was published since this one read what it builds on."""


@dataclass(frozen=True)
class Publication:
    """What counts: the folder of every partition (relative to the root), and the last batch applied of every stream."""

    number: int = 0
    partitions: Mapping[str, str] = field(default_factory=dict)
    batches: Mapping[str, int] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _fs(spark, f"{root}/{PUBLISHED}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _load(spark: SparkSession, root: str, number: int) -> Publication:
    text = spark.read.text(f"{root}/{PUBLISHED}/{number:08d}.json", wholetext=True).first()[0]
    return Publication(**json.loads(text))


def current(spark: SparkSession, root: str) -> Publication:
    """The newest publication of ``root``, an empty one where there is none."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else Publication()


def is_versioned(spark: SparkSession, root: str) -> bool:
    return bool(_numbers(spark, root))


def new_version() -> str:
    return uuid.uuid4().hex[:12]


def write_version(df: DataFrame, root: str, partition_by: Sequence[str], version: str, rebalance: bool = True) -> dict[str, str]:
    """Write ``df`` as ``version`` of the partitions it holds; returns their folders, as :func:`publish` takes them."""
    spark, out = df.sparkSession, df
    if partition_by and rebalance:
        out = out.hint("rebalance", *partition_by)
    (out.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(*partition_by, VERSION).parquet(root))
    fs, pattern = _fs(spark, "/".join([root, *["*=*"] * len(partition_by), f"{VERSION}={version}"]))
    base = fs.makeQualified(_fs(spark, root)[1]).toString().rstrip("/")
    folders = [status.getPath().toString()[len(base) + 1:] for status in fs.globStatus(pattern) or []]
    return {folder.rsplit("/", 1)[0] if "/" in folder else "": folder for folder in folders}


def publish(spark: SparkSession, root: str, basis: Publication, partitions: Mapping[str, str],
            batches: Mapping[str, int] | None = None, dropped: Iterable[str] = ()) -> Publication:
    """Let ``partitions`` count from now on, besides those of ``basis`` that they don't replace and that aren't ``dropped``."""
    gone = set(dropped)
    kept = {k: v for k, v in basis.partitions.items() if k not in gone}
    new = Publication(basis.number + 1, {**kept, **partitions}, {**basis.batches, **(batches or {})})
    target = f"{root}/{PUBLISHED}/{new.number:08d}.json"
    fs, path = _fs(spark, target)
    _, aside = _fs(spark, f"{root}/{PUBLISHED}/.{new.number:08d}-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(new.__dict__).encode()))
    finally:
        stream.close()
    sc = spark.sparkContext
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    plain = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(path), plain)  # fails where the target exists
    except Exception as error:
        fs.delete(aside, False)
        if fs.exists(path):
            raise PublicationConflict(f"{root}: publication {new.number} is there already") from error
        raise
    return new


def partition_key(row: Row | Mapping[str, object], partition_by: Sequence[str]) -> str:
    """The folder of a partition value, as Spark names it (numbers and null; other values must need no escape)."""
    return "/".join(f"{c}={NULL_PARTITION if row[c] is None else row[c]}" for c in partition_by)


def read_version(spark: SparkSession, root: str, schema: StructType, publication: Publication | None = None,
                 only: Iterable[str] | None = None) -> DataFrame:
    """The rows that count; ``only`` these partitions if given. ``schema`` includes the partition columns, which come last."""
    publication = current(spark, root) if publication is None else publication
    wanted = publication.partitions if only is None else set(only) & set(publication.partitions)
    folders = [f"{root}/{publication.partitions[k]}" for k in sorted(wanted)]
    return read_folders(spark, root, folders, schema)


def read_folders(spark: SparkSession, root: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    """The rows of version folders below ``root``."""
    if not folders:
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields, StructField(VERSION, StringType())])
    return spark.read.schema(full).option("basePath", root).parquet(*folders).drop(VERSION)


def partition_folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """The folders of a partitioned folder without versions, ``depth`` partition columns deep."""
    fs, base = _fs(spark, root)
    prefix = fs.makeQualified(base).toString().rstrip("/")
    _, pattern = _fs(spark, "/".join([root, *["*=*"] * depth]))
    return sorted(status.getPath().toString()[len(prefix) + 1:] for status in fs.globStatus(pattern) or [])


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs(spark, path)
    fs.delete(hadoop, True)


def history(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the publications that are still there, oldest first."""
    return _numbers(spark, root)


def roll_back(spark: SparkSession, root: str) -> Publication:
    """Publish the state before the newest publication once more; its folders must not have been vacuumed."""
    numbers = _numbers(spark, root)
    if len(numbers) < 2:
        raise ValueError(f"{root}: no earlier publication")
    newest, before = _load(spark, root, numbers[-1]), _load(spark, root, numbers[-2])
    basis = Publication(newest.number, {}, newest.batches)
    return publish(spark, root, basis, before.partitions)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the version folders that none of the last ``keep`` publications names, and older publications; returns the number of
    folders deleted. Not while a load runs: its folders aren't named yet."""
    numbers = _numbers(spark, root)
    if not numbers or keep < 1:
        return 0
    kept = [_load(spark, root, n) for n in numbers[-keep:]]
    named = {folder for p in kept for folder in p.partitions.values()}
    fs, base = _fs(spark, root)
    prefix, deleted = fs.makeQualified(base).toString().rstrip("/"), 0
    depths = {folder.count("/") for p in kept for folder in p.partitions.values()}
    for depth in depths:
        _, pattern = _fs(spark, "/".join([root, *["*"] * depth, f"{VERSION}=*"]))
        for status in fs.globStatus(pattern) or []:
            if status.getPath().toString()[len(prefix) + 1:] not in named:
                deleted += bool(fs.delete(status.getPath(), True))
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, f"{root}/{PUBLISHED}/{n:08d}.json")[1], False)
    return deleted
