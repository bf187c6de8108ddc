"""The warehouse: table creation, idempotent loads, and the load-check-publish job.

Tables are parquet tables in the session catalog at a caller-chosen (shared) location. ``load_table`` and ``copy_into`` write
into a table in place: columns aligned by name, whole tables overwritten, of a partitioned one only the delivered partitions.

``warehouse_load`` is all or nothing. It writes every table as a new version next to the one in use (``sources.versions``),
runs the checks on candidate tables that show the versions together, and only then publishes all of them by one
rename and points the catalog's tables at them. A failed check leaves the warehouse as it was, and the version
before stays readable (``versions.roll_back``, then ``create_tables``) until ``versions.vacuum``. The catalog follows the publication: a session that
meets the warehouse anew, or after a load that died between the two, is brought up to it by ``create_tables``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portolan import schemas
from portolan.operators.merge import ARRIVED, COMPLETE, DELIVERY, merge_deliveries
from portolan.operators.quality import DataQualityError, sql_check_report, table_counts
from portolan.operators.uniqueness import incremental_key_report
from portolan.plans import rollups
from portolan.session import path_exists
from portolan.sources import versions

#: Where the monthly states (``plans.rollups``) stand below the warehouse's location.
MONTHLY = "monthly/"
PUBLICATION = "portolan.publication"


def _ddl_columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_tables(spark: SparkSession, database: str, location: str,
                  tables: Mapping[str, object] = schemas.WAREHOUSE_SCHEMAS,
                  partitions: Mapping[str, Sequence[str]] = schemas.WAREHOUSE_PARTITIONS) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for every warehouse table under ``location``.

    Keys are not declared (parquet tables refuse constraints); the quality checks
    verify them instead. Partitioned tables overwrite only the partitions written.
    A session that meets the tables for the first time finds the partitions that earlier
    sessions left at their location: they are recovered, since a new catalog entry
    knows no partition. Where versions were published (:func:`warehouse_load`), the tables show the newest publication.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    published = versions.current(spark, location)
    for name, schema in tables.items():
        parts = partitions.get(name)
        clause = ""
        if parts:
            clause = (f" OPTIONS ('partitionOverwriteMode' 'dynamic')"
                      f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})")
        known = spark.catalog.tableExists(f"`{database}`.`{name}`")
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({_ddl_columns(schema)}) "
                  f"USING parquet{clause} LOCATION '{location}/{name}'")
        if published.number:
            _follow(spark, database, name, location, parts, published)
        elif parts and not known and path_exists(spark, f"{location}/{name}"):
            spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")


def _folders(partitions: Mapping[str, str], table: str) -> dict[str, str]:
    """A table's part of a publication: its partitions ("" for a table without) and their folders."""
    own = {k: v for k, v in partitions.items() if k == table or k.startswith(f"{table}/")}
    return {k[len(table) + 1:]: v for k, v in own.items()}


def _spec(partition: str) -> str:
    """``i94yr=2016/i94mon=4`` as SQL."""
    values = [part.split("=", 1) for part in partition.split("/")]
    return "PARTITION (" + ", ".join(f"`{c}`=" + ("null" if v == versions.NULL_PARTITION else f"'{v}'") for c, v in values) + ")"


def _add_partitions(spark: SparkSession, table: str, location: str, folders: Mapping[str, str], batch: int = 200) -> None:
    specs = [f"{_spec(partition)} LOCATION '{location}/{folder}'" for partition, folder in sorted(folders.items())]
    for start in range(0, len(specs), batch):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[start:start + batch])}")


def _follow(spark: SparkSession, database: str, name: str, location: str, parts: Sequence[str] | None,
            published: versions.Publication, before: versions.Publication | None = None) -> None:
    """Point a catalog table at a publication. Where it is known to show ``before``, only what changed is altered."""
    table, folders = f"`{database}`.`{name}`", _folders(published.partitions, name)
    shown = next((r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"] == PUBLICATION), None)
    if shown == str(published.number):
        return
    if not parts:
        if "" in folders:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}/{folders['']}'")
    else:
        known = before is not None and shown == str(before.number)
        old = _folders(before.partitions, name) if known else {}
        if not known:
            # Null values are shown by the folder's name.
            for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
                old[r[0].replace("=null", f"={versions.NULL_PARTITION}")] = ""
        for partition in old.keys() - folders.keys():
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(partition)}")
        for partition in sorted(folders.keys() & old.keys()):
            if old[partition] != folders[partition]:
                spark.sql(f"ALTER TABLE {table} {_spec(partition)} SET LOCATION '{location}/{folders[partition]}'")
        _add_partitions(spark, table, location, {k: v for k, v in folders.items() if k not in old})
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PUBLICATION}'='{published.number}')")
    spark.catalog.refreshTable(table)


def load_table(df: DataFrame, table: str, overwrite: bool = True, rebalance: bool = True) -> None:
    """Insert ``df`` into ``table``, columns matched by name and cast to the table's types.
    ``rebalance=False`` loads data that is already clustered by the table's partitions
    (a staged, partitioned folder) without a shuffle."""
    target = df.sparkSession.table(table).schema
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: columns missing from the data: {missing}")
    aligned = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])
    partitions = df.sparkSession.catalog.listColumns(table) if "." in table else []
    parts = [c.name for c in partitions if c.isPartition]
    if parts and rebalance:
        aligned = aligned.hint("rebalance", *parts)
    aligned.write.insertInto(table, overwrite=overwrite)


def copy_into(spark: SparkSession, path: str, table: str, format: str = "parquet", overwrite: bool = True) -> None:
    """Load the files at ``path`` (e.g. a staged parquet folder) into ``table``."""
    load_table(spark.read.format(format).load(path), table, overwrite=overwrite)


@dataclass
class Load:
    """A load in progress: what it has written so far, next to what is published."""

    spark: SparkSession
    location: str
    basis: versions.Publication
    schemas: Mapping[str, StructType]
    partitions: Mapping[str, Sequence[str]]
    version: str = field(default_factory=versions.new_version)
    written: dict[str, str] = field(default_factory=dict)
    dropped: set[str] = field(default_factory=set)

    def counting(self) -> dict[str, str]:
        """The partitions that would count if this load were published now."""
        return {**{k: v for k, v in self.basis.partitions.items() if k not in self.dropped}, **self.written}

    def _read(self, name: str, folders: Iterable[str]) -> DataFrame:
        schema, parts = self.schemas[name], self.partitions.get(name)
        paths = [f"{self.location}/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # Folders from before the first publication have no version in their name; they are read apart.
        kinds = [[p for p in paths if f"/{versions.VERSION}=" in p], [p for p in paths if f"/{versions.VERSION}=" not in p]]
        frames = []
        for kind in kinds:
            if kind and parts:
                frames.append(versions.read_folders(self.spark, f"{self.location}/{name}", kind, schema) if kind is kinds[0] else
                              self.spark.read.schema(schema).option("basePath", f"{self.location}/{name}").parquet(*kind))
            elif kind:
                frames.append(self.spark.read.schema(schema).option("basePath", kind[0]).parquet(*kind))
        return reduce(DataFrame.unionByName, frames)

    def table(self, name: str) -> DataFrame:
        """A table as it would be after this load."""
        return self._read(name, _folders(self.counting(), name).values())

    def delivered(self, name: str) -> DataFrame:
        """What this load has written of a table."""
        return self._read(name, _folders(self.written, name).values())

    def answers(self) -> rollups.Answers:
        """The monthly states as they would be after this load."""
        return rollups.Answers(self.spark, self.location, versions.Publication(0, self.counting()), MONTHLY)

    def write(self, name: str, df: DataFrame, rebalance: bool) -> None:
        """Write ``df``, aligned to the table's columns by name, as this load's version."""
        fields = self.schemas[name].fields
        missing = [f.name for f in fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"{name}: columns missing from the data: {missing}")
        aligned = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
        parts = list(self.partitions.get(name) or [])
        written = versions.write_version(aligned, f"{self.location}/{name}", parts, self.version, rebalance)
        if not parts:
            self.dropped.add(name)  # a whole table: also one that has become empty
        self.written |= {f"{name}/{k}" if k else name: f"{name}/{v}" for k, v in written.items()}

    def abandon(self) -> None:
        """Delete what was written; nothing refers to it."""
        for folder in set(self.written.values()):
            versions.delete_folder(self.spark, f"{self.location}/{folder}")


def _adopted(spark: SparkSession, location: str, tables: Iterable[str], partitions: Mapping[str, Sequence[str]]) -> versions.Publication:
    """The newest publication; where there is none, the tables that stand at the location as earlier, unversioned loads left them."""
    basis = versions.current(spark, location)
    if basis.number:
        return basis
    found: dict[str, str] = {}
    for name in tables:
        depth = len(partitions.get(name) or [])
        if depth:
            found |= {f"{name}/{k}": f"{name}/{k}" for k in versions.partition_folders(spark, f"{location}/{name}", depth)}
        elif path_exists(spark, f"{location}/{name}"):
            found[name] = name
    return versions.Publication(0, found)


def _candidate(load: Load, names: Iterable[str]) -> str:
    """A database of tables that show the load before it is published, for checks written as SQL."""
    spark, database = load.spark, f"portolan_candidate_{load.version}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{load.location}/_candidate-{load.version}'")
    for name in names:
        table, folders, parts = f"`{database}`.`{name}`", _folders(load.counting(), name), load.partitions.get(name)
        clause = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        place = folders.get("", f"_candidate-{load.version}/{name}")
        spark.sql(f"CREATE TABLE {table} ({_ddl_columns(load.schemas[name])}) USING parquet{clause} LOCATION '{load.location}/{place}'")
        if parts:
            _add_partitions(spark, table, load.location, folders)
    return database


def warehouse_load(spark: SparkSession, database: str, location: str,
                   tables: Mapping[str, DataFrame | Callable[[Load], DataFrame]],
                   checks: Sequence[Mapping[str, object]] = tuple(schemas.NULL_KEY_CHECKS),
                   keys: Mapping[str, str] = schemas.WAREHOUSE_KEYS,
                   order: Sequence[str] = tuple(schemas.WAREHOUSE_TABLES),
                   table_schemas: Mapping[str, StructType] = schemas.WAREHOUSE_SCHEMAS,
                   parallel: bool = True, rebalance: bool = True, whole_months: bool = True, unique_keys: bool = False,
                   states: Mapping[str, rollups.State] | None = None) -> DataFrame:
    """Write the fact, its monthly states and the dimensions as new versions, check them, then publish all at once.

    The first table of ``order`` (the fact) is written alone; the others do not depend on each other and are
    written as concurrent Spark jobs (``parallel``). A table may be given as a callable, called with the :class:`Load` after
    the fact and its states are written: the date dimension is ``lambda load: load.answers().date_dimension()``, which reads the
    days of each month and no fact rows of months that were not delivered.

    ``whole_months``: the delivery holds its months completely and replaces them; otherwise its rows are merged by
    key into what is there (``operators.merge``). ``unique_keys`` makes a repeated key of the fact a failure, checked on the delivered months
    against the stored bitmaps of the others. ``states`` are kept for the fact (``rollups.STATES`` unless given).

    Raises :class:`DataQualityError` listing every failed check, and then the warehouse is as it was; otherwise returns the
    per-table report (table, key, n_rows, null_keys). The fact's figures are the sums of its months' states, other tables are
    counted; the usual null-key statements (``schemas.NULL_KEY_CHECKS``) are answered from the report, other statements run on the candidate
    tables. ``rebalance=False`` writes data that is already clustered by the table's partitions without a shuffle.
    """
    states = rollups.STATES if states is None else states
    create_tables(spark, database, location, table_schemas)
    names = [name for name in order if name in tables]
    basis = _adopted(spark, location, table_schemas, schemas.WAREHOUSE_PARTITIONS)
    load = Load(spark, location, basis, table_schemas, schemas.WAREHOUSE_PARTITIONS)
    candidate = None
    try:
        def write(name: str) -> None:
            source = tables[name]
            load.write(name, source(load) if callable(source) else source, rebalance)

        fact = names[0] if names and schemas.WAREHOUSE_PARTITIONS.get(names[0]) else None
        if fact and not whole_months:
            _merge_fact(load, fact, keys[fact], tables[fact], rebalance)
        elif names:
            write(names[0])
        if fact:
            _write_states(load, fact, states)
        rest = names[1:]
        if parallel and len(rest) > 1:
            with ThreadPoolExecutor(max_workers=len(rest)) as pool:
                for future in [pool.submit(write, name) for name in rest]:
                    future.result()
        else:
            for name in rest:
                write(name)
        counted = {name: (load.table(name), keys[name]) for name in names if name != fact or "counts" not in states}
        counts = table_counts(counted) if counted else None
        rows = {r["table"]: tuple(r) for r in counts.collect()} if counts else {}  # a row per table
        if fact and "counts" in states:
            sums = load.answers().state("counts").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_rows", "null_keys")]).first()
            rows[fact] = (fact, keys[fact], *sums)
        failed, others = [], []
        for check in checks:
            answer = next((r[3] for name, r in rows.items()
                           if check["check_sql"] == f"SELECT COUNT(*) FROM {name} WHERE {keys[name]} is null"), None)
            if answer is None:
                others.append(check)
            elif answer != check["expected_result"]:
                failed.append({**check, "result": answer})
        if others:
            candidate, previous = _candidate(load, [n for n in table_schemas if n in names or _folders(basis.partitions, n)]), spark.catalog.currentDatabase()
            spark.catalog.setCurrentDatabase(candidate)
            try:
                failed += [r.asDict() for r in sql_check_report(spark, others).where(~F.col("passed")).collect()]
            finally:
                spark.catalog.setCurrentDatabase(previous)
        if fact and unique_keys:
            failed += [r.asDict() for r in _key_report(load).where(~F.col("passed")).collect()]
        if failed:
            raise DataQualityError(f"Data quality validation FAILED: {failed}")
        empty = [name for name in names if rows[name][2] < 1]
        if empty:
            raise DataQualityError(f"Row count validation FAILED, empty tables: {empty}")
        published = versions.publish(spark, location, basis, load.written, dropped=load.dropped)
    except Exception:
        load.abandon()
        raise
    finally:
        if candidate:
            spark.sql(f"DROP DATABASE `{candidate}` CASCADE")
    for name in table_schemas:
        _follow(spark, database, name, location, schemas.WAREHOUSE_PARTITIONS.get(name), published, basis)
    return spark.createDataFrame([rows[name] for name in names], "table string, key string, n_rows long, null_keys long")


def _merge_fact(load: Load, name: str, key: str, source: DataFrame | Callable[[Load], DataFrame], rebalance: bool) -> None:
    """Write the delivered rows merged by key into the months they touch."""
    df, parts = source(load) if callable(source) else source, list(load.partitions[name])
    df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in load.schemas[name].fields])
    months = {versions.partition_key(r, parts) for r in df.select(*parts).distinct().collect()}  # a row per month
    existing = load._read(name, [v for k, v in _folders(load.basis.partitions, name).items() if k in months])
    delivery = df.withColumns({DELIVERY: F.lit(load.version), ARRIVED: F.current_timestamp(), COMPLETE: F.lit(False)})
    load.write(name, merge_deliveries(existing, delivery, key, parts), rebalance)


def _write_states(load: Load, fact: str, states: Mapping[str, rollups.State]) -> None:
    """The states of the months just written, and of those that lack one (loaded before the state was kept)."""
    delivered, months = _folders(load.written, fact), _folders(load.counting(), fact)
    groups: dict[tuple[str, ...], dict[str, rollups.State]] = {}
    for name, state in states.items():
        known = _folders(load.basis.partitions, f"{MONTHLY}{name}")
        needed = tuple(k for k in months if k in delivered or k not in known)
        groups.setdefault(needed, {})[name] = state
    for needed, same in groups.items():
        facts = load._read(fact, [months[k] for k in needed])
        written = rollups.write_states(facts, needed, f"{load.location}/{MONTHLY}".rstrip("/"), load.version, same)
        load.written |= {f"{MONTHLY}{k}": f"{MONTHLY}{v}" for k, v in written.items()}


def _key_report(load: Load) -> DataFrame:
    """Repeated keys of the months just written, against the bitmaps of all others."""
    own = {k: v for k, v in load.written.items() if k.startswith(f"{MONTHLY}keys/")}
    others = {k: v for k, v in load.basis.partitions.items() if k not in load.written}
    new, history = (rollups.Answers(load.spark, load.location, versions.Publication(0, p), MONTHLY).state("keys") for p in (own, others))
    return incremental_key_report(new, history, rollups.MONTH)
