"""Versioned tables: immutable load folders and one manifest per version.

A table is a folder with

* ``data/load=<id>/pdate=<day>/`` -- what one job wrote, never changed afterwards;
* ``manifest/<version>.json`` -- the columns and, for every day, the loads that make it up.

A change first writes its load folder, then publishes the next manifest with a
single rename that fails when that version exists already.  Readers resolve the
newest manifest once, so they see all of a change or nothing; a job that dies
before the rename leaves the table as it was (its load is never referenced).
Replacing days needs no rewrite of other days and no staging copy: the load that
is checked is the one that is published.  Two writers that start from one version:
the second one takes the newer manifest as its base and tries again (a replaced
day is then that of the last writer, as with delete-and-insert transactions);
an append that depends on what was loaded fails instead.

The manifest grows with days times loads of a day (metadata, never rows);
``replace_days`` brings a day back to one load, ``compact`` all of them.  Columns
are recorded in every manifest: older files lack later columns and give NULL there.
The rename must be atomic (HDFS and local file systems are; a plain object store
needs a committer that makes it so).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.dates import parse_iso_only, parse_mixed_date

PDATE, LOAD = "pdate", "load"
#: how Spark names the folder of rows without a date
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
TRIES = 20


class Conflict(RuntimeError):
    """Another writer published the version this one wanted to publish."""


class Manifest(NamedTuple):
    version: int
    schema: T.StructType
    days: dict[str, list[str]]      # day (or NO_DAY) -> loads
    operation: str = ""


class Replaced(NamedTuple):
    version: int | None             # None: nothing was published
    days: int
    rows: int
    rejected: DataFrame | None      # staged rows whose date does not parse


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder), _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, table: str) -> list[int]:
    """Published versions, oldest first."""
    return sorted(int(n[:-5]) for n in _names(spark, f"{table}/manifest") if n.endswith(".json") and n[:-5].isdigit())


def is_snapshot(spark: SparkSession, table: str) -> bool:
    return bool(versions(spark, table))


def manifest(spark: SparkSession, table: str, version: int | None = None) -> Manifest | None:
    """The newest (or given) manifest; None when nothing is published."""
    have = versions(spark, table)
    if not have or (version is not None and version not in have):
        return None
    version = have[-1] if version is None else version
    path = f"{table}/manifest/{version:010d}.json"
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        m = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(version, T.StructType.fromJson(m["schema"]), m["days"], m["operation"])


def _publish(spark: SparkSession, table: str, m: Manifest) -> None:
    """Write the manifest aside and rename it to its version; raises Conflict when that version exists."""
    jvm, gw = spark.sparkContext._jvm, spark.sparkContext._gateway
    aside, final = f"{table}/manifest/.{uuid.uuid4().hex}", f"{table}/manifest/{m.version:010d}.json"
    out = _fs(spark, aside).create(_path(spark, aside), False)
    try:
        out.write(bytearray(json.dumps({"schema": m.schema.jsonValue(), "days": m.days, "operation": m.operation}).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, table).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    keep = gw.new_array(rename, 1)
    keep[0] = rename.NONE
    try:
        context.rename(_path(spark, aside), _path(spark, final), keep)
    except Exception as e:
        _fs(spark, aside).delete(_path(spark, aside), False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"{table}: version {m.version} is published already") from e
        raise


def _change(spark: SparkSession, table: str, change: Callable[[Manifest | None], Manifest]) -> Manifest:
    """Publish ``change`` of the newest manifest, again from the newer one when another writer was faster."""
    for _ in range(TRIES):
        m = change(manifest(spark, table))
        try:
            _publish(spark, table, m)
            return m
        except Conflict:
            continue
    raise Conflict(f"{table}: {TRIES} versions were published by others meanwhile")


def _next(base: Manifest | None, schema: T.StructType, days: dict[str, list[str]], operation: str) -> Manifest:
    return Manifest(base.version + 1 if base else 1, schema, days, operation)


def _merged(base: Manifest | None, schema: T.StructType) -> T.StructType:
    """The base's columns, then new ones; a column never changes its type."""
    if base is None:
        return schema
    known = {f.name: f for f in base.schema}
    for f in schema:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType(list(base.schema) + [T.StructField(f.name, f.dataType, True) for f in schema if f.name not in known])


def _write_load(spark: SparkSession, table: str, rows: DataFrame) -> tuple[str, dict[str, int]]:
    """Write ``rows`` (with ``pdate``) as a new load; its id and rows a day (one entry a day, read back from the files)."""
    load = uuid.uuid4().hex
    path = f"{table}/data/{LOAD}={load}"
    rows.write.partitionBy(PDATE).parquet(path)
    if not any(n.startswith(f"{PDATE}=") for n in _names(spark, path)):
        return load, {}
    back = spark.read.schema(T.StructType([T.StructField(PDATE, T.DateType())])).parquet(path)
    return load, {NO_DAY if r[0] is None else str(r[0]): r[1] for r in back.groupBy(PDATE).count().collect()}


def _columns(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema if f.name != PDATE])


def append(spark: SparkSession, table: str, rows: DataFrame, date_col: str | None = None, based_on: int | None = None) -> Manifest | None:
    """Add rows, each to its parsed day (rows without one are kept under no day); None when there are none.

    ``based_on`` names the version that ``rows`` were computed against (0: no table); when another writer has
    published since, Conflict is raised and nothing is added.
    """
    dated = rows.withColumn(PDATE, parse_mixed_date(date_col) if date_col and date_col in rows.columns else F.lit(None).cast("date"))
    load, days = _write_load(spark, table, dated)
    if not days:
        return None

    def change(base):
        if based_on is not None and (base.version if base else 0) != based_on:
            raise Conflict(f"{table}: rows were chosen against version {based_on}")
        have = dict(base.days) if base else {}
        return _next(base, _merged(base, _columns(rows)), have | {d: have.get(d, []) + [load] for d in days}, "append")

    if based_on is None:
        return _change(spark, table, change)
    m = change(manifest(spark, table))
    _publish(spark, table, m)
    return m


def replace_days(spark: SparkSession, table: str, staged: DataFrame, date_col: str = "日付") -> Replaced:
    """Replace every day that ``staged`` has with its rows, all days at once; rows without a real ISO date are returned.

    No row with a date: nothing is published.  Columns the table lacks are left out, those the rows lack are NULL.
    """
    base = manifest(spark, table)
    if base is None:
        raise ValueError(f"{table} has no version to replace days in")
    keep = [f for f in base.schema if f.name in staged.columns]
    if not keep:
        raise ValueError("staged rows share no column with the table")
    rows = staged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in keep], parse_iso_only(F.substring(date_col, 1, 10)).alias(PDATE))
    load, days = _write_load(spark, table, rows)
    rejected = None
    if NO_DAY in days:
        rejected = spark.read.schema(T.StructType(keep)).parquet(f"{table}/data/{LOAD}={load}/{PDATE}={NO_DAY}")
    real = {d: n for d, n in days.items() if d != NO_DAY}
    if not real:
        return Replaced(None, 0, 0, rejected)
    m = _change(spark, table, lambda b: _next(b, b.schema, dict(b.days) | {d: [load] for d in real}, "replace_days"))
    return Replaced(m.version, len(real), sum(real.values()), rejected)


def add_column(spark: SparkSession, table: str, column: str, dtype: str = "string") -> bool:
    """Record one more column (K6); files written before give NULL.  False when the table has it already."""
    done = []

    def change(base):
        done.append(column not in base.schema.names)
        wanted = T.StructType.fromDDL(f"`{column}` {dtype}")
        return _next(base, _merged(base, wanted) if done[-1] else base.schema, base.days, "add_column")

    if column in manifest(spark, table).schema.names:
        return False
    _change(spark, table, change)
    return done[-1]


def read(spark: SparkSession, table: str, version: int | None = None, from_day: str | None = None, to_day: str | None = None) -> DataFrame | None:
    """The table at its newest (or given) version with ``pdate``; None when nothing is published.

    Days outside ``from_day``..``to_day`` are not even listed (rows without a day always stay).
    """
    m = manifest(spark, table, version)
    if m is None:
        return None
    schema = T.StructType([*m.schema, T.StructField(LOAD, T.StringType()), T.StructField(PDATE, T.DateType())])
    wanted = [d for d in m.days if d == NO_DAY or ((from_day is None or d >= from_day) and (to_day is None or d <= to_day))]
    paths = [f"{table}/data/{LOAD}={x}/{PDATE}={d}" for d in sorted(wanted) for x in m.days[d]]
    if not paths:
        return spark.createDataFrame([], schema).drop(LOAD)
    return spark.read.schema(schema).option("basePath", f"{table}/data").parquet(*paths).drop(LOAD)


def compact(spark: SparkSession, table: str) -> Manifest | None:
    """Rewrite the days that several loads make up as one load; rows stay the same.  None: nothing to do."""
    base = manifest(spark, table)
    many = [d for d, loads in base.days.items() if len(loads) > 1]
    if not many:
        return None
    schema = T.StructType([*base.schema, T.StructField(LOAD, T.StringType()), T.StructField(PDATE, T.DateType())])
    paths = [f"{table}/data/{LOAD}={x}/{PDATE}={d}" for d in many for x in base.days[d]]
    rows = spark.read.schema(schema).option("basePath", f"{table}/data").parquet(*paths).drop(LOAD)
    load, days = _write_load(spark, table, rows.repartition(PDATE, F.pmod(F.xxhash64(*base.schema.names), F.lit(16))))
    m = _next(base, base.schema, dict(base.days) | {d: [load] for d in days}, "compact")
    _publish(spark, table, m)
    return m


def history(spark: SparkSession, table: str) -> list[Manifest]:
    """Every published manifest, oldest first: what was done, with which columns and days."""
    return [manifest(spark, table, v) for v in versions(spark, table)]


def unreferenced(spark: SparkSession, table: str) -> list[str]:
    """Loads that no version refers to: left by jobs that died, or still being written."""
    used = {x for m in history(spark, table) for loads in m.days.values() for x in loads}
    return sorted(n for n in _names(spark, f"{table}/data") if n.startswith(f"{LOAD}=") and n.split("=", 1)[1] not in used)
