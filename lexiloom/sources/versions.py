"""Tables whose units are replaced one at a time, each commit as a whole.

A table is a folder with `data`, where every commit writes a folder of its own,
and `_versions`, numbered documents that say which folders hold the rows of
each unit (a dataset config and a split).  A commit writes its rows first and
then publishes the next document, which no other writer may have published: it
takes over what the last one says of all other units.  Readers go by the last
document, so they see a commit wholly or not at all, and a run that is killed
leaves the version before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UnitKey = tuple[str, str]
UNIT = ("dataset_config", "split")


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def _document(spark: SparkSession, path: str) -> dict:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, document: dict) -> bool:
    """Write a document under a name that must be new; False if another writer has it."""
    jvm = spark.sparkContext._jvm
    draft, fs = _path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(document).encode()))
    finally:
        out.close()
    target, _ = _path(spark, path)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # without leave to overwrite
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), none)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception.toString()):
            raise
        fs.delete(draft, False)
        return False


def numbers(spark: SparkSession, table: str) -> list[int]:
    """The numbers of all published versions."""
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{table}/_versions") if n.endswith(".json"))


def version(spark: SparkSession, table: str, number: int | None = None) -> dict:
    """What a version says, by default the last: its number, the schema and the folders of each unit."""
    found = numbers(spark, table)
    if not found:
        return {"number": 0, "schema": None, "units": {}}
    number = found[-1] if number is None else number
    return {"number": number, **_document(spark, f"{table}/_versions/{number:012d}.json")}


def exists(spark: SparkSession, table: str) -> bool:
    """Whether there is a committed version, or a plain Parquet table."""
    p, fs = _path(spark, table)
    return bool(numbers(spark, table)) or (fs.exists(p) and not fs.exists(_path(spark, f"{table}/data")[0]))


def _merged(a: T.StructType | None, b: T.StructType) -> T.StructType:
    """All fields of both schemas; a field must have one type."""
    out = {f.name: f for f in (a.fields if a else [])}
    for f in b.fields:
        if f.name in out and out[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} was {out[f.name].dataType.simpleString()} and is {f.dataType.simpleString()}")
        out.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(out.values()))


def _key(unit: UnitKey) -> str:
    return json.dumps(list(unit), ensure_ascii=False)


def _read(spark: SparkSession, table: str, what: dict, units: Iterable[UnitKey] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(what["schema"])
    wanted = what["units"] if units is None else {k: v for k, v in what["units"].items() if k in set(map(_key, units))}
    folders = [f"{table}/data/{f}" for of in wanted.values() for f in of]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, table: str, units: Iterable[UnitKey] | None = None, number: int | None = None) -> DataFrame:
    """The committed rows, of some units or of all, in the last version or another; a plain Parquet table is read as it is."""
    what = version(spark, table, number)
    if what["schema"] is not None:
        return _read(spark, table, what, units)
    if not exists(spark, table):
        raise FileNotFoundError(f"nothing was committed to {table}")
    rows = spark.read.parquet(table)
    return rows if units is None else rows.where(in_units(units))


def in_units(units: Iterable[UnitKey]):
    """Whether a row is of one of the units."""
    found = F.lit(False)
    for config, split in units:
        found = found | ((F.col(UNIT[0]) == config) & (F.col(UNIT[1]) == split))
    return found


def commit(df: DataFrame, table: str, units: list[UnitKey], key: str | None = None) -> DataFrame:
    """Replace units by the rows of df, which must be of these units; the committed table.

    A unit without rows is empty afterwards.  With a `key`, rows of these units
    that are there already stay unless df has their key: for runs over a part.
    """
    spark, own = df.sparkSession, uuid.uuid4().hex
    number_of = F.lit(None).cast("int")
    for i, (config, split) in enumerate(units):
        number_of = F.when((F.col(UNIT[0]) == config) & (F.col(UNIT[1]) == split), i).otherwise(number_of)
    stray = F.raise_error(F.concat(F.lit("a row of another unit: "), F.coalesce(UNIT[0], F.lit("")), F.lit("/"), F.coalesce(UNIT[1], F.lit(""))))
    put = lambda rows, name: rows.withColumn("unit", F.coalesce(number_of, stray)).write.partitionBy("unit").option("compression", "zstd").parquet(f"{table}/data/{name}")
    put(df, own)
    schema = _merged(None, df.schema)
    while True:
        last = version(spark, table)
        names = [own]
        if key and last["schema"] is not None and any(last["units"].get(_key(u)) for u in units):
            mine = spark.read.schema(schema).parquet(f"{table}/data/{own}").select(key)
            names.append(uuid.uuid4().hex)
            put(_read(spark, table, last, units).join(mine, key, "left_anti"), names[1])
        there = {n: set(_names(spark, f"{table}/data/{n}")) for n in names}
        of = {_key(u): [f"{n}/unit={i}" for n in names if f"unit={i}" in there[n]] for i, u in enumerate(units)}
        stays = len(names) > 1 or any(of for k, of in last["units"].items() if k not in set(map(_key, units)))
        merged = _merged(T.StructType.fromJson(last["schema"]) if stays else None, schema)
        document = {"schema": merged.jsonValue(), "units": last["units"] | of}
        if _publish(spark, f"{table}/_versions/{last['number'] + 1:012d}.json", document):
            return _read(spark, table, document)


def expire(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Delete what only versions before the last `keep` hold, and unfinished commits; how many folders went.

    A folder that no version names may belong to a commit that is under way, so
    run it while nothing writes to the table.
    """
    found = numbers(spark, table)
    held = {f.partition("/")[0] for n in found[-keep:] for of in version(spark, table, n)["units"].values() for f in of}
    gone = [n for n in _names(spark, f"{table}/data") if n not in held]
    for n in gone:
        p, fs = _path(spark, f"{table}/data/{n}")
        fs.delete(p, True)
    for n in found[:-keep]:
        p, fs = _path(spark, f"{table}/_versions/{n:012d}.json")
        fs.delete(p, False)
    return len(gone)
