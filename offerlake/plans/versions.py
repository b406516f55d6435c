"""Numbered table versions behind one name.

A table's rows lie in folders below ``<database>/versions/<table>/data``, written once and
never changed.  A *version* says which rows of which folders make up the table; it is a
small record ``commits/<number>.json``, and the table's name is a persistent view over the
newest one.  Numbers count up from the last record; no clock takes part.

* **Compare and set.**  A writer notes the newest number when it begins and publishes under
  the next one, by a rename that fails if the record exists.  If somebody else published
  meanwhile nothing changes and :class:`ConcurrentWrite` is raised.
* **Crash.**  Before its record a writer has changed nothing that is visible.  Between its
  record and the move of the view the name still shows the version before, complete; the
  next writer moves the view on.
* **Sweep.**  A folder is deleted only if no kept record names it, neither does the record
  the view shows, and no writer has announced it (``writers/<folder>``, made before the
  folder).  Announcements of a dead driver protect its folder until
  :func:`clear_abandoned` is called.

Records also hold the table's columns.  ``merge_schema`` keeps the columns of earlier
versions, adds new ones and widens types, so old folders read under the new columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import landing as L

KEEP = 2
PROPERTY = "offerlake.version"
#: From narrow to wide within one family of types.
_WIDENING = ("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("date", "timestamp")


class ConcurrentWrite(RuntimeError):
    """Another writer published a version of the table since this one began."""


@dataclass(frozen=True)
class Part:
    """Rows of one folder: all, or those that satisfy ``where`` (on its partition columns)."""
    path: str
    columns: tuple[str, ...]
    where: str | None = None


@dataclass(frozen=True)
class Version:
    number: int
    fmt: str
    schema: str  # JSON of the table's StructType
    parts: tuple[Part, ...]
    buckets: int | None = None

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def select_sql(self, struct: T.StructType | None = None) -> str:
        """SQL text of the version's rows, under its own columns or under ``struct``."""
        def one(part: Part) -> str:
            columns = ", ".join(
                f"CAST({_quoted(f.name) if f.name in part.columns else 'NULL'} AS {f.dataType.simpleString()}) AS {_quoted(f.name)}"
                for f in (struct or self.struct).fields)
            return f"SELECT {columns} FROM {self.fmt}.`{part.path}`" + (f" WHERE {part.where}" if part.where else "")
        return " UNION ALL ".join(map(one, self.parts))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def versions_root(spark: SparkSession, target: str) -> str:
    database, table = target.rsplit(".", 1)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/versions/{table}"


def _commits(spark: SparkSession, target: str) -> list[str]:
    return [p for p in L.subfolders(spark, f"{versions_root(spark, target)}/commits") if p.endswith(".json")]


def _load(spark: SparkSession, path: str) -> Version:
    raw = json.loads(L.read_text(spark, path))
    return Version(**{**raw, "parts": tuple(Part(p["path"], tuple(p["columns"]), p["where"]) for p in raw["parts"])})


def current(spark: SparkSession, target: str) -> Version | None:
    """The newest published version."""
    paths = _commits(spark, target)
    return _load(spark, paths[-1]) if paths else None


def read_version(spark: SparkSession, target: str, number: int) -> DataFrame:
    """An earlier version (while it is kept) under the table's present columns."""
    path = f"{versions_root(spark, target)}/commits/{number:012d}.json"
    return spark.sql(_load(spark, path).select_sql(current(spark, target).struct))


def shown(spark: SparkSession, target: str) -> int | None:
    """Number of the version that the table's name shows."""
    if not spark.catalog.tableExists(target):
        return None
    for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect():
        if r["key"] == PROPERTY:
            return int(r["value"])
    return None


def point(spark: SparkSession, target: str) -> None:
    """Move the table's name to the newest version; looks again afterwards, so the last of
    several writers to arrive here leaves the newest one."""
    while (version := current(spark, target)) is not None and shown(spark, target) != version.number:
        spark.sql(f"CREATE OR REPLACE VIEW {target} TBLPROPERTIES ('{PROPERTY}' = '{version.number}') AS {version.select_sql()}")


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both: the old ones in their order, then new ones; types widened."""
    fresh = {f.name: f for f in new.fields}

    def wider(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
        for family in _WIDENING:
            if a.simpleString() in family and b.simpleString() in family:
                return max(a, b, key=lambda t: family.index(t.simpleString()))
        if a.simpleString() != b.simpleString():
            raise ValueError(f"column {name}: {a.simpleString()} and {b.simpleString()} do not merge")
        return a
    kept = [T.StructField(f.name, wider(f.name, f.dataType, fresh[f.name].dataType) if f.name in fresh else f.dataType)
            for f in old.fields]
    return T.StructType(kept + [f for f in new.fields if f.name not in {o.name for o in old.fields}])


def publish(spark: SparkSession, target: str, write: Callable[[str], Version], base: Version | None, keep: int = KEEP) -> Version:
    """Let ``write`` fill a new folder and name the version's rows; publish that after
    ``base``, move the name, sweep.  A failed or outrun writer leaves nothing behind."""
    if spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType != "VIEW":
        raise ValueError(f"{target} is a plain table of an earlier layout: rename it, then load again")
    root, name = versions_root(spark, target), uuid.uuid4().hex
    folder, sign = f"{root}/data/{name}", f"{root}/writers/{name}"
    L.write_text(spark, sign, "")
    number = base.number + 1 if base else 1
    try:
        version = write(folder)
        version = Version(number, version.fmt, version.schema, version.parts, version.buckets)
        if not L.write_text(spark, f"{root}/commits/{number:012d}.json", json.dumps(asdict(version))):
            raise ConcurrentWrite(f"{target}: version {number} was published by another writer")
    except BaseException:
        L.delete_path(spark, folder)
        L.delete_path(spark, sign)
        raise
    point(spark, target)
    L.delete_path(spark, sign)
    sweep(spark, target, keep)
    return version


def sweep(spark: SparkSession, target: str, keep: int = KEEP) -> list[str]:
    """Delete folders that nothing names any more.  Folders are listed before announcements
    and those before records: a writer announces first and publishes before it withdraws."""
    root = versions_root(spark, target)
    folders = L.subfolders(spark, f"{root}/data")
    named = {p.rsplit("/", 1)[-1] for p in L.subfolders(spark, f"{root}/writers")}
    paths = _commits(spark, target)
    visible = shown(spark, target)
    for path in paths[-keep:] + [p for p in paths[:-keep] if visible is not None and p.endswith(f"/{visible:012d}.json")]:
        named |= {part.path.rsplit("/data/", 1)[-1].split("/", 1)[0] for part in _load(spark, path).parts}
    gone = [f for f in folders if f.rsplit("/", 1)[-1] not in named]
    for f in gone:
        L.delete_path(spark, f)
    return gone


def clear_abandoned(spark: SparkSession, target: str) -> None:
    """Withdraw all announcements; call it only while no writer of the table runs."""
    for sign in L.subfolders(spark, f"{versions_root(spark, target)}/writers"):
        L.delete_path(spark, sign)


def aligned(df: DataFrame, struct: T.StructType) -> DataFrame:
    """``df`` under the columns of ``struct``; missing ones are NULL."""
    return df.select(*[(F.col(_quoted(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in struct.fields])


def replace(spark: SparkSession, df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None,
            merge_schema: bool = False, keep: int = KEEP, base: Version | None = None) -> Version:
    """Publish ``df`` as the whole table."""
    base = base or current(spark, target)
    struct = merged_schema(base.struct, df.schema) if merge_schema and base else df.schema

    def write(folder: str) -> Version:
        aligned(df, struct).write.format(fmt).options(**(options or {})).save(folder)
        return Version(0, fmt, struct.json(), (Part(folder, tuple(struct.names)),))
    return publish(spark, target, write, base, keep)


# --- bucketed tables --------------------------------------------------------------------------

BUCKET = "__bucket"
MAX_PARTS = 16


def _bucket_of(key: str, buckets: int):
    """Bucket of a row; rows without a key are bucket -1."""
    return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("int")


def _in(keys) -> str:
    return f"{BUCKET} IN ({', '.join(map(str, sorted(keys)))})"


def _keys(where: str) -> set[int]:
    return {int(k) for k in where[where.index("(") + 1:-1].split(",")}


def upsert(spark: SparkSession, incoming: DataFrame, target: str, merge: Callable[[DataFrame, DataFrame], DataFrame],
           key: str, buckets: int, fmt: str = "parquet", keep: int = KEEP, attempts: int = 3) -> Version:
    """Merge ``incoming`` by ``key``: only the hash buckets that its keys fall into are read
    and written again, the others stay in the folders they lie in.

    Rows without a key are added, never merged.  The folders of all versions still in use
    make up the view; beyond ``MAX_PARTS`` of them (and on a table without buckets) all
    buckets are written again.  Outrun by another writer, the merge is done again."""
    for attempt in range(attempts):
        base = current(spark, target)
        struct = merged_schema(base.struct, incoming.schema) if base else incoming.schema
        rows = aligned(incoming, struct)
        old = base.parts if base else ()
        stays: list[Part] = []
        if base and base.buckets and len(old) < MAX_PARTS:
            # At most `buckets` numbers.
            touched = {r[0] for r in rows.where(F.col(key).isNotNull()).select(_bucket_of(key, base.buckets)).distinct().collect()}
            stays = [Part(p.path, p.columns, _in(k)) for p in old if (k := _keys(p.where) - touched)]
            old = tuple(Part(p.path, p.columns, _in(k)) for p in old if (k := _keys(p.where) & touched))
        n = base.buckets if base and base.buckets else buckets
        before = spark.sql(Version(0, base.fmt, base.schema, tuple(old)).select_sql(struct)) if old else rows.limit(0)
        merged = aligned(merge(before, rows), struct).withColumn(BUCKET, _bucket_of(key, n))

        def write(folder: str) -> Version:
            merged.hint("rebalance", BUCKET).write.format(fmt).partitionBy(BUCKET).save(folder)
            written = [int(p.rsplit("=", 1)[1]) for p in L.subfolders(spark, folder) if f"/{BUCKET}=" in p]
            new = [Part(folder, tuple(struct.names), _in(written))] if written else []
            if not new and not stays:
                aligned(rows.limit(0), struct).withColumn(BUCKET, F.lit(-1)).write.mode("overwrite").format(fmt).save(folder)
                new = [Part(folder, tuple(struct.names), _in([-1]))]
            return Version(0, fmt, struct.json(), (*stays, *new), n)
        try:
            return publish(spark, target, write, base, keep)
        except ConcurrentWrite:
            if attempt + 1 == attempts:
                raise
