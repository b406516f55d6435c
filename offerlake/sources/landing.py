"""Landing snapshots: CSV/JSON sinks, snapshot discovery and the by-name CSV scan.

A snapshot is one landing unit named ``<prefix>_yyyyMMdd_HHmmss`` (a single ``.csv``
file, or a directory of part files written by Spark).  Multi-line CSV files are not
splittable, so the sink writes several part files per snapshot (one read task each)
rather than funnelling a run through one file.  For the same reason compressing them
(``compression="gzip"``: files ``*.csv.gz``) costs no read task; discovery and scans take
plain and compressed files alike.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANDING_COLUMNS, LANDING_SCHEMA, RECORD_SCHEMA

# Landing file-name prefix and the timestamp layout in the name.
DEFAULT_PREFIX = "the_it_protocol_jobs"
NAME_TS_FORMAT = "yyyyMMdd_HHmmss"

# Separators used when list fields are flattened for CSV.
TECH_SEPARATOR = ", "
TEXT_LIST_SEPARATOR = " | "

# Keep field text byte-exact: no whitespace trimming, '' written as an empty field.
CSV_WRITE_OPTIONS = {"header": "true", "emptyValue": "", "escape": '"',
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_READ_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "mode": "PERMISSIVE"}


#: Compressed landing files that are found beside plain ones.
COMPRESSED = ".gz"


def flatten_lists(df: DataFrame) -> DataFrame:
    """Array columns -> strings: technologies joined by ', ', requirements and
    responsibilities by ' | ' (an empty list gives '')."""
    seps = {"expected_technologies": TECH_SEPARATOR, "requirements": TEXT_LIST_SEPARATOR,
            "responsibilities": TEXT_LIST_SEPARATOR}
    out = df
    for name, sep in seps.items():
        if name in df.columns and isinstance(df.schema[name].dataType, T.ArrayType):
            out = out.withColumn(name, F.array_join(F.col(name), sep))
    return out


def snapshot_name(run_ts: _dt.datetime, prefix: str = DEFAULT_PREFIX) -> str:
    return f"{prefix}_{run_ts.strftime('%Y%m%d_%H%M%S')}.csv"


def _publish_snapshot(writer, rows: DataFrame, path: str) -> str | None:
    """Run the write job once into a hidden folder beside ``path``, counting its rows on the
    way, then move it there.  An empty run, or one that fails, leaves ``path`` as it was."""
    spark = rows.sparkSession
    landing, name = path.rsplit("/", 1)
    draft = f"{landing}/_writing-{uuid.uuid4().hex[:12]}-{name}"  # '_': no scan or stream sees it
    counted = Observation()
    try:
        writer(rows.observe(counted, F.count(F.lit(1)).alias("n")), draft)
        if not counted.get["n"]:
            return None
        fs, target = _filesystem(spark, path)
        fs.delete(target, True)
        if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), target):
            raise OSError(f"{draft} could not be moved to {path}")
        return path
    finally:
        delete_path(spark, draft)


def write_csv_snapshot(df: DataFrame, landing_dir: str, run_ts: _dt.datetime,
                       prefix: str = DEFAULT_PREFIX, files: int | None = None,
                       compression: str = "none") -> str | None:
    """Write one run as a CSV snapshot; returns its path, or None for an empty run.

    Takes landing rows, their lists as arrays or flattened.  Header row, empty strings
    written as empty fields, '"' escaping, overwrite of a snapshot with the same name.
    ``files`` optionally sets the number of part files, ``compression`` ("gzip") packs them.
    """
    rows = flatten_lists(df).select(*[F.col(c).cast("string") for c in LANDING_COLUMNS])
    if files:
        rows = rows.repartition(files)
    path = f"{landing_dir.rstrip('/')}/{snapshot_name(run_ts, prefix)}"
    options = {**CSV_WRITE_OPTIONS, "compression": compression}
    return _publish_snapshot(lambda r, to: r.write.options(**options).csv(to), rows, path)


def write_json_snapshot(df: DataFrame, landing_dir: str, run_ts: _dt.datetime,
                        prefix: str = DEFAULT_PREFIX, compression: str = "none") -> str | None:
    """Write one run as a JSON-lines snapshot of the 20 landing columns: lists stay arrays,
    NULL fields are written out; returns its path, or None for an empty run.  ``compression``
    as for CSV; a compressed file is read by one task, a plain one may be split."""
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in RECORD_SCHEMA.fields])
    path = f"{landing_dir.rstrip('/')}/{snapshot_name(run_ts, prefix)[:-4]}.json"
    options = {"ignoreNullFields": "false", "compression": compression}
    return _publish_snapshot(lambda r, to: r.write.options(**options).json(to), rows, path)


def name_timestamp(path: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    """Timestamp encoded in a landing path; NULL when absent or impossible.  Of several
    path components the last one that carries a stamp counts."""
    raw = F.regexp_extract(path, rf"^(?:.*/)?{prefix}_(\d{{8}}_\d{{6}})", 1)
    return F.try_to_timestamp(F.nullif(raw, F.lit("")), F.lit(NAME_TS_FORMAT))


def _below(path: Column, landing_dir: str) -> tuple[Column, Column]:
    """(path up to the landing folder with its slash, first component below it)."""
    base = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", landing_dir).strip("/") + "/"
    root = F.substr(path, F.lit(1), F.instr(path, base) + F.lit(len(base) - 1))
    return root, F.substring_index(F.substr(path, F.length(root) + F.lit(1)), "/", 1)


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Paths right below ``path``, by name; none if there is no such folder."""
    fs, p = _filesystem(spark, path)
    return sorted(f.getPath().toString() for f in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or, if ``path`` exists, not at all (False)."""
    fs, p = _filesystem(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(p.getParent(), f"_draft-{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    never_over = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    never_over[0] = getattr(hadoop, "Options$Rename").valueOf("NONE")
    context = hadoop.FileContext.getFileContext(fs.makeQualified(p).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(p), never_over)
        return True
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _filesystem(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def being_written(spark: SparkSession, unit: str) -> bool:
    """Does a Spark job still have uncommitted output in this landing unit?"""
    fs, p = _filesystem(spark, f"{unit}/_temporary")
    return fs.exists(p)


def file_glob(suffix: str = "csv") -> str:
    """Names of landing files of one kind, plain and compressed."""
    return f"*.{{{suffix},{suffix}{COMPRESSED}}}"


def list_landing_files(spark: SparkSession, landing_dir: str, suffix: str = "csv") -> DataFrame:
    """(path, length, modificationTime) of every ``*.<suffix>`` file, plain or compressed, under
    the landing dir; a binaryFile scan without its content column, so file contents are never read."""
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", file_glob(suffix))
            .option("recursiveFileLookup", "true")
            .load(landing_dir)
            .select("path", "length", "modificationTime"))


def snapshot_candidates(spark: SparkSession, landing_dir: str, prefix: str = DEFAULT_PREFIX, suffix: str = "csv") -> DataFrame:
    """(unit, snapshot_ts, files, digest) for every landing unit: a file or a directory right
    below the landing folder, stamped by its own name only (unmatched names have a NULL ts).
    ``digest`` changes with the paths, lengths and modification times of the unit's files."""
    root, name = _below(F.col("path"), landing_dir)
    return (list_landing_files(spark, landing_dir, suffix).select(
        root.alias("root"), name.alias("name"), F.xxhash64("path", "length", "modificationTime").alias("h"))
            .groupBy(F.concat("root", "name").alias("unit"), name_timestamp(F.col("name"), prefix).alias("snapshot_ts"))
            .agg(F.count("*").alias("files"), F.concat_ws("-", F.count("*"), F.hex(F.bit_xor("h"))).alias("digest")))


def newest_unit(spark: SparkSession, landing_dir: str, prefix: str = DEFAULT_PREFIX, suffix: str = "csv"):
    """Row (unit, snapshot_ts, files, digest) of the snapshot with the greatest name timestamp, or
    None.  Unmatched or impossible timestamps rank lowest (ties: greatest path); units
    that are still being written are passed over."""
    skipped: list[str] = []
    while True:
        cands = snapshot_candidates(spark, landing_dir, prefix, suffix).where(
            ~F.col("unit").isin(skipped) if skipped else F.lit(True))
        order = F.struct(F.col("snapshot_ts").isNotNull(), "snapshot_ts", "unit")
        best = cands.agg(F.max_by(F.struct("unit", "snapshot_ts", "files", "digest"), order).alias("u")).first()["u"]
        if best is None or not being_written(spark, best["unit"]):
            return best
        skipped.append(best["unit"])


def latest_snapshot(spark: SparkSession, landing_dir: str, prefix: str = DEFAULT_PREFIX, suffix: str = "csv") -> str:
    """Path of the newest complete snapshot unit; no file of the kind at all raises
    ValueError.  Only one row (the chosen unit) reaches the driver."""
    best = newest_unit(spark, landing_dir, prefix, suffix)
    if best is None:
        raise ValueError(f"No {suffix.upper()} files found in {landing_dir}")
    return best["unit"]


def spread_over_cores(spark: SparkSession, path: str) -> bool:
    """Do the CSV files of ``path``, a task each, keep all cores busy by themselves (the
    largest holds no more than two cores' share)?"""
    total, largest = list_landing_files(spark, path).agg(F.sum("length"), F.max("length")).first()
    return bool(total) and largest * spark.sparkContext.defaultParallelism <= 2 * total


def read_landing_csv(spark: SparkSession, path: str, with_source: bool = True) -> DataFrame:
    """By-name CSV scan: all strings, header names mapped to the 20 landing columns,
    missing columns added as NULL, extra columns ignored.  A multi-line file is one task;
    if its files do not keep the cores busy, the rebalance hint lets AQE cut what they hold
    into partitions of advisory size, else no row is shuffled."""
    raw = spark.read.options(**CSV_READ_OPTIONS).csv(path)
    present = set(raw.columns)
    cols = [F.col(f"`{c}`") if c in present else F.lit(None).cast("string").alias(c)
            for c in LANDING_COLUMNS]
    if with_source:
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    rows = raw.select(*cols)
    return rows if spread_over_cores(spark, path) else rows.hint("rebalance")


def read_latest_snapshot(spark: SparkSession, landing_dir: str, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    return read_landing_csv(spark, latest_snapshot(spark, landing_dir, prefix))


def read_landing_json(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of a JSON snapshot: the 20 landing columns, lists as arrays, plus
    source_file; keys a record lacks are NULL, other keys are ignored."""
    return spark.read.schema(RECORD_SCHEMA).json(path).withColumn("source_file", F.col("_metadata.file_path"))


# --- files that differ in their headers ---------------------------------------------------------

#: Columns a landing file may have; all 20 must be among the first so many.
MAX_FILE_COLUMNS = 64
RAW_SCHEMA = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(MAX_FILE_COLUMNS)]
                          + [T.StructField("source_file", T.StringType())])
BY_HEADER_SCHEMA = T.StructType(LANDING_SCHEMA.fields + [T.StructField("source_file", T.StringType())])


def raw_csv_schema() -> T.StructType:
    """Schema under which files of any header are read: columns by place, header row included."""
    return T.StructType(RAW_SCHEMA.fields[:-1])


def _places(header: pa.RecordBatch) -> list[int | None]:
    """Place of each landing column in a file, from its header row (the first of equal names)."""
    names = [v[0].as_py() for v in header.columns[:-1]]
    names[0] = names[0].lstrip("\ufeff") if names[0] else names[0]
    places = [names.index(c) if c in names else None for c in LANDING_COLUMNS]
    if names[-1] is not None and None in places:
        raise ValueError(f"{header.columns[-1][0].as_py()} has more than {MAX_FILE_COLUMNS} columns and may lose some")
    return places


def _by_header(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    file, places = None, []
    for batch in batches:
        ends = pc.run_end_encode(batch.columns[-1]).run_ends.to_pylist() if len(batch) else []
        start = 0
        for end in ends:
            part, start = batch.slice(start, end - start), end
            if part.columns[-1][0].as_py() != file:  # a file begins with its header
                file = part.columns[-1][0].as_py()
                places = _places(part.slice(0, 1))
                part = part.slice(1)
            if len(part):
                none = pa.nulls(len(part), pa.string())
                yield pa.RecordBatch.from_arrays([none if i is None else part.columns[i] for i in places] + [part.columns[-1]],
                                                 BY_HEADER_SCHEMA.names)


def by_header(raw: DataFrame) -> DataFrame:
    """Rows read under :func:`raw_csv_schema` (batch or stream) with their ``source_file`` ->
    the 20 landing columns by header name, each file by its own header: columns in any
    order, missing ones NULL, others ignored.

    A multi-line CSV file is read by one task, from its first row on; so the task finds each
    file's header in front of its rows and no file is opened twice."""
    return raw.select(*[c.name for c in RAW_SCHEMA.fields]).mapInArrow(_by_header, BY_HEADER_SCHEMA)


def read_mixed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of CSV files that may differ in their headers (a file, folder or glob)."""
    reader = spark.read.schema(raw_csv_schema()).options(**{**CSV_READ_OPTIONS, "header": "false"})
    if not any(ch in path for ch in "*?[{"):
        reader = reader.option("recursiveFileLookup", "true")
    return by_header(reader.csv(path).withColumn("source_file", F.col("_metadata.file_path")))
