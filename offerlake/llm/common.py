"""Spark helpers shared by the training-data operators.

Column contract: operators read only the columns they name, by a cast projection
(:func:`pick`), so extra or clashing columns of an input never meet the operators' own
columns.  Intermediate tables are written below ``spark.checkpoint.dir`` and read back
(:func:`stored`), which also cuts lineage: a lost executor costs a re-read, not a re-run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offerlake.session import shared_path, ship_package

BATCH_BYTES = "16MB"
#: Rows of a key table that may be broadcast (16-byte keys: a few tens of MB).
BROADCAST_ROWS = 1_000_000


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and bound the bytes of an Arrow batch, so a
    run of very long texts becomes many batches rather than one huge one."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns cast to the given types; a column the input lacks is NULL."""
    return df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c)
                       for c, t in types.items()])


def packed(df: DataFrame, names: list[str] | None = None) -> Column:
    """The caller's columns as one struct ``own``: an operator's own columns stand beside it and
    cannot clash with any of them; ``select("own.*")`` gives the caller's rows back unchanged."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if names is None else names)]).alias("own")


def stored(df: DataFrame, spark: SparkSession, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = shared_path(spark, "llm", tag, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*cols: Column) -> Column:
    """16-byte identity of a row from its columns (NULL differs from the empty string)."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x00", *parts)))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL for a NULL id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def keep_keys(df: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Semi (or anti) join with a distinct key table: the keys are broadcast only when a
    count of the (stored) table shows at most ``BROADCAST_ROWS`` of them, otherwise the
    planner shuffles both sides."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return df.join(keys, on, how)


def map_batches(df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | StructType) -> DataFrame:
    return df.mapInArrow(fn, schema)


def sampled_rows(df: DataFrame, limit: int, max_bytes: int, *order: Column) -> DataFrame:
    """A bounded, deterministic training sample: the ``limit`` rows with the smallest hash
    order among those whose text has at most ``max_bytes`` bytes."""
    return df.where(F.octet_length("text") <= max_bytes).orderBy(*order).limit(limit)
