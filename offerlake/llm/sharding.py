"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that stays together; a group's size is the sum of its
rows' sizes (UTF-8 bytes + 8).  Units, sorted by size, go to the least-loaded shard
through a heap.  Scheduling is sequential, so the heap must see a bounded list: a group
larger than ``1 / (shards * UNITS_PER_SHARD)`` of all bytes is a unit of its own (there are
at most ``shards * UNITS_PER_SHARD`` such groups), the smaller groups are first packed by
hash into that many bundles.  The driver thus handles at most ``2 * shards *
UNITS_PER_SHARD`` rows at any input size, and the same table is what is broadcast.  On a
table with fewer groups than units every group is its own unit.  Loads then differ by at
most the largest unit (the LPT bound); a single group heavier than a fair shard fills one
shard, since it may not be split.

Slots (gapless from 0 in each shard) come from counts per (shard, salt) and a row number
inside each salt, so neither a shard nor a hot group is ordered in one task.

Defined cases: NULL text has size 8, crc32 0 and groups with the empty text; repeated rows
get their own slots; NULL ids sort first; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.llm.common import packed, pick, prepare, stored

UNITS_PER_SHARD = 400
ROWS_PER_SALT = 2000


def lpt(units: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Longest processing time first; ties by name, then by lowest shard number."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for name, size in sorted(units, key=lambda u: (-u[1], u[0])):
        load, s = heapq.heappop(heap)
        out[name] = s
        heapq.heappush(heap, (load + size, s))
    return out


def _keys(docs: DataFrame) -> DataFrame:
    """``docs`` with the helper columns: size, checksum and group of each row."""
    text = F.col("text").cast("string") if "text" in docs.columns else F.lit(None).cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return docs.withColumns({
        "__size": (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("bigint"),
        "__crc": F.crc32(raw), "__group": F.concat(F.lit("g"), F.sha2(raw, 256))})


def _bundle(bundles: int) -> Column:
    return F.concat(F.lit("b"), F.pmod(F.xxhash64("__group"), F.lit(bundles)).cast("string"))


def assignment(keyed: DataFrame, spark: SparkSession, shards: int) -> DataFrame:
    """unit -> shard for heavy groups ("g" + digest) and bundles ("b" + number): at most
    ``2 * shards * UNITS_PER_SHARD`` rows, whatever the input."""
    bundles = shards * UNITS_PER_SHARD
    groups = keyed.groupBy("__group").agg(F.sum("__size").alias("bytes"))
    total = keyed.agg(F.sum("__size")).first()[0] or 0
    unit = F.when(F.col("bytes") * bundles > total, F.col("__group")).otherwise(_bundle(bundles))
    units = groups.groupBy(unit.alias("unit")).agg(F.sum("bytes").alias("bytes")).collect()
    return spark.createDataFrame(list(lpt([(u["unit"], u["bytes"]) for u in units], shards).items()),
                                 "unit string, shard int")


def place(keyed: DataFrame, slim: DataFrame, spark: SparkSession, shards: int) -> DataFrame:
    """``keyed`` rows with ``shard`` and ``slot``; ``slim`` holds the same rows' helper
    columns and ids (a stored table), from which assignment and counts are taken."""
    units = assignment(slim, spark, shards)
    heavy = F.broadcast(units.select(F.col("unit").alias("__group"), F.col("shard").alias("__own")))
    bundle = F.broadcast(units.select(F.col("unit").alias("__bundle"), F.col("shard").alias("__shared")))
    salts = max(1, -(-slim.count() // (shards * ROWS_PER_SALT)))

    def dealt(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("__bundle", _bundle(shards * UNITS_PER_SHARD))
                .join(heavy, "__group", "left").join(bundle, "__bundle", "left")
                .withColumns({"shard": F.coalesce("__own", "__shared"),
                              "__salt": F.pmod(F.xxhash64("__id", "__group"), F.lit(salts)).cast("int")})
                .drop("__own", "__shared", "__bundle"))

    before = Window.partitionBy("shard").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt(slim).groupBy("shard", "__salt").agg(F.count("*").alias("n"))
               .select("shard", "__salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")))
    inside = Window.partitionBy("shard", "__salt").orderBy("__id", "__group")
    return (dealt(keyed).withColumn("__at", F.row_number().over(inside)).join(offsets, ["shard", "__salt"])
            .withColumn("slot", (F.col("__before") + F.col("__at") - 1).cast("bigint"))
            .drop("__before", "__at", "__salt"))


def shard_documents(docs: DataFrame, spark: SparkSession, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (NULL: another
    shard count is another schedule)."""
    prepare(spark)
    slim = _keys(pick(docs, doc_id="bigint", text="string")).withColumn("__id", F.col("doc_id")).drop("doc_id", "text")
    slim = stored(slim, spark, "sharding")
    return place(slim, slim, spark, shards).select(
        F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def add_shards(docs: DataFrame, spark: SparkSession, shards: int = 24) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (columns of those names are replaced)."""
    prepare(spark)
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    whole = docs.select(packed(docs, names), F.col("doc_id").cast("bigint").alias("__id"),
                        *[F.col(c) for c in names if c == "text"])
    keyed = _keys(whole).drop("text")
    slim = stored(keyed.select("__id", "__size", "__crc", "__group"), spark, "sharding")
    return place(keyed, slim, spark, shards).select("own.*", "shard", "slot")
