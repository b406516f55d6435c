"""Mergeable quantile sketches: the opt-in for percentiles over many snapshots.

An exact percentile needs every snapshot's rows again whenever one is added.  A KLL sketch
(Spark's ``kll_sketch_agg_bigint``) of each group and snapshot is a few kilobytes, is built
with map-side partial aggregation, is stored once per snapshot, and merges with those of
other snapshots into the sketch of all their rows.

The normalised rank error of one quantile is at most ``rank_error(k)`` (four times the
library's 99 % figure 2.296 / k^0.9021): between that share below the wanted rank and that
share above it lies the returned value, which is always one of the values aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_K = 800
QUARTILES = (0.25, 0.5, 0.75)


def rank_error(k: int = DEFAULT_K) -> float:
    return 4 * 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = DEFAULT_K) -> DataFrame:
    """One sketch (and the number of values) per group; NULL values are not counted and a
    group without any has no row."""
    return (df.where(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"), F.count("*").alias("n")))


def merged_sketches(sketches: DataFrame, keys: list[str], k: int = DEFAULT_K) -> DataFrame:
    """Sketches of several snapshots -> one per group, by merging alone."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], ranks: tuple[float, ...] = QUARTILES) -> DataFrame:
    """(keys, n, rank, value) for each group and rank."""
    at = F.array(*[F.lit(r) for r in ranks])
    pairs = F.arrays_zip(at.alias("rank"), F.kll_sketch_get_quantile_bigint("sketch", at).alias("value"))
    return sketches.select(*keys, "n", F.explode(pairs).alias("q")).select(*keys, "n", "q.rank", "q.value")


def within_error(estimates: DataFrame, df: DataFrame, keys: list[str], value: str, error: float) -> DataFrame:
    """``estimates`` with ``ok``: do the exact ranks of the estimated value come within
    ``error`` of the wanted one?  Reads the rows once more, as a histogram per group."""
    histogram = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    ranked = estimates.join(histogram, keys).groupBy(*keys, "n", "rank", estimates["value"]).agg(
        (F.sum(F.when(F.col(value) < F.col("value"), F.col("c")).otherwise(0)) / F.col("n")).alias("below"),
        (F.sum(F.when(F.col(value) <= F.col("value"), F.col("c")).otherwise(0)) / F.col("n")).alias("upto"),
        F.max(F.col(value) == F.col("value")).alias("held"))
    return ranked.withColumn("ok", F.col("held") & (F.col("below") <= F.col("rank") + error) & (F.col("upto") >= F.col("rank") - error))
