"""Mixing sources to target weights (DataFrame operations only).

Temperature mixing.  A source's share of all tokens is raised to an exponent in [0, 1] and
the results are normalised to weights: exponent 1 keeps the corpus mixture, 0 is uniform.
The exponent is bisected to meet a target:

* ``max_repeats``: no source is read more than that many times as often as the least
  repeated one (the smallest exponent that keeps within the limit), or
* ``entropy``: the weights' entropy as a fraction of the uniform mixture's.

Each bisection round cuts the bracket into ``SECTIONS`` parts with one aggregation over the
(stored) source totals, so the driver sees one row a round, whatever the number of sources.

Realisation.  ``budget_tokens`` are dealt to the sources by weight; a source with ``r``
times its tokens in the budget is read ``floor(r)`` whole epochs plus a partial one.  Every
epoch orders the source's documents by a seeded hash permutation and the partial epoch is
the longest prefix of its permutation within the budget.  An epoch is cut into blocks of
``block_tokens`` and the blocks of all sources are permuted by a hash (``block_key``), so
reading in (block_key, position) order interleaves the sources.  By default the budget is
the smallest one that reads every source once at least, so no document is left out.

Prefixes and blocks come from token totals per (source, epoch, hash bucket): a window orders
documents only inside one bucket, and buckets follow the row count, so a source that holds a
third of all rows is spread over many tasks.

Defined cases: a NULL source is a source of its own; NULL and empty texts have no tokens and
come once in every epoch, the partial one included while its prefix lasts; sources without
tokens get weight 0 and are read once; repeated rows are documents like any other; an empty
table gives an empty result; other columns are kept by :func:`mix_documents`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.llm.common import packed, pick, prepare, row_key, stored

SECTIONS = 16
ROUNDS = 7
ROWS_PER_BUCKET = 1000
BLOCK_TOKENS = 20_000


@dataclass(frozen=True)
class Mixture:
    """What to aim for: exactly one of ``max_repeats`` and ``entropy``."""
    max_repeats: float | None = 2.0
    entropy: float | None = None
    budget_tokens: int | None = None
    block_tokens: int = BLOCK_TOKENS
    seed: int = 7


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens of a text (0 for NULL)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("__source").agg(F.sum("__tokens").alias("tokens"), F.count("*").alias("rows"))


def find_exponent(totals: DataFrame, spark: SparkSession, mixture: Mixture) -> float:
    """The smallest exponent within the repetition limit, or the largest whose weights
    reach the entropy target (1.0 if even the unchanged mixture does)."""
    sized = totals.where("tokens > 0")
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * i / SECTIONS for i in range(SECTIONS + 1)]
        points = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a")) for i, a in enumerate(grid)]))
        # Shares enter only by their logarithms, up to a constant.
        power = F.col("p.a") * F.ln("tokens")
        per = (sized.select("tokens", points.alias("p")).groupBy("p.i")
               .agg(F.sum(F.exp(power)).alias("z"), F.sum(F.exp(power) * power).alias("zl"),
                    F.max(F.exp(power) / F.col("tokens")).alias("most"),
                    F.min(F.exp(power) / F.col("tokens")).alias("least"), F.count("*").alias("n"))
               .select("i", (F.ln("z") - F.col("zl") / F.col("z")).alias("entropy"), F.ln("n").alias("uniform"),
                       (F.col("most") / F.col("least")).alias("repeats")))
        if mixture.entropy is not None:
            ok = F.col("entropy") >= F.col("uniform") * F.lit(mixture.entropy) - F.lit(1e-12)
            best = per.where(ok).agg(F.max("i")).first()[0]
            best = 0 if best is None else best
            lo, hi = grid[best], grid[min(best + 1, SECTIONS)]
        else:
            ok = F.col("repeats") <= F.lit(float(mixture.max_repeats)) + F.lit(1e-9)
            best = per.where(ok).agg(F.min("i")).first()[0]
            best = SECTIONS if best is None else best
            lo, hi = grid[max(best - 1, 0)], grid[best]
    return lo if mixture.entropy is not None else hi


def weights(totals: DataFrame, exponent: float, budget_tokens: int | None) -> DataFrame:
    """Per source: share, weight, budget (tokens) and ``epochs`` (budget over tokens)."""
    raised = F.when(F.col("tokens") > 0, F.exp(F.lit(exponent) * F.ln("tokens"))).otherwise(0.0)
    # Weight = raised / z; the smallest budget that reads every source once is z * max(tokens / raised).
    all_tokens, z, least = totals.agg(F.sum("tokens"), F.sum(raised),
                                      F.max(F.try_divide(F.col("tokens"), raised))).first()
    budget = float(z or 0) * float(least or 0) if budget_tokens is None else float(budget_tokens)
    weight = raised / F.lit(float(z or 1) or 1.0)
    # Rounding absorbs floating error so that a source meant to be read once is read whole.
    return totals.select(
        "__source", "tokens", "rows", (F.col("tokens") / F.lit(float(all_tokens or 1))).alias("share"),
        weight.alias("weight"), (weight * budget).alias("budget"),
        F.when(F.col("tokens") > 0, F.round(weight * budget / F.col("tokens"), 9)).otherwise(1.0).alias("epochs"))


def _ordered_copies(rows: DataFrame, plan: DataFrame, mixture: Mixture, buckets: int) -> DataFrame:
    """One row per emitted copy: epoch, position (tokens before it in its epoch)."""
    dose = plan.select(F.col("__source").alias("__s"), "epochs", F.col("tokens").alias("__all"))
    copies = rows.join(dose, rows["__source"].eqNullSafe(dose["__s"])).drop("__s").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("epochs") - 1, F.lit(0)).cast("int"))))
    order = F.xxhash64(F.lit(mixture.seed), F.col("epoch"), F.col("__row"))
    copies = copies.withColumn("__order", order).withColumn(
        "__bucket", F.pmod(F.shiftrightunsigned("__order", 20), F.lit(buckets)).cast("int"))
    key = ["__source", "epoch", "__bucket"]
    sums = copies.groupBy(*key).agg(F.sum("__tokens").alias("t"))
    run = Window.partitionBy("__source", "epoch").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*[F.col(c).alias("k" + c) for c in key], F.coalesce(F.sum("t").over(run), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*key).orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.withColumn("__in", F.coalesce(F.sum("__tokens").over(inside), F.lit(0)))
    on = (placed["__source"].eqNullSafe(before["k__source"]) & (placed["epoch"] == before["kepoch"])
          & (placed["__bucket"] == before["k__bucket"]))
    placed = placed.join(before, on).withColumn("position", F.col("__before") + F.col("__in"))
    whole = F.col("epoch") + 1 <= F.col("epochs")
    left = F.round((F.col("epochs") - F.col("epoch")) * F.col("__all"))
    return (placed.where(whole | (F.col("position") + F.col("__tokens") <= left))
            .withColumn("block", F.floor(F.col("position") / F.lit(mixture.block_tokens)))
            .withColumn("block_key", F.xxhash64(F.lit(mixture.seed + 1), F.col("__source"), F.col("epoch"), F.col("block")))
            .drop("kepoch", "k__source", "k__bucket", "__before", "__in", "__bucket", "__order", "__all", "epochs"))


def _slim(docs: DataFrame) -> DataFrame:
    rows = pick(docs, doc_id="bigint", text="string", source="string")
    return rows.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), tokens(F.col("text")).alias("__tokens"),
                       row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("__row"))


def plan_mixture(slim: DataFrame, spark: SparkSession, mixture: Mixture) -> tuple[DataFrame, int]:
    totals = stored(source_totals(slim), spark, "sources")
    plan = stored(weights(totals, find_exponent(totals, spark, mixture), mixture.budget_tokens), spark, "mixture")
    rows = totals.agg(F.sum("rows")).first()[0] or 0
    return plan, max(1, -(-rows // ROWS_PER_BUCKET))


def mix_sources(docs: DataFrame, spark: SparkSession, mixture: Mixture = Mixture()) -> DataFrame:
    """One row per emitted copy: doc_id, source, tokens, weight, epoch, block, block_key,
    position."""
    prepare(spark)
    slim = stored(_slim(docs), spark, "mixing")
    plan, buckets = plan_mixture(slim, spark, mixture)
    out = _ordered_copies(slim, plan, mixture, buckets)
    w = plan.select(F.col("__source").alias("s"), "weight")
    return out.join(w, out["__source"].eqNullSafe(w["s"])).select(
        F.col("__id").alias("doc_id"), F.col("__source").alias("source"), F.col("__tokens").alias("tokens"), "weight",
        "epoch", "block", "block_key", "position")


def mix_documents(docs: DataFrame, spark: SparkSession, mixture: Mixture = Mixture()) -> DataFrame:
    """The mixed corpus: ``docs`` rows, each as often as the mixture reads it.  Copies are
    counted on the slim table and joined to the texts by row identity; repeated rows share
    their copies evenly."""
    prepare(spark)
    slim = stored(_slim(docs), spark, "mixing")
    plan, buckets = plan_mixture(slim, spark, mixture)
    counts = _ordered_copies(slim, plan, mixture, buckets).groupBy("__row").agg(F.count("*").alias("__n"))
    counts = counts.join(slim.groupBy("__row").agg(F.count("*").alias("__m")), "__row")
    own = docs.select(packed(docs), row_key(F.col("doc_id").cast("bigint"), F.col("source").cast("string"),
                                            F.col("text").cast("string")).alias("__row"))
    nth = F.row_number().over(Window.partitionBy("__row").orderBy("__row"))
    extra = (F.col("__nth") <= F.col("__n") % F.col("__m")).cast("int")
    own = own.join(counts, "__row").withColumn("__nth", nth)
    times = (F.floor(F.col("__n") / F.col("__m")) + extra).cast("int")
    return own.select("own", F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).select("own.*")
