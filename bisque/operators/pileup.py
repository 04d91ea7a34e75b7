"""Pileup: grouped aggregation of observed bases by position, and what is made of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def pileup(obs: DataFrame, bq_threshold: int = 13, by: tuple = ("tid", "p")) -> DataFrame:
    """AGG-1: counts and quality sums of the eight channels, and the sum of squared MAPQ, per position.

    One partial and one final hash aggregate; only (position, 18 numbers) is shuffled.
    """
    good = obs.where(F.col("q") >= bq_threshold)
    sums = []
    for k in range(8):
        hit = F.col("ch") == k
        sums += [F.sum(hit.cast("bigint")).alias(f"c{k}"), F.sum(F.when(hit, F.col("q")).otherwise(0)).alias(f"q{k}")]
    return good.groupBy(*by).agg(F.min("ref").alias("ref"), *sums, F.sum(F.col("mapq") * F.col("mapq")).alias("m2"), F.count("*").alias("dp"))


def pileup_stranded(obs: DataFrame, bq_threshold: int = 13) -> DataFrame:
    """AGG-1 with strands apart: channel k of the reverse strand is c(k + 8)."""
    good = obs.where(F.col("q") >= bq_threshold)
    cell = F.col("ch") + 8 * F.col("rev")
    return good.groupBy("tid", "p").agg(F.min("ref").alias("ref"), *[F.sum((cell == k).cast("bigint")).alias(f"c{k}") for k in range(16)])


def fold_strands(sites16: DataFrame) -> DataFrame:
    """AGG-2: eight counts from sixteen, and the depth."""
    folded = [(F.col(f"c{k}") + F.col(f"c{k + 8}")).alias(f"c{k}") for k in range(8)]
    depth = sum((F.col(f"c{k}") for k in range(16)), F.lit(0))
    return sites16.select("tid", "p", "ref", *folded, depth.alias("dp"))


def mean_quality(k: int) -> Column:
    """PRJ-13: mean base quality of a channel, at most 63, 0 without reads."""
    n = F.col(f"c{k}")
    return F.when(n > 0, F.least(F.lit(63), F.round(F.col(f"q{k}") / n).cast("int"))).otherwise(0)


def rms_mapq() -> Column:
    return F.least(F.lit(255), F.round(F.sqrt(F.col("m2") / F.col("dp"))).cast("int"))


def gc_bins(ref: DataFrame, width: int = 100) -> DataFrame:
    """AGG-12: G and C per window; 255 unless every base of the window is known."""
    g = ref.groupBy("tid", F.floor(F.col("p") / width).alias("bin")).agg(F.count("*").alias("n"), F.sum(F.col("ref").isin(1, 2).cast("bigint")).alias("gc"))
    return g.select("tid", "bin", F.when(F.col("n") == width, F.col("gc")).otherwise(255).alias("gc"))


def counts_array() -> Column:
    return F.array(*[F.col(f"c{k}") for k in range(8)])


def site_summary(sites: DataFrame) -> DataFrame:
    """Depth, mean qualities and RMS MAPQ of a site."""
    return sites.select("tid", "p", "ref", "dp", rms_mapq().alias("mq"), *[mean_quality(k).alias(f"bq{k}") for k in range(8)], F.substring(F.lit("ACGT"), F.col("ref").cast("int") + 1, F.lit(1)).alias("ref_base"))
