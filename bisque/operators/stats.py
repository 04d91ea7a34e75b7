"""Statistics and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def count_if(c: Column) -> Column:
    return F.sum(F.coalesce(c, F.lit(False)).cast("bigint"))


def histogram(df: DataFrame, value: Column, **parts: Column) -> DataFrame:
    """AGG-5, 8, 9: rows by value, split by conditions."""
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"), *[count_if(c).alias(k) for k, c in parts.items()])


def filter_table(df: DataFrame) -> DataFrame:
    """Sites by each reason of their filter string, with the rows All and PASS even where they count none."""
    always = df.sparkSession.range(1).select(F.explode(F.array(F.lit("All"), F.lit("PASS"))).alias("reason"), F.lit(0).alias("one"))
    reason = F.concat(F.array(F.lit("All")), F.split("filter", ";"))
    return df.select(F.explode(reason).alias("reason"), F.lit(1).alias("one")).unionByName(always).groupBy("reason").agg(F.sum("one").alias("n"))


def contig_rollup(df: DataFrame) -> DataFrame:
    """AGG-6: counts per contig and in all (tid null)."""
    return df.rollup("tid").agg(F.count("*").alias("sites"), count_if(F.col("variant")).alias("variants"), count_if(F.col("passed")).alias("passed_sites"), count_if(F.col("variant") & F.col("passed")).alias("passed_variants"))


def mutation_spectrum(df: DataFrame) -> DataFrame:
    """AGG-7: mutation types of sites with exactly one other allele."""
    return df.where("mutation is not null").groupBy("mutation").agg(F.count("*").alias("n"), count_if(F.col("passed")).alias("n_passed"), count_if(F.col("known")).alias("n_known"), count_if(F.col("known") & F.col("passed")).alias("n_known_passed"))


TRANSITIONS = ("A>G", "G>A", "C>T", "T>C")


def ti_tv(spectrum: DataFrame) -> DataFrame:
    """AGG-21: transitions, transversions, their ratio (null without transversions)."""
    ti = F.sum(F.when(F.col("mutation").isin(*TRANSITIONS), F.col("n")).otherwise(0))
    tv = F.sum(F.when(F.col("mutation").isin(*TRANSITIONS), 0).otherwise(F.col("n")))
    return spectrum.agg(ti.alias("ti"), tv.alias("tv"), F.round(F.try_divide(ti, tv), 6).alias("ratio"))


def posterior_histogram(counts: DataFrame) -> DataFrame:
    """AGG-10 over (a, b): sum of normalised (i/100)^a (1-i/100)^b, i = 0..100. Equal (a, b) are grouped first, so the explosion is small."""
    g = counts.groupBy("a", "b").agg(F.count("*").alias("n"))
    # weights by logarithms, relative to the greatest: at depths of thousands the powers themselves are 0
    x = F.col("i") / 100.0
    power = lambda n, base: F.when(n == 0, 0.0).when(base > 0, n * F.ln(F.greatest(base, F.lit(1e-9)))).otherwise(float("-inf"))
    e = g.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(100)))).withColumn("l", power(F.col("a"), x) + power(F.col("b"), 1 - x))
    e = e.withColumn("w", F.exp(F.col("l") - F.max("l").over(W.partitionBy("a", "b"))))
    e = e.withColumn("share", F.col("w") / F.sum("w").over(W.partitionBy("a", "b")))
    return e.groupBy("i").agg(F.round(F.sum(F.col("share") * F.col("n")), 6).alias("mass"))


def cumulative(hist: DataFrame) -> DataFrame:
    """WIN-8 over (value, n): running and full totals; a histogram has one row a value, so its one partition is small."""
    by = W.orderBy("value")
    return hist.withColumn("cum", F.sum("n").over(by.rowsBetween(W.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(W.partitionBy()))


def quantile_cut(hist: DataFrame, percent: int = 99) -> DataFrame:
    """AGG-19: the least value at which the running total reaches a share of all."""
    return cumulative(hist).where(F.col("cum") * 100 >= F.col("total") * percent).agg(F.min("value").alias("cut"))


def median(hist: DataFrame) -> DataFrame:
    return cumulative(hist).where(F.col("cum") >= F.expr("total div 2")).agg(F.min("value").alias("median"))


def up_to_quantile(df: DataFrame, value: str, n: str, percent: int = 99) -> DataFrame:
    """The cells of a histogram up to the least integral value at which the running total reaches a share of all; one partition of cells."""
    below = F.coalesce(F.sum(n).over(W.orderBy(value).rangeBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("below__", below).withColumn("total__", F.sum(n).over(W.partitionBy())).where(F.col("below__") * 100 < F.col("total__") * percent).drop("below__", "total__")


def profile(mass: DataFrame) -> DataFrame:
    """AGG-22 over (i 0..100, mass): mass of the low, middle and high thirds (below 0.3, 0.7), and the median in steps of 0.01."""
    i = F.col("i")
    part = lambda c: F.round(F.sum(F.when(c, F.col("mass")).otherwise(0.0)), 3)
    run = mass.withColumn("cum", F.sum("mass").over(W.orderBy("i").rowsBetween(W.unboundedPreceding, 0))).withColumn("all", F.sum("mass").over(W.partitionBy()))
    half = F.min(F.when((F.col("all") > 0) & (F.col("cum") >= 0.5 * F.col("all")), i))
    return run.agg(part(i < 30).alias("low"), part((i >= 30) & (i < 70)).alias("middle"), part(i >= 70).alias("high"), F.round(half * 0.01, 2).alias("median"))


def weighted_pearson(df: DataFrame, x: str, y: str, n: str) -> DataFrame:
    """AGG-20: correlation of a histogram's cells, 0 if degenerate; the coverage cut is :func:`up_to_quantile`."""
    w, a, b = F.col(n).cast("double"), F.col(x).cast("double"), F.col(y).cast("double")
    s = df.agg(F.sum(w).alias("w"), F.sum(w * a).alias("a"), F.sum(w * b).alias("b"), F.sum(w * a * a).alias("aa"), F.sum(w * b * b).alias("bb"), F.sum(w * a * b).alias("ab"))
    va, vb = F.col("aa") * F.col("w") - F.col("a") * F.col("a"), F.col("bb") * F.col("w") - F.col("b") * F.col("b")
    return s.select(F.round(F.when((va > 0) & (vb > 0), (F.col("ab") * F.col("w") - F.col("a") * F.col("b")) / F.sqrt(va * vb)).otherwise(0.0), 6).alias("corr"))


def merge(parts: DataFrame) -> DataFrame:
    """AGG-16 over (part, hist map): key-wise sums of all parts' maps, the first included."""
    return parts.select(F.explode("hist").alias("value", "n")).groupBy("value").agg(F.sum("n").alias("n"))


def conversion_rate(c2t: dict[str, Column], g2a: dict[str, Column], least: int = 10_000) -> Column:
    """AGG-18: conversion of control bases, from counts of a, c, g, t on both strands; null below ``least`` bases or if either kind is missing.

    Bases that conversion leaves alone (A and G of one strand, C and T of the other) give the error rate z: an A or T there stands for
    a G or C. Of the others, z is taken from the converted ones and added to those that are not.
    """
    still = c2t["a"] + c2t["g"] + g2a["c"] + g2a["t"]
    open_ = c2t["c"] + c2t["t"] + g2a["a"] + g2a["g"]
    z = F.try_divide(c2t["a"] + g2a["t"], still)
    conv, unconv = c2t["t"] + g2a["a"], c2t["c"] + g2a["g"]
    return F.when((still + open_ >= least) & (still > 0) & (open_ > 0), F.try_divide(conv * (1 - z) - unconv * z, open_ * (1 - z)))


def conversion_limits(rate: Column) -> tuple[Column, Column]:
    """Under- and over-conversion from the rates of their controls; null where a rate is not to be believed, 0.001 at least."""
    return F.when(rate >= 0.9, F.greatest(1 - rate, F.lit(0.001))), F.when(rate <= 0.15, F.greatest(rate, F.lit(0.001)))


def unique_fragments(hist: DataFrame, threshold: int) -> DataFrame:
    """AGG-17."""
    return hist.agg(F.sum(F.when(F.col("value") >= threshold, F.col("n")).otherwise(0)).alias("unique_fragments"))


def level_table(df: DataFrame, key: str, n: str) -> DataFrame:
    """AGG-25: counts with total and percentage, 0 where the total is 0."""
    total = F.sum(n).over(W.partitionBy())
    return df.withColumn("total", total).withColumn("percent", F.when(total > 0, F.round(F.col(n) * 100.0 / total, 6)).otherwise(0.0)).select(key, n, "total", "percent")
