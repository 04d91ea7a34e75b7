"""Methylation extracts: CpG pairs, non-CpG sites, bedMethyl, several samples, zoom levels."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, shapes
from .sites import with_neighbours


#: Genotypes that hold a C, and a G.
WITH_C, WITH_G = ([g for g, x in enumerate(codes.GENOTYPES) if b in x] for b in "CG")


def cpg_pairs(sites: DataFrame, inform: int = 1, het: bool = False) -> DataFrame:
    """JON-8, FLT-8: a C at p and a G at p + 1, with the informative reads of both strands; ``het`` takes calls with a C and a G beside another base too."""
    n = with_neighbours(sites, ("gt", "c4", "c6", "c5", "c7", "ref", "dp", "m2"))
    pair = n.where(F.col("gt").isin(WITH_C) & F.col("next_gt").isin(WITH_G) if het else (F.col("gt") == 4) & (F.col("next_gt") == 7))
    non_conv, conv = F.col("c5") + F.col("next_c6"), F.col("c7") + F.col("next_c4")
    mq = F.floor(F.sqrt((F.col("m2") + F.col("next_m2")) / (F.col("dp") + F.col("next_dp"))) + 0.5).cast("int")
    enough = (F.col("c5") + F.col("c7") >= inform) | (F.col("next_c6") + F.col("next_c4") >= inform)
    return pair.where(enough).select("tid", "p", non_conv.alias("non_conv"), conv.alias("conv"), F.when(non_conv + conv > 0, shapes.share_text(non_conv, non_conv + conv)).otherwise(".").alias("meth"), mq.alias("mq"))


def cpg_strands(sites: DataFrame) -> DataFrame:
    """Both strands of a CpG on rows of their own."""
    n = with_neighbours(sites, ("gt",))
    c = n.where((F.col("gt") == 4) & (F.col("next_gt") == 7)).select("tid", "p", F.lit("C").alias("strand"), F.col("c5").alias("non_conv"), F.col("c7").alias("conv"))
    g = n.where((F.col("gt") == 7) & (F.col("prev_gt") == 4)).select("tid", "p", F.lit("G").alias("strand"), F.col("c6").alias("non_conv"), F.col("c4").alias("conv"))
    return c.unionByName(g)


def noncpg(sites: DataFrame, min_nc: int = 1, min_inform: int = 1, exclude_cpg: bool = False) -> DataFrame:
    """FLT-9: cytosines of either strand with enough unconverted and informative reads."""
    n = with_neighbours(sites, ("gt",)) if exclude_cpg else sites
    c, g = F.col("gt") == 4, F.col("gt") == 7
    a, b = F.when(c, F.col("c5")).when(g, F.col("c6")), F.when(c, F.col("c7")).when(g, F.col("c4"))
    out = n.where(c | g)
    if exclude_cpg:
        out = out.where(~(c & F.coalesce(F.col("next_gt") == 7, F.lit(False)) | g & F.coalesce(F.col("prev_gt") == 4, F.lit(False))))
    return out.where((a >= min_nc) & (a + b >= min_inform)).select("tid", "p", "gt", a.alias("non_conv"), b.alias("conv"), codes.support(F.col("gt"), F.array(*[F.col(f"c{k}") for k in range(8)])).alias("support"), "dp")


def bed_methyl(sites: DataFrame) -> DataFrame:
    """PRJ-17..19 over (tid, p, gt, cx, c4..c7): strand, context class, score, colour, percent."""
    plus = F.col("gt") == 4
    cx = F.when(plus, F.col("cx")).otherwise(codes.reverse_complement(F.col("cx")))
    cov = F.when(plus, F.col("c5") + F.col("c7")).otherwise(F.col("c6") + F.col("c4"))
    m = F.when(plus, F.col("c5")).otherwise(F.col("c6")) / cov
    nxt, after = F.substring(cx, 4, 1), F.substring(cx, 5, 1)
    kind = F.when(nxt == "G", "CpG").when(after == "G", "CHG").otherwise("CHH")
    step = F.floor(m * 10 + 0.5).cast("int")
    rgb = F.concat_ws(",", F.least(F.lit(255), step * 51).cast("string"), F.least(F.lit(255), (10 - step) * 51).cast("string"), F.lit("0"))
    return sites.where(plus | (F.col("gt") == 7)).where(cov > 0).select("tid", "p", F.when(plus, "+").otherwise("-").alias("strand"), kind.alias("kind"), F.least(F.lit(1000), cov).alias("score"), rgb.alias("rgb"), cov.alias("coverage"), F.floor(m * 100).cast("int").alias("percent"))


def pass_distribution(probs: Column) -> Column:
    """AGG-13: distribution of the number of passing samples (Poisson-binomial), k = 0..n."""
    start = F.array(F.lit(1.0))

    def step(acc, p):
        longer = F.concat(acc, F.array(F.lit(0.0)))
        shifted = F.concat(F.array(F.lit(0.0)), acc)
        return F.zip_with(longer, shifted, lambda a, b: a * (F.lit(1.0) - p) + b * p)

    return F.aggregate(probs, start, step)


def at_least(probs: Column, n: int) -> Column:
    """Probability that n samples or more pass; 1 for n = 0."""
    if n <= 0:
        return F.lit(1.0)
    return F.lit(1.0) - F.aggregate(F.slice(pass_distribution(probs), 1, n), F.lit(0.0), lambda s, x: s + x)


def enough_samples(probs: Column, n: int, threshold: int) -> Column:
    """FLT-10: whether the quality of "n samples or more pass" reaches a threshold; n = 0 lets every record through."""
    return F.lit(True) if n <= 0 else codes.error_phred(F.round(F.lit(1.0) - at_least(probs, n), 9)) >= threshold


def pair_probability(first: Column, second: Column, het: bool = False) -> Column:
    """FLT-8: probability of a C then a G from two sites' natural log posteriors: both homozygous, or any genotype that holds the base."""
    if not het:
        return F.exp(first[4] + second[7])
    return sum((F.exp(first[g]) for g in WITH_C), F.lit(0.0)) * sum((F.exp(second[g]) for g in WITH_G), F.lit(0.0))


def common_genotype(lls: Column) -> Column:
    """AGG-15: first genotype of greatest summed log likelihood over samples (array of arrays of ten)."""
    total = F.aggregate(lls, F.array_repeat(F.lit(0.0), 10), lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    return (F.array_position(total, F.array_max(total)) - 1).cast("int")


def zoom_aligned(values: DataFrame, widths: tuple) -> DataFrame:
    """AGG-14, aligned spans: count, least, greatest, sum and sum of squares per level; one scan for all levels."""
    rows = values.withColumn("width", F.explode(F.array(*[F.lit(w).cast("bigint") for w in widths])))
    x = F.col("value")
    return rows.groupBy("tid", "width", F.floor(F.col("p") / F.col("width")).alias("span")).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"), F.sum(x).alias("total"), F.sum(x * x).alias("squares"))


def zoom_anchored(values: DataFrame, width: int) -> DataFrame:
    """AGG-14, WIN-7, exact spans: a span begins at the first value beyond the last one. Sequential per contig, streamed: one open span a task."""
    rows = values.select(F.col("tid").cast("bigint").alias("tid"), F.col("p").cast("bigint").alias("p"), F.col("value").cast("double").alias("value"))

    def run(batches: Iterator):
        import pandas as pd

        names = ["tid", "start", "n", "low", "high", "total", "squares"]
        span: list | None = None
        for pdf in batches:
            out = []
            for t, p, x in pdf.itertuples(index=False):
                if span is None or t != span[0] or p >= span[1] + width:
                    if span:
                        out.append(span)
                    span = [t, p, 0, x, x, 0.0, 0.0]
                span[2] += 1
                span[3], span[4] = min(span[3], x), max(span[4], x)
                span[5] += x
                span[6] += x * x
            yield pd.DataFrame(out, columns=names)
        if span:
            yield pd.DataFrame([span], columns=names)

    return rows.repartition("tid").sortWithinPartitions("tid", "p").mapInPandas(run, "tid bigint, start bigint, n bigint, low double, high double, total double, squares double")
