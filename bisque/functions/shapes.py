"""Small text and array forms: split alignments, durations, sizes, read groups, dense quality arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def split_alignments(sa: Column) -> Column:
    """PRJ-2: entries ``contig,pos,strand,cigar,mapq,nm;`` as structs; positions become 0-based."""
    entries = F.filter(F.split(sa, ";"), lambda x: x != "")

    def one(x):
        f = F.split(x, ",")
        lead = F.regexp_extract(f[3], r"^([0-9]+)[SH]", 1)
        tail = F.regexp_extract(f[3], r"([0-9]+)[SH]$", 1)
        clip = F.when(f[2] == "-", tail).otherwise(lead)
        return F.struct(F.when(clip == "", 0).otherwise(clip.cast("int")).alias("clip"), f[0].alias("contig"), (f[1].cast("bigint") - 1).alias("pos"), f[2].alias("strand"), f[3].alias("cigar"), f[4].cast("int").alias("mapq"))

    return F.transform(entries, one)


def in_read_order(parts: Column) -> Column:
    """PRJ-3: parts of a split read by the bases clipped before them, in the direction of the read."""
    return F.array_sort(parts)


def trimmed_span(start: Column, length: Column, left: Column, right: Column) -> Column:
    """PRJ-6: first and last reference position after overlap trimming, null if nothing is left."""
    lo, hi = start + left, start + length - 1 - right
    return F.when(lo <= hi, F.struct(lo.alias("lo"), hi.alias("hi")))


def expand_qualities(counts: Column, dense: Column, fallback: int) -> Column:
    """PRJ-20: a quality per channel from one per channel with reads; ``fallback`` where there is no array, 0 without reads."""
    rank = lambda i: F.size(F.filter(F.slice(counts, 1, i + 1), lambda c: c > 0))
    return F.transform(counts, lambda c, i: F.when(c <= 0, 0).otherwise(F.coalesce(F.try_element_at(dense, rank(i)), F.lit(fallback))))


def best_bearing(ll: Column, ref: Column) -> Column:
    """PRJ-21: the first best genotype that bears C or G; ties between a C and a G strand go by the reference base."""
    bearing = (1, 2, 4, 5, 6, 7, 8)
    masked = F.transform(ll, lambda x, i: F.when(i.isin(*bearing), x))
    best = F.array_position(masked, F.array_max(masked)) - 1
    return F.when(best.isin(1, 4, 6), "C").when(best.isin(2, 7, 8), "G").otherwise(F.when(ref == 2, "G").otherwise("C"))


#: By k, whether the double next to (2k + 1) / 2000 is written with three decimals as k / 1000 (1) or as (k + 1) / 1000 (0).
HALVES_DOWN = "".join(str(int(f"{(2 * k + 1) / 2000:.3f}" == f"{k / 1000:.3f}")) for k in range(1000))


def share_text(part: Column, total: Column) -> Column:
    """part / total with three decimals as C writes the double, for whole numbers 0 <= part <= total; null for a total of 0.

    Spark's ``format_string`` rounds the shortest decimal form upwards at a half; C rounds the double itself, and a double that is a half to the even digit.
    """
    part, total = part.cast("bigint"), F.nullif(total.cast("bigint"), F.lit(0).cast("bigint"))
    steps = F.call_function("div", part * 2000, total)
    low = F.call_function("div", steps, F.lit(2))
    half = (part * 2000 % total == 0) & (steps % 2 == 1)
    down = half & (F.substring(F.lit(HALVES_DOWN), low.cast("int") + 1, F.lit(1)) == "1")
    n = low + (steps % 2) - down.cast("bigint")
    return F.concat(F.when(n == 1000, "1.").otherwise("0."), F.lpad((n % 1000).cast("string"), 3, "0"))


def human_size(bases: Column) -> Column:
    """PRJ-31."""
    return (
        F.when(bases >= 1_000_000_000, F.format_string("%.2f Gb", bases / 1e9)).when(bases >= 1_000_000, F.format_string("%.2f Mb", bases / 1e6))
        .when(bases >= 1000, F.format_string("%.2f Kb", bases / 1e3)).otherwise(F.format_string("%d b", bases))
    )


def seconds_of(text: Column) -> Column:
    """PRJ-32: [d-]h:m:s, h:m, or seconds."""
    days = F.regexp_extract(text, r"^([0-9]+)-", 1)
    clock = F.split(F.regexp_replace(text, r"^[0-9]+-", ""), ":")
    n = F.size(clock)
    part = lambda i: F.coalesce(F.try_element_at(clock, F.lit(i)).cast("bigint"), F.lit(0))
    of = F.when(n == 1, part(1)).when(n == 2, part(1) * 3600 + part(2) * 60).otherwise(part(1) * 3600 + part(2) * 60 + part(3))
    return of + F.when(days == "", 0).otherwise(days.cast("bigint")) * 86400


def bytes_of(text: Column) -> Column:
    """PRJ-32: digits with k, m or g."""
    unit = F.lower(F.regexp_extract(text, r"([kKmMgG]?)$", 1))
    return F.regexp_extract(text, r"^([0-9]+)", 1).cast("bigint") * F.when(unit == "k", 1 << 10).when(unit == "m", 1 << 20).when(unit == "g", 1 << 30).otherwise(1)


def read_group(**fields: Column) -> Column:
    """PRJ-33: ID, SM, BC, PU, DS, LB, CN and PL where known."""
    order = ("ID", "SM", "BC", "PU", "DS", "LB", "CN", "PL")
    return F.concat_ws("\t", F.lit("@RG"), *[F.when(fields[k].isNotNull(), F.concat(F.lit(k + ":"), fields[k].cast("string"))) for k in order if k in fields])


def fill_template(template: Column, **values: Column) -> Column:
    """PRJ-30: @NAME in a template by values."""
    for k, v in values.items():
        template = F.replace(template, F.lit("@" + k.upper()), v)
    return template


def out_of_order(df: DataFrame, order: tuple) -> DataFrame:
    """WIN-6: rows, in the order they are given by ``order``, whose position is below the one before, per contig."""
    by = W.partitionBy("tid").orderBy(*order)
    return df.withColumn("before", F.lag("pos").over(by)).where(F.col("before") > F.col("pos"))
