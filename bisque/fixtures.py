"""Deterministic projections that turn the driver's star schema into alignments, observations and sites; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codes


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def reference_base(pos, tid):
    return ((pos * pos * 31 + pos * 17 + tid * 101) % 1009) % 4


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Alignments: tid, pos, rlen, mapq, bs strand, a flag code, and the line's key for ties."""
    return table(spark, d, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("tid"), ((F.col("l_partkey") * 997 + F.col("l_orderkey") * 31) % 200000).alias("pos"), (F.lit(20) + F.col("l_quantity")).cast("bigint").alias("rlen"),
        F.col("l_orderkey").alias("k1"), F.col("l_partkey").alias("k2"), F.col("l_suppkey").alias("k3"), F.col("l_linenumber").cast("bigint").alias("ln"), (F.col("l_partkey") % 61).alias("mapq"),
        ((F.col("l_orderkey") + F.col("l_partkey")) % 4).alias("bs"), ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 100).alias("fc"), F.col("l_quantity").cast("bigint").alias("qty"), F.col("l_shipdate").alias("sd"),
    )


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Ten bases of every read, with quality, strand and channel."""
    r = reads(spark, d).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("p", F.col("pos") + F.col("i"))
    r = r.withColumn("ref", reference_base(F.col("p"), F.col("tid")))
    b0 = F.when((F.col("k1") * 13 + F.col("k2") + F.col("i") * 7) % 10 < 8, F.col("ref")).otherwise((F.col("ref") + 1 + F.col("k3") % 3) % 4)
    r = r.withColumn("b0", b0).withColumn("q", 5 + (F.col("k1") + 7 * F.col("i")) % 40).withColumn("rev", F.col("ln") % 2)
    changed = (F.col("k1") + F.col("p")) % 3 != 0
    base = F.when((F.col("bs") == 1) & (F.col("b0") == 1) & changed, 3).when((F.col("bs") == 2) & (F.col("b0") == 2) & changed, 0).otherwise(F.col("b0"))
    return r.withColumn("base", base).withColumn("ch", codes.channel(F.col("base"), F.col("bs")))


READS = """reads as (select l_suppkey % 5 as tid, (l_partkey*997 + l_orderkey*31) % 200000 as pos, cast(20 + l_quantity as bigint) as rlen,
 l_orderkey as k1, l_partkey as k2, l_suppkey as k3, cast(l_linenumber as bigint) as ln, l_partkey % 61 as mapq, (l_orderkey + l_partkey) % 4 as bs,
 (l_orderkey*7 + l_partkey) % 100 as fc, cast(l_quantity as bigint) as qty, l_shipdate as sd from lineitem)"""
OBS = (
    READS
    + """,
o0 as (select r.*, i, pos + i as p from reads r, range(10) t(i)),
o1 as (select *, ((p*p*31 + p*17 + tid*101) % 1009) % 4 as ref from o0),
o2 as (select *, case when (k1*13 + k2 + i*7) % 10 < 8 then ref else (ref + 1 + k3 % 3) % 4 end as b0, 5 + (k1 + 7*i) % 40 as q, ln % 2 as rev from o1),
o3 as (select *, case when bs=1 and b0=1 and (k1+p) % 3 <> 0 then 3 when bs=2 and b0=2 and (k1+p) % 3 <> 0 then 0 else b0 end as base from o2),
obs as (select *, case when bs=1 then case base when 0 then 0 when 1 then 5 when 2 then 2 else 7 end
 when bs=2 then case base when 0 then 4 when 1 then 1 when 2 then 6 else 3 end else base end as ch from o3)"""
)
SITES = (
    OBS
    + ",\nsites as (select tid, p, min(ref) as ref, "
    + ", ".join(f"cast(sum(case when ch={k} then 1 else 0 end) as bigint) as c{k}, cast(sum(case when ch={k} then q else 0 end) as bigint) as q{k}" for k in range(8))
    + ", cast(sum(mapq*mapq) as bigint) as m2, count(*) as dp from obs where q >= 13 group by tid, p)"
)
SITES16 = (
    OBS
    + ",\nsites16 as (select tid, p, min(ref) as ref, "
    + ", ".join(f"cast(sum(case when ch={k} and rev={r} then 1 else 0 end) as bigint) as c{k + 8 * r}" for r in (0, 1) for k in range(8))
    + " from obs where q >= 13 group by tid, p)"
)
