"""Registered queries take the whole of their input: against their SQL without its cut, on the smallest tables."""

import pytest

from pyspark.sql import functions as F

from bisque import queries as engine
from bisque.operators import sites

from .test_queries import SF, duck, plain  # noqa: F401


def same_rows(spark, duck, name, cut, whole):  # noqa: F811
    sql = engine.ORACLES[name]
    cur = duck.execute(sql.replace(cut, whole))
    cols = [x[0] for x in cur.description]
    want = sorted((tuple(plain(v) for v in r) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in engine.QUERIES[name](spark, SF).collect()), key=repr)
    assert got == want
    return len(got)


@pytest.mark.parametrize(("name", "cut"), [("genotype_likelihood", " where p % 3 = 0"), ("genotype_haploid", " where p % 3 = 0"), ("vcf_roundtrip", " where p % 5 = 0"), ("expand_qualities", " where p % 7 = 0")])
def test_every_site(spark, duck, name, cut):  # noqa: F811
    assert same_rows(spark, duck, name, cut, "") == engine.QUERIES["pileup_counts"](spark, SF).count()


@pytest.mark.parametrize(("name", "cut", "rows"), [("ref_context", "range(20000)", 5 * 200010), ("fasta_md5", "range(2000)", 5)])
def test_whole_reference(spark, duck, name, cut, rows):  # noqa: F811
    assert same_rows(spark, duck, name, cut, "range(200010)") == rows


def test_mac1(spark):
    """Every heterozygote with one read for an allele, by the allele groups of the survey, 2.13c."""
    groups = {1: ((0, 4), (1, 5, 7)), 2: ((0,), (2, 6)), 3: ((0, 4), (3, 7)), 5: ((1, 5, 7), (2, 4, 6)), 6: ((1, 5), (3,)), 8: ((2, 4, 6), (3, 7))}
    rows = [(g, k, n, q) for g in range(10) for k in range(8) for n in (1, 2) for q in (19, 60)]
    for g, k, n, q, f in (
        spark.createDataFrame(rows, "gt int, k int, n int, phred int")
        .select("*", F.lit(10).alias("dp"), F.lit(0).alias("fs"), F.lit(60).alias("mq"), *[F.when(F.col("k") == c, F.col("n")).otherwise(2 if c in (0, 1, 2, 3) else 0).alias(f"c{c}") for c in range(8)])
        .transform(sites.site_filters).select("gt", "k", "n", "phred", "filter").collect()
    ):
        c = [2, 2, 2, 2, 0, 0, 0, 0]
        c[k] = n
        few = g in groups and any(sum(c[i] for i in x) <= 1 for x in groups[g])
        assert f == ("q20;qd2" if q < 20 else "mac1" if few else "PASS"), (g, k, n)


def test_mac1_in_the_queries(spark):
    rows = engine.QUERIES["filter_table"](spark, SF).collect()
    n = {r.reason: r.n for r in rows}
    assert n["mac1"] == engine.QUERIES["site_filters"](spark, SF).where("filter = 'mac1'").count() > 0
    assert n["PASS"] == engine.QUERIES["contig_stats_rollup"](spark, SF).where("tid is null").first().passed_sites
