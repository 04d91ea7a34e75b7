"""Queries against their SQL where small tables agree by chance: no site passes, halves at the last digit, ties of likelihoods."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bisque import fixtures as fx
from bisque import queries as engine
from bisque.functions import shapes
from bisque.operators import extract, sites

from .test_queries import SF


def against_sql(spark, name, folder):
    import duckdb

    c = duckdb.connect()
    for f in folder.iterdir():
        c.execute(f"create view {f.stem} as select * from '{f}/*.parquet'")
    cur = c.execute(engine.ORACLES[name])
    cols = [x[0] for x in cur.description]
    want = sorted(cur.fetchall(), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in engine.QUERIES[name](spark, str(folder)).collect()), key=repr)
    return got, want


@pytest.mark.parametrize("rows", ["l_partkey % 61 < 20", "false"])
def test_filter_table_without_passing_sites(spark, tmp_path, rows):
    spark.read.parquet(f"{SF}/lineitem.parquet").where(rows).write.parquet(str(tmp_path / "lineitem.parquet"))
    got, want = against_sql(spark, "filter_table", tmp_path)
    assert ("PASS", 0) in want and got == want


def test_shares_as_c_writes_them(spark):
    n = [(a, b) for b in (*range(1, 260), 400, 1000, 1600, 2000, 16000) for a in range(b + 1)] + [(7, 10**15), (10**15 // 16, 10**15)]
    got = spark.createDataFrame(n, "a bigint, b bigint").select("a", "b", shapes.share_text(F.col("a"), F.col("b")).alias("s")).collect()
    assert [(r.a, r.b, r.s) for r in got if r.s != f"{r.a / r.b:.3f}"] == [] and len(got) == len(n)
    assert spark.range(1).select(shapes.share_text(F.lit(0), F.lit(0)).alias("s")).first().s is None


def test_cpg_meth_at_a_half(spark):
    pair = [(0, 5, 4, 5, 11, 0, 0), (0, 6, 7, 0, 0, 0, 0), (0, 8, 4, 3, 77, 0, 0), (0, 9, 7, 0, 0, 0, 0)]
    rows = spark.createDataFrame(pair, "tid bigint, p bigint, gt bigint, c5 bigint, c7 bigint, c4 bigint, c6 bigint").withColumns({"ref": F.lit(0), "dp": F.lit(16), "m2": F.lit(400)})
    assert {r.p: r.meth for r in extract.cpg_pairs(rows).collect()} == {5: "0.312", 8: "0.037"}


def test_baf_at_a_half(spark):
    rows = spark.createDataFrame([(1, 15, 1), (1, 11, 5), (1, 77, 3)], "gt int, c0 bigint, c1 bigint").withColumns({f"c{k}": F.lit(0) for k in range(2, 8)})
    assert [r.baf for r in sites.baf(rows).orderBy("c1", "c0").collect()] == ["0.062", "0.037", "0.312"]


#: (ref, counts, quality sums) of sites whose best genotypes tie but for the last bit, from six copies of the tables of sf0.1 with shifted keys.
TIED = [
    (0, [20, 3, 1, 3, 5, 0, 1, 0], [556, 102, 14, 103, 145, 0, 43, 0]),
    (1, [3, 11, 3, 2, 0, 1, 0, 2], [103, 290, 103, 83, 0, 25, 0, 53]),
    (2, [1, 2, 12, 2, 7, 0, 3, 0], [22, 68, 343, 68, 191, 0, 83, 0]),
    (2, [1, 3, 16, 3, 2, 0, 1, 0], [21, 101, 455, 102, 52, 0, 25, 0]),
    (0, [18, 2, 1, 2, 5, 0, 0, 0], [485, 68, 31, 67, 162, 0, 0, 0]),
    (0, [11, 2, 2, 2, 2, 0, 0, 0], [254, 67, 42, 68, 60, 0, 0, 0]),
    (1, [3, 18, 3, 1, 0, 1, 0, 6], [103, 497, 101, 26, 0, 26, 0, 169]),
    (2, [1, 2, 12, 2, 3, 0, 1, 0], [32, 67, 394, 67, 89, 0, 36, 0]),
    (3, [2, 1, 2, 14, 0, 0, 0, 9], [68, 21, 67, 461, 0, 0, 0, 236]),
]


@pytest.fixture
def tied_sites(spark, monkeypatch):
    """The tied sites, and random ones with few qualities, instead of the pileup; as a table for DuckDB."""
    rng = random.Random(7)
    given = list(TIED)
    for _ in range(4000):
        n, deep = [0] * 8, rng.choice((3, 9, 90))
        for k in rng.sample(range(8), rng.randint(1, 6)):
            n[k] = rng.choice((1, 2, deep))
        given.append((rng.randrange(4), n, [x * rng.choice((13, 27, 44)) for x in n]))
    names = ["tid", "p", "ref", *[f"c{k}" for k in range(8)], *[f"q{k}" for k in range(8)]]
    rows = [(0, i, ref, *n, *q) for i, (ref, n, q) in enumerate(given)]
    monkeypatch.setattr(engine, "_sites", lambda s, d: spark.createDataFrame(rows, ", ".join(f"{x} bigint" for x in names)))
    return pa.table(dict(zip(names, zip(*rows))))


def tied(spark, name, given):  # noqa: ARG001
    import duckdb

    cur = duckdb.sql(engine.ORACLES[name].replace(fx.SITES, "sites as (select * from given)"))
    got = sorted((tuple(r[c] for c in cur.columns) for r in engine.QUERIES[name](spark, "").collect()), key=repr)
    want = sorted(cur.fetchall(), key=repr)
    assert len(got) == len(want)
    return [x for x in zip(got, want) if x[0] != x[1]]


def test_likelihoods_to_the_last_bit(spark, tied_sites):
    assert tied(spark, "genotype_likelihood", tied_sites) == []


def test_estimates_to_the_last_bit(spark, tied_sites):
    assert tied(spark, "methylation_estimate", tied_sites) == []
