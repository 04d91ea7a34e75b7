"""Formulas against values worked out independently, and invariants."""

import itertools
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from bisque.functions import codes
from bisque.operators import extract, intervals, model, pileup, reads, sites, stats
from bisque.plans import dag
from bisque.sources import dbsnp, text
from bisque.streaming import islands


def site(**k):
    base = {"tid": 0, "p": 1, "ref": 0, "dp": 1, "m2": 400} | {f"c{i}": 0 for i in range(8)} | {f"q{i}": 0 for i in range(8)}
    return Row(**(base | k))


def test_likelihoods_sum_to_one(spark):
    rows = [site(p=i, ref=i % 4, **{f"c{i % 8}": 3, f"q{i % 8}": 90, f"c{(i * 3 + 1) % 8}": 2, f"q{(i * 3 + 1) % 8}": 50}) for i in range(40)]
    for r in model.likelihoods(spark.createDataFrame(rows)).select("ll").collect():
        assert abs(sum(10**x for x in r.ll) - 1) < 1e-9


def test_likelihood_worked_example(spark):
    # ten plain A reads of quality 30, reference A, no methylation evidence
    r = model.likelihoods(spark.createDataFrame([site(c0=10, q0=300)]), log10=False).first()
    e = 1e-3
    k = e / (3 - 4 * e)
    x, h, w = 10 * math.log(1 + k), 10 * math.log(0.5 + k), 10 * math.log(k)
    raw = [x + math.log(2), *[h + math.log(1.5)] * 3, *[w] * 6]
    top = max(raw)
    norm = top + math.log(sum(math.exp(v - top) for v in raw))
    assert r.max_gt == 0
    assert r.ll == pytest.approx([v - norm for v in raw], abs=1e-9)


def fisher(a, b, c, d):
    n, r, k = a + b + c + d, a + b, a + c
    p = lambda x: math.comb(r, x) * math.comb(n - r, k - x) / math.comb(n, k)
    lo, hi = max(0, k - (n - r)), min(r, k)
    delta = a - r * k / n
    if delta > 0:
        far = a - math.ceil(2 * delta)
        total = sum(p(x) for x in range(a, hi + 1)) + sum(p(x) for x in range(lo, far + 1))
    else:
        far = a + max(math.ceil(-2 * delta), 1)
        total = sum(p(x) for x in range(lo, a + 1)) + sum(p(x) for x in range(far, hi + 1))
    return math.log10(max(min(total, 1), 1e-20))


def test_fisher_against_enumeration(spark):
    tables = [t for t in itertools.product(range(5), repeat=4) if sum(t)] + [(20, 3, 5, 18), (0, 30, 30, 0)]
    df = spark.createDataFrame([(i, list(t)) for i, t in enumerate(tables)], "i int, t array<bigint>")
    got = {r.i: r.v for r in df.select("i", model.fisher_log10(F.col("t")).alias("v")).collect()}
    for i, t in enumerate(tables):
        assert got[i] == pytest.approx(fisher(*t), abs=1e-6), t


def test_poisson_binomial(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.9],)], "p array<double>")
    r = df.select(extract.pass_distribution(F.col("p")).alias("d"), extract.at_least(F.col("p"), 2).alias("two"), extract.at_least(F.col("p"), 0).alias("none")).first()
    assert sum(r.d) == pytest.approx(1)
    assert r.two == pytest.approx(0.2 * 0.5 * 0.1 + 0.2 * 0.5 * 0.9 + 0.8 * 0.5 * 0.9 + 0.2 * 0.5 * 0.9)
    assert r.none == 1


def test_lookup_rules(spark):
    df = spark.range(40).select((F.col("id") / 4).cast("int").alias("g"), (F.col("id") % 4).cast("int").alias("r"))
    for r in df.select("g", "r", codes.alt(F.col("g"), F.col("r")).alias("alt"), codes.gt(F.col("g"), F.col("r")).alias("gt")).collect():
        g, ref = codes.GENOTYPES[r.g], codes.BASES[r.r]
        alt = sorted({*g} - {ref})
        assert r.alt == (",".join(alt) or ".")
        assert r.gt == ("0/0" if not alt else "1/1" if g[0] == g[1] else "0/1" if ref in g else "1/2")


def test_halo_windows(spark):
    at = [sites.TILE - 1, sites.TILE, sites.TILE + 1, 5]
    df = spark.createDataFrame([(0, p, i) for i, p in enumerate(at)], "tid int, p bigint, gt int")
    got = {r.p: (r.prev_gt, r.next_gt) for r in sites.with_neighbours(df, ("gt",)).collect()}
    assert got == {sites.TILE - 1: (None, 1), sites.TILE: (0, 2), sites.TILE + 1: (1, None), 5: (None, None)}


def test_overlaps_match_nested_loops(spark):
    b = [(0, i, i * 700, i * 700 + 650) for i in range(30)]
    r = [(0, k, k * 1111 - 40, k * 1111 + 1500) for k in range(1, 15)]
    got = intervals.overlaps(spark.createDataFrame(b, "tid int, block_id int, start bigint, stop bigint"), spark.createDataFrame(r, "tid int, region_id int, start bigint, stop bigint"))
    want = {(x[1], y[1], min(x[3], y[3]) - max(x[2], y[2]) + 1) for x in b for y in r if x[2] <= y[3] and x[3] >= y[2]}
    rows = [(x.block_id, x.region_id, x.overlap) for x in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_pools():
    got = dag.pool_contigs([("a", 30), ("b", 9), ("c", 8), ("d", 7), ("e", 1)], 25)
    assert got["a"] == "a" and len(set(got.values())) == 2
    got = dag.pool_contigs([(str(i), 10 + i) for i in range(10)], 25)
    load = {}
    for i in range(10):
        load[got[str(i)]] = load.get(got[str(i)], 0) + 10 + i
    assert len(load) == 6 and max(load.values()) <= 2 * 25


def test_config():
    c = dag.read_config('base = /x # note\n[mapping]\nout = "${base}/m"\nidx=${default:base}/i\n')
    assert c["mapping"] == {"out": "/x/m", "idx": "/x/i"}
    with pytest.raises(ValueError):
        dag.read_config("a=${b}\nb=${a}\n")


def test_sources(spark):
    sam = spark.createDataFrame([("@SQ\tSN:c1\tLN:9\tUR:u",), ("r 1@\t16\tc1\t5\t60\t4M\t=\t1\t0\tACGN\tII!~\tXG:Z:GA\tNM:i:1",)], "value string")
    h = text.sam_header(sam).first()
    assert (h.name, h.len, h.tags["UR"]) == ("c1", 9, "u")
    r = text.sam_records(sam).select("*", reads.strand_from_tags(F.col("tags")).alias("strand"), text.clean_names(F.col("qname")).alias("q"), text.sequence_qualities(F.col("seq"), F.col("qual")).alias("sq")).first()
    assert (r.pos, r.reverse, r.strand, r.q) == (4, True, "G2A", "r_1_")
    assert [tuple(x) for x in r.sq] == [(0, 40), (1, 40), (2, 0), (0, 0)]
    bad = text.bed_regions(spark.createDataFrame([("c1\t5\t5",)], "value string"), spark.createDataFrame([("c1", 10)], "name string, len bigint"))
    with pytest.raises(Exception, match="bad region"):
        bad.collect()
    assert "##contig=<ID=c1,length=9,md5=x>" in text.vcf_header([("c1", 9, "x", None, None)], "s")


def test_metadata(spark):
    m = dbsnp.normalise_metadata(spark.createDataFrame([("b", "d", 1)], "SampleBarcode string, Dataset string, junk int"))
    assert m.columns == ["barcode", "dataset"] and dbsnp.conflicts(m).isEmpty()
    with pytest.raises(ValueError):
        dbsnp.normalise_metadata(spark.createDataFrame([("b", "d")], "sample string, barcode string"))


def test_zoom_anchored(spark):
    df = spark.createDataFrame([(0, p, float(p)) for p in (3, 5, 12, 13, 40)] + [(1, 0, 1.0)], "tid int, p int, value double")
    got = sorted((r.tid, r.start, r.n, r.low, r.high, r.total) for r in extract.zoom_anchored(df, 10).collect())
    assert got == [(0, 3, 2 + 1, 3.0, 12.0, 20.0), (0, 13, 1, 13.0, 13.0, 13.0), (0, 40, 1, 40.0, 40.0, 40.0), (1, 0, 1, 1.0, 1.0, 1.0)]


def test_row_order_does_not_matter(spark):
    rows = [(0, p, ch, 0, 20 + ch, 30, 0) for p in range(20) for ch in range(p % 8)]
    df = spark.createDataFrame(rows, "tid int, p int, ch int, ref int, q int, mapq int, rev int")
    a = pileup.pileup(df).orderBy("p").collect()
    assert a == pileup.pileup(df.orderBy(F.col("q").desc(), F.col("p").desc())).orderBy("p").collect()


def test_empty_frames(spark):
    obs = spark.createDataFrame([], "tid int, p int, ch int, ref int, q int, mapq int, rev int")
    assert pileup.pileup(obs).isEmpty()
    assert stats.median(spark.createDataFrame([], "value int, n bigint")).first()["median"] is None


def test_streaming_islands(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "2024-01-01 00:00:00", "x", 1.0), (1, "2024-01-01 00:10:00", "x", 1.0), (1, "2024-01-01 02:00:00", "x", 1.0), (2, "2024-01-02 00:00:00", "x", 1.0)], "user_id bigint, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts")).write.parquet(src)
    stream = islands.sessions(spark.readStream.schema(spark.read.parquet(src).schema).parquet(src))
    q = stream.writeStream.format("memory").queryName("islands").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.user_id, r.n) for r in spark.sql("select * from islands").collect())
    assert got == [(1, 1), (1, 2)]  # user 2's session is still open at the watermark


def test_posterior_of_deep_sites(spark):
    """Depths at which the powers are 0: mass 1 a site, greatest at the share of unconverted reads."""
    rows = [(600, 600), (100_000, 0), (0, 100_000), (30_000, 70_000), (0, 0)]
    for a, b in rows:
        hist = {r.i: r.mass for r in stats.posterior_histogram(spark.createDataFrame([(a, b)], "a long, b long")).collect()}
        assert abs(sum(hist.values()) - 1) < 1e-4
        assert not a + b or hist[round(100 * a / (a + b))] == max(hist.values())


def test_conversion_rate(spark):
    """The control's error rate comes from the bases that conversion leaves alone."""
    one = spark.createDataFrame([(40, 100, 9960, 9900, 9900, 9960, 100, 40), (0, 0, 10, 10, 0, 0, 0, 0), (0, 0, 0, 90_000, 0, 0, 0, 0)], "a1 long, c1 long, g1 long, t1 long, a2 long, c2 long, g2 long, t2 long")
    rate = stats.conversion_rate(*[{x: F.col(f"{x}{k}") for x in "acgt"} for k in (1, 2)])
    under, over = stats.conversion_limits(rate)
    got = one.select(rate.alias("r"), under.alias("u"), over.alias("o")).collect()
    z = 80 / 20_000
    want = (19_800 * (1 - z) - 200 * z) / (20_000 * (1 - z))
    assert abs(got[0].r - want) < 1e-12 and abs(got[0].u - (1 - want)) < 1e-12 and got[0].o is None
    assert got[1].r is None and got[2].r is None


def test_required_refuses_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("x", "y"), ("y", "x")], "task string, needs string")
    of = lambda t: dag.required(spark, edges, spark.createDataFrame([(t,)], "task string"))
    assert {r.task: r.depth for r in of("a").collect()} == {"a": 0, "b": 1, "c": 1, "d": 2}
    with pytest.raises(ValueError):
        of("x")


def test_fasta_contigs(spark, tmp_path):
    f = tmp_path / "r.fa"
    f.write_text(">c1 first > contig\nACGT\nAC\n>c2\nnnA\n>c3\n")
    got = [tuple(x) for x in text.fasta_contigs(spark, str(f), tile=4).orderBy("name", "no").collect()]
    assert got == [("c1", 6, 0, "ACGT"), ("c1", 6, 1, "AC"), ("c2", 3, 0, "nnA"), ("c3", 0, 0, "")]


def test_header_regions_are_checked(spark):
    header, kind = spark.createDataFrame([("a", 9), ("b", 5)], "name string, len bigint"), "name string, len bigint"
    for reference, why in (([("a", 9)], "not in the reference: b"), ([("a", 9), ("b", 6)], "lengths differ: b")):
        with pytest.raises(Exception, match=why):
            text.header_regions(header, spark.createDataFrame(reference, kind)).collect()


def test_likelihood_vector(spark):
    ll = [-float(k) for k in range(9)] + [-200.0]
    rows = [(ll, 4, 1), (ll, 1, 0), (ll, 6, 0), (ll, 9, 3), (ll, 4, None)]
    got = [list(x[0]) for x in spark.createDataFrame(rows, "ll array<double>, gt int, ref int").select(codes.likelihood_vector(F.col("ll"), F.col("gt"), F.col("ref"))).collect()]
    assert got == [[-4.0], [0.0, -1.0, -4.0], [0.0, -1.0, -4.0, -3.0, -6.0, -99.999], [-99.999], [-99.999, -99.999, -4.0]]


def test_pair_probability_and_phred(spark):
    p, q = [0.1, 0.2, 0.0, 0.0, 0.7, 0.0, 0.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.6, 0.3, 0.1]
    logs = lambda v: [math.log(x) if x else -1e9 for x in v]
    a, b = F.col("a"), F.col("b")
    r = spark.createDataFrame([(logs(p), logs(q))], "a array<double>, b array<double>").select(extract.pair_probability(a, b), extract.pair_probability(a, b, het=True)).first()
    assert (round(r[0], 9), round(r[1], 9)) == (0.42, 0.81)
    got = spark.createDataFrame([(0.0,), (-1.0,), (1.0,), (2.0,), (0.05,), (1e-30,)], "z double").select(codes.error_phred(F.col("z")))
    assert [x[0] for x in got.collect()] == [255, 255, 0, 0, 13, 255]


def test_lims_names(spark):
    doc = '{"objects":[{"flowcell_name":"F","lane_number":2,"passfail":"pass"}]}'
    with pytest.raises(Exception, match="without flowcell"):
        dbsnp.lims_datasets(spark.createDataFrame([(doc,)], "value string")).collect()


@pytest.mark.parametrize("tile_bits", [3, 6, 20])
def test_islands_over_tiles(spark, monkeypatch, tile_bits):
    """Blocks by a walk along each contig, with reads longer than many tiles, empty tiles, a contig of null and repeated rows."""
    monkeypatch.setattr(reads, "TILE_BITS", tile_bits)
    rng = random.Random(tile_bits)
    rows = [(rng.choice([1, 2, None]), rng.randrange(3000), i, 0, 0, 0, 0, 0, rng.choice([0, 3, 5, 9, 200])) for i in range(160)] + [(2, 40, 1, 0, 0, 0, 0, 0, 5)] * 3
    df = spark.createDataFrame(rows, "tid int, pos int, k1 int, k2 int, k3 int, ln int, qty int, sd int, rlen int")
    want, state = [], {}
    for r in sorted(rows, key=lambda r: (str(r[0]), *r[1:8])):
        end, no = state.get(r[0], (None, 0))
        no += end is None or r[1] > end + 2
        state[r[0]] = (r[1] + r[8] if end is None else max(end, r[1] + r[8]), no)
        want.append((r[0], r[1], r[2], no))
    got = reads.coverage_islands(df)
    assert got.columns == [*df.columns, "block_id"]
    assert sorted(((r.tid, r.pos, r.k1, r.block_id) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert len({(w[0], w[3]) for w in want}) > 20
    assert reads.coverage_islands(df.limit(0)).isEmpty()
