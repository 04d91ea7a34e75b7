"""Queries of the engine over fixture projections of the driver's tables, with SQL that gives the same rows.

Doubles are rounded in both, since the engines' logarithms differ in the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import codes, shapes
from .operators import extract, intervals, model, pileup, reads, sites, stats
from .plans import dag
from .sources import dbsnp, text
from .streaming import islands

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def _sites(s: SparkSession, d: str) -> DataFrame:
    return pileup.pileup(fx.observations(s, d))


def _round5(x):
    """Five decimals as the SQL rounds: away from zero at a half of the product, not of the shortest decimal form."""
    return F.round(x * 1e5) / 1e5


C8 = ", ".join(f"c{k}" for k in range(8))
Q8 = ", ".join(f"q{k}" for k in range(8))

# ---- pileup


@query("pileup_counts", f"with {fx.SITES} select tid, p, ref, {C8}, {Q8}, m2, dp from sites")
def pileup_counts(s, d):
    return _sites(s, d)


@query(
    "pileup_site_filter",
    f"""with {fx.SITES} select tid, p, ref, substr('ACGT', cast(ref as int) + 1, 1) as ref_base, dp, cast(least(255, round(sqrt(m2 / dp::double))) as bigint) as mq,
    {", ".join(f"cast(case when c{k} > 0 then least(63, round(q{k} / c{k}::double)) else 0 end as bigint) as bq{k}" for k in range(8))}
    from sites where dp >= 2 and least(255, round(sqrt(m2 / dp::double))) >= 20""",
)
def pileup_site_filter(s, d):
    out = pileup.site_summary(_sites(s, d)).where("dp >= 2 and mq >= 20")
    return out.select("tid", "p", "ref", "ref_base", "dp", *[F.col(c).cast("bigint").alias(c) for c in ("mq", *[f"bq{k}" for k in range(8)])])


@query("fold_strands", f"with {fx.SITES16} select tid, p, ref, " + ", ".join(f"c{k} + c{k + 8} as c{k}" for k in range(8)) + ", " + " + ".join(f"c{k}" for k in range(16)) + " as dp from sites16")
def fold_strands(s, d):
    return pileup.fold_strands(pileup.pileup_stranded(fx.observations(s, d)))


REF = "ref as (select tid, p, ((p*p*31 + p*17 + tid*101) % 1009) % 4 as ref from range(5) a(tid), range({n}) b(p))"


def _ref(s, n=200010):
    return s.range(5 * n).select((F.col("id") % 5).alias("tid"), F.expr("id div 5").alias("p")).withColumn("ref", fx.reference_base(F.col("p"), F.col("tid")))


@query("gc_bins", f"with {REF.format(n=200010)} select tid, p // 100 as bin, cast(case when count(*) = 100 then sum(case when ref in (1, 2) then 1 else 0 end) else 255 end as bigint) as gc from ref group by all")
def gc_bins(s, d):
    return pileup.gc_bins(_ref(s))


@query(
    "ref_context",
    f"with {REF.format(n=200010)}, b as (select tid, p, substr('ACGT', cast(ref as int) + 1, 1) as base from ref) select tid, p, "
    + " || ".join(f"coalesce({f}(base, {k}) over w, 'N')" if k else "base" for f, k in (("lag", 2), ("lag", 1), ("", 0), ("lead", 1), ("lead", 2)))
    + " as cx from b window w as (partition by tid order by p)",
)
def ref_context(s, d):
    r = _ref(s).withColumn("base", F.substring(F.lit("ACGT"), F.col("ref").cast("int") + 1, F.lit(1)))
    return sites.context(r, "base", "cx")


# ---- reads

def _flags() -> dict:
    return {
        "unmapped": F.col("fc") <= 2, "qcfail": F.col("fc") == 3, "secondary": F.col("fc").between(4, 5), "dup": F.col("fc").between(6, 9), "supplementary": F.col("fc").between(10, 11),
        "no_pos": F.lit(False), "mate_unmapped": F.col("fc") == 12, "no_mate_pos": F.col("fc") == 13, "mate_other": F.col("fc") == 14, "large_insert": F.col("fc").between(15, 16),
    }
REASON = """case when fc <= 2 then 'Unmapped' when fc = 3 then 'QCFlags' when fc in (4, 5) then 'SecondaryAlignment' when fc between 6 and 9 then 'Duplicate' when mapq < 20 then 'LowMAPQ'
 when fc in (10, 11) then 'SupplementaryAlignment' when fc = 12 then 'MateUnmapped' when fc = 13 then 'NoMatePosition' when fc = 14 then 'MismatchContig' when fc in (15, 16) then 'LargeInsertSize' else 'Passed' end"""


@query("read_filter_cascade", f"with {fx.READS} select {REASON} as reason, count(*) as reads, cast(sum(rlen) as bigint) as bases from reads group by 1")
def read_filter_cascade(s, d):
    return reads.filter_stats(fx.reads(s, d).withColumns(_flags()).withColumn("reason", reads.reason()))


@query(
    "read_base_stats",
    f"with {fx.OBS} select case when c < 1 or c >= 8 then 'Trimmed' when q < 13 then 'LowQuality' else 'Passed' end as fate, count(*) as bases from (select *, case when rev = 1 then 9 - i else i end as c from obs) group by 1",
)
def read_base_stats(s, d):
    return reads.base_stats(fx.observations(s, d), 1, 2, 13, 10)


ORD = "pos, k1, k2, k3, ln, qty, sd"
BLOCKS = f"""{fx.READS}, fl as (select *, case when pos > coalesce(max(pos + rlen) over (partition by tid order by {ORD} rows between unbounded preceding and 1 preceding), -1000) + 2 then 1 else 0 end as new from reads),
blocks as (select *, cast(sum(new) over (partition by tid order by {ORD} rows unbounded preceding) as bigint) as block_id from fl)"""


@query("coverage_islands", f"with {BLOCKS} select tid, block_id, min(pos) as start, max(pos + rlen) as stop, count(*) as reads from blocks group by tid, block_id")
def coverage_islands(s, d):
    return reads.island_table(fx.reads(s, d))


@query(
    "dedup_reads",
    f"""with {fx.READS}, m as (select * replace (pos // 50 * 50 as pos, rlen // 25 as rlen), case when fc = 13 then null else fc % 3 end as mate_pos from reads), x as (select *,
    count(*) over w as n_before, coalesce(max(case when mate_pos is null then 1 else 0 end) over w, 0) as wild, row_number() over (partition by tid, pos, bs, rlen, mate_pos order by {ORD}) as no
    from m window w as (partition by tid, pos, bs, rlen order by {ORD} rows between unbounded preceding and 1 preceding))
    select tid, case when mate_pos is null then n_before > 0 else no > 1 or wild > 0 end as duplicate, count(*) as n, cast(sum(k1) as bigint) as keys from x group by 1, 2""",
)
def dedup_reads(s, d):
    m = fx.reads(s, d).withColumns({"pos": F.expr("pos div 50 * 50"), "rlen": F.expr("rlen div 25"), "mate_pos": F.when(F.col("fc") != 13, F.col("fc") % 3)})
    return reads.dedup(m).groupBy("tid", "duplicate").agg(F.count("*").alias("n"), F.sum("k1").alias("keys"))


@query(
    "mate_pairs_overlap_trim",
    f"""with {BLOCKS}, n as (select *, row_number() over w as no, lead(pos) over w as pos2, lead(rlen) over w as rlen2, lead(ln) over w as ln2 from blocks window w as (partition by tid, block_id, k1 order by {ORD})),
    e as (select *, pos + rlen - 1 as e1, pos2 + rlen2 - 1 as e2, ln % 2 = 1 as r1, ln2 % 2 = 1 as r2 from n where no = 1 and pos2 is not null),
    c as (select *, greatest(e1, e2) - least(pos, pos2) + 1 as template, case when r1 = r2 then 'BadOrientation' when greatest(e1, e2) - least(pos, pos2) + 1 >= 1000 then 'LargeInsertSize' when r1 and pos2 > e1 then 'BadOrientation' else 'Passed' end as "check" from e)
    select tid, block_id, k1, pos, pos2, rlen, rlen2, template, "check", cast(case when "check" = 'Passed' and r1 and pos2 > pos then pos2 - pos else 0 end as bigint) as clip1_start,
    cast(case when "check" = 'Passed' and not r1 and e1 >= pos2 then least(e1 - pos2 + 1, rlen2) else 0 end as bigint) as clip2_start, cast(case when "check" = 'Passed' and r1 and e2 > e1 then least(e2 - e1, rlen2) else 0 end as bigint) as clip2_end from c""",
)
def mate_pairs(s, d):
    return reads.mate_pairs(reads.coverage_islands(fx.reads(s, d)))


@query(
    "cigar_lengths",
    f"""with {fx.READS}, c as (select *, '5S' || (rlen - 7) || 'M2I3M1D3M' as cigar from reads), o as (select *, regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1) as n, regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2) as op from c),
    u as (select cigar, rlen, unnest(n)::bigint as l, unnest(op) as x from o) select cigar, count(*) // 6 as reads, cast(sum(case when x in ('M', 'I', 'S') then l else 0 end) // (count(*) // 6) as bigint) as qlen,
    cast(sum(case when x in ('M', 'I', 'S') then l else 0 end) // (count(*) // 6) as bigint) as qlen1, cast(sum(case when x in ('M', 'D') then l else 0 end) // (count(*) // 6) as bigint) as reflen from u group by cigar""",
)
def cigar_lengths(s, d):
    c = fx.reads(s, d).withColumn("cigar", F.concat(F.lit("5S"), F.col("rlen") - 7, F.lit("M2I3M1D3M")))
    return reads.cigar_lengths(c.groupBy("cigar").agg(F.count("*").alias("reads")))


REGIONS = "regions as (select s_suppkey as region_id, s_suppkey % 5 as tid, (s_suppkey*1999) % 190000 as start, (s_suppkey*1999) % 190000 + 499 + s_nationkey*100 as stop from supplier)"


@query(
    "region_best_overlap",
    f"""with {BLOCKS}, b as (select tid, block_id, min(pos) as start, max(pos + rlen) - 1 as stop from blocks group by 1, 2), {REGIONS},
    j as (select b.tid, block_id, region_id, greatest(b.start, r.start) as clip_start, least(b.stop, r.stop) as clip_stop, least(b.stop, r.stop) - greatest(b.start, r.start) + 1 as overlap
    from b join regions r on b.tid = r.tid and b.start <= r.stop and b.stop >= r.start)
    select tid, block_id, region_id, clip_start, clip_stop, overlap from j qualify row_number() over (partition by tid, block_id order by overlap desc, region_id) = 1""",
)
def region_best_overlap(s, d):
    b = reads.island_table(fx.reads(s, d)).select("tid", "block_id", "start", (F.col("stop") - 1).alias("stop"))
    start = (F.col("s_suppkey") * 1999) % 190000
    r = fx.table(s, d, "supplier").select(F.col("s_suppkey").alias("region_id"), (F.col("s_suppkey") % 5).alias("tid"), start.alias("start"), (start + 499 + F.col("s_nationkey") * 100).alias("stop"))
    return intervals.best_overlap(b, r).select("tid", "block_id", "region_id", "clip_start", "clip_stop", "overlap")


@query("contig_include_exclude", f"with {fx.READS} select tid, count(*) as reads from reads where tid in (select n_nationkey % 7 from nation) and tid not in (select r_regionkey from region where r_regionkey % 2 = 1) group by tid")
def contig_include_exclude(s, d):
    inc = fx.table(s, d, "nation").select((F.col("n_nationkey") % 7).cast("bigint").alias("tid"))
    exc = fx.table(s, d, "region").where("r_regionkey % 2 = 1").select(F.col("r_regionkey").cast("bigint").alias("tid"))
    return intervals.restrict(fx.reads(s, d), inc, exc).groupBy("tid").agg(F.count("*").alias("reads"))


# ---- model


def _model_sql(haploid: bool = False) -> str:
    """The likelihoods spelled out genotype by genotype."""
    import math

    k = [f"(e{i} / (3e0 - 4e0 * e{i}))" for i in range(8)]
    X = lambda i: f"ln(1 + k{i})"
    H = lambda i: f"ln(0.5e0 + k{i})"
    K = lambda i: f"ln(k{i})"
    L = lambda i, inner: f"ln({inner} + k{i})"
    per = {
        "AA": [X(0), K(1), K(2), K(3), X(4), K(5), K(6), K(7)],
        "AC": [H(0), H(1), K(2), K(3), H(4), L(5, "0.5e0*z0c"), K(6), L(7, "0.5e0*(1-z0c)")],
        "AG": [H(0), K(1), H(2), K(3), L(4, "1-0.5e0*z1b"), K(5), L(6, "0.5e0*z1b"), K(7)],
        "AT": [H(0), K(1), K(2), H(3), H(4), K(5), K(6), H(7)],
        "CC": [K(0), X(1), K(2), K(3), K(4), L(5, "z0a"), K(6), L(7, "1-z0a")],
        "CG": [K(0), H(1), H(2), K(3), L(4, "0.5e0*(1-z1c)"), L(5, "0.5e0*z0c"), L(6, "0.5e0*z1c"), L(7, "0.5e0*(1-z0c)")],
        "CT": [K(0), H(1), K(2), H(3), K(4), L(5, "0.5e0*z0b"), K(6), L(7, "1-0.5e0*z0b")],
        "GG": [K(0), K(1), X(2), K(3), L(4, "1-z1a"), K(5), L(6, "z1a"), K(7)],
        "GT": [K(0), K(1), H(2), H(3), L(4, "0.5e0*(1-z1c)"), K(5), L(6, "0.5e0*z1c"), H(7)],
        "TT": [K(0), K(1), K(2), X(3), K(4), K(5), K(6), X(7)],
    }
    fz = lambda v: f"(case when {v} < -1 then 0.01e0 when {v} > 1 then 0.95e0 else 0.5e0*(0.94e0*({v}) + 0.96e0) end)"

    def z(x1, x2, k1, k2, form):
        d = f"(({x1}+{x2})*0.94e0)"
        v = {"a": f"(({x1}*(1.04e0+2*{k2}) - {x2}*(0.96e0+2*{k1}))/{d})", "b": f"(({x1}*(3.04e0+4*{k2}) - {x2}*(0.96e0+4*{k1}))/{d})", "c": f"(({x1}*(1.04e0+4*{k2}) - {x2}*(0.96e0+4*{k1}))/{d})"}[form]
        return f"case when {x1}=0 and {x2}=0 then -1e0 when {x2}=0 then 0.95e0 when {x1}=0 then 0.01e0 else {fz(v)} end"

    raw = []
    for g, terms in per.items():
        prior = f"case when rb = '{g[0]}' then {math.log(2.0)!r} else 0 end" if g[0] == g[1] else f"case when rb in ('{g[0]}','{g[1]}') then {math.log(1.5)!r} else 0 end"
        raw.append(" + ".join(f"case when c{i} > 0 then c{i}*{t} else 0 end" for i, t in enumerate(terms)) + " + " + prior)
    kept = [0, 4, 7, 9] if haploid else list(range(10))
    zs = ", ".join(f"{z('c5', 'c7', 'k5', 'k7', f)} as z0{f}, {z('c6', 'c4', 'k6', 'k4', f)} as z1{f}" for f in "abc")
    return f"""{fx.SITES}, e as (select *, substr('ACGT', cast(ref as int) + 1, 1) as rb, {", ".join(f"least(power(10e0, -(case when c{i} > 0 then least(63, round(q{i} / c{i}::double)) else 0 end) / 10e0), 0.5e0) as e{i}" for i in range(8))} from sites),
    k as (select *, {", ".join(f"{k[i]} as k{i}" for i in range(8))} from e), z as (select *, {zs} from k), raw as (select *, {", ".join(f"{raw[g]} as g{g}" for g in kept)} from z),
    top as (select *, greatest({", ".join(f"g{g}" for g in kept)}) as mx from raw),
    gt as (select *, mx + ln({" + ".join(f"exp(g{g} - mx)" for g in kept)}) as norm, case {" ".join(f"when g{g} = mx then {g}" for g in kept)} end as max_gt from top)"""


MODEL = _model_sql()
LN10 = "2.302585092994046"


@query("genotype_likelihood", f"with {MODEL} select tid, p, cast(max_gt as bigint) as max_gt, " + ", ".join(f"round((g{g} - norm) / {LN10}, 5) + 0e0 as ll{g}" for g in range(10)) + " from gt")
def genotype_likelihood(s, d):
    m = model.likelihoods(_sites(s, d))
    return m.select("tid", "p", F.col("max_gt").cast("bigint").alias("max_gt"), *[(_round5(F.col("ll")[g]) + F.lit(0.0)).alias(f"ll{g}") for g in range(10)])


@query("genotype_haploid", f"with {_model_sql(True)} select tid, p, cast(max_gt as bigint) as max_gt, " + ", ".join(f"round((g{g} - norm) / {LN10}, 5) + 0e0 as ll{g}" for g in (0, 4, 7, 9)) + " from gt")
def genotype_haploid(s, d):
    m = model.likelihoods(_sites(s, d), haploid=True)
    return m.select("tid", "p", F.col("max_gt").cast("bigint").alias("max_gt"), *[(F.round(F.col("ll")[g], 5) + F.lit(0.0)).alias(f"ll{g}") for g in (0, 4, 7, 9)])


EST = lambda z: f"(case when {z} < 0 then null when ({z} - 0.01e0) / 0.94e0 < 0 then null else round(least(1e0, ({z} - 0.01e0) / 0.94e0), 5) end)"


@query(
    "methylation_estimate",
    f"with {MODEL} select tid, p, cast(max_gt as bigint) as max_gt, case max_gt when 4 then {EST('z0a')} when 6 then {EST('z0b')} when 1 then {EST('z0c')} when 5 then {EST('z0c')} end as meth_c, case max_gt when 7 then {EST('z1a')} when 2 then {EST('z1b')} when 5 then {EST('z1c')} when 8 then {EST('z1c')} end as meth_g from gt where max_gt not in (0, 3, 9)",
)
def methylation_estimate(s, d):
    m = model.likelihoods(_sites(s, d)).where(~F.col("max_gt").isin(0, 3, 9))
    c, g = model.meth(F.col("max_gt"))
    return m.select("tid", "p", F.col("max_gt").cast("bigint").alias("max_gt"), _round5(c).alias("meth_c"), _round5(g).alias("meth_g"))


@query("fisher_strand")
def fisher_strand(s, d):
    m = pileup.pileup_stranded(fx.observations(s, d)).withColumn("gt", ((F.col("p") + F.col("tid")) % 10).cast("int"))
    t = m.withColumn("table", model.fisher_table(F.col("gt"))).where("table is not null")
    return t.select("tid", "p", "gt", F.round(model.fisher_log10(F.col("table")), 6).alias("log10_p"))


GENOTYPE = "cast(case when (p + dp) % 7 < 5 then [0, 4, 7, 9][cast(ref as int) + 1] else [1, 5, 8, 3][cast(ref as int) + 1] end as bigint)"
#: Allele groups of heterozygotes, SURVEY 2.13c: at most one read for either.
MAC1 = """case gt when 1 then least(c0 + c4, c1 + c5 + c7) when 2 then least(c0, c2 + c6) when 3 then least(c0 + c4, c3 + c7) when 5 then least(c1 + c5 + c7, c2 + c4 + c6)
 when 6 then least(c1 + c5, c3) when 8 then least(c2 + c4 + c6, c3 + c7) else 2 end <= 1"""
SF = f"""f as (select tid, p, dp, {GENOTYPE} as gt, c0, c1, c2, c3, c4, c5, c6, c7, (m2 * 7 + p) % 90 as phred, (p * 13 + dp) % 120 as fs, cast(least(255, round(sqrt(m2 / dp::double))) as bigint) as mq from sites), w as (select *, phred // dp as qd from f),
flt as (select tid, p, dp, phred, fs, mq, qd, coalesce(nullif(concat_ws(';', case when phred < 20 then 'q20' end, case when qd < 2 then 'qd2' end, case when fs > 60 then 'fs60' end, case when mq < 40 then 'mq40' end), ''), case when {MAC1} then 'mac1' end, 'PASS') as filter from w)"""


def _filtered(s, d):
    f = _calls(s, d).select("tid", "p", "dp", "gt", *[f"c{k}" for k in range(8)], ((F.col("m2") * 7 + F.col("p")) % 90).alias("phred"), ((F.col("p") * 13 + F.col("dp")) % 120).alias("fs"), pileup.rms_mapq().cast("bigint").alias("mq"))
    return sites.site_filters(f).drop("gt", *[f"c{k}" for k in range(8)])


@query("site_filters", f"with {fx.SITES}, {SF} select tid, p, dp, phred, fs, mq, qd, filter from flt")
def site_filters(s, d):
    return _filtered(s, d)


#: Simple calls, whole numbers only: the genotype of the reference base where all reads agree with it, else of reference and the next base.
GT = f"calls as (select *, {GENOTYPE} as gt from sites)"


def _calls(s, d):
    hom, het = codes.at((0, 4, 7, 9), F.col("ref")), codes.at((1, 5, 8, 3), F.col("ref"))
    return _sites(s, d).withColumn("gt", F.when((F.col("p") + F.col("dp")) % 7 < 5, hom).otherwise(het).cast("bigint"))


PAIR = "case when {a} is null and {b} is null then 0 when {a} is null then cast({b} in (2,5,7,8) as int) when {b} is null then cast({a} in (1,4,5,6) as int) when {a} = 4 and {b} = 7 then 4 when {a} in (1,4,5,6) and {b} in (2,5,7,8) then 3 when {a} in (1,4,5,6) or {b} in (2,5,7,8) then 2 else 0 end"


@query(
    "cpg_status",
    f"with {fx.SITES}, {GT}, n as (select tid, p, gt, case when lag(p) over w = p - 1 then lag(gt) over w end as pg, case when lead(p) over w = p + 1 then lead(gt) over w end as ng from calls window w as (partition by tid order by p)), s as (select tid, p, gt, cast(greatest({PAIR.format(a='pg', b='gt')}, {PAIR.format(a='gt', b='ng')}) as bigint) as state from n) select *, substr('.?NHY', cast(state as int) + 1, 1) as cpg from s",
)
def cpg_status(s, d):
    return sites.cpg_status(_calls(s, d)).withColumn("state", F.col("state").cast("bigint"))


# ---- known variants

SNPS = "snps as (select p_partkey % 5 as tid, (p_partkey*997) % 200000 + 1 as pos, p_partkey as number, (p_size % 50) / 100e0 as maf from part), prep as (select tid, pos, min(number) as number, arg_min(maf, number) as maf from snps group by 1, 2)"


def _snps(s, d):
    p = fx.table(s, d, "part").select((F.col("p_partkey") % 5).alias("tid"), ((F.col("p_partkey") * 997) % 200000 + 1).alias("pos"), F.concat(F.lit("rs"), F.col("p_partkey")).alias("rs"), ((F.col("p_size") % 50) / 100.0).alias("maf"))
    chosen = fx.table(s, d, "part").where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("number"))
    return sites.prepare_snps(p, 0.3, chosen)


@query("dbsnp_lookup", f"with {fx.SITES}, {SNPS} select s.tid, s.p, dp, 'rs' || number as rs, maf >= 0.3e0 or number % 7 = 0 as selected from sites s join prep on prep.tid = s.tid and prep.pos = s.p + 1")
def dbsnp_lookup(s, d):
    return sites.snp_lookup(_sites(s, d).select("tid", "p", "dp"), _snps(s, d)).where("rs is not null")


@query("dbsnp_stats", f"with {SNPS} select tid, count(*) as snps, cast(sum(case when maf >= 0.3e0 or number % 7 = 0 then 1 else 0 end) as bigint) as selected, count(distinct pos // 256) as bins from prep group by tid")
def dbsnp_stats(s, d):
    return _snps(s, d).groupBy("tid").agg(F.count("*").alias("snps"), stats.count_if(F.col("selected")).alias("selected"), F.count_distinct(F.expr("pos div 256")).alias("bins"))


_BAF = {0: ("c0+c4", None), 1: ("c1+c5+c7", "c0+c4"), 2: ("c2", "c0"), 3: ("c3+c7", "c0+c4"), 4: ("", None), 5: ("c2+c4+c6", "c1+c5+c7"), 6: ("c3", "c1"), 8: ("c3+c7", "c2+c4+c6")}


@query(
    "snp_baf",
    f"with {fx.SITES}, {GT}, {SNPS}, b as (select c.tid, c.p, 'rs' || number as rs, gt, case "
    + " ".join(f"when gt = {g} then {y}" for g, (y, x) in _BAF.items() if x)
    + " else 0 end as alt, case "
    + " ".join(f"when gt = {g} then {y} + {x}" for g, (y, x) in _BAF.items() if x)
    + " when gt = 0 then c0+c4 when gt = 4 then c1+c5+c7 when gt = 7 then c2+c4+c6 else c3+c7 end as total from calls c join prep on prep.tid = c.tid and prep.pos = c.p + 1) select tid, p, rs, gt, case when total > 0 then printf('%.3f', alt / total::double) else '-' end as baf from b",
)
def snp_baf(s, d):
    return sites.baf(sites.snp_lookup(_calls(s, d), _snps(s, d)).where("rs is not null")).select("tid", "p", "rs", "gt", "baf")


# ---- extracts


@query(
    "cpg_combined",
    f"with {fx.SITES}, {GT}, b as (select *, lead(p) over w as bp, lead(gt) over w as bgt, lead(c4) over w as b4, lead(c6) over w as b6, lead(m2) over w as bm, lead(dp) over w as bd from calls window w as (partition by tid order by p)), j as (select tid, p, c5 + b6 as non_conv, c7 + b4 as conv, cast(floor(sqrt((m2 + bm) / (dp + bd)::double) + 0.5e0) as bigint) as mq from b where gt = 4 and bgt = 7 and bp = p + 1 and (c5 + c7 >= 1 or b6 + b4 >= 1)) select tid, p, non_conv, conv, case when non_conv + conv > 0 then printf('%.3f', non_conv / (non_conv + conv)::double) else '.' end as meth, mq from j",
)
def cpg_combined(s, d):
    return extract.cpg_pairs(_calls(s, d)).withColumn("mq", F.col("mq").cast("bigint"))


@query(
    "cpg_het",
    f"with {fx.SITES}, {GT}, b as (select *, lead(p) over w as bp, lead(gt) over w as bgt, lead(c4) over w as b4, lead(c6) over w as b6 from calls window w as (partition by tid order by p)) select tid, p, c5 + b6 as non_conv, c7 + b4 as conv from b where gt in (1, 4, 5, 6) and bgt in (2, 5, 7, 8) and bp = p + 1 and (c5 + c7 >= 1 or b6 + b4 >= 1)",
)
def cpg_het(s, d):
    return extract.cpg_pairs(_calls(s, d), het=True).select("tid", "p", "non_conv", "conv")


@query(
    "cpg_strand_specific",
    f"with {fx.SITES}, {GT}, j as (select a.tid, a.p, a.c5, a.c7, b.p as p2, b.c6, b.c4 from calls a join calls b on a.tid = b.tid and b.p = a.p + 1 where a.gt = 4 and b.gt = 7) select tid, p, 'C' as strand, c5 as non_conv, c7 as conv from j union all select tid, p2, 'G', c6, c4 from j",
)
def cpg_strand_specific(s, d):
    return extract.cpg_strands(_calls(s, d))


@query(
    "noncpg_extract",
    f"with {fx.SITES}, {GT}, x as (select *, case when gt = 4 then c5 else c6 end as a, case when gt = 4 then c7 else c4 end as b, case when gt = 4 then c1+c5+c7 else c2+c4+c6 end as support from calls where gt in (4, 7)) select tid, p, gt, a as non_conv, b as conv, support, dp from x where a >= 1 and a + b >= 1",
)
def noncpg_extract(s, d):
    return extract.noncpg(_calls(s, d))


@query(
    "bed_methyl",
    f"""with {fx.SITES}, {GT}, b as (select tid, p, gt, [{", ".join(f"substr('ACGT', cast((((p+({k}))*(p+({k}))*31 + (p+({k}))*17 + tid*101) % 1009) % 4 as int) + 1, 1)" for k in range(-2, 3))}] as cx, case when gt = 4 then c5 + c7 else c6 + c4 end as cov, case when gt = 4 then c5 else c6 end as u from calls where gt in (4, 7) and p >= 2),
    y as (select *, case when gt = 4 then cx[4] else translate(cx[2], 'ACGT', 'TGCA') end as n1, case when gt = 4 then cx[5] else translate(cx[1], 'ACGT', 'TGCA') end as n2, cast(floor(u / cov::double * 10 + 0.5e0) as int) as step from b where cov > 0)
    select tid, p, case when gt = 4 then '+' else '-' end as strand, case when n1 = 'G' then 'CpG' when n2 = 'G' then 'CHG' else 'CHH' end as kind, least(1000, cov) as score, concat_ws(',', least(255, step * 51), least(255, (10 - step) * 51), 0) as rgb, cov as coverage, cast(floor(u / cov::double * 100) as bigint) as percent from y""",
)
def bed_methyl(s, d):
    base = lambda k: F.substring(F.lit("ACGT"), fx.reference_base(F.col("p") + k, F.col("tid")).cast("int") + 1, F.lit(1))
    c = _calls(s, d).where("p >= 2").withColumn("cx", F.concat(*[base(k) for k in range(-2, 3)]))
    return extract.bed_methyl(c).withColumn("percent", F.col("percent").cast("bigint"))


@query(
    "multi_sample_pass",
    f"""with {fx.OBS}, s as (select tid, p, k1 % 3 as sample, count(*) as n from obs where q >= 13 group by 1, 2, 3), w as (select tid, p, coalesce(max(case when sample = 0 then n end), 0) as a, coalesce(max(case when sample = 1 then n end), 0) as b, coalesce(max(case when sample = 2 then n end), 0) as c from s group by 1, 2),
    x as (select tid, p, a / (a + 1e0) as x, b / (b + 1e0) as y, c / (c + 1e0) as z from w)
    select tid, p, round(1 - (1-x)*(1-y)*(1-z), 6) as p1, round(x*y*z + x*y*(1-z) + x*(1-y)*z + (1-x)*y*z, 6) as p2, round(x*y*z, 6) as p3 from x""",
)
def multi_sample_pass(s, d):
    o = fx.observations(s, d).where("q >= 13").withColumn("sample", F.col("k1") % 3)
    n = [F.sum((F.col("sample") == k).cast("bigint")) for k in range(3)]
    w = o.groupBy("tid", "p").agg(*[(x / (x + 1.0)).alias(f"x{k}") for k, x in enumerate(n)]).withColumn("probs", F.array("x0", "x1", "x2"))
    return w.select("tid", "p", *[F.round(extract.at_least(F.col("probs"), k), 6).alias(f"p{k}") for k in (1, 2, 3)])


@query(
    "multi_sample_threshold",
    f"""with {fx.OBS}, s as (select tid, p, k1 % 3 as sample, count(*) as n from obs where q >= 13 group by 1, 2, 3), w as (select tid, p, coalesce(max(case when sample = 0 then n end), 0) as a, coalesce(max(case when sample = 1 then n end), 0) as b, coalesce(max(case when sample = 2 then n end), 0) as c from s group by 1, 2),
    x as (select tid, p, a / (a + 1e0) as x, b / (b + 1e0) as y, c / (c + 1e0) as z from w), e as (select tid, p, round(1 - (x*y*z + x*y*(1-z) + x*(1-y)*z + (1-x)*y*z), 9) as miss from x)
    select tid, p from e where case when miss <= 0 then 255 else trunc(-10 * log10(miss)) end >= 2""",
)
def multi_sample_threshold(s, d):
    """FLT-10: two of three samples pass with a quality of 2."""
    o = fx.observations(s, d).where("q >= 13").withColumn("sample", F.col("k1") % 3)
    n = [F.sum((F.col("sample") == k).cast("bigint")) for k in range(3)]
    w = o.groupBy("tid", "p").agg(F.array(*[x / (x + 1.0) for x in n]).alias("probs"))
    return w.where(extract.enough_samples(F.col("probs"), 2, 2)).select("tid", "p")


@query("zoom_levels_aligned", f"with {fx.SITES} select tid, width, p // width as span, count(*) as n, min(dp) as low, max(dp) as high, cast(sum(dp) as bigint) as total, cast(sum(dp*dp) as bigint) as squares from sites, (values (1000::bigint), (4000), (16000)) v(width) group by all")
def zoom_levels_aligned(s, d):
    return extract.zoom_aligned(_sites(s, d).withColumn("value", F.col("dp")), (1000, 4000, 16000))


@query("zoom_levels_anchored")
def zoom_levels_anchored(s, d):
    return extract.zoom_anchored(_sites(s, d).withColumn("value", F.col("dp")), 1000)


# ---- statistics


@query("coverage_hist", f"with {fx.SITES}, {GT} select dp as value, count(*) as n, cast(sum(case when gt not in (0,4,7,9) then 1 else 0 end) as bigint) as variant, cast(sum(case when gt in (4,7) then 1 else 0 end) as bigint) as cytosine from calls group by dp")
def coverage_hist(s, d):
    return stats.histogram(_calls(s, d), F.col("dp"), variant=~F.col("gt").isin(0, 4, 7, 9), cytosine=F.col("gt").isin(4, 7))


@query("quality_hist", f"with {fx.SITES}, {SF}, h as (select phred, count(*) as c from flt group by 1) select v as value, coalesce(c, 0) as n from range(256) r(v) left join h on v = phred")
def quality_hist(s, d):
    h = _filtered(s, d).groupBy("phred").agg(F.count("*").alias("c"))
    return s.range(256).join(h, F.col("id") == F.col("phred"), "left").select(F.col("id").alias("value"), F.coalesce("c", F.lit(0)).alias("n"))


@query("qc_dist", f"with {fx.SITES}, {SF} select filter as value, count(*) as n, cast(sum(case when dp % 2 = 0 then 1 else 0 end) as bigint) as het, cast(sum(case when dp % 2 = 1 then 1 else 0 end) as bigint) as hom from flt group by 1")
def qc_dist(s, d):
    return stats.histogram(_filtered(s, d), F.col("filter"), het=F.col("dp") % 2 == 0, hom=F.col("dp") % 2 == 1)


FLAGGED = f"{fx.SITES}, {SF}, {GT}, a as (select c.tid, c.p, c.gt, c.ref, c.dp, filter = 'PASS' as passed, gt not in (0,4,7,9) as variant from calls c join flt using (tid, p))"


def _flagged(s, d):
    c = _calls(s, d)
    f = c.withColumns({"phred": (F.col("m2") * 7 + F.col("p")) % 90, "fs": (F.col("p") * 13 + F.col("dp")) % 120, "mq": pileup.rms_mapq().cast("bigint")})
    return sites.site_filters(f).withColumns({"passed": F.col("filter") == "PASS", "variant": ~F.col("gt").isin(0, 4, 7, 9)})


@query("contig_stats_rollup", f"with {FLAGGED} select tid, count(*) as sites, cast(sum(variant::int) as bigint) as variants, cast(sum(passed::int) as bigint) as passed_sites, cast(sum((variant and passed)::int) as bigint) as passed_variants from a group by rollup (tid)")
def contig_stats_rollup(s, d):
    return stats.contig_rollup(_flagged(s, d))


ALT1 = "[1, 2, 3, 0]"
SPECTRUM = f"{FLAGGED}, {SNPS}, m as (select a.*, case when variant then substr('ACGT', cast(ref as int) + 1, 1) || '>' || [['C','G','T','A'],['G','G','T','A']][1][cast(ref as int) + 1] end as mutation, number is not null as known from a left join prep on prep.tid = a.tid and prep.pos = a.p + 1), spec as (select mutation, count(*) as n, cast(sum(passed::int) as bigint) as n_passed, cast(sum(known::int) as bigint) as n_known, cast(sum((known and passed)::int) as bigint) as n_known_passed from m where mutation is not null group by 1)"


def _spectrum(s, d):
    a = sites.snp_lookup(_flagged(s, d), _snps(s, d))
    ref = F.substring(F.lit("ACGT"), F.col("ref").cast("int") + 1, F.lit(1))
    other = codes.alt(F.col("gt"), F.col("ref"))
    one = F.col("variant") & (F.length(other) == 1) & (other != ".")
    return stats.mutation_spectrum(a.withColumns({"mutation": F.when(one, F.concat(ref, F.lit(">"), other)), "known": F.col("rs").isNotNull()}))


@query("mutation_spectrum", f"with {SPECTRUM} select * from spec")
def mutation_spectrum(s, d):
    return _spectrum(s, d)


@query("ti_tv", f"with {SPECTRUM}, t as (select cast(sum(case when mutation in ('A>G','G>A','C>T','T>C') then n else 0 end) as bigint) as ti, cast(sum(case when mutation in ('A>G','G>A','C>T','T>C') then 0 else n end) as bigint) as tv from spec) select ti, tv, round(ti / tv::double, 6) as ratio from t")
def ti_tv(s, d):
    return stats.ti_tv(_spectrum(s, d))


POST = f"{fx.SITES}, g as (select c5 + c6 as a, c7 + c4 as b, count(*) as n from sites where c5 + c6 + c7 + c4 > 0 group by 1, 2), w as (select a, b, n, i, power(i / 100e0, a) * power(1 - i / 100e0, b) as w from g, range(101) r(i)), s as (select *, w / sum(w) over (partition by a, b) as share from w), hist as (select i, round(sum(share * n), 6) as mass from s group by i)"


def _posterior(s, d):
    m = _sites(s, d).where("c5 + c6 + c7 + c4 > 0").select((F.col("c5") + F.col("c6")).alias("a"), (F.col("c7") + F.col("c4")).alias("b"))
    return stats.posterior_histogram(m).select(F.col("i").cast("bigint").alias("i"), "mass")


@query("meth_posterior_hist", f"with {POST} select i, mass from hist")
def meth_posterior_hist(s, d):
    return _posterior(s, d)


@query(
    "meth_profile",
    f"with {POST}, c as (select *, sum(mass) over (order by i) as cum, sum(mass) over () as total from hist) select round(sum(case when i < 30 then mass else 0 end), 3) as low, round(sum(case when i >= 30 and i < 70 then mass else 0 end), 3) as middle, round(sum(case when i >= 70 then mass else 0 end), 3) as high, round(min(case when cum >= 0.5e0 * total then i end) * 0.01e0, 2) as median from c",
)
def meth_profile(s, d):
    return stats.profile(_posterior(s, d))


NONCPG = f"{fx.OBS}, n as (select case when rev = 1 then 9 - i else i end as cycle, base, ref, bs, (((p+1)*(p+1)*31 + (p+1)*17 + tid*101) % 1009) % 4 as nref, (((p-1)*(p-1)*31 + (p-1)*17 + tid*101) % 1009) % 4 as pref from obs where q >= 13 and p > 0)"


@query(
    "noncpg_profile",
    f"with {NONCPG}, t as (select cycle, cast(sum(case when ref = 1 and nref <> 2 and bs = 1 and base = 1 or ref = 2 and pref <> 1 and bs = 2 and base = 2 then 1 else 0 end) as bigint) as unconverted, cast(sum(case when ref = 1 and nref <> 2 and bs = 1 and base = 3 or ref = 2 and pref <> 1 and bs = 2 and base = 0 then 1 else 0 end) as bigint) as converted from n group by 1) select cycle, unconverted, converted, round(100e0 * unconverted / (unconverted + converted), 6) as percent from t",
)
def noncpg_profile(s, d):
    o = fx.observations(s, d).where("q >= 13 and p > 0")
    o = o.withColumns({"nref": fx.reference_base(F.col("p") + 1, F.col("tid")), "pref": fx.reference_base(F.col("p") - 1, F.col("tid")), "cycle": F.when(F.col("rev") == 1, 9 - F.col("i")).otherwise(F.col("i")).cast("bigint")})
    c, g = (F.col("ref") == 1) & (F.col("nref") != 2) & (F.col("bs") == 1), (F.col("ref") == 2) & (F.col("pref") != 1) & (F.col("bs") == 2)
    t = o.groupBy("cycle").agg(stats.count_if(c & (F.col("base") == 1) | g & (F.col("base") == 2)).alias("unconverted"), stats.count_if(c & (F.col("base") == 3) | g & (F.col("base") == 0)).alias("converted"))
    return t.withColumn("percent", F.round(F.try_divide(100.0 * F.col("unconverted"), F.col("unconverted") + F.col("converted")), 6))


@query(
    "gc_depth_corr",
    f"with {fx.SITES}, {REF.format(n=200100)}, g as (select tid, p // 100 as bin, sum(case when ref in (1, 2) then 1 else 0 end) as gc from ref group by 1, 2), c as (select gc, dp, count(*) as n from sites s join g on g.tid = s.tid and g.bin = s.p // 100 group by 1, 2), k as (select dp as cut from (select dp, sum(sum(n)) over (order by dp) as cum, sum(sum(n)) over () as total from c group by dp) where cum * 100 >= total * 99 order by dp limit 1), w as (select sum(n)::double as w, sum(n*gc)::double as a, sum(n*dp)::double as b, sum(n*gc*gc)::double as aa, sum(n*dp*dp)::double as bb, sum(n*gc*dp)::double as ab from c where dp <= (select cut from k)) select round((ab*w - a*b) / sqrt((aa*w - a*a) * (bb*w - b*b)), 6) as corr from w",
)
def gc_depth_corr(s, d):
    g = pileup.gc_bins(_ref(s, 200100)).withColumnRenamed("tid", "t2")
    c = _sites(s, d).withColumn("b", F.expr("p div 100")).join(g, (F.col("tid") == F.col("t2")) & (F.col("b") == F.col("bin"))).groupBy("gc", "dp").agg(F.count("*").alias("n"))
    return stats.weighted_pearson(stats.up_to_quantile(c, "dp", "n"), "gc", "dp", "n")


HIST = f"{fx.SITES}, h as (select m2 // 100 as value, count(*) as n from sites group by 1), c as (select *, sum(n) over (order by value) as cum, sum(n) over () as total from h)"


def _hist(s, d):
    return _sites(s, d).groupBy(F.expr("m2 div 100").alias("value")).agg(F.count("*").alias("n"))


@query("hist_quantile_cut", f"with {HIST} select min(value) as cut from c where cum * 100 >= total * 99")
def hist_quantile_cut(s, d):
    return stats.quantile_cut(_hist(s, d))


@query("hist_median", f"with {HIST} select min(value) as median from c where cum >= total // 2")
def hist_median(s, d):
    return stats.median(_hist(s, d))


@query("unique_fragments", f"with {HIST} select cast(sum(case when value >= 10 then n else 0 end) as bigint) as unique_fragments from h")
def unique_fragments(s, d):
    return stats.unique_fragments(_hist(s, d), 10)


@query("stats_merge", f"with {fx.SITES} select dp as value, count(*) as n from sites group by 1")
def stats_merge(s, d):
    parts = _sites(s, d).groupBy("tid", "dp").agg(F.count("*").alias("n")).groupBy("tid").agg(F.map_from_entries(F.collect_list(F.struct("dp", "n"))).alias("hist"))
    return stats.merge(parts)


@query(
    "conversion_rate",
    f"""with {fx.OBS}, t as (select rev, {", ".join(f"count(*) filter (where bs = {k} and base = {i})::double as {x}{k}" for k in (1, 2) for i, x in enumerate("acgt"))} from obs where q >= 13 group by 1),
    z as (select *, a1 + g1 + c2 + t2 as n1, c1 + t1 + a2 + g2 as n2, (a1 + t2) / (a1 + g1 + c2 + t2) as z from t),
    r as (select rev, case when n1 + n2 >= 10000 and n1 > 0 and n2 > 0 then ((t1 + a2) * (1 - z) - (c1 + g2) * z) / (n2 * (1 - z)) end as rate from z)
    select cast(rev as bigint) as rev, round(rate, 6) as rate, round(case when rate >= 0.9 then greatest(1 - rate, 0.001e0) end, 6) as under, round(case when rate <= 0.15 then greatest(rate, 0.001e0) end, 6) as over from r""",
)
def conversion_rate(s, d):
    n = lambda k, i: stats.count_if((F.col("bs") == k) & (F.col("base") == i)).alias(f"{'acgt'[i]}{k}")
    t = fx.observations(s, d).where("q >= 13").groupBy("rev").agg(*[n(k, i) for k in (1, 2) for i in range(4)])
    rate = stats.conversion_rate(*[{x: F.col(f"{x}{k}") for x in "acgt"} for k in (1, 2)])
    under, over = stats.conversion_limits(rate)
    return t.select(F.col("rev").cast("bigint").alias("rev"), F.round(rate, 6).alias("rate"), F.round(under, 6).alias("under"), F.round(over, 6).alias("over"))


@query("site_output", f"with {fx.SITES}, {GT}, {SNPS} select c.tid, c.p, c.gt from calls c left join prep on prep.tid = c.tid and prep.pos = c.p + 1 where not (c.gt = 0 and c.ref = 0 or c.gt = 9 and c.ref = 3) or coalesce(maf >= 0.3e0 or number % 7 = 0, false)")
def site_output(s, d):
    c = sites.snp_lookup(_calls(s, d), _snps(s, d))
    return c.where(sites.reported(F.col("gt"), F.col("ref"), F.col("selected"))).select("tid", "p", "gt")


@query("read_level_table", f"with {fx.READS}, t as (select {REASON} as reason, count(*) as reads from reads group by 1) select reason, reads, cast(sum(reads) over () as bigint) as total, round(reads * 100e0 / sum(reads) over (), 6) as percent from t")
def read_level_table(s, d):
    return stats.level_table(read_filter_cascade(s, d).select("reason", "reads"), "reason", "reads")


# ---- formats


def _sam(s, d):
    r = fx.reads(s, d)
    flag = F.when(F.col("ln") % 2 == 1, 16).otherwise(0) + F.when(F.col("fc") <= 2, 4).otherwise(0)
    return r.select(F.concat_ws("\t", F.concat(F.lit("r@"), F.col("k1"), F.lit("-"), F.col("k2")), flag.cast("string"), F.concat(F.lit("chr"), F.col("tid")), F.col("pos") + 1, F.col("mapq"), F.concat(F.col("rlen"), F.lit("M")), F.lit("="), F.lit("1"), F.lit("0"), F.lit("ACGNT"), F.lit("I5I!~"), F.concat(F.lit("XB:A:"), F.when(F.col("bs") == 1, "C").otherwise("G"))).alias("value"))


@query("sam_parse", f"with {fx.READS} select 'chr' || tid as rname, case when bs = 1 then 'C2T' else 'G2A' end as strand, fc <= 2 as unmapped, ln % 2 = 1 as reverse, count(*) as n, cast(sum(pos) as bigint) as positions, cast(sum(mapq) as bigint) as mapqs from reads group by 1, 2, 3, 4")
def sam_parse(s, d):
    r = text.sam_records(_sam(s, d)).withColumn("strand", reads.strand_from_tags(F.col("tags")))
    return r.groupBy("rname", "strand", "unmapped", "reverse").agg(F.count("*").alias("n"), F.sum("pos").alias("positions"), F.sum("mapq").alias("mapqs"))


@query("seq_qual", f"with {fx.READS} select 5 as bases, cast(count(*) * (40 + 20 + 40 + 0 + 62) as bigint) as quality, cast(count(*) * (0 + 1 + 2 + 0 + 3) as bigint) as codes from reads")
def seq_qual(s, d):
    r = text.sam_records(_sam(s, d)).select(text.sequence_qualities(F.col("seq"), F.col("qual")).alias("sq"))
    total = lambda k: F.sum(F.aggregate("sq", F.lit(0), lambda a, x: a + x[k])).cast("bigint")
    return r.agg(F.max(F.size("sq")).alias("bases"), total("qual").alias("quality"), total("base").alias("codes"))


@query("read_name_clean", f"with {fx.READS} select 'r_' || k1 || '-' || k2 as name, count(*) as n from reads group by 1")
def read_name_clean(s, d):
    return text.sam_records(_sam(s, d)).groupBy(text.clean_names(F.col("qname")).alias("name")).agg(F.count("*").alias("n"))


@query("sq_header_enrich", "select n_name as name, '@SQ' || chr(9) || 'SN:' || n_name || chr(9) || 'LN:' || (case when n_nationkey % 2 = 0 then n_nationkey * 10 + 1 else n_nationkey + 5 end) || case when n_nationkey % 2 = 0 then chr(9) || 'M5:' || md5(n_name) else '' end || chr(9) || 'UR:x' as line from nation")
def sq_header_enrich(s, d):
    n = fx.table(s, d, "nation")
    header = text.sam_header(n.select(F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "n_name"), F.concat(F.lit("LN:"), F.col("n_nationkey") + 5), F.lit("UR:x")).alias("value")))
    even = text.contig_md5(n.where("n_nationkey % 2 = 0").select(F.concat_ws("\t", "n_name", F.concat(F.lit("LN:"), F.col("n_nationkey") * 10 + 1), F.concat(F.lit("M5:"), F.md5("n_name"))).alias("value")))
    return text.enrich_header(header, even)


@query("fasta_md5", f"with {REF.format(n=200010)}, q as (select tid, string_agg(substr('ACGT', cast(ref as int) + 1, 1), '' order by p) as seq from ref group by 1) select 'chr' || tid as name, length(seq) as len, md5(seq) as m5 from q")
def fasta_md5(s, d):
    r = _ref(s).withColumn("b", F.substring(F.lit("acgt"), F.col("ref").cast("int") + 1, F.lit(1)))
    return text.fasta_md5(r.select(F.concat(F.lit("chr"), "tid").alias("name"), F.col("p").alias("no"), F.concat("b", F.lit(" ")).alias("line")))


@query("vcf_roundtrip", f"with {fx.SITES}, {GT} select 'chr' || tid as chrom, p, cast((p + dp) % 60 as bigint) as qual, dp as depth, cast({' + '.join(f'c{k}' for k in range(8))} as bigint) as reads from calls")
def vcf_roundtrip(s, d):
    c = _calls(s, d)
    v = c.select(
        F.concat(F.lit("chr"), "tid").alias("chrom"), "p", F.lit(None).cast("string").alias("id"), F.substring(F.lit("ACGT"), F.col("ref").cast("int") + 1, F.lit(1)).alias("ref"), codes.alt(F.col("gt"), F.col("ref")).alias("alt"), ((F.col("p") + F.col("dp")) % 60).alias("qual"), F.lit("PASS").alias("filter"), F.lit("NNCGN").alias("cx"),
        codes.gt(F.col("gt"), F.col("ref")).alias("GT"), F.lit("PASS").alias("FT"), F.col("dp").alias("DP"), F.lit(40).alias("MQ"), F.lit(30).alias("GQ"), F.lit(3).alias("QD"), pileup.counts_array().alias("MC8"), codes.strand_of(F.col("gt")).alias("CS"),
    )
    back = text.vcf_records(text.vcf_lines(v))
    return back.select("chrom", "p", F.col("qual").cast("bigint").alias("qual"), F.col("DP").cast("bigint").alias("depth"), F.aggregate("MC8", F.lit(0), lambda a, x: a + x).cast("bigint").alias("reads"))


@query("bed_regions", "select 'chr' || s_suppkey % 5 as name, (s_suppkey*1999) % 190000 as start, least((s_suppkey*1999) % 190000 + 500, 180000) - 1 as stop from supplier where (s_suppkey*1999) % 190000 < 180000")
def bed_regions(s, d):
    start = (F.col("s_suppkey") * 1999) % 190000
    b = fx.table(s, d, "supplier").where(start < 180000).select(F.concat_ws("\t", F.concat(F.lit("chr"), F.col("s_suppkey") % 5), start, start + 500).alias("value"))
    return text.bed_regions(b, s.range(5).select(F.concat(F.lit("chr"), "id").alias("name"), F.lit(180000).cast("bigint").alias("len")))


@query("dbsnp_sources", "select 'chr' || p_partkey % 5 as contig, p_partkey * 3 + 1 as pos, 'rs' || p_partkey as rs from part where p_size % 3 <> 2")
def dbsnp_sources(s, d):
    p = fx.table(s, d, "part")
    ctg, rs = F.concat(F.lit("chr"), F.col("p_partkey") % 5), F.concat(F.lit("rs"), "p_partkey")
    at = F.col("p_partkey") * 3
    bed = dbsnp.from_bed(p.where("p_size % 3 = 0").select(F.concat_ws("\t", ctg, at, at + 1, rs, F.lit("0")).alias("value")))
    vcf = dbsnp.from_vcf(p.where("p_size % 3 <> 0").select(F.concat_ws("\t", ctg, at + 1, rs, F.lit("A"), F.when(F.col("p_size") % 3 == 1, "G").otherwise("GT"), F.lit(".")).alias("value")))
    return bed.unionByName(vcf)


@query("refsnp_json", "select 'NC_' || p_partkey % 5 as contig, p_partkey * 3 + 1 as pos, 'rs' || p_partkey as rs, round(least((p_size * 2) / 200e0, 1 - (p_size * 2) / 200e0), 6) as maf from part")
def refsnp_json(s, d):
    spdi = lambda ins: f'{{"allele":{{"spdi":{{"seq_id":"NC_%s","position":%s,"deleted_sequence":"A","inserted_sequence":"{ins}"}}}}}}'
    freq = '{"study_name":"s","allele_count":%s,"total_count":100,"observation":{"deleted_sequence":"A","inserted_sequence":"G"}}'
    shape = '{"refsnp_id":"%s","primary_snapshot_data":{"placements_with_allele":[{"is_ptlp":false,"alleles":[]},{"is_ptlp":true,"alleles":[' + spdi("A") + "," + spdi("G") + ']}],"allele_annotations":[{"frequency":[' + freq + "," + freq + "]}]}}"
    k, at = F.col("p_partkey"), F.col("p_partkey") * 3
    j = fx.table(s, d, "part").select(F.format_string(shape, k, k % 5, at, k % 5, at, F.col("p_size"), F.col("p_size")).alias("value"))
    return dbsnp.from_json(j).withColumn("maf", F.round("maf", 6))


@query("metadata_normalise", "select 'b' || o_custkey % 20 as barcode, count(distinct 'd' || o_orderkey) as datasets, min('d' || o_orderkey) as first_dataset, max('d' || o_orderkey) as last_dataset from orders group by 1")
def metadata_normalise(s, d):
    m = fx.table(s, d, "orders").select(F.concat(F.lit("b"), F.col("o_custkey") % 20).alias("Sample Barcode"), F.concat(F.lit("d"), "o_orderkey").alias("File_ID"), F.lit("x").alias("unknown"))
    return dbsnp.datasets_by_barcode(dbsnp.normalise_metadata(m))


@query(
    "gl_vector",
    f"""with {MODEL}, l as (select tid, p, rb, [{", ".join(f"(g{g} - norm) / {LN10}" for g in range(10))}] as ll, {list(codes.GENOTYPES)!r}[cast(max_gt as int) + 1] as name from gt),
    a as (select *, list_filter(case when name[1] = name[2] then [name[1]] else [name[1], name[2]] end, lambda x: x <> rb) as others from l),
    w as (select *, case len(others) when 0 then [rb || rb] when 1 then [rb || rb, rb || others[1], others[1] || others[1]] else [rb || rb, rb || others[1], others[1] || others[1], rb || others[2], others[1] || others[2], others[2] || others[2]] end as pairs from a),
    v as (select tid, p, list_transform(pairs, lambda x: round(greatest(-99.999e0, ll[list_position({list(codes.GENOTYPES)!r}, case when x[1] <= x[2] then x else x[2] || x[1] end)]), 5) + 0e0) as gl from w)
    select tid, p, cast(len(gl) as bigint) as n, {", ".join(f"gl[{k}] as gl{k}" for k in range(1, 7))} from v""",
)
def gl_vector(s, d):
    m = model.likelihoods(_sites(s, d)).select("tid", "p", codes.likelihood_vector(F.col("ll"), F.col("max_gt"), F.col("ref")).alias("gl"))
    return m.select("tid", "p", F.size("gl").cast("bigint").alias("n"), *[(F.round(F.get("gl", F.lit(k)), 5) + F.lit(0.0)).alias(f"gl{k + 1}") for k in range(6)])


@query(
    "complete_records",
    "select p_partkey * 3 as p, p_partkey % 5 as kind from part where p_size % 3 <> 0 and p_partkey % 5 in (0, 4)",
)
def complete_records(s, d):
    """FLT-7: lines that lack an allele C or G, a base of the context, a count or the mapping quality go."""
    k = F.col("p_partkey") % 5
    cx = F.when(k == 1, "CX=ACG").otherwise("CX=TACGA")
    sample = F.concat_ws(":", F.lit("0/1:9"), F.when(k == 2, "1,2,3").otherwise("1,2,3,4,5,6,7,8"), F.when(k == 3, ".").otherwise("40"))
    alleles = F.when(F.col("p_size") % 3 == 0, "A\tT").when(F.col("p_size") % 3 == 1, "C\tT").otherwise("A\tT,G")
    line = F.concat_ws("\t", F.lit("chr1"), F.col("p_partkey") * 3 + 1, F.lit("."), alleles, F.lit("30"), F.lit("PASS"), cx, F.lit("GT:DP:MC8:MQ"), sample)
    r = text.vcf_records(fx.table(s, d, "part").select(line.alias("value")).where("value is not null"))
    return text.complete_records(r).select("p", F.expr("p div 3 % 5").alias("kind"))


@query("selected_names", "select distinct cast(p_partkey % 1500 as varchar) as name from part where p_size % 4 <> 3")
def selected_names(s, d):
    k = (F.col("p_partkey") % 1500).cast("string")
    line = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("rs"), k, F.lit(" note"))).when(F.col("p_size") % 4 == 1, F.concat(F.lit("\t"), k)).when(F.col("p_size") % 4 == 2, k).otherwise("  ")
    return dbsnp.selected_names(fx.table(s, d, "part").select(line.alias("value")))


@query("lims_datasets", "select 'F' || o_custkey % 9 || '_' || o_orderkey % 8 || '_' || o_orderkey as dataset, 'F' || o_custkey % 9 || '_' || o_orderkey % 8 || '_0' as alternative, 'b' || o_custkey as barcode, 'l' || o_orderkey % 7 as library from orders where o_orderstatus <> 'F'")
def lims_datasets(s, d):
    one = F.struct(
        F.concat(F.lit("F"), F.col("o_custkey") % 9).alias("flowcell_name"), (F.col("o_orderkey") % 8).alias("lane_number"), F.col("o_orderkey").cast("string").alias("index_name"), F.concat(F.lit("b"), "o_custkey").alias("sample_barcode"),
        F.concat(F.lit("l"), F.col("o_orderkey") % 7).alias("library_barcode"), F.when(F.col("o_orderstatus") != "F", "pass").otherwise("fail").alias("passfail"),
    )
    docs = fx.table(s, d, "orders").groupBy((F.col("o_orderkey") % 97).alias("no")).agg(F.to_json(F.struct(F.collect_list(one).alias("objects"))).alias("value"))
    return dbsnp.lims_datasets(docs)


@query("header_regions", "select n_name as name, cast(0 as bigint) as start, n_nationkey * 1000 + 499 as stop from nation where n_regionkey in (0, 1, 3) and n_regionkey <> 1")
def header_regions(s, d):
    n = fx.table(s, d, "nation")
    size = F.col("n_nationkey").cast("bigint") * 1000 + 500
    header = text.sam_header(n.select(F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "n_name"), F.concat(F.lit("LN:"), size)).alias("value")))
    part = lambda *k: n.where(F.col("n_regionkey").isin(*k)).select(F.col("n_name").alias("name"), size.alias("len"))
    return text.header_regions(header, part(0, 1, 2, 3, 4), part(0, 1, 3), part(1))


# ---- planning and streams


@query("contig_pools")
def contig_pools(s, d):
    return dag.pools(s, fx.table(s, d, "nation").select(F.col("n_name").alias("name"), ((F.col("n_nationkey") * 7919000) % 60000000 + 1000).cast("bigint").alias("len")))


@query(
    "dag_required_tasks",
    "with recursive e(task, needs) as (select 'n' || n_nationkey, 'r' || n_regionkey from nation union all select 's' || s_suppkey, 'n' || s_nationkey from supplier), need(task, depth) as (select 's' || s_suppkey, 0 from supplier where s_suppkey % 10 = 1 union all select e.needs, depth + 1 from need join e using (task)) select task, min(depth) as depth from need group by 1",
)
def dag_required_tasks(s, d):
    name = lambda p, c: F.concat(F.lit(p), F.col(c))
    sup = fx.table(s, d, "supplier")
    e = fx.table(s, d, "nation").select(name("n", "n_nationkey").alias("task"), name("r", "n_regionkey").alias("needs")).unionByName(sup.select(name("s", "s_suppkey").alias("task"), name("n", "s_nationkey").alias("needs")))
    return dag.required(s, e, sup.where("s_suppkey % 10 = 1").select(name("s", "s_suppkey").alias("task")))


@query(
    "stream_sessions",
    "with f as (select *, case when ts - lag(ts) over w < interval 30 minutes then 0 else 1 end as new from events window w as (partition by user_id order by ts)), g as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from f) select user_id, min(ts) as first_ts, max(ts) as last_ts, count(*) as n from g group by user_id, k",
)
def stream_sessions(s, d):
    return islands.sessions(fx.table(s, d, "events"))


@query("stream_tumbling", "select time_bucket(interval 1 hour, ts, timestamp '1970-01-01') as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def stream_tumbling(s, d):
    return islands.tumbling(fx.table(s, d, "events"))


@query("stream_sliding", "select start - k * interval 1 hour as start, count(*) as n from (select time_bucket(interval 1 hour, ts, timestamp '1970-01-01') as start from events), range(2) r(k) group by 1")
def stream_sliding(s, d):
    return islands.sliding(fx.table(s, d, "events"))


# ---- small forms


@query("split_alignments", f"with {fx.READS} select tid, 2 as parts, cast(min(pos) as bigint) as first_pos, cast(max(pos + 100) as bigint) as second_pos, '10M30S' as first_cigar, count(*) as n from reads group by tid")
def split_alignments(s, d):
    sa = F.concat(F.lit("chr1,"), (F.col("pos") + 101).cast("string"), F.lit(",-,30M10S,60,1;chr1,"), (F.col("pos") + 1).cast("string"), F.lit(",+,10M30S,60,0;"))
    r = fx.reads(s, d).withColumn("parts", shapes.in_read_order(shapes.split_alignments(sa)))
    return r.groupBy("tid").agg(F.max(F.size("parts")).alias("parts"), F.min(F.col("parts")[0]["pos"]).alias("first_pos"), F.max(F.col("parts")[1]["pos"]).alias("second_pos"), F.max(F.col("parts")[0]["cigar"]).alias("first_cigar"), F.count("*").alias("n"))


@query("trimmed_spans", f"with {fx.READS}, t as (select tid, pos + ln as lo, pos + rlen - 1 - mapq as hi from reads) select tid, count(*) as n, cast(sum(hi - lo + 1) as bigint) as bases from t where lo <= hi group by tid")
def trimmed_spans(s, d):
    t = fx.reads(s, d).withColumn("span", shapes.trimmed_span(F.col("pos"), F.col("rlen"), F.col("ln"), F.col("mapq"))).where("span is not null")
    return t.groupBy("tid").agg(F.count("*").alias("n"), F.sum(F.expr("span.hi - span.lo + 1")).alias("bases"))


@query("expand_qualities", f"with {fx.SITES} select tid, p, {', '.join(f'cast(case when c{k} > 0 then {k} + 10 else 0 end as bigint) as bq{k}' for k in range(8))} from sites")
def expand_qualities(s, d):
    c = pileup.counts_array()
    dense = F.filter(F.transform(c, lambda x, i: F.when(x > 0, i + 10)), lambda x: x.isNotNull())
    full = shapes.expand_qualities(F.col("counts"), F.col("dense"), 20)
    m = _sites(s, d).withColumns({"counts": c, "dense": dense}).withColumn("full", full)
    return m.select("tid", "p", *[F.col("full")[k].cast("bigint").alias(f"bq{k}") for k in range(8)])


@query("human_sizes", "select n_name as name, printf('%.2f Kb', (n_nationkey + 1) * 7.5e0) as size, cast((n_nationkey % 3) * 86400 + n_nationkey * 3600 + 61 as bigint) as seconds, cast((n_nationkey + 1) * 1048576 as bigint) as bytes, '@RG' || chr(9) || 'ID:' || n_nationkey || chr(9) || 'BC:' || n_name as rg, 'out/' || n_name || '.bam' as path from nation")
def human_sizes(s, d):
    n, k = fx.table(s, d, "nation"), F.col("n_nationkey")
    clock = F.concat((k % 3).cast("string"), F.lit("-"), k.cast("string"), F.lit(":1:1"))
    return n.select(F.col("n_name").alias("name"), shapes.human_size((k + 1) * 7500).alias("size"), shapes.seconds_of(clock).alias("seconds"), shapes.bytes_of(F.concat(k + 1, F.lit("m"))).alias("bytes"), shapes.read_group(ID=k, SM=F.lit(None), BC=F.col("n_name")).alias("rg"), shapes.fill_template(F.lit("out/@BARCODE.bam"), barcode=F.col("n_name")).alias("path"))


@query("sort_check", f"with {fx.READS}, x as (select *, lag(pos) over (partition by tid order by k1, k2, k3, ln, qty, sd, pos) as before from reads) select tid, count(*) as unsorted from x where before > pos group by tid")
def sort_check(s, d):
    return shapes.out_of_order(fx.reads(s, d), ("k1", "k2", "k3", "ln", "qty", "sd", "pos")).groupBy("tid").agg(F.count("*").alias("unsorted"))


@query("filter_table", f"with {fx.SITES}, {SF} select unnest(string_split(filter, ';')) as reason, count(*) as n from flt where filter <> 'PASS' group by 1 union all select 'All', count(*) from flt union all select 'PASS', count(*) from flt where filter = 'PASS'")
def filter_table(s, d):
    return stats.filter_table(_filtered(s, d))


@query("stats_json", f"with {fx.READS}, t as (select {REASON} as reason, count(*) as reads, cast(sum(rlen) as bigint) as bases from reads group by 1) select reason, reads, bases from t")
def stats_json(s, d):
    """SNK-7, SRC-27: the document as JSON text, read again and opened."""
    one = read_filter_cascade(s, d).agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("reason", F.struct("reads", "bases")))).alias("filterStats"))).alias("value"))
    back = one.select(F.from_json("value", "filterStats map<string,struct<reads:bigint,bases:bigint>>").alias("j"))
    return back.select(F.explode("j.filterStats").alias("reason", "v")).select("reason", "v.reads", "v.bases")


@query("contig_sizes", "select n_name as name, (n_nationkey * 7919000) % 60000000 + 1000 as len, n_name || chr(9) || ((n_nationkey * 7919000) % 60000000 + 1000) as line from nation where (n_nationkey * 7919000) % 60000000 + 1000 >= 20000000 and n_regionkey <> 2")
def contig_sizes(s, d):
    """SNK-12, FLT-13."""
    c = fx.table(s, d, "nation").where("n_regionkey <> 2").select(F.col("n_name").alias("name"), ((F.col("n_nationkey").cast("bigint") * 7919000) % 60000000 + 1000).alias("len")).where("len >= 20000000")
    return c.withColumn("line", F.concat_ws("\t", "name", F.col("len").cast("string")))
