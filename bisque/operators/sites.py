"""Called sites: filters, context, CpG status, known variants, SNP tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import shapes

TILE = 1 << 20

#: Channels of a heterozygote's two alleles; A/G and C/T leave out what conversion can make of the other allele.
HET_CHANNELS = {1: ((1, 5, 7), (0, 4)), 2: ((2, 6), (0,)), 3: ((3, 7), (0, 4)), 5: ((2, 6, 4), (1, 5, 7)), 6: ((3,), (1, 5)), 8: ((3, 7), (2, 6, 4))}


def mac1() -> Column:
    """One read at most for either allele of a heterozygote, over gt and c0 .. c7."""
    few = lambda ch: sum((F.col(f"c{k}") for k in ch), F.lit(0)) <= 1
    out = F.lit(False)
    for g, (x, y) in HET_CHANNELS.items():
        out = out | (F.coalesce(F.col("gt") == g, F.lit(False)) & (few(x) | few(y)))
    return out


def site_filters(df: DataFrame, min_phred: int = 20, min_qd: int = 2, max_fs: int = 60, min_mq: int = 40) -> DataFrame:
    """FLT-6, PRJ-12, PRJ-14 over (phred, dp, fs, mq, gt, c0 .. c7): quality by depth and the filter string; mac1 where no other filter fires."""
    qd = F.when(F.col("dp") > 0, F.expr("phred div dp")).otherwise(F.col("phred").cast("bigint"))
    df = df.withColumn("qd", qd)
    marks = [F.when(F.col("phred") < min_phred, "q20"), F.when(F.col("qd") < min_qd, "qd2"), F.when(F.col("fs") > max_fs, "fs60"), F.when(F.col("mq") < min_mq, "mq40")]
    text = F.concat_ws(";", *marks)
    return df.withColumn("filter", F.when(text != "", text).when(mac1(), "mac1").otherwise("PASS"))


def reported(gt: Column, ref: Column, selected: Column, all_positions: bool = False) -> Column:
    """FLT-5: whether a site is put out: not AA on A or TT on T (ref 0..3), unless a selected known variant is there or all are wanted."""
    plain = (gt == 0) & (ref == 0) | (gt == 9) & (ref == 3)
    return F.lit(all_positions) | F.coalesce(selected, F.lit(False)) | ~F.coalesce(plain, F.lit(False))


def context(df: DataFrame, column: str, out: str, reach: int = 2, missing: str = "N") -> DataFrame:
    """WIN-3, WIN-4: the bases at p - reach .. p + reach as text; positions without a row are ``missing``.

    Neighbours are found by shifted copies of the row's own key: each row is sent to the positions it is seen from and one aggregation per
    position puts them in order. The partition key is (tid, position), so few contigs are no hot partitions.
    """
    shifted = df.select("tid", F.col("p").alias("q"), F.col(column).alias("b"), F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("o"))
    seen = shifted.select("tid", (F.col("q") + F.col("o")).alias("p"), (-F.col("o")).alias("o"), "b")
    own = F.max(F.when(F.col("o") == 0, F.lit(1)))
    cells = [F.coalesce(F.max(F.when(F.col("o") == k, F.col("b"))), F.lit(missing)) for k in range(-reach, reach + 1)]
    return seen.groupBy("tid", "p").agg(own.alias("own"), F.concat(*cells).alias(out)).where("own = 1").drop("own")


def cpg_state(left: Column, right: Column) -> Column:
    """PRJ-16: state of neighbouring genotypes (null: not called)."""
    has = lambda g, codes_: g.isin(*codes_)
    c, g = has(left, (1, 4, 5, 6)), has(right, (2, 5, 7, 8))
    both = F.when((left == 4) & (right == 7), 4).when(c & g, 3).when(c | g, 2).otherwise(0)
    return F.when(left.isNull() & right.isNull(), 0).when(left.isNull(), g.cast("int")).when(right.isNull(), c.cast("int")).otherwise(both)


def with_neighbours(df: DataFrame, columns: tuple) -> DataFrame:
    """Columns of the rows at p - 1 and p + 1 (prev_*, next_*), by lag and lead inside tiles with a halo of one position.

    A contig is cut into tiles, and rows at a tile's edge are sent to the neighbour tile as well, so one contig is many partitions.
    """
    tile = F.floor(F.col("p") / TILE)
    edge = F.when(F.col("p") % TILE == 0, F.array(tile, tile - 1)).when(F.col("p") % TILE == TILE - 1, F.array(tile, tile + 1)).otherwise(F.array(tile))
    rows = df.withColumn("tile", F.explode(edge))
    by = W.partitionBy("tid", "tile").orderBy("p")
    out = rows.withColumns({"_pp": F.lag("p").over(by), "_np": F.lead("p").over(by)} | {f"prev_{c}": F.lag(c).over(by) for c in columns} | {f"next_{c}": F.lead(c).over(by) for c in columns})
    for c in columns:
        out = out.withColumns({f"prev_{c}": F.when(F.col("_pp") == F.col("p") - 1, F.col(f"prev_{c}")), f"next_{c}": F.when(F.col("_np") == F.col("p") + 1, F.col(f"next_{c}"))})
    return out.where(F.col("tile") == tile).drop("tile", "_pp", "_np")


def cpg_status(calls: DataFrame) -> DataFrame:
    """Site value: the greater state of (p - 1, p) and (p, p + 1), shown as . ? N H Y."""
    n = with_neighbours(calls, ("gt",))
    state = F.greatest(cpg_state(F.col("prev_gt"), F.col("gt")), cpg_state(F.col("gt"), F.col("next_gt")))
    return n.select("tid", "p", "gt", state.alias("state"), F.substring(F.lit(".?NHY"), state + 1, F.lit(1)).alias("cpg"))


def prepare_snps(snps: DataFrame, maf_limit: float, selected: DataFrame | None = None) -> DataFrame:
    """PRJ-25, AGG-27, FLT-12: valid rs names, lowest number per position, flag by frequency or list."""
    good = snps.where(F.col("rs").rlike("^rs[0-9]+$")).withColumn("number", F.substring("rs", 3, 20).cast("bigint"))
    one = good.groupBy("tid", "pos").agg(F.min(F.struct("number", "rs", "maf")).alias("s")).select("tid", "pos", F.col("s.rs").alias("rs"), F.col("s.number").alias("number"), F.col("s.maf").alias("maf"))
    chosen = F.coalesce(F.col("maf") >= maf_limit, F.lit(False))
    if selected is not None:
        one = one.join(selected.select(F.col("number").alias("n2")).distinct(), F.col("number") == F.col("n2"), "left")
        chosen = chosen | F.col("n2").isNotNull()
    return one.select("tid", "pos", "rs", "maf", chosen.alias("selected"))


def snp_lookup(sites: DataFrame, snps: DataFrame) -> DataFrame:
    """JON-4: sites (0-based p) with the known variant at the 1-based position p + 1."""
    s = snps.select(F.col("tid").alias("t2"), (F.col("pos") - 1).alias("p2"), "rs", "selected")
    return sites.join(s, (F.col("tid") == F.col("t2")) & (F.col("p") == F.col("p2")), "left").drop("t2", "p2")


#: BAF (alternative, reference) channels by allele: A/G pairs use only channels 0 and 2, C/T pairs only 1 and 3.
ALLELES = {"A": (0, 4), "C": (1, 5, 7), "G": (2, 4, 6), "T": (3, 7)}


def baf(df: DataFrame) -> DataFrame:
    """PRJ-24: B-allele frequency of heterozygotes, '-' without reads."""
    from ..functions.codes import GENOTYPES

    num = den = None
    for g, name in enumerate(GENOTYPES):
        x, y = name
        cx, cy = ((0,), (2,)) if name == "AG" else ((1,), (3,)) if name == "CT" else (ALLELES[x], ALLELES[y])
        s = lambda ch: sum((F.col(f"c{k}") for k in ch), F.lit(0))
        b, total = (s(cy), s(cx) + s(cy)) if x != y else (F.lit(0), s(cx))
        hit = F.col("gt") == g
        num, den = (F.when(hit, b), F.when(hit, total)) if num is None else (num.when(hit, b), den.when(hit, total))
    return df.withColumn("baf", F.when(den > 0, shapes.share_text(num, den)).otherwise("-"))
