"""Alignments: filter cascade, islands, duplicates, mates, trimming, CIGAR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Tiles of 2^20 positions.
TILE_BITS = 20
ORDER = ("pos", "k1", "k2", "k3", "ln", "qty", "sd")
#: FLT-1, in order: the first that holds names the reason.
REASONS = (
    ("Unmapped", "unmapped"), ("QCFlags", "qcfail"), ("SecondaryAlignment", "secondary"), ("Duplicate", "dup"), ("LowMAPQ", "low_mapq"), ("SupplementaryAlignment", "supplementary"),
    ("NoPosition", "no_pos"), ("MateUnmapped", "mate_unmapped"), ("NoMatePosition", "no_mate_pos"), ("MismatchContig", "mate_other"), ("LargeInsertSize", "large_insert"),
)


def reason(mapq_threshold: int = 20, ignore_duplicates: bool = False, keep_duplicates: bool = False, keep_supplementary: bool = False) -> Column:
    """FLT-1: why a read is dropped, or Passed."""
    out = None
    for name, flag in REASONS:
        if flag == "dup" and (ignore_duplicates or keep_duplicates) or flag == "supplementary" and keep_supplementary:
            continue
        test = F.col("mapq") < mapq_threshold if flag == "low_mapq" else F.col(flag)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("Passed")


def filter_stats(reads: DataFrame) -> DataFrame:
    """AGG-3: reads and bases by reason."""
    return reads.groupBy("reason").agg(F.count("*").alias("reads"), F.sum("rlen").alias("bases"))


def coverage_islands(reads: DataFrame, gap: int = 2) -> DataFrame:
    """WIN-1: blocks of reads; a new one begins where a read starts beyond the furthest end so far + gap.

    A contig's reads are dealt by tiles of positions; what runs along the contig, the furthest end and the number of blocks before a tile, comes
    from one row a tile. Reads that ORDER does not tell apart are in one block, whichever comes first; a null length counts as 0.
    """
    r = reads.withColumns({"__tile": F.coalesce(F.shiftright(F.col("pos").cast("bigint"), TILE_BITS), F.lit(-1).cast("bigint")), "__end": F.col("pos") + F.coalesce("rlen", F.lit(0))})
    by = W.partitionBy("tid", "__tile").orderBy(*ORDER)
    tiles = W.partitionBy("tid").orderBy("__tile").rowsBetween(W.unboundedPreceding, -1)
    r = r.withColumn("__before", F.max("__end").over(by.rowsBetween(W.unboundedPreceding, -1)))
    r = _beside(r, r.groupBy("tid", "__tile").agg(F.max("__end").alias("__far")).select("tid", "__tile", F.max("__far").over(tiles).alias("__carried")))
    before = F.greatest("__before", "__carried")  # of what is known
    r = r.withColumn("__new", (before.isNull() | (F.col("pos") > before + gap)).cast("bigint"))
    r = r.withColumn("__no", F.sum("__new").over(by))
    r = _beside(r, r.groupBy("tid", "__tile").agg(F.sum("__new").alias("__blocks")).select("tid", "__tile", F.sum("__blocks").over(tiles).alias("__first")))
    return r.select(*reads.columns, (F.coalesce("__no", F.lit(0)) + F.coalesce("__first", F.lit(0))).alias("block_id"))


def _beside(rows: DataFrame, tiles: DataFrame) -> DataFrame:
    """``rows`` with the other columns of their tile's row."""
    t = tiles.withColumnsRenamed({"tid": "__tid", "__tile": "__of"})
    return rows.join(t, F.col("tid").eqNullSafe(F.col("__tid")) & (F.col("__tile") == F.col("__of"))).drop("__tid", "__of")


def island_table(reads: DataFrame, gap: int = 2) -> DataFrame:
    b = coverage_islands(reads, gap)
    return b.groupBy("tid", "block_id").agg(F.min("pos").alias("start"), F.max(F.col("pos") + F.col("rlen")).alias("stop"), F.count("*").alias("reads"))


def dedup(reads: DataFrame) -> DataFrame:
    """WIN-2: reads with equal start, strand, alignment and mate position; the first is kept.

    A missing mate position equals any: such a read is a duplicate of any earlier equal read, and the first with a position is one if an earlier
    read without was kept. Keys without the mate are partitions; within, what came before is two running values.
    """
    key = ("tid", "pos", "bs", "rlen")
    by = W.partitionBy(*key).orderBy(*ORDER)
    earlier = by.rowsBetween(W.unboundedPreceding, -1)
    same_mate = F.row_number().over(W.partitionBy(*key, "mate_pos").orderBy(*ORDER)) > 1
    any_before = F.count("*").over(earlier) > 0
    wild_before = F.coalesce(F.max(F.col("mate_pos").isNull().cast("int")).over(earlier), F.lit(0)) > 0
    return reads.withColumn("duplicate", F.when(F.col("mate_pos").isNull(), any_before).otherwise(same_mate | wild_before))


def mate_pairs(reads: DataFrame, max_template: int = 1000) -> DataFrame:
    """JON-1, JON-2, FLT-2: pairs of a template's reads in a block, their check and overlap clips; one window, one shuffle."""
    by = W.partitionBy("tid", "block_id", "k1").orderBy(*ORDER)
    r = reads.withColumn("no", F.row_number().over(by))
    nxt = lambda c: F.lead(c).over(by)
    r = r.withColumns({"pos2": nxt("pos"), "rlen2": nxt("rlen"), "ln2": nxt("ln")}).where("no = 1 and pos2 is not null")
    rev1, rev2 = F.col("ln") % 2 == 1, F.col("ln2") % 2 == 1
    end1, end2 = F.col("pos") + F.col("rlen") - 1, F.col("pos2") + F.col("rlen2") - 1
    template = F.greatest(end1, end2) - F.least("pos", "pos2") + 1
    check = F.when(rev1 == rev2, "BadOrientation").when(template >= max_template, "LargeInsertSize").when(rev1 & (F.col("pos2") > end1), "BadOrientation").otherwise("Passed")
    fr = ~rev1 & rev2
    clip2_start = F.when(fr & (end1 >= F.col("pos2")), F.least(end1 - F.col("pos2") + 1, F.col("rlen2"))).otherwise(0)
    clip1_start = F.when(~fr & (F.col("pos2") > F.col("pos")), F.col("pos2") - F.col("pos")).otherwise(0)
    clip2_end = F.when(~fr & (end2 > end1), F.least(end2 - end1, F.col("rlen2"))).otherwise(0)
    ok = check == "Passed"
    zero = lambda c: F.when(ok, c).otherwise(0).cast("bigint")
    return r.select("tid", "block_id", "k1", "pos", "pos2", "rlen", "rlen2", template.alias("template"), check.alias("check"), zero(clip1_start).alias("clip1_start"), zero(clip2_start).alias("clip2_start"), zero(clip2_end).alias("clip2_end"))


def base_stats(obs: DataFrame, left: int, right: int, bq_threshold: int, length: int) -> DataFrame:
    """AGG-4, WIN-10: bases by fate; trimming counts from the 5' end of the read."""
    cycle = F.when(F.col("rev") == 1, F.lit(length - 1) - F.col("i")).otherwise(F.col("i"))
    fate = F.when((cycle < left) | (cycle >= length - right), "Trimmed").when(F.col("q") < bq_threshold, "LowQuality").otherwise("Passed")
    return obs.groupBy(fate.alias("fate")).agg(F.count("*").alias("bases"))


CIGAR_PART = r"([0-9]+)([MIDNSHP=X])"


def cigar_ops(cigar: Column) -> Column:
    """PRJ-4: array of (len, op)."""
    n, op = F.regexp_extract_all(cigar, F.lit(CIGAR_PART), F.lit(1)), F.regexp_extract_all(cigar, F.lit(CIGAR_PART), F.lit(2))
    return F.zip_with(n, op, lambda a, b: F.struct(a.cast("bigint").alias("len"), b.alias("op")))


def cigar_length(ops: Column, kinds: str) -> Column:
    """PRJ-5: summed length of the operations of some kinds."""
    return F.aggregate(F.filter(ops, lambda x: F.lit(kinds).contains(x["op"])), F.lit(0).cast("bigint"), lambda s, x: s + x["len"])


def cigar_lengths(df: DataFrame) -> DataFrame:
    """Query length, query length with hard clips, reference length."""
    ops = cigar_ops(F.col("cigar"))
    return df.withColumns({"qlen": cigar_length(ops, "M=XIS"), "qlen1": cigar_length(ops, "M=XISH"), "reflen": cigar_length(ops, "M=XDN")})


def strand_from_tags(tags: Column) -> Column:
    """PRJ-1: bisulfite strand from the tags of the known aligners."""
    t = lambda k: F.element_at(tags, k)
    c2t = (t("XB") == "C") | t("XG").startswith("C") | (t("ZB") == "C") | t("ZS").startswith("+") | (t("YD") == "f")
    g2a = (t("XB") == "G") | t("XG").startswith("G") | (t("ZB") == "G") | t("ZS").startswith("-") | (t("YD") == "r")
    return F.when(c2t, "C2T").when(g2a, "G2A").otherwise("Unconverted")
