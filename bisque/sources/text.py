"""Text formats: SAM, FASTA, VCF, BED, contig lists; parsing is columns over lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


SAM_FIELDS = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
FLAG_BITS = {"paired": 1, "unmapped": 4, "mate_unmapped": 8, "reverse": 16, "secondary": 256, "qcfail": 512, "dup": 1024, "supplementary": 2048}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file or folder; Spark undoes gz, bz2, zst and lz4 by suffix (SRC-22)."""
    return spark.read.text(path)


def sam_records(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-1, SRC-3: alignments of SAM lines; pos 0-based, tags a map from name to value."""
    f = F.split(F.col(column), "\t")
    tags = F.map_from_entries(F.transform(F.slice(f, 12, 1 << 20), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 6, 1 << 20))))
    ints = {"flag", "pos", "mapq", "pnext", "tlen"}
    cols = [(f[i].cast("int") if n in ints else f[i]).alias(n) for i, n in enumerate(SAM_FIELDS)]
    out = df.where(~F.col(column).startswith("@")).select(*cols, tags.alias("tags"))
    return out.withColumns({"pos": F.col("pos") - 1, "pnext": F.col("pnext") - 1} | {k: F.col("flag").bitwiseAND(b) != 0 for k, b in FLAG_BITS.items()})


def sam_header(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-2: reference sequences of @SQ lines, with their other tags."""
    f = F.split(F.col(column), "\t")
    tags = F.map_from_entries(F.transform(F.slice(f, 2, 1 << 20), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 4, 1 << 20))))
    return df.where(F.col(column).startswith("@SQ\t")).select(F.element_at(tags, "SN").alias("name"), F.element_at(tags, "LN").cast("bigint").alias("len"), tags.alias("tags"))


def sequence_qualities(seq: Column, qual: Column) -> Column:
    """SRC-4: (base code, quality at most 62) per base; N gets quality 0."""
    def one(i):
        code = F.instr(F.lit("ACGT"), F.substring(seq, i, F.lit(1))) - 1
        q = F.least(F.ascii(F.substring(qual, i, F.lit(1))) - 33, F.lit(62))
        return F.struct(F.greatest(code, F.lit(0)).alias("base"), F.when(code < 0, 0).otherwise(q).alias("qual"))

    return F.when(F.length(seq) > 0, F.transform(F.sequence(F.lit(1), F.length(seq)), one)).otherwise(F.array().cast("array<struct<base:int,qual:int>>"))


def clean_names(name: Column) -> Column:
    """PRJ-28: bytes outside ! to ~, and @, become _."""
    return F.regexp_replace(name, "[^!-?A-~]", "_")


def enrich_header(header: DataFrame, contigs: DataFrame) -> DataFrame:
    """PRJ-29, JON-13: @SQ lines with LN, M5, AS and SP of the contig table where it has them."""
    c = contigs.select(F.col("name").alias("n2"), F.col("len").alias("len2"), "m5", "assembly", "species")
    j = header.join(c, F.col("name") == F.col("n2"), "left")
    tag = lambda k, v: F.concat(F.lit(k + ":"), v.cast("string"))
    old = lambda k: F.element_at("tags", k)
    rest = F.array_join(F.transform(F.array_sort(F.filter(F.map_entries("tags"), lambda e: ~e["key"].isin("SN", "LN", "M5", "AS", "SP"))), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), "\t")
    line = F.concat_ws("\t", F.lit("@SQ"), tag("SN", F.col("name")), tag("LN", F.coalesce("len2", "len")), tag("M5", F.coalesce(F.col("m5"), old("M5"))), tag("AS", F.coalesce(F.col("assembly"), old("AS"))), tag("SP", F.coalesce(F.col("species"), old("SP"))), F.when(rest != "", rest))
    return j.select("name", line.alias("line"))


def contig_md5(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-7: name, LN:, M5: [, AS:, SP:] lines."""
    f = F.split(F.col(column), "\t")
    tags = F.map_from_entries(F.transform(F.slice(f, 2, 64), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 4, 1 << 20))))
    return df.select(f[0].alias("name"), F.element_at(tags, "LN").cast("bigint").alias("len"), F.element_at(tags, "M5").alias("m5"), F.element_at(tags, "AS").alias("assembly"), F.element_at(tags, "SP").alias("species"))


def fasta_md5(parts: DataFrame) -> DataFrame:
    """SRC-6 over (name, no, line): bases of a contig in order, upper case, other bytes dropped, with length and MD5."""
    clean = F.upper(F.regexp_replace("line", "[^!-~]", ""))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", clean.alias("s")))), lambda x: x["s"]), "")
    return parts.groupBy("name").agg(whole.alias("seq")).select("name", F.length("seq").cast("bigint").alias("len"), F.md5("seq").alias("m5"))


def fasta_contigs(spark: SparkSession, path: str, tile: int = 1 << 20) -> DataFrame:
    """SRC-5: (name, len, no, bases) of a FASTA file, a row a tile; names end at white space. A record, one contig, is the unit of reading."""
    f = F.regexp_extract("value", r"^>?([^\s]*)[^\n]*\n?([\s\S]*)$", 2)
    rows = spark.read.text(path, lineSep="\n>").select(F.regexp_extract("value", r"^>?([^\s]*)", 1).alias("name"), F.regexp_replace(f, r"[^!-~]", "").alias("seq")).where("name <> ''")
    rows = rows.withColumn("len", F.length("seq").cast("bigint")).withColumn("no", F.explode(F.sequence(F.lit(0), F.expr(f"greatest(len - 1, 0) div {tile}").cast("int"))))
    return rows.select("name", "len", "no", F.substring("seq", F.col("no") * tile + 1, F.lit(tile)).alias("bases"))


def header_regions(header: DataFrame, reference: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """SRC-10: whole contigs of the header that are included (any, without a list) and not excluded; one that the reference has not, or not in this length, raises."""
    rows = header.select("name", "len")
    if include is not None:
        rows = rows.join(include.select("name").distinct(), "name", "left_semi")
    if exclude is not None:
        rows = rows.join(exclude.select("name").distinct(), "name", "left_anti")
    j = rows.join(reference.select(F.col("name").alias("n2"), F.col("len").alias("len2")), F.col("name") == F.col("n2"), "left")
    wrong = lambda why: F.raise_error(F.concat(F.lit(why), F.col("name"))).cast("bigint")
    stop = F.when(F.col("len2").isNull(), wrong("not in the reference: ")).when(F.col("len") != F.col("len2"), wrong("lengths differ: ")).otherwise(F.col("len") - 1)
    return j.select("name", F.lit(0).cast("bigint").alias("start"), stop.alias("stop"))


def bed_regions(df: DataFrame, contigs: DataFrame, column: str = "value") -> DataFrame:
    """SRC-8: regions of BED lines, stop inclusive and clamped to the contig; lines with fewer fields or an empty range raise."""
    f = F.split(F.trim(F.col(column)), "\t")
    rows = df.where(F.trim(F.col(column)) != "").select(f[0].alias("name"), F.get(f, 1).cast("bigint").alias("start"), F.get(f, 2).cast("bigint").alias("end"))
    c = contigs.select(F.col("name").alias("n2"), "len")
    bad = F.col("start").isNull() | F.col("end").isNull() | (F.col("start") >= F.col("end"))
    stop = F.when(bad, F.raise_error(F.concat(F.lit("bad region on "), F.col("name")))).otherwise(F.least(F.col("end"), F.col("len")) - 1)
    return rows.join(c, F.col("name") == F.col("n2")).select("name", "start", stop.cast("bigint").alias("stop"))


FORMAT = ("GT", "FT", "DP", "MQ", "GQ", "QD", "MC8", "CS")


def vcf_lines(sites: DataFrame) -> DataFrame:
    """SNK-1: text records of (chrom, p, id, ref, alt, qual, filter, cx, GT, FT, DP, MQ, GQ, QD, MC8 array, CS)."""
    sample = F.concat_ws(":", *[F.array_join(F.transform("MC8", lambda x: x.cast("string")), ",") if k == "MC8" else F.col(k).cast("string") for k in FORMAT])
    line = F.concat_ws("\t", "chrom", (F.col("p") + 1).cast("string"), F.coalesce("id", F.lit(".")), "ref", "alt", F.col("qual").cast("string"), "filter", F.concat(F.lit("CX="), F.col("cx")), F.lit(":".join(FORMAT)), sample)
    return sites.select(line.alias("value"))


def vcf_records(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-11, SRC-13: records with typed fields; INFO and FORMAT become maps; numbers not given (".") are null."""
    f = F.split(F.col(column), "\t")
    info = F.map_from_entries(F.transform(F.filter(F.split(f[7], ";"), lambda x: x != "."), lambda x: F.struct(F.substring_index(x, "=", 1), F.regexp_replace(x, "^[^=]*=?", ""))))
    fmt = F.map_from_arrays(F.split(f[8], ":"), F.split(f[9], ":"))
    return df.where(~F.col(column).startswith("#")).select(
        f[0].alias("chrom"), (f[1].cast("bigint") - 1).alias("p"), F.when(f[2] != ".", f[2]).alias("id"), f[3].alias("ref"), F.split(f[4], ",").alias("alts"), f[5].try_cast("int").alias("qual"), f[6].alias("filter"),
        F.element_at(info, "CX").alias("cx"), F.element_at(fmt, "GT").alias("GT"), F.element_at(fmt, "DP").try_cast("int").alias("DP"), F.element_at(fmt, "GQ").try_cast("int").alias("GQ"), F.element_at(fmt, "MQ").try_cast("int").alias("MQ"),
        F.transform(F.split(F.element_at(fmt, "MC8"), ","), lambda x: x.try_cast("int")).alias("MC8"),
    )


def complete_records(records: DataFrame) -> DataFrame:
    """FLT-7 over :func:`vcf_records`: records with an allele C or G, a context of five bases, all eight counts and a mapping quality."""
    alleles = F.concat(F.array("ref"), "alts")
    whole = (F.length("cx") == 5) & (F.size("MC8") == 8) & ~F.exists("MC8", lambda x: x.isNull()) & F.col("MQ").isNotNull()
    return records.where(F.exists(alleles, lambda a: a.isin("C", "G")) & F.coalesce(whole, F.lit(False)))


HEADER = (
    '##fileformat=VCFv4.2', '##FILTER=<ID=fail,Description="No sample passed">', '##FILTER=<ID=q20,Description="Quality below 20">', '##FILTER=<ID=qd2,Description="Quality by depth below 2">',
    '##FILTER=<ID=fs60,Description="Strand bias above 60">', '##FILTER=<ID=mq40,Description="RMS mapping quality below 40">', '##INFO=<ID=CX,Number=1,Type=String,Description="Reference context">',
)


def vcf_header(contigs: list[tuple], sample: str, benchmark: bool = True, date: str = "") -> str:
    """SNK-2: header text; contigs are (name, len, md5, assembly, species) with None for what is unknown."""
    rows = list(HEADER)
    if not benchmark:
        rows.insert(1, f"##fileDate({date})")
    for name, n, m5, assembly, species in contigs:
        extra = "".join(f",{k}={v}" for k, v in (("md5", m5), ("assembly", assembly), ("sp", f'"{species}"' if species else None)) if v)
        rows.append(f"##contig=<ID={name},length={n}{extra}>")
    return "\n".join([*rows, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample])]) + "\n"


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """SNK-3, SNK-4, SNK-10: rows in genome order; each part file is a range of it."""
    df.orderBy("tid", "p").write.csv(path, sep="\t", header=header, mode="overwrite")
