"""Known variants: BED, VCF and refsnp JSON; metadata tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REFSNP = (
    "refsnp_id string, primary_snapshot_data struct<placements_with_allele:array<struct<is_ptlp:boolean,alleles:array<struct<allele:struct<spdi:struct<"
    "seq_id:string,position:bigint,deleted_sequence:string,inserted_sequence:string>>>>>>,allele_annotations:array<struct<frequency:array<struct<"
    "study_name:string,allele_count:bigint,total_count:bigint,observation:struct<deleted_sequence:string,inserted_sequence:string>>>>>>"
)


def kind_of(first_line):
    """SRC-17: format by the first line."""
    return F.when(first_line.startswith("{"), "JSON").when(first_line.startswith("##fileformat=VCF"), "VCF").otherwise("BED")


def from_bed(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-14: single-base entries, pos = stop (1-based); track lines carry no entry."""
    f = F.split(F.col(column), "\t")
    return df.where(~F.col(column).startswith("track") & (F.size(f) > 4)).select(f[0].alias("contig"), f[1].cast("bigint").alias("start"), f[2].cast("bigint").alias("pos"), f[3].alias("rs")).where("pos - start = 1").drop("start")


def from_vcf(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-15: single-base REF and ALT."""
    f = F.split(F.col(column), "\t")
    return df.where(~F.col(column).startswith("#")).where((F.length(f[3]) == 1) & (F.length(f[4]) == 1)).select(f[0].alias("contig"), f[1].cast("bigint").alias("pos"), f[2].alias("rs"))


def from_json(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-16, PRJ-27: contig, 1-based pos, rs and folded allele frequency summed over studies, per object with a single-base change."""
    j = df.select(F.from_json(F.col(column), REFSNP).alias("j")).select("j.refsnp_id", "j.primary_snapshot_data.*")
    place = F.get(F.filter("placements_with_allele", lambda p: p["is_ptlp"]), 0)
    spdi = F.get(F.filter(F.transform(place["alleles"], lambda a: a["allele"]["spdi"]), lambda s: (s["deleted_sequence"] != s["inserted_sequence"]) & (F.length(s["deleted_sequence"]) == 1) & (F.length(s["inserted_sequence"]) == 1)), 0)
    found = F.filter(F.flatten(F.transform("allele_annotations", lambda a: a["frequency"])), lambda f: (f["observation"]["deleted_sequence"] != f["observation"]["inserted_sequence"]) & (f["allele_count"] <= f["total_count"]) & (f["total_count"] > 0))
    total = lambda k: F.aggregate(found, F.lit(0).cast("bigint"), lambda s, f: s + f[k])
    z = total("allele_count") / total("total_count")
    return j.withColumn("spdi", spdi).where("spdi is not null").select(F.col("spdi.seq_id").alias("contig"), (F.col("spdi.position") + 1).alias("pos"), F.concat(F.lit("rs"), F.col("refsnp_id")).alias("rs"), F.when(total("total_count") > 0, F.least(z, 1 - z)).alias("maf"))


def canonical(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """PRJ-26, SRC-21, JON-11: contigs by alias lines (canonical first); unknown ones go. An alias table is a few names a contig."""
    f = F.split(F.col("value"), "\t")
    pairs = aliases.select(f[0].alias("canonical"), F.explode(f).alias("alias")).distinct()
    return df.join(pairs, F.col("contig") == F.col("alias")).withColumn("contig", F.col("canonical")).drop("canonical", "alias")


#: Header aliases of sample tables, lower case without blanks and underscores.
ALIASES = {
    "samplebarcode": "barcode", "sample": "barcode", "barcode": "barcode", "dataset": "dataset", "fileid": "dataset", "fli": "dataset", "samplename": "sample_name", "name": "sample_name",
    "library": "library", "librarybarcode": "library", "file": "file", "filename": "file", "file1": "file1", "end1": "file1", "file2": "file2", "end2": "file2", "end": "end", "fileend": "end",
    "centre": "centre", "center": "centre", "platform": "platform", "description": "description",
}


def normalise_metadata(df: DataFrame) -> DataFrame:
    """SRC-23, FLT-15: known header names; a repeated one raises; datasets with conflicting barcodes raise when read."""
    names = [(c, ALIASES.get(c.lower().replace(" ", "").replace("_", ""))) for c in df.columns]
    known = [n for _, n in names if n]
    if len(known) != len(set(known)):
        raise ValueError("a column is given twice")
    for need in ("barcode", "dataset"):
        if need not in known:
            raise ValueError(f"no {need} column")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names if n])


def selected_names(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-20: distinct names of a list of selected variants: the first word of a line, without a leading rs; empty lines have none."""
    word = F.regexp_extract(column, r"^\s*(\S+)", 1)
    return df.select(F.regexp_replace(word, "^rs", "").alias("name")).where(word != "").distinct()


LIMS = "objects array<struct<flowcell_name:string,lane_number:bigint,index_name:string,passfail:string,sample_barcode:string,library_barcode:string>>"


def lims_datasets(df: DataFrame, column: str = "value") -> DataFrame:
    """SRC-24: datasets of JSON documents (one a row): flowcell, lane and index make the name, lane 0 the other one; those that did not pass go, one without a name raises."""
    x = df.select(F.explode(F.from_json(column, LIMS)["objects"]).alias("x")).where("x is not null").select("x.*")
    named = F.col("flowcell_name").isNotNull() & F.col("lane_number").isNotNull() & F.col("index_name").isNotNull()
    lane = F.concat_ws("_", "flowcell_name", F.col("lane_number").cast("string"))
    dataset = F.when(named, F.concat(lane, F.lit("_"), "index_name")).otherwise(F.raise_error(F.lit("an object without flowcell, lane or index")).cast("string"))
    out = x.select(dataset.alias("dataset"), F.concat(lane, F.lit("_0")).alias("alternative"), F.col("sample_barcode").alias("barcode"), F.col("library_barcode").alias("library"), "passfail")
    return out.where("passfail = 'pass'").drop("passfail")


def conflicts(meta: DataFrame) -> DataFrame:
    return meta.groupBy("dataset").agg(F.count_distinct("barcode").alias("barcodes")).where("barcodes > 1")


def datasets_by_barcode(meta: DataFrame) -> DataFrame:
    """JON-14."""
    return meta.groupBy("barcode").agg(F.count_distinct("dataset").alias("datasets"), F.min("dataset").alias("first_dataset"), F.max("dataset").alias("last_dataset"))
