"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source is wanted target / size times, at most twice. The whole part is taken for sure; the fractions are rounded together: two
fractional documents meet, and mass moves between them at random, so that expectations hold, until one of them is integral. Mass is counted in words (a
document's share times its size), so a source's words never change and at most one document stays fractional; that one goes to the
nearer side, so a source misses its target by half a document at most.

The meetings form a reduction tree: every source is dealt into groups of bounded size by hash, a group leaves at most one residual, residuals are
grouped again by a fixed fan-in, and so on until a source has one. Each level is one aggregation; nothing is gathered in one task but a group.

Only DataFrame functions are used. Random numbers are hashes of document and level, so reruns agree.

Defined results: null texts have size 0 and are taken 0 times; a null source is a source of its own, last in order; rows that are repeated are
told apart by a running number and rounded on their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Documents of a first group about, and residuals that meet at a later level.
GROUP, FAN_IN = 128, 64
#: Rows that agree in id, source and size are numbered in so many parts.
PARTS = 4096
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def n_words(text):
    """Number of runs of characters other than the six ASCII blanks."""
    return F.when(text.isNull() | (F.length(text) == 0), F.lit(0)).otherwise(F.regexp_count(text, F.lit(NOT_SPACE))).cast("long")


def targets(sources: DataFrame, percent: int = 150, most: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size) with ``target``: shares of ``percent`` of all sizes by weight, none above ``most`` times its size.

    What is cut off is shared again by weight until none is above: that is target = min(most * size, level * weight) for the level that
    uses everything up. Sources sorted by most * size / weight reach their limit in turn, so the level follows from running sums.
    The table has one row a source, so its one-partition windows see a catalogue, not documents.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("limit", F.col("source_size") * float(most))
    by = W.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    s = s.withColumn("goal", F.least(F.sum("source_size").over(every) * (percent / 100.0), F.sum("limit").over(every)))
    # if this source and all after it are below their limits, the level is this
    s = s.withColumn("level", (F.col("goal") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    fits = F.col("level") * F.col("w") <= F.col("limit")
    s = s.withColumn("at", F.min(F.when(fits, F.struct(F.col("limit") / F.col("w"), "level"))).over(every)["level"])
    return s.select("source", "source_size", F.coalesce(F.least("limit", F.col("at") * F.col("w")), F.col("limit")).alias("target"))


def _meet(rows, level: int, seed: int):
    """Fold the members of a group: struct(kept: residual or null, done: array of (key, copies)).

    ``rows`` is an array of struct(key, n, x): document key, size, fractional copies.
    """
    one = "struct<key:string,n:double,x:double>"
    kind = f"struct<rest:{one},done:array<struct<key:string,copies:int>>>"
    start = F.lit(None).cast(one)

    def result(rest, done):
        return F.struct(rest.cast(one).alias("rest"), done.alias("done")).cast(kind)

    def out(key, copies):
        return F.struct(key.alias("key"), F.lit(copies).cast("int").alias("copies"))

    def step(acc, y):
        a = acc["rest"]
        # masses in words; u: room of a upwards or of y downwards, v: the other way round
        ma, my = a["n"] * a["x"], y["n"] * y["x"]
        u = F.least(a["n"] - ma, my)
        v = F.least(ma, y["n"] - my)
        r = F.pmod(F.xxhash64(a["key"], y["key"], F.lit(level), F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
        up = r < v / (u + v)
        na, ny = F.when(up, ma + u).otherwise(ma - v), F.when(up, my - u).otherwise(my + v)
        tiny = 1e-9
        a_done = (na <= tiny * a["n"]) | (na >= a["n"] * (1 - tiny))
        y_done = (ny <= tiny * y["n"]) | (ny >= y["n"] * (1 - tiny))
        fa = F.struct(a["key"].alias("key"), (na >= a["n"] * 0.5).cast("int").alias("copies"))
        fy = F.struct(y["key"].alias("key"), (ny >= y["n"] * 0.5).cast("int").alias("copies"))
        ra = F.struct(a["key"].alias("key"), a["n"].alias("n"), (na / a["n"]).alias("x"))
        ry = F.struct(y["key"].alias("key"), y["n"].alias("n"), (ny / y["n"]).alias("x"))
        done = F.concat(acc["done"], F.when(a_done & y_done, F.array(fa, fy)).when(a_done, F.array(fa)).otherwise(F.array(fy)))
        rest = F.when(a_done & y_done, start).when(a_done, ry).otherwise(ra)
        return F.when(a.isNull(), result(y, acc["done"])).otherwise(result(rest, done))

    return F.aggregate(rows, result(start, F.array().cast("array<struct<key:string,copies:int>>")), step)


def mix(docs: DataFrame, percent: int = 150, seed: int = 17, group: int = GROUP, fan_in: int = FAN_IN) -> DataFrame:
    """One row a row of ``docs``: doc_id, size, source_size, target, copies, taken."""
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size"))
    # the sizes are counted once: what follows reads these slim rows again and again
    slim = common.stored(slim)
    # rows that agree in id, source and size are told apart by a number; only those go through a window, in parts
    alike = ["doc_id", "source", "size"]
    again = slim.groupBy(*alike).agg(F.count("*").alias("c")).where("c > 1").select(*[F.col(c).alias(f"{c}2") for c in alike])
    same = F.lit(True)
    for c in alike:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}2"))
    part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).alias("part")
    some = common.stored(slim.join(again, same, "left_semi").select(*alike, part))
    some = some.withColumn("no", F.row_number().over(W.partitionBy(*alike, "part").orderBy(F.lit(1))))
    slim = common.stored(slim.join(again, same, "left_anti").select(*alike, F.lit("").alias("no")).unionByName(some.select(*alike, F.concat_ws("/", "part", "no").alias("no"))))
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    goal = targets(sources.select("source", "source_size"), percent).withColumnRenamed("source", "source2")
    known = sources.join(goal.drop("source_size"), F.col("source").eqNullSafe(F.col("source2"))).drop("source2").withColumnRenamed("source", "source2")
    rows = slim.join(known, F.col("source").eqNullSafe(F.col("source2"))).drop("source2")
    wanted = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.col("target") / F.col("source_size")).otherwise(0.0)
    # digits first, the source last: whatever it holds, two rows never have one key
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    key = F.concat(text_of("doc_id"), F.lit("|"), F.col("size").cast("string"), F.lit("|"), "no", F.lit("|"), F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), "source")))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "source_rows", key.alias("key"), F.floor(wanted + 1e-12).cast("int").alias("whole"), wanted.alias("wanted"))
    rows = rows.withColumn("x", F.greatest(F.lit(0.0), F.col("wanted") - F.col("whole")))
    open_ = rows.where(F.col("x") > 1e-12)
    n_groups = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / group)).cast("long")
    member = F.struct("key", F.col("size").cast("double").alias("n"), "x")
    level_rows = open_.select("source", F.pmod(F.xxhash64("key", F.lit(seed)), n_groups).alias("g"), n_groups.alias("left"), member.alias("m"))
    # a group has about ``group`` members whatever a source's size, so the array stays small
    most = sources.agg(F.max("source_rows")).first()[0] or 0
    decided, level = None, 0
    n_left = -(-most // group)
    while True:
        folded = level_rows.groupBy("source", "g", "left").agg(F.array_sort(F.collect_list("m")).alias("ms")).select("source", "g", "left", _meet(F.col("ms"), level, seed).alias("f"))
        folded = common.stored(folded)
        done = folded.select(F.explode("f.done").alias("d")).select("d.key", "d.copies")
        decided = done if decided is None else decided.unionByName(done)
        rest = folded.where(F.col("f.rest").isNotNull())
        if n_left <= 1:
            break
        left = F.greatest(F.lit(1), F.ceil(F.col("left") / fan_in)).cast("long")
        level_rows = rest.select("source", F.floor(F.col("g") / fan_in).alias("g"), left.alias("left"), F.col("f.rest").alias("m"))
        n_left, level = -(-n_left // fan_in), level + 1
    last = F.col("f.rest.x") >= 0.5
    decided = decided.unionByName(rest.select(F.col("f.rest.key").alias("key"), last.cast("int").alias("copies")))
    out = rows.join(decided.withColumnRenamed("key", "key2"), F.col("key") == F.col("key2"), "left")
    out = out.withColumn("copies", F.col("whole") + F.coalesce("copies", F.lit(0)))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (up to twice)."""
    taken = mix(docs).where(F.col("copies") > 0).select(F.col("doc_id").alias("id2"), F.col("source").alias("source2"), F.col("size").alias("size2"), "copies")
    taken = taken.groupBy("id2", "source2", "size2").agg(F.sort_array(F.collect_list("copies"), asc=False).alias("copies"))
    by = W.partitionBy("doc_id", "source", "size2").orderBy("text")
    given = docs.withColumn("size2", n_words(F.col("text").cast("string")))
    joined = given.join(taken.withColumnRenamed("size2", "size3"), (F.col("doc_id").eqNullSafe(F.col("id2"))) & F.col("source").eqNullSafe(F.col("source2")) & (F.col("size2") == F.col("size3")))
    joined = joined.withColumn("no", F.row_number().over(by)).where(F.size("copies") >= F.col("no"))
    copies = F.array_repeat(F.lit(1), F.element_at("copies", F.col("no").cast("int")))
    return joined.select(*docs.columns, F.explode(copies).alias("copy")).drop("copy")
