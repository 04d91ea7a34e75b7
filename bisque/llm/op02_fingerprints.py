"""Document fingerprints: I-Match over randomised lexica.

Terms are words, known by 64-bit hashes. Document frequencies of the terms over the whole corpus give the lexicon: the terms whose frequency
lies in a band (neither noise nor stop words). As each of them is in a share ``low`` of the documents at least, there are at most 1 / ``low``
times as many as a document has distinct terms on average, however large the corpus. Tasks hold the lexicon as a filter of bits, sized by the
number of terms kept: at least SPARE bits a term up to 2^MAX_BITS in all, so about one term in SPARE outside the band is taken for one inside,
the same ones in every text.
A document keeps its distinct terms of the lexicon, sorted, and hashes them: once as they are, and once for each of several random subsets of
the lexicon. Subsets come in chains of falling rates (a quarter, a sixteenth, ...), so that texts of any length have subsets in which they hold
a term or two, and a changed part leaves many of the hashes alone. The likeness of two fingerprints is the share of equal hashes at the
sparsest rate at which at least half of the subsets hold a term of either text.

Only DataFrame functions are used; the next document is found by a range split on ids and joined by id, so no task sees the whole order.

Defined results: a null text counts as empty; a text with fewer than ``few`` terms in the lexicon uses all its terms; two texts without words
have equal fingerprints; repeated ids all get the same next document, of several texts with its id the smallest; a null id has an empty next document and likeness 0 to it; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

#: The filter: least and most bits (as powers of two; 16 MB at most), and bits a term.
MIN_BITS, MAX_BITS, SPARE = 12, 27, 64
#: Band of document frequencies, as shares of all documents.
LOW, HIGH = 0.0005, 0.25
CHAINS, LEVELS, RATE = 12, 5, 4
#: A text with fewer terms of the lexicon is fingerprinted by all its terms: short texts are told apart, but an edit of theirs moves more hashes.
FEW = 8
NO_TERM = 0


def terms(text: Column) -> Column:
    """Hashes of a text's distinct words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def band(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(term, df): the lexicon, with document frequencies; one partial and final aggregation over all documents."""
    found = docs.select(F.explode(terms(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    total = docs.agg(F.count("*").alias("n")).scalar()
    return found.where((F.col("df") >= total * low) & (F.col("df") <= total * high))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row: ``bits``, the filter of the band's terms, 64 bits to a number."""
    spark = docs.sparkSession
    kept = common.stored(band(docs, low, high))
    k = min(MAX_BITS, max(MIN_BITS, (SPARE * kept.count() - 1).bit_length()))
    slot = F.pmod("term", F.lit(1 << k)).cast("int").alias("slot")
    words = kept.select(slot).groupBy((F.col("slot") / 64).cast("int").alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, slot % 64)")).alias("b"))
    every = spark.range(1 << (k - 6)).select(F.col("id").cast("int").alias("k"))
    whole = every.join(words, F.col("k") == F.col("i"), "left").select("k", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "b"))), lambda x: x["b"]).alias("bits"))


def with_hashes(df: DataFrame, text: str, bits: Column, out: str, few: int = FEW) -> DataFrame:
    """``df`` with the array of a text's 1 + CHAINS * LEVELS hashes; 0 stands for no term."""
    all_, kept = f"{out}_all", f"{out}_kept"
    # a generator's output stays a plain column, so the optimiser puts the filter, used once, into the expression; as a column of its own it would
    # be copied into every row
    df = df.select("*", F.explode(F.array(terms(F.col(text)))).alias(all_)).withColumn("bits__", bits)

    def inside(t, words):
        slot = F.pmod(t, F.size(words).cast("long") * 64)
        return F.getbit(F.element_at(words, F.shiftright(slot, 6).cast("int") + 1), slot.cast("int") % 64) == 1

    df = df.withColumn(kept, F.transform(F.array("bits__"), lambda words: F.filter(F.col(all_), lambda t: inside(t, words)))[0]).drop("bits__")
    df = df.withColumn(kept, F.array_sort(F.when(F.size(kept) < few, F.col(all_)).otherwise(F.col(kept)))).drop(all_)
    mark = lambda l: F.when(F.size(l) == 0, F.lit(NO_TERM)).otherwise(F.xxhash64(l).bitwiseAND(F.lit(0xFFFF)).cast("int").bitwiseOR(F.lit(1 << 16)))
    parts = [F.array(mark(F.col(kept)))]
    before, names = None, [kept]
    for k in range(1, LEVELS + 1):
        name = f"{out}_{k}"
        names.append(name)

        def pick(l, j, k=k):
            return F.filter(l, lambda s: F.pmod(F.shiftright(F.xxhash64(s, j), 4 * k), F.lit(RATE)) == 0)

        if before is None:
            df = df.withColumn(name, F.transform(F.sequence(F.lit(0), F.lit(CHAINS - 1)), lambda j: pick(F.col(kept), j)))
        else:
            df = df.withColumn(name, F.transform(F.col(before), lambda l, j: pick(l, j)))
        parts.append(F.transform(F.col(name), mark))
        before = name
    return df.withColumn(out, F.concat(*parts)).drop(*names)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes at the sparsest rate that enough subsets speak at."""
    out = F.lit(0.0)
    # from the sparsest rate down; the densest entry, the whole lexicon, is the last resort
    cases = None
    for k in range(LEVELS, 0, -1):
        x, y = (F.slice(z, 2 + CHAINS * (k - 1), CHAINS) for z in (a, b))
        pairs = F.zip_with(x, y, lambda p, q: F.when((p == NO_TERM) & (q == NO_TERM), F.lit(None)).otherwise((p == q).cast("int")))
        spoken = F.filter(pairs, lambda v: v.isNotNull())
        n = F.size(spoken)
        share = F.aggregate(spoken, F.lit(0), lambda s, v: s + v) / n
        cases = F.when(2 * n >= CHAINS, share) if cases is None else cases.when(2 * n >= CHAINS, share)
    out = cases.otherwise((F.element_at(a, 1) == F.element_at(b, 1)).cast("double"))
    return F.coalesce(F.when(a == b, F.lit(1.0)).otherwise(out), F.lit(0.0))


def shown(a: Column) -> Column:
    """A fingerprint as text: four hex digits a hash, four dashes for none."""
    return F.array_join(F.transform(a, lambda v: F.when(v == NO_TERM, F.lit("----")).otherwise(F.lower(F.substring(F.hex(v), 2, 4)))), "")


def next_ids(docs: DataFrame, n_splits: int | None = None) -> DataFrame:
    """(id, next_id, need): the next greater id, after the last the first; need is the longest quarter of the id's texts.

    Ids are split into ranges at values that occur, so that the first id of every range is known; only the ranges' starts come to the driver.
    """
    slim = docs.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max(F.floor(F.length("text") / 4)).cast("int").alias("need"))
    n = docs.count() if n_splits is None else 0
    k = n_splits or min(4096, max(12, n // 100_000))
    at = docs.agg(F.min("doc_id").alias("low"), F.percentile_approx("doc_id", [i / k for i in range(1, k)], 10 * k).alias("starts")).first()
    starts = sorted({at["low"], *(at["starts"] or [])} - {None})
    if not starts:
        return slim.select("id", F.col("id").alias("next_id"), "need")
    if len(starts) > 1:
        # halving over the sorted starts: as many comparisons as the logarithm of their number
        def place(lo: int, hi: int):
            if hi - lo == 1:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(F.col("id") < F.lit(starts[mid]), place(lo, mid)).otherwise(place(mid, hi))

        after = lambda lo, hi: F.lit(starts[(lo + 1) % len(starts)]) if hi - lo == 1 else F.when(F.col("id") < F.lit(starts[(lo + hi) // 2]), after(lo, (lo + hi) // 2)).otherwise(after((lo + hi) // 2, hi))
        bucket, follower = place(0, len(starts)), after(0, len(starts))
    else:
        bucket, follower = F.lit(0), F.lit(starts[0])
    rows = slim.withColumn("bucket", bucket)
    return rows.select("id", F.coalesce(F.lead("id").over(W.partitionBy("bucket").orderBy("id")), follower).alias("next_id"), "need")


def fingerprint(docs: DataFrame, bits: Column | None = None, few: int = FEW) -> DataFrame:
    """``docs`` (doc_id, text) with its hashes as ``fp``, by the lexicon of the same documents unless one is given."""
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return with_hashes(base, "text", lexicon(docs).scalar() if bits is None else bits, "fp", few)


def edited_neighbours(docs: DataFrame) -> DataFrame:
    bits = common.stored(lexicon(docs)).scalar()
    # both joins below read the same shuffle of the texts by id: it is the same plan, so Spark runs it once
    known = docs.where(F.col("doc_id").isNotNull())
    base = fingerprint(known, bits)
    pairs = next_ids(known.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    heads = base.join(pairs, F.col("doc_id") == F.col("next_id")).select("id", F.struct(F.expr("left(text, need)").alias("head"), F.col("fp").alias("next_fp")).alias("h"))
    heads = heads.groupBy("id").agg(F.min("h").alias("h"))
    both = base.join(heads, F.col("doc_id") == F.col("id")).drop("id")
    alone = fingerprint(docs.where(F.col("doc_id").isNull()), bits)
    both = both.unionByName(alone.withColumn("h", F.lit(None).cast(both.schema["h"].dataType))).withColumn("n", F.length("text"))
    quarter = F.floor(F.col("n") / 4).cast("int")
    both = both.withColumn("edited", F.concat(F.left("text", F.col("n") - quarter), F.coalesce(F.left(F.col("h.head"), quarter), F.lit(""))))
    both = both.select("doc_id", "n", "fp", F.col("h.next_fp").alias("next_fp"), "edited")
    both = with_hashes(both, "edited", bits, "edited_fp")
    return both.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), shown(F.col("fp")).alias("fingerprint"),
        shown(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
