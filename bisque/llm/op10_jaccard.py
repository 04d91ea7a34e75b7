"""N-gram Jaccard join with set-relation skipping.

A document is the set of its distinct word n-grams, hashed to 64 bits. Equal sets are one class. Classes join exactly at a threshold p/q:

1. Peeling. A class of m grams that has m - ceil(m p / q) + 1 grams which no other class has can link with nothing. Grams are counted by a plain
   aggregation, so the counts are exact at any size; only grams from a fixed part of the hash range take part, which keeps the shuffle small.
2. Index. The classes that are left list their rarest grams (by exact counts among them; any order gives the same result), so many that two linked
   classes share one.
3. Answer-level skipping. A class is assigned to a similar one, its pivot: of those that share minima over independent hashes with it, the one that
   shares most with others. Only its difference D from the pivot is kept. A class that its pivot links has the pivot's answers and needs no
   comparison of its own; the others are compared with the classes of their pivot by |a xor b| = |Da| + |Db| - 2 |Da and Db|, in blocks of
   bounded size, and only the links of a spanning forest of a block are put out.
4. Index-level skipping, for classes of different pivots. A list is sorted by size and cut into blocks; a pair of blocks is skipped as a whole when
   its sizes and positions leave too little room for the overlap that a link takes. Lists of one pivot are not read at all. A long list is
   dealt into parts: classes outside its most frequent pivot meet all parts, the others only those classes.
5. Candidates are filtered in their list by parity bitmaps, whose distance never exceeds that of the sets, then decided on whole sets: first
   the nearest pair of two groups that are linked so far, then, where these did not link, all others.
6. Links are merged to components by rounds of least neighbours.

Nothing is capped or sampled: no link is lost, while groups of copies cost in proportion to their size.

Defined results: null, empty and blank texts have no grams, link with nothing and are components of their own; texts with fewer words than n are
one gram; rows with a repeated id are texts of their own, each with the least id of its component; an empty table gives an empty result; a row
without id takes part like any other and gets the least id of its component, null if none there has an id; columns of the input that clash with
the new ones are replaced.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KEYS = 6
#: Longer lists are dealt into parts of about BLOCK entries; members of a pivot that one task compares at once, and grams in their differences.
LONG, BLOCK, BLOCK_GRAMS = 1024, 1024, 1 << 20
#: Bits of a bitmap.
BITS = 1024
#: So many ids (8 bytes each) are broadcast at most.
SENT = 2_000_000
#: Bytes of text whose words are hashed at once; longer words are hashed on their own.
WINDOW, LONG_WORD = 1 << 18, 64
#: Odd multipliers for mixing hashes.
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * ODD[3]
        x = (x ^ (x >> np.uint64(29))) * ODD[4]
    return x ^ (x >> np.uint64(32))


def _powers(base: int) -> np.ndarray:
    out = np.empty(WINDOW, np.uint64)
    out[0] = 1
    k = 1
    while k < WINDOW:
        out[k : 2 * k] = out[: min(k, WINDOW - k)] * np.uint64(pow(base, k, 1 << 64))
        k *= 2
    return out


class Sets:
    """The sorted distinct gram hashes of texts.

    A word's hash is a sum of its bytes' codes times powers of an odd number, so one running sum over the bytes gives those of all words;
    the powers of the word's place are divided out. Words longer than LONG_WORD, where such sums could be made to collide, are hashed by xxh3.
    """

    def __init__(self, n: int):
        with np.errstate(over="ignore"):
            self.codes = mixed(np.arange(1, 257, dtype=np.uint64) * ODD[0])
            self.codes[65:91] = self.codes[97:123]  # A-Z as a-z
            self.up, self.down = _powers(int(ODD[1])), _powers(pow(int(ODD[1]), -1, 1 << 64))
        self.blank = np.zeros(256, bool)
        self.blank[[32, 9, 10, 11, 12, 13]] = True
        self.n = n

    def _window(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the words of a window; ``first`` marks bytes before which a text ends."""
        gap = self.blank[data]
        before, after = np.empty(len(data), bool), np.empty(len(data), bool)
        before[0], before[1:] = True, gap[:-1] | first[1:]
        after[-1], after[:-1] = True, gap[1:] | first[1:]
        start, stop = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
        size = stop - start
        if len(data) <= WINDOW:
            run = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.codes[data] * self.up[: len(data)], out=run[1:])
            words = (run[stop] - run[start]) * self.down[start]
        else:  # one word
            words = np.zeros(len(start), np.uint64)
        words = mixed(words ^ size.astype(np.uint64) * ODD[2])
        for i in np.flatnonzero(size > LONG_WORD):
            words[i] = xxhash.xxh3_64_intdigest(bytes(data[start[i] : stop[i]]).lower())
        return start, words

    def words(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of all words of texts that lie side by side, cut at ``off``."""
        first = np.zeros(len(data) + 1, bool)
        first[off] = True
        found, a = [], 0
        while a < len(data):
            b = min(a + WINDOW, len(data))
            if b < len(data):
                # back to the last place where no word runs on, else forth to the next
                at = np.flatnonzero(self.blank[data[a + 1 : b]] | first[a + 1 : b])
                if len(at):
                    b = a + 1 + int(at[-1])
                else:
                    while b < len(data) and not (self.blank[data[b]] or first[b]):
                        b += 1
            start, words = self._window(data[a:b], first[a:b])
            found.append((start + a, words))
            a = b
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        return np.concatenate([s for s, _ in found]), np.concatenate([w for _, w in found])

    def __call__(self, texts) -> list[np.ndarray]:
        """One array a text; ``texts`` is an Arrow array of strings."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        _, offsets, bytes_ = texts.buffers()
        off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(bytes_, np.uint8)[off[0] : off[-1]] if bytes_ is not None else np.empty(0, np.uint8)
        with np.errstate(over="ignore"):
            return self._grams(*self.words(data, off - off[0]), off - off[0])

    def _grams(self, start: np.ndarray, words: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        n, at = self.n, np.searchsorted(start, off)
        total = np.full(len(words), n, np.uint64)
        for i in range(n):
            ahead = np.zeros(len(words), np.uint64)
            ahead[: len(words) - i] = words[i:]
            total = mixed(total * ODD[0] + ahead)
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= n:
                g = np.sort(total[a : b - n + 1])
                new = np.empty(len(g), bool)
                new[0] = True
                np.not_equal(g[1:], g[:-1], out=new[1:])
                out.append(g[new])
            elif b > a:
                one = np.full(1, b - a, np.uint64)
                for w in words[a:b]:
                    one = mixed(one * ODD[0] + w)
                out.append(one)
            else:
                out.append(np.empty(0, np.uint64))
        return out


def signature(s: np.ndarray) -> int | None:
    """One number for a set; None for the empty one."""
    if not len(s):
        return None
    h = xxhash.xxh3_64_intdigest(s.tobytes())
    return h - (1 << 64) if h >> 63 else h


def prefix_length(n: int, p: int, q: int) -> int:
    """So many of the first grams of a set of n, in any order: two linked sets share one of them."""
    return n - -(-p * n // q) + 1 if n else 0


def prefix_sql(n: str, p: int, q: int) -> str:
    return f"({n} + 1 - ({p} * {n} + {q - 1}) div {q})"


def enough(na, nb, p: int, q: int):
    """The least overlap of linked sets of these sizes."""
    return -(-p * (na + nb) // (p + q))


def parities(s: np.ndarray) -> np.ndarray:
    """A bitmap: a bit is on if an odd number of grams falls on it. Two bitmaps never differ in more bits than their sets in grams."""
    on = np.bincount((mixed(s * ODD[5]) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(on.astype(np.uint8), bitorder="little").view(np.int64)


def list_pairs(n: np.ndarray, pos: np.ndarray, family: np.ndarray, p: int, q: int, block: int = 32) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs (as two arrays) of a list's entries, sorted by size, that may be linked and are of different families; blocks without any are skipped."""
    m, room = len(n), n - pos  # grams from this position on, this one included
    starts, out = range(0, m, block), []
    most = [int(room[s : s + block].max()) for s in starts]
    for x, s in enumerate(starts):
        e = min(s + block, m)
        for y, t in enumerate(starts[x:], x):
            if q * int(n[e - 1]) < p * int(n[t]):
                break  # sizes only grow from here
            if min(most[x], most[y]) < enough(int(n[s]), int(n[t]), p, q):
                continue
            f = min(t + block, m)
            ok = (q * n[s:e, None] >= p * n[None, t:f]) & (family[s:e, None] != family[None, t:f])
            ok &= np.minimum(room[s:e, None], room[None, t:f]) >= enough(n[s:e, None], n[None, t:f], p, q)
            if x == y:
                ok = np.triu(ok, 1)
            i, j = np.nonzero(ok)
            if len(i):
                out.append((i + s, j + t))
    return out


class Forest:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _over_sets(df: DataFrame, n: int, fields: str, give) -> DataFrame:
    """``df`` with the columns ``fields``: lists by name that ``give`` makes from a list of sets."""

    def make():
        sets = Sets(n)
        return lambda texts: give(sets(texts))

    return common.map_text(df, "text", fields, make, arrow=True)


def _low(share: float) -> np.uint64:
    return np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))


def _offers(docs: DataFrame, n: int, share: float) -> DataFrame:
    """(gram, sig): the grams below a share of the hash range, with the set that they are of."""
    top = _low(share)

    def give(found):
        return {"sig": list(map(signature, found)), "grams": [s[: np.searchsorted(s, top)].view(np.int64) for s in found]}

    return _over_sets(docs.select("text"), n, "sig long, grams array<bigint>", give).select(F.explode("grams").alias("gram"), "sig")


def _slim(docs: DataFrame, n: int, p: int, q: int, share: float) -> DataFrame:
    """(sig, m, low, more, keys, bits): the offered grams, as many of the next ones as a prefix may take, minima of independent hashes."""
    top = _low(share)

    def give(found):
        out = {c: [] for c in ("sig", "m", "low", "more", "keys", "bits")}
        for s in found:
            k = int(np.searchsorted(s, top))
            out["sig"].append(signature(s))
            out["m"].append(len(s))
            out["low"].append(s[:k].view(np.int64))
            out["more"].append(s[k : max(k, prefix_length(len(s), p, q))].view(np.int64))
            out["keys"].append([int(mixed(s * ODD[i]).min().view(np.int64)) for i in range(KEYS)] if len(s) else [])
            out["bits"].append(parities(s))
        return out

    return _over_sets(docs.select("text"), n, "sig long, m long, low array<bigint>, more array<bigint>, keys array<bigint>, bits array<bigint>", give).select("sig", "m", "low", "more", "keys", "bits")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the given ids (id), and those without id.

    Ids are counted: up to SENT of them go to the tasks as a table of fixed size at most, more are joined by a shuffle.
    """
    few = ids.count() <= SENT
    known = docs.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("id"), "left_semi")
    return known.unionByName(docs.where("doc_id is null"))


def _sets_of(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(sig, grams), a row a class of ``classes`` (sig, rep); the sets are made anew from the texts."""

    def give(found):
        return {"sig": list(map(signature, found)), "grams": [s.view(np.int64) for s in found]}

    ids = classes.select(F.col("rep").alias("id")).where("id is not null").distinct()
    sets = _over_sets(_texts_of(docs, ids).select("text"), n, "sig long, grams array<bigint>", give).select("sig", "grams")
    return sets.join(classes.select(F.col("sig").alias("sig2")), F.col("sig") == F.col("sig2"), "left_semi").dropDuplicates(["sig"])


def _entries(slim: DataFrame, p: int, q: int) -> DataFrame:
    """(token, sig, m, pos): the first grams of the classes, ordered by how many classes have them; grams of one class only are left out."""
    offers = slim.select("sig", F.explode("low").alias("token"))
    counts = offers.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").withColumnRenamed("token", "token2")
    common_ = offers.join(counts, F.col("token") == F.col("token2")).groupBy("sig").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("common"))
    k = F.expr(prefix_sql("m", p, q))
    rows = slim.select("sig", "m", F.size("low").cast("long").alias("offered"), "more", k.alias("k")).join(common_.withColumnRenamed("sig", "sig2"), F.col("sig") == F.col("sig2"), "left").drop("sig2")
    alone = F.col("offered") - F.coalesce(F.size("common"), F.lit(0))
    first = rows.select("sig", "m", "k", alone.alias("before"), F.posexplode("common").alias("i", "x")).select(F.col("x.token").alias("token"), "sig", "m", "k", (F.col("before") + F.col("i")).alias("pos"))
    later = rows.select("sig", "m", "k", "offered", F.posexplode("more").alias("i", "token")).select("token", "sig", "m", "k", (F.col("offered") + F.col("i")).alias("pos"))
    return first.unionByName(later).where("pos < k").select("token", "sig", "m", "pos")


def _candidates(entries: DataFrame, bits: DataFrame, p: int, q: int) -> DataFrame:
    """(a, b, apart) of different families and nodes that share a listed gram and may be linked as far as sizes, positions and bitmaps tell.

    ``entries``: token, sig, m, pos, family, node; ``bits``: sig, bits. ``apart`` is the distance of the bitmaps.
    """
    lists = entries.groupBy("token").agg(F.count("*").alias("length"), F.min("family").alias("x"), F.max("family").alias("y")).where("x <> y").select(F.col("token").alias("token2"), "length")
    rows = entries.join(lists, F.col("token") == F.col("token2")).drop("token2")
    rows = common.stored(rows)
    short = rows.where(F.col("length") <= LONG).select("token", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("role"), "m", "pos", "sig", "family", "node")
    # a long list: the classes outside its most frequent family (role 0) meet all of its classes (role 1), part by part
    long_ = rows.where(F.col("length") > LONG)
    families = long_.groupBy("token", "family", "length").agg(F.count("*").alias("c")).groupBy("token", "length").agg(F.max(F.struct("c", "family")).alias("top"))
    outside = F.col("length") - F.col("top.c")
    parts = families.select(F.col("token").alias("token2"), F.col("top.family").alias("top"), F.ceil(outside / BLOCK).cast("int").alias("n_i"), F.ceil(F.col("length") / BLOCK).cast("int").alias("n_j"))
    long_ = long_.join(parts, F.col("token") == F.col("token2"))
    i, j = F.pmod(F.xxhash64("sig"), F.col("n_i")).cast("int"), F.pmod(F.xxhash64("sig", F.lit(1)), F.col("n_j")).cast("int")
    left = long_.where("family <> top").select("token", i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_j") - 1)).alias("j"), F.lit(0).alias("role"), "m", "pos", "sig", "family", "node")
    right = long_.select("token", F.explode(F.sequence(F.lit(0), F.col("n_i") - 1)).alias("i"), j.alias("j"), F.lit(1).alias("role"), "m", "pos", "sig", "family", "node")
    dealt = short.unionByName(left).unionByName(right).join(bits.withColumnRenamed("sig", "sig2"), F.col("sig") == F.col("sig2")).drop("sig2")
    names = ["token", "i", "j", "role", "m", "pos", "sig", "family", "node"]

    def run(batches):
        import pyarrow as pa

        held = None  # the last list's entries so far: a short list, or a part of about 2 * BLOCK
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            maps = batch.column("bits")
            cols.append(maps.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(maps), BITS // 64))
            if held is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            cut = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            last = int(cut[-1]) if len(cut) else 0
            held = [c[last:] for c in cols]
            yield from pairs(cols, [0, *cut.tolist()], pa)
        if held is not None and len(held[0]):
            yield from pairs(held, [0, len(held[0])], pa)

    def pairs(cols, cuts, pa):
        out = []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if e - s < 2:
                continue
            _, _, _, role, m, pos, ids, family, node, maps = (c[s:e] for c in cols)
            for i, j in list_pairs(m, pos, family, p, q):
                met = (node[i] != node[j]) & ((role[i] == 2) | (role[i] != role[j]))
                i, j = i[met], j[met]
                apart = np.bitwise_count(maps[i] ^ maps[j]).sum(axis=1, dtype=np.int64)
                near = (p + q) * apart <= (q - p) * (m[i] + m[j])
                if near.any():
                    u, v = ids[i[near]], ids[j[near]]
                    out.append((np.minimum(u, v), np.maximum(u, v), apart[near]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["a", "b", "apart"])

    return dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "m", "pos", "sig", "role").mapInArrow(run, "a long, b long, apart long").distinct()


def _differences(docs: DataFrame, classes: DataFrame, slim: DataFrame, n: int) -> DataFrame:
    """(sig, m, pivot, pm, diff): a similar class of a class, its size, and the grams that only one of the two has; no row if none is near."""
    keyed = slim.select("sig", F.posexplode("keys").alias("i", "key"))
    met = keyed.groupBy("i", "key").agg(F.count("*").alias("c")).where("c > 1").select(F.col("i").alias("i2"), F.col("key").alias("key2"), "c")
    keyed = common.stored(keyed.join(met, (F.col("i") == F.col("i2")) & (F.col("key") == F.col("key2"))).select("sig", "i", "key", "c"))
    # the text that copies were made from shares more minima than any copy
    shares = keyed.groupBy("sig").agg(F.sum("c").alias("shares")).withColumnRenamed("sig", "sig2")
    shared = keyed.join(shares, F.col("sig") == F.col("sig2")).select("sig", "i", "key", "shares")
    top = shared.groupBy("i", "key").agg(F.max(F.struct("shares", "sig")).alias("top")).withColumnRenamed("i", "i2").withColumnRenamed("key", "key2")
    pivots = keyed.join(top, (F.col("i") == F.col("i2")) & (F.col("key") == F.col("key2"))).groupBy("sig").agg(F.max("top")["sig"].alias("pivot")).where("sig <> pivot")
    pivots = common.stored(pivots)
    members = _sets_of(docs, classes.join(pivots.select(F.col("sig").alias("s2")), F.col("sig") == F.col("s2"), "left_semi"), n)
    theirs = _sets_of(docs, classes.join(pivots.select("pivot"), F.col("sig") == F.col("pivot"), "left_semi"), n).select(F.col("sig").alias("p2"), F.col("grams").alias("pivot_grams"))
    mine = members.join(pivots.withColumnRenamed("sig", "s2"), F.col("sig") == F.col("s2")).drop("s2")
    diff = F.array_union(F.array_except("grams", "pivot_grams"), F.array_except("pivot_grams", "grams"))
    both = mine.join(theirs.hint("merge"), F.col("pivot") == F.col("p2")).select("sig", "pivot", F.size("grams").cast("long").alias("m"), F.size("pivot_grams").cast("long").alias("pm"), diff.alias("diff"))
    return both.where(F.size("diff") * 2 <= F.least("m", "pm"))


def _within_pivots(near: DataFrame, p: int, q: int) -> DataFrame:
    """(a, b): links between classes of one pivot, of a spanning forest of each pair of blocks.

    The classes that the pivot links (inner) are known to be linked through it. Only the others (outer) are compared, with all classes of the
    pivot: a block of outer ones meets every block, so what is copied grows with the number of outer ones.
    """
    inner = (p + q) * F.size("diff") <= (q - p) * (F.col("m") + F.col("pm"))
    members = near.select("pivot", "sig", "m", "diff", inner.alias("inner"))
    n_parts = lambda rows, grams: F.greatest(F.ceil(rows / BLOCK), F.ceil(grams / BLOCK_GRAMS)).cast("int")
    outer = (~F.col("inner")).cast("long")
    sizes = members.groupBy("pivot").agg(F.count("*").alias("rows"), F.sum(outer).alias("outer"), F.sum(F.size("diff").cast("long")).alias("grams"), F.sum(outer * F.size("diff")).alias("outer_grams"))
    sizes = sizes.where("outer > 0 and rows > 1").select(F.col("pivot").alias("pivot2"), n_parts(F.col("outer"), F.col("outer_grams")).alias("n_i"), n_parts(F.col("rows"), F.col("grams")).alias("n_j"))
    rows = members.join(sizes, F.col("pivot") == F.col("pivot2")).drop("pivot2")
    i, j = F.pmod(F.xxhash64("sig"), F.col("n_i")).cast("int"), F.pmod(F.xxhash64("sig", F.lit(1)), F.col("n_j")).cast("int")
    left = rows.where("not inner").select("pivot", i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_j") - 1)).alias("j"), F.lit(True).alias("asks"), "sig", "m", "diff", "inner")
    right = rows.select("pivot", F.explode(F.sequence(F.lit(0), F.col("n_i") - 1)).alias("i"), j.alias("j"), F.lit(False).alias("asks"), "sig", "m", "diff", "inner")

    def compare(pdf):
        import pandas as pd

        asks = pdf["asks"].to_numpy()
        asking, asked = pdf[asks], pdf[~asks]
        ids, m, inner = asked["sig"].to_numpy(), asked["m"].to_numpy(), asked["inner"].to_numpy()
        sizes = np.array([len(d) for d in asked["diff"]], np.int64)
        where = np.repeat(np.arange(len(asked)), sizes)
        flat = np.concatenate([np.asarray(d, np.int64) for d in asked["diff"]]) if len(asked) else np.empty(0, np.int64)
        by = np.argsort(flat, kind="stable")
        sorted_, where = flat[by], where[by]
        forest, out = Forest(), []
        known = ids[inner].tolist()
        for x in known[1:]:  # known through the pivot already
            forest.join(x, known[0])
        for sig, size, diff in zip(asking["sig"].tolist(), asking["m"].tolist(), asking["diff"], strict=True):
            diff = np.asarray(diff, np.int64)
            first, last = np.searchsorted(sorted_, diff, "left"), np.searchsorted(sorted_, diff, "right")
            hits = [where[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True) if b > a]
            shared = np.bincount(np.concatenate(hits), minlength=len(ids)) if hits else np.zeros(len(ids), np.int64)
            linked = (p + q) * (len(diff) + sizes - 2 * shared) <= (q - p) * (size + m)
            for x in ids[linked].tolist():
                if x != sig and forest.join(sig, x):
                    out.append((min(sig, x), max(sig, x)))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return left.unionByName(right).groupBy("pivot", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _decide(docs: DataFrame, pairs: DataFrame, classes: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), by whole sets. Both sides grow with the data, so both joins are by key at any size."""
    ends = pairs.select(F.col("a").alias("e")).unionByName(pairs.select(F.col("b").alias("e"))).distinct()
    sets = _sets_of(docs, common.stored(classes.join(ends, F.col("sig") == F.col("e"), "left_semi").select("sig", "rep")), n)
    rows = pairs.select("a", "b").join(sets.select(F.col("sig").alias("a2"), F.col("grams").alias("ga")).hint("merge"), F.col("a") == F.col("a2")).drop("a2")
    rows = rows.join(sets.select(F.col("sig").alias("b2"), F.col("grams").alias("gb")).hint("merge"), F.col("b") == F.col("b2"))
    shared = F.size(F.array_intersect("ga", "gb")).cast("long")
    return common.stored(rows.where((p + q) * shared >= p * (F.size("ga") + F.size("gb"))).select("a", "b"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every end of an edge: each id's least reachable id, by rounds of least neighbours with shortcuts.

    A round links every id's larger neighbours to the least of its neighbourhood, then every id's smaller ones; the number of rounds
    grows with the logarithm of the longest chain. It is settled when a round leaves the table as it was, row by row.
    """
    both = edges.select("a", "b").where(F.col("a") != F.col("b"))
    now = common.stored(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    size = now.count()
    for _ in range(rounds):
        if not size:
            break
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = sides.join(least, F.col("u") == F.col("w")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least2 = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        joined = large.join(least2, F.col("u") == F.col("w"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least2.select(F.col("w").alias("u"), F.col("m").alias("v")))
        new = common.stored(small.where("u <> v").distinct())
        new_size = new.count()
        # both tables hold distinct rows: equal sizes and nothing new mean equal tables
        settled = new_size == size and new.join(now.select(F.col("u").alias("u2"), F.col("v").alias("v2")), (F.col("u") == F.col("u2")) & (F.col("v") == F.col("v2")), "left_anti").isEmpty()
        now, size = new, new_size
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    whole = now.unionByName(now.select(F.col("v").alias("u"), "v"))
    return whole.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")


def _named(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with x and y, the names of a and b: ``names`` is (id, component), ids that it lacks name themselves."""
    left, right = names.select(F.col("id").alias("i1"), F.col("component").alias("c1")), names.select(F.col("id").alias("i2"), F.col("component").alias("c2"))
    rows = pairs.join(left, F.col("a") == F.col("i1"), "left").join(right, F.col("b") == F.col("i2"), "left")
    return rows.select(*pairs.columns, F.coalesce("c1", "a").alias("x"), F.coalesce("c2", "b").alias("y"))


def _links(docs: DataFrame, classes: DataFrame, n: int, p: int, q: int, share: float) -> DataFrame:
    """(id, component) of linked classes; ``classes`` is (sig, rep, m)."""
    ids = classes.select(F.col("rep").alias("id")).where("id is not null").distinct()
    slim = _slim(_texts_of(docs, ids), n, p, q, share)
    slim = common.stored(slim.join(classes.select(F.col("sig").alias("sig2")), F.col("sig") == F.col("sig2"), "left_semi").dropDuplicates(["sig"]))
    near = common.stored(_differences(docs, classes, slim, n))
    stars = near.where((p + q) * F.size("diff") <= (q - p) * (F.col("m") + F.col("pm"))).select(F.col("pivot").alias("a"), F.col("sig").alias("b"))
    edges = common.stored(stars.unionByName(_within_pivots(near, p, q)))
    nodes = common.stored(components(edges))
    families = near.select(F.col("sig").alias("s2"), "pivot")
    entries = _entries(slim, p, q).join(families, F.col("sig") == F.col("s2"), "left").join(nodes, F.col("sig") == F.col("id"), "left")
    entries = entries.select("token", "sig", "m", "pos", F.coalesce("pivot", "sig").alias("family"), F.coalesce("component", "sig").alias("node"))
    pairs = common.stored(_candidates(common.stored(entries), slim.select("sig", "bits"), p, q))
    if pairs.isEmpty():
        return nodes
    # first the nearest pair of every two nodes
    one = _named(pairs, nodes).groupBy(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).agg(F.min(F.struct("apart", "a", "b")).alias("top")).select("top.a", "top.b")
    one = common.stored(one)
    edges = edges.unionByName(_decide(docs, one, classes, n, p, q))
    names = common.stored(components(edges))
    left = _named(pairs.select("a", "b"), names).where("x <> y").select("a", "b")
    left = common.stored(left.join(one.select(F.col("a").alias("a2"), F.col("b").alias("b2")), (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")), "left_anti"))
    if left.isEmpty():
        return names
    return components(edges.unionByName(_decide(docs, left, classes, n, p, q)))


def join_components(docs: DataFrame, n: int = 3, p: int = 9, q: int = 10) -> DataFrame:
    """(doc_id, n_shingles, component_id) of (doc_id, text): documents link at a Jaccard likeness of p/q of their word n-grams."""
    prof = _profiled(docs, n, p, q)
    least = prof.groupBy("node").agg(F.min("doc_id").alias("least")).withColumnRenamed("node", "node2")
    out = prof.join(least, F.col("node") == F.col("node2"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def _profiled(docs: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """(doc_id, n_shingles, sig, node): a row a document, node the same for all documents of a component, null for texts without words."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    share = (q - p) / q + 0.1
    sized = _over_sets(docs, n, "n_shingles long, sig long", lambda found: {"n_shingles": list(map(len, found)), "sig": list(map(signature, found))})
    prof = common.stored(sized.select("doc_id", "n_shingles", "sig"))
    alone = _offers(docs, n, share).groupBy("gram").agg(F.min("sig").alias("x"), F.max("sig").alias("y")).where("x = y").groupBy("x").agg(F.count("*").alias("alone"))
    classes = prof.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("m"))
    left = classes.join(alone, F.col("sig") == F.col("x"), "left").where(f"coalesce(alone, 0) < {prefix_sql('m', p, q)}").select("sig", "rep", "m")
    names = _links(docs, common.stored(left), n, p, q, share)
    return prof.join(names, F.col("sig") == F.col("id"), "left").select("doc_id", "n_shingles", "sig", F.coalesce("component", "sig").alias("node"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(common.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, likeness 0.8): the one with the least id, one without id only if no other is there.

    A row that repeats another's id and set is a copy of it. Texts without words are no copies of one another, but for repeated ids.
    """
    n = 5
    prof = common.stored(_profiled(docs, n, 4, 5).groupBy("doc_id", "sig", "node").agg(F.count("*").alias("rows")))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sig", "rows")
    keep = prof.where("node is not null").groupBy("node").agg(F.min(row).alias("top")).select("top.doc_id", "top.sig", "top.rows").unionByName(prof.where("node is null").select("doc_id", "sig", "rows"))
    # an id that one row has tells the row; other rows are told by their sets as well
    again = common.stored(prof.groupBy("doc_id").agg(F.sum("rows").alias("rows")).where("rows > 1 and doc_id is not null").select(F.col("doc_id").alias("again")))
    single = common.stored(keep.where("doc_id is not null").join(again, F.col("doc_id") == F.col("again"), "left_anti").select(F.col("doc_id").alias("id")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.join(F.broadcast(single) if single.count() <= SENT else single, F.col("doc_id") == F.col("id"), "left_semi")
    if again.isEmpty() and docs.where("doc_id is null").isEmpty():
        return out
    many = again.count() > SENT
    rest = docs.join(again if many else F.broadcast(again), F.col("doc_id") == F.col("again"), "left_semi").unionByName(docs.where("doc_id is null"))
    given = _over_sets(rest, n, "__sig long", lambda found: {"__sig": list(map(signature, found))})
    told = keep.select(F.col("doc_id").alias("__id"), F.col("sig").alias("__sig2"))
    found = given.join(told, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__sig").eqNullSafe(F.col("__sig2")))
    return out.unionByName(found.dropDuplicates(["__id", "__sig"]).select(*names))


#: The same in DuckDB, by all pairs that share a gram.
SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
u as (select a as u, b as v from e union all select b, a from e),
r(doc, reach) as (select doc_id, doc_id from documents union select r.doc, u.v from r join u on r.reach = u.u)
select d.doc_id, coalesce(n.n, 0) as n_shingles, (select min(reach) from r where r.doc = d.doc_id) as component_id from documents d left join n using (doc_id)
"""
