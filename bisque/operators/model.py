"""Genotype and methylation model: likelihoods of ten genotypes, methylation and strand bias."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes

UNDER, OVER, BIAS = 0.01, 0.05, 2.0
#: Term of a channel for a genotype. X all, H half, K error; other letters are the methylation terms, ``inner`` in ``likelihoods``.
TERMS = (
    "XHHHKKKKKK", "KHKKXHHKKK", "KKHKKHKXHK", "KKKHKKHKHX",
    "XHaHKbKcbK", "KdKKedfKKK", "KKgKKhKihK", "KjKHmjlKHX",
)


def _rates(under: float, over: float) -> tuple[float, ...]:
    """Of lambda = 1 - under and theta = over: 1 - lambda, 1 - theta, lambda - theta, lambda + theta and what is left of it to 2, worked out in decimals and then rounded once."""
    u, o = Decimal(repr(float(under))), Decimal(repr(float(over)))
    return tuple(map(float, (u, 1 - o, 1 - u - o, 1 - u + o, 1 + u - o)))


def likelihoods(sites: DataFrame, under: float = UNDER, over: float = OVER, bias: float = BIAS, haploid: bool = False, log10: bool = True) -> DataFrame:
    """``sites`` (ref, c0..7, q0..7) with ``z0`` and ``z1``, ``max_gt`` (first maximum) and ``ll``, ten normalised log likelihoods (null where ``haploid`` has none).

    A z is (za, zb, zc): the fitted share of unchanged bases if one, both or a half of the alleles carry the base; -1 without reads. A null count is 0.
    Genotypes of equal likelihood are told apart by the last bit, so the logarithms are those of the C library and sums run from channel 0 to 7
    and then the prior: the JVM's and numpy's own logarithms differ from C's in that bit. Arrow batches, no shuffle.
    """
    rates, genotypes, bases, terms = _rates(under, over), codes.GENOTYPES, codes.BASES, TERMS
    new = "z0 array<double>, z1 array<double>, max_gt int, ll array<double>"
    kept = [c for c in sites.columns if c.lower() not in ("z0", "z1", "max_gt", "ll")]
    schema = T.StructType([*(sites.schema[c] for c in kept), *T.StructType.fromDDL(new)])
    some = (0, 4, 7, 9) if haploid else tuple(range(10))

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        low, high, span, both, rest = rates
        each = lambda f, x: np.fromiter(map(f, x.tolist()), float, len(x))
        error = np.array([min(math.pow(10.0, -(q / 10.0)), 0.5) for q in range(64)])
        miss = error / (3.0 - 4.0 * error)
        fixed = {"X": each(math.log, 1 + miss), "H": each(math.log, 0.5 + miss), "K": each(math.log, miss)}

        def shares(x1, x2, k1, k2):
            d = np.where(x1 + x2 > 0, (x1 + x2) * span, 1.0)
            for v in ((x1 * (both + 2 * k2) - x2 * (rest + 2 * k1)) / d, (x1 * (2 + both + 4 * k2) - x2 * (rest + 4 * k1)) / d, (x1 * (both + 4 * k2) - x2 * (rest + 4 * k1)) / d):
                fitted = np.where(v < -1, low, np.where(v > 1, high, 0.5 * (span * v + rest)))
                yield np.where((x1 == 0) & (x2 == 0), -1.0, np.where(x2 == 0, high, np.where(x1 == 0, low, fitted)))

        def lists(columns, absent=()):
            n, width = len(columns[0]), len(columns)
            flat, gone = np.stack(columns, axis=1).ravel(), np.tile([i in absent for i in range(width)], n)
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="int32") * width), pa.array(flat, mask=gone.astype(bool)))

        for batch in batches:
            number = lambda name: batch.column(name).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            c = [np.nan_to_num(number(f"c{i}")) for i in range(8)]
            level = []
            for i in range(8):
                mean = number(f"q{i}") / np.where(c[i] > 0, c[i], 1.0)
                whole = np.floor(mean)
                level.append(np.where(c[i] > 0, np.clip(np.fmin(whole + (mean - whole >= 0.5), 63), 0, 63), 0).astype("int64"))
            k = [miss[x] for x in level]
            z0, z1 = list(shares(c[5], c[7], k[5], k[7])), list(shares(c[6], c[4], k[6], k[4]))
            inner = {
                "a": lambda: 1 - 0.5 * z1[1], "b": lambda: 0.5 * (1 - z1[2]), "c": lambda: 1 - z1[0],
                "d": lambda: 0.5 * z0[2], "e": lambda: z0[0], "f": lambda: 0.5 * z0[1],
                "g": lambda: 0.5 * z1[1], "h": lambda: 0.5 * z1[2], "i": lambda: z1[0],
                "j": lambda: 0.5 * (1 - z0[2]), "m": lambda: 1 - z0[0], "l": lambda: 1 - 0.5 * z0[1],
            }  # fmt: skip  # noqa: B023
            term = {}
            for i in range(8):
                seen = c[i] > 0
                for x in dict.fromkeys(terms[i]):
                    term[i, x] = np.zeros(len(seen))
                    term[i, x][seen] = c[i][seen] * (fixed[x][level[i][seen]] if x in fixed else each(math.log, (inner[x]() + k[i])[seen]))
            ref, raw = number("ref"), []
            for g in some:
                x, y = genotypes[g]
                v = term[0, terms[0][g]]
                for i in range(1, 8):
                    v = v + term[i, terms[i][g]]
                prior = math.log(bias) if x == y else math.log(0.5 * (1 + bias))
                raw.append(v + np.where((ref == bases.index(x)) | (ref == bases.index(y)), prior, 0.0))
            best = np.argmax(raw, axis=0)
            top = np.max(raw, axis=0)
            total = each(math.exp, raw[0] - top)
            for v in raw[1:]:
                total = total + each(math.exp, v - top)
            norm = top + each(math.log, total)
            ll = [np.zeros(len(ref))] * 10
            for g, v in zip(some, raw):
                ll[g] = (v - norm) / (math.log(10) if log10 else 1.0)
            made = [lists(z0), lists(z1), pa.array(np.array(some, dtype="int32")[best]), lists(ll, set(range(10)) - set(some))]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), *made], names=[*kept, "z0", "z1", "max_gt", "ll"])

    return sites.select(*[F.col(f"`{x}`") for x in kept]).mapInArrow(run, schema)


def estimate(z: Column, under: float = UNDER, over: float = OVER) -> Column:
    """Methylation of a z: null without data or below zero, at most 1."""
    low, _, span, *_ = _rates(under, over)
    m = (z - low) / span
    return F.when(z.isNull() | (z < 0), F.lit(None)).when(m < 0, F.lit(None)).otherwise(F.least(F.lit(1.0), m))


def meth(genotype: Column) -> tuple[Column, Column]:
    """PRJ-23: estimates on the C and the G strand for a genotype; null where it does not apply."""
    c = F.when(genotype == 4, F.col("z0")[0]).when(genotype == 6, F.col("z0")[1]).when(genotype.isin(1, 5), F.col("z0")[2])
    g = F.when(genotype == 7, F.col("z1")[0]).when(genotype == 2, F.col("z1")[1]).when(genotype.isin(5, 8), F.col("z1")[2])
    return estimate(c), estimate(g)


#: Channels of either allele of a heterozygote that count for strand bias.
FISHER = {1: ((0, 4), (1, 5, 7)), 2: ((0,), (2, 6)), 3: ((0, 4), (3, 7)), 5: ((1, 5, 7), (2, 4, 6)), 6: ((1, 5), (3,)), 8: ((2, 4, 6), (3, 7))}


def fisher_table(genotype: Column) -> Column:
    """(a, b, c, d): first and second allele, forward then reverse, from c0..c15; null for homozygotes."""
    out = None
    for g, (x, y) in FISHER.items():
        cell = lambda ch, off: sum((F.col(f"c{k + off}") for k in ch), F.lit(0))
        t = F.array(*[cell(ch, off).cast("bigint") for off in (0, 8) for ch in (x, y)])
        out = F.when(genotype == g, t) if out is None else out.when(genotype == g, t)
    return out


def fisher_log10(t: Column) -> Column:
    """Two-sided exact test of a 2x2 table, log10 of max(p, 1e-20): the observed tail and the tail beyond the mirrored deviation.

    Tables of the same margins are walked with the ratio of neighbouring terms; the walk is as long as the smallest margin.
    """
    a, b, c, d = (t[i].cast("double") for i in range(4))
    n = a + b + c + d
    expected = (a + b) * (a + c) / n
    delta = a - expected
    lo, hi = F.greatest(F.lit(0.0), a - d), F.least(a + b, a + c)
    lg = lambda x: F.aggregate(F.when(x >= 1, F.sequence(F.lit(1), F.greatest(F.lit(1), x.cast("int")))).otherwise(F.array(F.lit(1))), F.lit(0.0), lambda s, k: s + F.ln(k))
    base = lg(a + b) + lg(c + d) + lg(a + c) + lg(b + d) - lg(n)
    step = F.when(delta > 0, F.ceil(delta * 2)).otherwise(F.greatest(F.ceil(delta * -2), F.lit(1)))
    far = F.when(delta > 0, a - step).otherwise(a + step)

    def p_of(x):
        return F.exp(base - lg(x) - lg(a + b - x) - lg(a + c - x) - lg(d - a + x))

    def tail(start, stop):
        return F.when(start <= stop, F.aggregate(F.sequence(start.cast("int"), stop.cast("int")), F.lit(0.0), lambda s, x: s + p_of(x.cast("double")))).otherwise(0.0)

    p = F.when(delta > 0, tail(a, hi) + tail(lo, far)).otherwise(tail(lo, a) + tail(far, hi))
    return F.when(t.isNull() | (n == 0), 0.0).otherwise(F.log10(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-20))))
