"""Codes and lookup rules of the data model.

Bases are 0-3 = A, C, G, T. Channels 0-3 are A, C, G, T that do not speak of methylation, 4-7 those that do. Genotypes 0-9 are the
unordered pairs AA, AC, AG, AT, CC, CG, CT, GG, GT, TT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
BASES = "ACGT"
GENOTYPES = ("AA", "AC", "AG", "AT", "CC", "CG", "CT", "GG", "GT", "TT")
IUPAC = "AMRWCSYGKT"
#: Channels that support an allele.
SUPPORT = {"A": (0, 4), "C": (1, 5, 7), "G": (2, 4, 6), "T": (3, 7)}


def ints(values) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def at(values, index: Column) -> Column:
    """values[index], 0-based, as a lookup in a literal array."""
    return F.element_at(ints(values) if not isinstance(values[0], str) else F.array(*map(F.lit, values)), index.cast("int") + 1)


def channel(base: Column, strand: Column) -> Column:
    """Channel of a base by bisulfite strand (1: C to T, 2: G to A, else unknown)."""
    return F.when(strand == 1, at((0, 5, 2, 7), base)).when(strand == 2, at((4, 1, 6, 3), base)).otherwise(base)


def alt(genotype: Column, ref: Column) -> Column:
    """Alleles of a genotype that differ from the reference base, in ACGT order, joined by commas ('.' if none)."""
    text = [[",".join(dict.fromkeys(b for b in sorted(g) if b != r)) or "." for r in BASES] for g in GENOTYPES]
    return at([x for row in text for x in row], genotype * 4 + ref)


def gt(genotype: Column, ref: Column) -> Column:
    def one(g, r):
        alleles = set(g)
        if len(alleles) == 1:
            return "0/0" if r in alleles else "1/1"
        return "0/1" if r in alleles else "1/2"

    return at([one(g, r) for g in GENOTYPES for r in BASES], genotype * 4 + ref)


def strand_of(genotype: Column) -> Column:
    """'+' for C without G, '-' for G without C, '+-' for CG, else NA."""
    return at(["+-" if g == "CG" else "+" if "C" in g else "-" if "G" in g else "NA" for g in GENOTYPES], genotype)


def support(genotype: Column, counts: Column) -> Column:
    """Reads that support a genotype: channels of either allele."""
    masks = [[int(any(k in SUPPORT[a] for a in g)) for k in range(8)] for g in GENOTYPES]
    rows = F.array(*[ints(m) for m in masks])
    return F.aggregate(F.zip_with(counts, F.element_at(rows, genotype.cast("int") + 1), lambda c, m: c * m), F.lit(0).cast("bigint"), lambda s, x: s + x)


def phred(log10_p: Column) -> Column:
    """Quality of a call whose log10 posterior is given: min(trunc(-10 log10(1 - 10**p)), 255)."""
    miss = 1 - F.pow(F.lit(10.0), log10_p)
    return F.when(miss <= 0, F.lit(255)).otherwise(F.least(F.lit(255), F.greatest(F.lit(0), (F.log10(miss) * -10).cast("int"))))


def error_phred(z: Column) -> Column:
    """PRJ-11: quality of an error probability: min(trunc(-10 log10 z), 255), 255 for none, never below 0."""
    return F.when(z <= 0, F.lit(255)).otherwise(F.least(F.lit(255), F.greatest(F.lit(0), (F.log10(z) * -10).cast("int"))))


def likelihood_vector(ll: Column, genotype: Column, ref: Column, floor: float = -99.999) -> Column:
    """PRJ-10: log10 likelihoods of the pairs of the reference and the call's other alleles, in VCF order (RR, RA, AA, RB, AB, BB).

    ``ref`` is a base code; a null one (N) has the floor wherever the reference base takes part, and every allele of the call is another.
    """
    lists = []
    for g in GENOTYPES:
        for r in (*BASES, ""):
            alleles = [r, *dict.fromkeys(b for b in g if b != r)]
            pairs = ["".join(sorted(a + b)) for k, b in enumerate(alleles) for a in alleles[: k + 1]]
            lists.append(ints(GENOTYPES.index(p) if p in GENOTYPES else -1 for p in pairs))
    chosen = F.element_at(F.array(*lists), (genotype * 5 + F.coalesce(ref, F.lit(4))).cast("int") + 1)
    return F.transform(chosen, lambda j: F.when(j < 0, F.lit(floor)).otherwise(F.greatest(F.lit(floor), F.get(ll, j))))


def reverse_complement(text: Column) -> Column:
    return F.translate(F.reverse(text), "ACGTYRSWKMBVDHN.", "TGCARYSWMKVBHDN.")
