"""Nucleotide and alignment-string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code, codons in TCAG order.
CODON_BASES = "TCAG"
CODON_AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def identity_count(a: Column, b: Column) -> Column:
    """Equal letters at equal positions, case ignored, up to the shorter length."""
    x, y = F.split(F.upper(a), ""), F.split(F.upper(b), "")
    same = F.zip_with(x, y, lambda p, q: F.when((p == q) & (p != ""), 1).otherwise(0))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(
        F.aggregate(same, F.lit(0), lambda acc, v: acc + F.coalesce(v, F.lit(0)))).cast("bigint")


def _cigar_total(cigar: Column, ops: str) -> Column:
    n = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    return F.aggregate(n, F.lit(0).cast("bigint"), lambda acc, v: acc + v.cast("bigint"))


def cigar_query_length(cigar: Column) -> Column:
    return _cigar_total(cigar, "MIS=X")


def cigar_reference_length(cigar: Column) -> Column:
    return _cigar_total(cigar, "MDN=X")


def translate_codons(seq: Column) -> Column:
    """Protein of a coding sequence by the standard code; unknown codons give X, a partial last codon is dropped."""
    codons = [a + b + c for a in CODON_BASES for b in CODON_BASES for c in CODON_BASES]
    code = F.create_map(*[F.lit(x) for pair in zip(codons, CODON_AMINO_ACIDS) for x in pair])
    dna = F.translate(F.upper(seq), "U", "T")
    triples = F.regexp_extract_all(dna, F.lit("(...)"), F.lit(1))
    return F.array_join(F.transform(triples, lambda t: F.coalesce(F.try_element_at(code, t), F.lit("X"))), "")
