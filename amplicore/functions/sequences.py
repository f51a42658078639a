"""Sequences and qualities as text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements.
IUPAC, COMPLEMENT = "ACGTUNRYSWKMBDHVacgtunryswkmbdhv", "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"
#: What an IUPAC code stands for.
CODES = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def ambiguous(seq: Column) -> Column:
    """How many N or n there are."""
    return F.length(seq) - F.length(F.translate(seq, "Nn", ""))


def long_homopolymer(seq: Column, most: int) -> Column:
    """Whether a run has most + 2 letters or more, or the last run most + 1 or more (repeats are counted, and the last run is judged as it stands)."""
    return seq.rlike(rf"(.)\1{{{most + 1},}}") | seq.rlike(rf"(.)\1{{{most},}}$")


def poor_quality(quality: Column, threshold: int, window: int, offset: int = 33) -> Column:
    """Whether two letters below the threshold stand with at most window letters between them; one at the very start counts as such."""
    low = "".join(chr(c) for c in range(offset, offset + threshold))
    marked = F.regexp_replace(F.translate(quality, low, "\x01" * len(low)), "[^\x01]", "H")
    return marked.rlike(f"^\x01|\x01H{{0,{window}}}\x01")


def quality_offset(quality: Column) -> Column:
    """33 or 64 by the smallest and largest character, null if both are possible."""
    codes = F.transform(F.split(quality, ""), lambda c: F.ascii(c))
    low, high = F.array_min(F.filter(codes, lambda c: c > 0)), F.array_max(codes)
    return F.when(low < 59, 33).when(high > 74, 64)


def mismatches(a: Column, b: Column) -> Column:
    """Places in which two texts differ, over the length of the second; missing letters differ."""
    differ = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(b), F.lit(1))), F.lit(0), lambda n, i: n + (F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))).cast("int"))
    return F.when(F.length(b) == 0, 0).otherwise(differ)


def primer_pattern(primer: str) -> str:
    """A regular expression of a primer with IUPAC codes; N in the read matches any letter."""
    return "".join(f"[{CODES[c]}N]" for c in primer.upper())


def tags_to_n(seq: Column, tag: str) -> Column:
    """A joined pair's filler: the tag becomes as many N; the place is to be kept beside it, as after_tag gives."""
    return F.replace(seq, F.lit(tag), F.lit("N" * len(tag)))


def sized_id(seq_id: Column) -> tuple[Column, Column]:
    """Name and size of an id;size=n; size 1 without."""
    n = F.regexp_extract(seq_id, r";size=(\d+)", 1)
    return F.substring_index(seq_id, ";size=", 1), F.when(n == "", F.lit(1)).otherwise(n.cast("long")).cast("long")
