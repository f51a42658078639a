"""Lineages as arrays of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTI = "Multi-affiliation"


def canonical(text: Column) -> Column:
    """A lineage of a separated text: blanks trimmed, an empty last name dropped, and bootstraps like name(0.98) too if the first name has one."""
    names = F.transform(F.split(F.regexp_replace(text, r";\s*$", ""), ";"), lambda x: F.trim(x))
    bare = F.transform(names, lambda x: F.trim(F.regexp_replace(x, r"\([^()]*\)$", "")))
    return F.when(F.get(names, F.lit(0)).rlike(r"\([0-9.eE+-]*\)$"), bare).otherwise(names)


def reference_lineage(description: Column) -> Column:
    """A lineage of a reference's description: ids in brackets and a leading Root go."""
    names = F.transform(F.split(F.regexp_replace(description, r";\s*$", ""), ";"), lambda x: F.trim(F.regexp_replace(x, r"\[id: ?[^\]]*\]", "")))
    return F.when(F.lower(F.get(names, F.lit(0))) == "root", F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0)))).otherwise(names)


def consensus(lineages: Column) -> Column:
    """Names that all lineages share, rank by rank; from the first rank on at which they differ, MULTI. Of no lineage: empty."""

    def joined(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.when(x == y, x).otherwise(F.lit(MULTI)))

    flat = F.aggregate(F.slice(lineages, 2, F.greatest(F.size(lineages) - 1, F.lit(0))), F.get(lineages, F.lit(0)), joined)
    at = F.array_position(flat, MULTI)
    below = F.concat(F.slice(flat, 1, F.greatest(at - 1, F.lit(0)).cast("int")), F.array_repeat(F.lit(MULTI), (F.size(flat) - at + 1).cast("int")))
    return F.when(F.size(lineages) <= 0, F.array().cast("array<string>")).when(at > 0, below).otherwise(flat)


def ancestors(lineage: Column) -> Column:
    """The lineage and all that lead to it, shortest first."""
    return F.when(F.size(lineage) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.size(lineage), F.lit(1))), lambda i: F.slice(lineage, F.lit(1), i))).otherwise(F.slice(F.array(lineage), 1, 0))


def uniform(values: Column, otherwise: str) -> Column:
    """The value that all share, else a name for their difference."""
    return F.when(F.size(F.array_distinct(values)) == 1, F.get(values, F.lit(0)).cast("string")).otherwise(F.lit(otherwise))


def toggled(text: Column, patterns: list[str]) -> Column:
    """Whether an odd number of the patterns is found: each one that matches turns the answer around."""
    out = F.lit(False)
    for p in patterns:
        out = out != text.rlike(p)
    return out


def with_bootstraps(names: Column, boots: Column) -> Column:
    return F.array_join(F.zip_with(names, boots, lambda n, b: F.concat(n, F.lit(";("), b.cast("string"), F.lit(");"))), "")


def of_bootstraps(text: Column) -> tuple[Column, Column]:
    """Names and bootstraps of a text that with_bootstraps wrote."""
    return F.regexp_extract_all(text, F.lit(r"([^;]+);\([^)]*\);"), 1), F.transform(F.regexp_extract_all(text, F.lit(r"[^;]+;\(([^)]*)\);"), 1), lambda x: x.cast("double"))


def inferred(text: Column) -> Column:
    """What a text is read as: letters make a string, a point a float, else an int."""
    return F.when(text.rlike("[A-Za-z]"), "str").when(text.contains("."), "float").otherwise("int")


def cleaned_species(name: Column) -> Column:
    """A species name without strain: what stands behind `Genus sp.` or before ` subsp.` of two words, or before a final DSM number.

    Names that begin with uncultured, and the whole names undefined, unidentified and incertae sedis, are unknown."""
    undefined = name.startswith("uncultured") | F.lower(name).isin("undefined", "unidentified", "incertae sedis")
    out = F.when(undefined, F.lit("unknown species"))
    for pattern in (r"^(\S+ sp\.).+", r"^(\S+ \S+) subsp\.", r"^(.+) DSMY? \d+$"):
        out = out.when(name.rlike(pattern), F.regexp_extract(name, pattern, 1))
    return out.otherwise(name)


def completed(lineage: Column, ranks: list[str]) -> Column:
    """A lineage with a name at each rank: unknown and the rank's name where it has none."""
    wanted = F.array(*[F.lit(r) for r in ranks])
    return F.transform(wanted, lambda r, i: F.coalesce(F.nullif(F.get(lineage, i), F.lit("")), F.concat(F.lit("unknown "), r)))


#: Accented letters and what they are without.
_ACCENTS = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def unaccented(text: Column) -> Column:
    """ASCII letters for accented ones; other characters beyond ASCII go."""
    return F.regexp_replace(F.translate(text, _ACCENTS, _PLAIN), r"[^\x00-\x7F]", "")


#: Where the pages of ids stand, by what an id holds; the first that fits counts.
LINKS = [("COG", "https://www.ncbi.nlm.nih.gov/research/cog/cog/"), ("PF", "https://pfam.xfam.org/family/"), ("TIGR", "https://0-www-ncbi-nlm-nih-gov.linyanti.ub.bw/genome/annotation_prok/evidence/"), ("K[0-9]{5}|EC:", "https://www.genome.jp/dbget-bin/www_bget?")]


def link(name: Column) -> Column:
    """A database link by what an id holds anywhere."""
    out = F.when(F.lit(False), F.lit(""))
    for held, url in LINKS:
        out = out.when(name.rlike(held), F.concat(F.lit(url), name))
    return out.otherwise(F.lit("no link"))


def same_depth(a: Column, b: Column) -> Column:
    """How many leading names two lineages share."""
    both = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(both, False)
    return F.when(first > 0, first - 1).otherwise(F.size(both).cast("long"))


def lowest_shared(a: Column, b: Column, ranks: list[str]) -> Column:
    """The name of the deepest rank down to which two lineages agree; null if they differ from the first on."""
    return F.get(F.array(*[F.lit(r) for r in ranks]), (same_depth(a, b) - 1).cast("int"))


def converted(lineage: Column, ranks: list[str], domains: list[str]) -> Column:
    """A reference's lineage at fixed ranks, missing ones unknown; null outside the domains."""
    return F.when(F.get(lineage, F.lit(0)).isin(domains), completed(lineage, ranks))


def as_dna(seq: Column) -> Column:
    return F.translate(seq, "Uu", "Tt")


def ratio(value: str | float) -> float:
    """A share in percent, 0 to 100; anything else is an error."""
    try:
        out = float(value)
    except (TypeError, ValueError):
        out = -1.0
    if not 0 <= out <= 100:
        raise ValueError(f"{value} isn't between 0 and 100")
    return out
