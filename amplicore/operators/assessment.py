"""Expected against observed: how well a result gives back a known community."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amplicore.functions.taxonomy import ancestors


def cleaned(lineage: Column) -> Column:
    """A foreign tool's lineage: quotes, bootstraps, ids in brackets, rank letters and a root go."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(lineage, r"[\"']", ""), r"\([0-9.]+\)", ""), r"\[id: ?[^\]]*\]", "")
    names = F.transform(F.split(F.regexp_replace(text, r";\s*$", ""), ";"), lambda x: F.regexp_replace(F.trim(x), "^[a-z](__|:)", ""))
    return F.filter(names, lambda x: ~F.lower(x).isin("root", ""))


def abundance_by_rank(ab: DataFrame, lineages: DataFrame) -> DataFrame:
    """rank, taxon (prefix), count."""
    own = ab.groupBy("obs_id").agg(F.sum("count").alias("count")).join(lineages, "obs_id").groupBy("taxonomy").agg(F.sum("count").alias("count"))
    up = own.select(F.explode(ancestors(F.col("taxonomy"))).alias("node"), "count")
    return up.groupBy(F.size("node").cast("long").alias("rank"), F.array_join("node", ";").alias("taxon")).agg(F.sum("count").alias("count"))


def divergence(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """rank, divergence (100 less the sum of the smaller percents), common, only_expected, only_observed."""

    def shares(df: DataFrame, to: str) -> DataFrame:
        sums = df.groupBy("rank").agg(F.sum("count").alias("all"))
        return df.join(sums, "rank").select("rank", "taxon", (100 * F.col("count") / F.col("all")).alias(to))

    both = shares(expected, "e").join(shares(observed, "o"), ["rank", "taxon"], "full")
    zero = F.lit(0.0)
    return both.groupBy("rank").agg(
        F.round(100 - F.sum(F.least(F.coalesce("e", zero), F.coalesce("o", zero))), 6).alias("divergence"), F.count_if(F.col("e").isNotNull() & F.col("o").isNotNull()).alias("common"),
        F.count_if(F.col("o").isNull()).alias("only_expected"), F.count_if(F.col("e").isNull()).alias("only_observed"),
    )


def identical(sequences: DataFrame) -> DataFrame:
    """first, n: of sequences that several records share, the first id and how many."""
    return sequences.groupBy("sequence").agg(F.min("seq_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("first", "n")


def recovered(references: DataFrame, results: DataFrame) -> DataFrame:
    """sample_id, expected, found, split: distinct reference sequences, those that some result has, and those that several results have.

    References with one sequence count once. references: sample_id, sequence; results: sample_id, sequence, seq_id.
    """
    want = references.select("sample_id", "sequence").distinct()
    got = results.groupBy("sample_id", "sequence").agg(F.countDistinct("seq_id").alias("n"))
    return want.join(got, ["sample_id", "sequence"], "left").groupBy("sample_id").agg(F.count("*").alias("expected"), F.count("n").alias("found"), F.count_if(F.col("n") > 1).alias("split"))
