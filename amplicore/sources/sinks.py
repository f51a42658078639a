"""Tables for people: observations with chosen fields beside their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "no data"


def wide_table(observations: DataFrame, ab: DataFrame, samples: list[str], fields: dict[str, Column], sequences: DataFrame | None = None) -> DataFrame:
    """fields, (sequence,) observation_name, observation_sum and a column for each sample; what is missing says so."""
    counts = ab.groupBy("obs_id").pivot("sample_id", samples).agg(F.sum("count")).na.fill(0)
    sums = ab.groupBy("obs_id").agg(F.sum("count").alias("observation_sum"))
    rows = observations.join(sums, "obs_id", "left").join(counts, "obs_id", "left").na.fill(0, ["observation_sum", *samples])
    shown = [F.coalesce(c.cast("string"), F.lit(MISSING)).alias(n) for n, c in fields.items()]
    if sequences is not None:  # in the sequences' order, only what both have
        rows = rows.join(sequences.select(F.col("seq_id").alias("obs_id"), F.col("sequence").alias("seed_sequence"), "ord"), "obs_id").orderBy("ord")
        shown.append(F.col("seed_sequence"))
    return rows.select(*shown, F.col("obs_id").alias("observation_name"), "observation_sum", *samples)


def write_tsv(df: DataFrame, path: str) -> None:
    df.toDF(df.columns[0] if df.columns[0].startswith("#") else "#" + df.columns[0], *df.columns[1:]).write.mode("overwrite").option("sep", "\t").option("comment", "\x01").option("header", True).csv(path)


def sunburst(df: DataFrame, label: str, value: str) -> DataFrame:
    """Labels with whole values (halves to the even number); NA doesn't show."""
    return df.where(F.col(label) != "NA").groupBy(label).agg(F.bround(F.sum(value), 0).cast("long").alias(value))
