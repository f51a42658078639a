"""Tabular inputs of other tools, and small dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.operators.numbering import numbered
from amplicore.functions.taxonomy import reference_lineage
from amplicore.operators.taxonomy import rdp_triples
from amplicore.sources.fastx import read_fasta

#: The columns of tabular alignments, and old names of multi-hit columns with their new ones.
ALIGNMENT = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue string, bitscore double, qlen int, slen int"
OLD_NAMES = {"OTU": "observation_name", "Subject_taxonomy": "blast_taxonomy", "Blast_subject": "blast_subject", "Prct_identity": "blast_perc_identity", "Prct_query_coverage": "blast_perc_query_coverage", "e-value": "blast_evalue", "Alignment_length": "blast_aln_length"}
MULTI_HIT = ["observation_name", "blast_taxonomy", "blast_subject", "blast_perc_identity", "blast_perc_query_coverage", "blast_perc_subject_coverage", "blast_evalue", "blast_aln_length"]


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Tabular alignments; the subject's length may be missing."""
    return spark.read.option("sep", "\t").option("mode", "PERMISSIVE").schema(ALIGNMENT).csv(path)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Global alignments of a SAM file as tabular rows: only each query's highest scores; deletions at the ends don't count."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(f) >= 11)).select(F.get(f, F.lit(0)).alias("qseqid"), F.get(f, F.lit(2)).alias("sseqid"), F.get(f, F.lit(5)).alias("cigar"), F.get(f, F.lit(9)).alias("seq"), F.regexp_extract("value", r"\tAS:i:(-?[0-9]+)", 1).cast("double").alias("bitscore"), F.regexp_extract("value", r"\tNM:i:([0-9]+)", 1).cast("int").alias("nm"))
    inner = F.regexp_replace(F.regexp_replace("cigar", r"^[0-9]+D", ""), r"[0-9]+D$", "")

    def total(kind: str) -> Column:
        return F.aggregate(F.regexp_extract_all(inner, F.lit(rf"([0-9]+){kind}"), 1), F.lit(0), lambda s, x: s + x.cast("int"))

    qlen = F.length("seq")
    n = qlen - F.length(F.translate("seq", "Nn", ""))
    out = rows.withColumn("m", total("[M=X]")).withColumn("gaps", total("[ID]"))
    outer = F.aggregate(F.regexp_extract_all("cigar", F.lit(r"(?:^([0-9]+)D)|(?:([0-9]+)D$)"), 0), F.lit(0), lambda s, x: s + F.regexp_extract(x, "([0-9]+)", 1).cast("int"))
    wrong = F.greatest(F.col("nm") - outer - F.col("gaps"), F.lit(0))
    out = out.select("qseqid", "sseqid", F.round((F.col("m") - wrong) * 100 / (qlen - n), 2).alias("pident"), (F.col("m") + F.col("gaps")).alias("length"), F.col("gaps").alias("gapopen"), "bitscore", qlen.alias("qlen"))
    best = out.groupBy("qseqid").agg(F.max("bitscore").alias("top"))
    return out.join(best, "qseqid").where("bitscore = top").drop("top")


def read_rdp(spark: SparkSession, path: str) -> DataFrame:
    """obs_id, taxonomy, bootstrap of a classifier's lines."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(f) > 4).select(F.regexp_extract(F.get(f, F.lit(0)), r"^(\S+)", 1).alias("obs_id"), rdp_triples(f).alias("t"))
    return rows.select("obs_id", F.col("t.taxon").alias("taxonomy"), F.col("t.bootstrap").alias("bootstrap"))


def read_multi_hits(spark: SparkSession, path: str) -> DataFrame:
    """obs_id, affs of a table of detailed affiliations; old headers are renamed, others are an error."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    names = [c.replace("#", "").replace('"', "").strip() for c in df.columns]
    df = df.toDF(*[OLD_NAMES.get(c, c) for c in names])
    if wrong := [c for c in df.columns if c not in MULTI_HIT]:
        raise ValueError(f"not columns of detailed affiliations: {', '.join(wrong)}")
    each = F.struct(F.col("blast_subject").alias("subject"), F.split("blast_taxonomy", ";").alias("taxonomy"), F.col("blast_perc_identity").cast("double").alias("identity"), F.col("blast_perc_query_coverage").cast("double").alias("coverage"), F.col("blast_evalue").alias("evalue"), F.col("blast_aln_length").cast("int").alias("aln_length"))
    return df.groupBy(F.col("observation_name").alias("obs_id")).agg(F.collect_list(each).alias("affs"))


def wide_to_abundance(table: DataFrame, samples: list[str], key: str = "observation_name") -> DataFrame:
    return table.select(F.col(key).alias("obs_id"), *samples).unpivot(["obs_id"], samples, "sample_id", "count").select("obs_id", "sample_id", F.col("count").cast("long").alias("count")).where("count <> 0")


def consistent(observations: DataFrame, hits: DataFrame) -> DataFrame:
    """Observations that say multi-subject but have no detailed hits: none, if the two tables belong together."""
    return observations.where(F.col("blast_subject") == "multi-subject").join(hits.select("obs_id"), "obs_id", "left_anti")


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, forward, reverse (null with two columns)."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(F.get(f, F.lit(0)).alias("sample_id"), F.get(f, F.lit(1)).alias("forward"), F.get(f, F.lit(2)).alias("reverse"))


def read_replicates(spark: SparkSession, path: str, samples: DataFrame | None = None) -> DataFrame:
    """sample_id, group; a sample that the matrix hasn't is an error."""
    f = F.split(F.trim("value"), r"\s+")
    out = spark.read.text(path).where(F.trim("value") != "").select(F.get(f, F.lit(0)).alias("sample_id"), F.get(f, F.lit(1)).alias("group"))
    if samples is not None and (lost := out.join(samples, "sample_id", "left_anti").head(1)):
        raise ValueError(f"no sample is named {lost[0]['sample_id']}")
    return out


def read_excluded(spark: SparkSession, path: str) -> DataFrame:
    """obs_id: the first word of each line that isn't a comment."""
    return spark.read.text(path).where(~F.trim("value").startswith("#") & (F.trim("value") != "")).select(F.regexp_extract(F.trim("value"), r"^(\S+)", 1).alias("obs_id")).distinct()


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """subject, taxonomy, length of a reference FASTA."""
    return read_fasta(spark, path).select(F.col("seq_id").alias("subject"), reference_lineage(F.col("description")).alias("taxonomy"), F.length("sequence").alias("length"))


def read_dimension(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A small table without header, by column names; gzip is read as it is."""
    return spark.read.option("sep", "\t").csv(path).toDF(*names)


def composition(spark: SparkSession, path: str) -> DataFrame:
    """cluster_ord, ord, seq_id of a cluster file: a line is a cluster, its first member the seed."""
    rows = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")).where(F.trim("value") != "")
    # lines of a block of a file follow each other in a task, and blocks are told by where they begin
    rows = numbered(rows, [F.asc("file_path"), F.asc("file_block_start"), F.asc("at")], "cluster_ord")
    return rows.select("cluster_ord", F.posexplode(F.split(F.trim("value"), r"\s+")).alias("ord", "member")).select("cluster_ord", "ord", F.regexp_replace("member", r"_[0-9]+$", "").alias("seq_id"))
