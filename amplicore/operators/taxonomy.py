"""Operators on alignments and lineages: best hits, consensus, filters of affiliations, trees and distributions.

Alignments are rows (query_id, subject, ord, bitscore, identity, coverage, aln_length, taxonomy); lists of them are made only
for one query at a time, from its best hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amplicore.operators.numbering import numbered
from amplicore.functions import taxonomy as T


def best_hits(aln: DataFrame) -> DataFrame:
    """All alignments with their query's highest score; ties stay."""
    w = Window.partitionBy("query_id").orderBy(F.desc("bitscore"))
    return aln.withColumn("rk", F.rank().over(w)).where("rk = 1").drop("rk")


def spans(aln: DataFrame, start: str = "qstart", end: str = "qend", qlen: str = "qlen", slen: str = "slen") -> DataFrame:
    """Shares of query and subject that the query's span covers, in percent; 0 for a subject of unknown length."""
    length = F.col(end) - F.col(start) + 1
    return aln.withColumn("query_coverage", 100 * length / F.col(qlen)).withColumn("subject_coverage", F.when(F.coalesce(F.col(slen), F.lit(0)) == 0, 0.0).otherwise(100 * length / F.col(slen)))


def affiliations(hits: DataFrame) -> DataFrame:
    """query_id, affs (its hits in file order, as structs)."""
    each = F.struct("ord", "subject", "identity", "coverage", "aln_length", "taxonomy", "bitscore")
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_list(each)).alias("affs"))


def with_consensus(affs: DataFrame) -> DataFrame:
    return affs.withColumn("consensus", T.consensus(F.col("affs.taxonomy")))


def attached(observations: DataFrame, affs: DataFrame, key: str = "obs_id") -> DataFrame:
    """Observations with affiliations and consensus; empty lists where there are none."""
    kind = affs.schema["affs"].dataType.simpleString()
    joined = observations.join(affs.withColumnRenamed("query_id", key), key, "left")
    return joined.withColumn("affs", F.coalesce("affs", F.array().cast(kind))).withColumn("consensus", F.coalesce("consensus", F.array().cast("array<string>")))


def affiliation_summary(cons: DataFrame) -> DataFrame:
    """rank, ambiguous, unambiguous: by rank from 1, how many consensus lineages are ambiguous there."""
    names = cons.select(F.posexplode("consensus").alias("pos", "name"))
    return names.groupBy((F.col("pos") + 1).cast("long").alias("rank")).agg(F.count_if(F.col("name") == T.MULTI).alias("ambiguous"), F.count_if(F.col("name") != T.MULTI).alias("unambiguous"))


def metric_filter(affs: DataFrame, criteria: dict[str, Column]) -> DataFrame:
    """query_id, affs, consensus, status after criteria on affiliations.

    criteria: columns over an affiliation's fields, given as functions of it. A criterion acts only where it changes the
    number of a query's distinct lineages; an affiliation stays if it meets all that act. Where none would stay the query
    is impacted and keeps what it had, with the acting criteria's names in reasons.
    """
    out = affs
    kinds = F.size(F.array_distinct(F.transform("affs", lambda a: a["taxonomy"])))
    for name, test in criteria.items():
        left = F.size(F.array_distinct(F.transform(F.filter("affs", test), lambda a: a["taxonomy"])))
        out = out.withColumn(f"act_{name}", left != kinds)

    def stays(a: Column) -> Column:
        keep = F.lit(True)
        for name, test in criteria.items():
            keep = keep & (~F.col(f"act_{name}") | test(a))
        return keep

    out = out.withColumn("left", F.filter("affs", stays))
    acting = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"act_{n}"), F.lit(n)) for n in criteria])), ",")
    gone = F.size("left") == 0
    changed = F.size("left") < F.size("affs")
    status = F.when(gone, "impacted").when(changed, "changed").otherwise("unchanged")
    out = out.select("query_id", F.when(gone, F.col("affs")).otherwise(F.col("left")).alias("affs"), status.alias("status"), F.when(gone, acting).otherwise("").alias("reasons"))
    return with_consensus(out)


def deleted(filtered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept queries, and impacted ones as deleted."""
    return filtered.where("status <> 'impacted'"), filtered.where("status = 'impacted'").withColumn("status", F.lit("ASV_deleted"))


def masked(filtered: DataFrame) -> DataFrame:
    """All queries; impacted ones without affiliations and consensus."""
    gone = F.col("status") == "impacted"
    kind = filtered.schema["affs"].dataType.simpleString()
    status = F.when(gone, "Affiliation_masked").when(F.col("status") == "changed", "Blast_taxonomy_changed").otherwise("unchanged")
    return filtered.select("query_id", F.when(gone, F.array().cast(kind)).otherwise(F.col("affs")).alias("affs"), F.when(gone, F.array().cast("array<string>")).otherwise(F.col("consensus")).alias("consensus"), status.alias("status"), "reasons")


def shortest_reference(hits: DataFrame, lengths: DataFrame) -> DataFrame:
    """The hits of each query whose reference is shortest; all of them where a reference's length is missing. lengths: subject, length."""
    w = Window.partitionBy("query_id")
    known = hits.join(lengths, "subject", "left").withColumn("missing", F.max(F.col("length").isNull()).over(w)).withColumn("least", F.min("length").over(w))
    return known.where(F.col("missing") | (F.col("length") == F.col("least"))).drop("missing", "least")


def reference_reduction(aln: DataFrame, k: int) -> DataFrame:
    """The subjects among the k best distinct scores of any query."""
    w = Window.partitionBy("query_id").orderBy(F.desc("bitscore"))
    return aln.withColumn("dr", F.dense_rank().over(w)).where(F.col("dr") <= k).select("subject").distinct()


def multi_rows(affs: DataFrame) -> DataFrame:
    """A row for each affiliation of queries with several."""
    return affs.where(F.size("affs") > 1).select("query_id", F.explode("affs").alias("a")).select("query_id", F.array_join("a.taxonomy", ";").alias("lineage"), "a.subject", "a.identity", "a.coverage", "a.aln_length")


def collapsed(affs: DataFrame) -> DataFrame:
    """One row for each query: its affiliations' common values, or what differs."""
    return affs.select("query_id", T.uniform(F.col("affs.subject"), "multi-subject").alias("subject"), T.uniform(F.transform("affs", lambda a: F.round(a["identity"]).cast("int")), "multi-identity").alias("identity"), T.uniform(F.transform("affs", lambda a: F.round(a["coverage"]).cast("int")), "multi-coverage").alias("coverage"), T.uniform(F.col("affs.aln_length"), "multi-alignment-lg").alias("aln_length"))


def standard(affs: DataFrame, depth: int) -> DataFrame:
    """query_id, taxonomy text; Unclassified at each rank where there is no consensus."""
    none = F.array_repeat(F.lit("Unclassified"), depth)
    return affs.select("query_id", F.array_join(F.when(F.size("consensus") == 0, none).otherwise(F.col("consensus")), ";").alias("taxonomy"))


def terminal_counts(ab: DataFrame, lineages: DataFrame) -> DataFrame:
    """lineage (text), sample_id, count at each lineage's own node; null, empty and unknown lineages don't count."""
    named = lineages.where("size(taxonomy) > 0 and taxonomy[0] <> 'unknown'").select("obs_id", F.array_join("taxonomy", ";").alias("lineage"))
    return ab.join(named, "obs_id").groupBy("lineage", "sample_id").agg(F.sum("count").alias("count"))


def rollup(ab: DataFrame, lineages: DataFrame) -> DataFrame:
    """lineage, depth, count of each node and all above it. Counts are summed by lineage first, so ancestors multiply few rows."""
    own = ab.groupBy("obs_id").agg(F.sum("count").alias("count")).join(lineages, "obs_id").groupBy("taxonomy").agg(F.sum("count").alias("count"))
    up = own.select(F.explode(T.ancestors(F.col("taxonomy"))).alias("node"), "count")
    return up.groupBy(F.array_join("node", ";").alias("lineage"), F.size("node").cast("long").alias("depth")).agg(F.sum("count").alias("count"))


def distinct_by_rank(lineages: DataFrame, excluded: list[str]) -> DataFrame:
    names = lineages.select(F.posexplode("taxonomy").alias("pos", "name")).where(~F.col("name").isin(excluded))
    return names.groupBy((F.col("pos") + 1).cast("long").alias("rank")).agg(F.countDistinct("name").alias("taxa"))


def bootstrap_distribution(boots: DataFrame) -> DataFrame:
    """rank, bootstrap (percent), clusters, reads. boots: bootstrap (array), reads."""
    each = boots.select(F.posexplode("bootstrap").alias("pos", "b"), "reads")
    return each.groupBy((F.col("pos") + 1).cast("long").alias("rank"), F.round(F.col("b") * 100).cast("long").alias("bootstrap")).agg(F.count("*").alias("clusters"), F.sum("reads").cast("long").alias("reads"))


def alignment_distribution(affs: DataFrame, reads: DataFrame) -> DataFrame:
    """identity, coverage (of the first affiliation, 0 without), clusters, reads. reads: query_id, reads."""
    first = F.get(F.col("affs"), F.lit(0))
    both = reads.join(affs, "query_id", "left")
    return both.groupBy(F.coalesce(first["identity"], F.lit(0.0)).alias("identity"), F.coalesce(first["coverage"], F.lit(0.0)).alias("coverage")).agg(F.count("*").alias("clusters"), F.sum("reads").cast("long").alias("reads"))


def _best_of_pairs(aln: DataFrame) -> DataFrame:
    """query_id, subject and b (identity and coverage) of each pair's best alignment; scores compare as numbers, the first of equals counts,
    and of those with one place the most alike: without that, which one is taken would change with the order of rows."""
    return aln.groupBy("query_id", "subject").agg(F.max_by(F.struct("identity", "coverage"), F.struct("bitscore", -F.col("ord"), "identity", "coverage")).alias("b"))


def heat_map(aln: DataFrame) -> DataFrame:
    """identity, coverage (whole percents from 0 to 100, halves up), n: the best alignments of queries with subjects; cells without any too. Alignments without a query don't count."""
    n = _best_of_pairs(aln).groupBy(F.floor(F.col("b.identity") + 0.5).alias("identity"), F.floor(F.col("b.coverage") + 0.5).alias("coverage")).agg(F.count("query_id").alias("n"))
    cell = aln.sparkSession.range(101 * 101).select(F.floor(F.col("id") / 101).alias("identity"), (F.col("id") % 101).alias("coverage"))
    return cell.join(n, ["identity", "coverage"], "left").select("identity", "coverage", F.coalesce("n", F.lit(0)).alias("n"))


def contaminated(aln: DataFrame, identity: float, coverage: float) -> DataFrame:
    """Queries whose best alignment with some subject reaches both thresholds. Scores compare as numbers."""
    return _best_of_pairs(aln).where((F.col("b.identity") >= identity) & (F.col("b.coverage") >= coverage)).select("query_id").distinct()


def rdp_triples(fields: Column) -> Column:
    """(taxon, rank, bootstrap) of a classifier's line, split in fields; the root's triple goes."""
    n = F.floor((F.size(fields) - 2) / 3).cast("int")
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(fields, 2 + 3 * i).alias("taxon"), F.get(fields, 3 + 3 * i).alias("rank"), F.get(fields, 4 + 3 * i).cast("double").alias("bootstrap")))
    return F.filter(each, lambda t: t["rank"] != "rootrank")


def training_nodes(lineages: DataFrame) -> DataFrame:
    """id, name, parent, depth of a reference's taxonomy: every prefix is a node, numbered by where it is first seen.

    The driver gets nothing; numbers come from a sort by ranges of the distinct prefixes, which are as many as taxa.
    """
    prefixes = lineages.select("ord", F.posexplode(T.ancestors(F.transform("taxonomy", lambda x: T.unaccented(x)))).alias("pos", "node"))
    seen = prefixes.groupBy(F.array_join("node", ";").alias("path")).agg(F.min(F.struct("ord", "pos")).alias("at"), F.first("node").alias("node"))
    nodes = numbered(seen.select("path", "node", "at.ord", "at.pos"), [F.asc("ord"), F.asc("pos")], "id")
    up = nodes.select(F.col("path").alias("up"), F.col("id").alias("up_id"))
    parent = F.array_join(F.slice("node", 1, F.size("node") - 1), ";")
    return nodes.join(up, parent == F.col("up"), "left").select("id", F.element_at("node", -1).alias("name"), F.coalesce("up_id", F.lit(0)).alias("parent"), F.size("node").cast("long").alias("depth"))
