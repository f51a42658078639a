"""Queries on alignments and lineages."""

from __future__ import annotations

from pyspark.sql import functions as F

from amplicore.functions import taxonomy as T
from amplicore.operators import taxonomy as X
from amplicore.plans.bridge import AB_SQL, AFF_SQL, BEST_SQL, CONS_SQL, abundance, alignments, lineages, table
from amplicore.plans.registry import query

_CONS = f"WITH {AFF_SQL}, {BEST_SQL}, {CONS_SQL}"
_JOINED = "c1 || ';' || c2 || ';' || c3"


def _best(spark, sf_dir):
    return X.best_hits(alignments(spark, sf_dir))


def _cons(spark, sf_dir):
    return X.with_consensus(X.affiliations(_best(spark, sf_dir)))


@query("best_hits", f"WITH {AFF_SQL}, {BEST_SQL} SELECT query_id, subject, ord, bitscore, identity, coverage, r1 || ';' || r2 || ';' || r3 AS lineage FROM best")
def best_hits(spark, sf_dir):
    return _best(spark, sf_dir).select("query_id", "subject", "ord", "bitscore", "identity", "coverage", F.array_join("taxonomy", ";").alias("lineage"))


@query("hit_coverage", """SELECT l_orderkey AS query_id, l_linenumber AS ord, round(100.0::DOUBLE * (l_quantity - l_linenumber + 1) / 60, 6) AS query_coverage,
CASE WHEN p_size % 5 = 0 THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE * (l_quantity - l_linenumber + 1) / p_size, 6) END AS subject_coverage FROM lineitem JOIN part ON l_partkey = p_partkey""")
def hit_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").alias("ord"), F.col("l_linenumber").alias("qstart"), F.col("l_quantity").alias("qend"), F.lit(60).alias("qlen"), F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("slen"))
    return X.spans(rows).select("query_id", "ord", F.round("query_coverage", 6).alias("query_coverage"), F.round("subject_coverage", 6).alias("subject_coverage"))


@query("tax_consensus", f"{_CONS} SELECT query_id, hits, {_JOINED} AS consensus FROM cons")
def tax_consensus(spark, sf_dir):
    return _cons(spark, sf_dir).select("query_id", F.size("affs").cast("long").alias("hits"), F.array_join("consensus", ";").alias("consensus"))


@query("attach_affiliations", f"{_CONS} SELECT o_orderkey AS obs_id, coalesce(hits, 0) AS hits, coalesce({_JOINED}, '') AS consensus FROM orders LEFT JOIN cons ON o_orderkey = query_id")
def attach_affiliations(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs_id"))
    return X.attached(obs, _cons(spark, sf_dir)).select("obs_id", F.size("affs").cast("long").alias("hits"), F.array_join("consensus", ";").alias("consensus"))


@query("affiliation_summary", f"""{_CONS} SELECT count(*) AS obs, count(query_id) AS affiliated, CAST(sum(q) AS BIGINT) AS reads, CAST(sum(q) FILTER (query_id IS NOT NULL) AS BIGINT) AS affiliated_reads,
count(*) FILTER (c3 = 'Multi-affiliation') AS ambiguous FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS q FROM orders) LEFT JOIN cons ON o_orderkey = query_id""")
def affiliation_summary(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs_id"), F.col("o_totalprice").alias("p"))
    both = X.attached(obs.select("obs_id", F.floor("p").alias("q")), _cons(spark, sf_dir))
    has = F.size("affs") > 0
    return both.agg(F.count("*").alias("obs"), F.count_if(has).alias("affiliated"), F.sum("q").alias("reads"), F.sum(F.when(has, F.col("q"))).alias("affiliated_reads"), F.count_if(F.array_contains("consensus", T.MULTI)).alias("ambiguous"))


@query("rank_ambiguity", f"""{_CONS} SELECT rank, count(*) FILTER (c = 'Multi-affiliation') AS ambiguous, count(*) FILTER (c <> 'Multi-affiliation') AS unambiguous
FROM (SELECT 1::BIGINT AS rank, c1 AS c FROM cons UNION ALL SELECT 2, c2 FROM cons UNION ALL SELECT 3, c3 FROM cons) GROUP BY 1""")
def rank_ambiguity(spark, sf_dir):
    return X.affiliation_summary(_cons(spark, sf_dir))


@query("uniform_or_multi", f"""WITH {AFF_SQL}, {BEST_SQL} SELECT query_id, CASE WHEN count(DISTINCT subject) = 1 THEN CAST(min(subject) AS VARCHAR) ELSE 'multi-subject' END AS subject,
CASE WHEN count(DISTINCT CAST(round(identity) AS INTEGER)) = 1 THEN CAST(CAST(round(min(identity)) AS INTEGER) AS VARCHAR) ELSE 'multi-identity' END AS identity,
CASE WHEN count(DISTINCT CAST(round(coverage) AS INTEGER)) = 1 THEN CAST(CAST(round(min(coverage)) AS INTEGER) AS VARCHAR) ELSE 'multi-coverage' END AS coverage,
CASE WHEN count(DISTINCT aln_length) = 1 THEN CAST(min(aln_length) AS VARCHAR) ELSE 'multi-alignment-lg' END AS aln_length FROM best GROUP BY 1""")
def uniform_or_multi(spark, sf_dir):
    return X.collapsed(X.affiliations(_best(spark, sf_dir)))


@query("multi_affiliation_rows", f"""WITH {AFF_SQL}, {BEST_SQL} SELECT query_id, r1 || ';' || r2 || ';' || r3 AS lineage, subject, identity, coverage, aln_length
FROM (SELECT *, count(*) OVER (PARTITION BY query_id) AS k FROM best) WHERE k > 1""")
def multi_affiliation_rows(spark, sf_dir):
    return X.multi_rows(X.affiliations(_best(spark, sf_dir)))


_FILTERED = f"""WITH {AFF_SQL}, g AS (SELECT query_id, count(DISTINCT r1 || r2 || r3) AS k, count(DISTINCT r1 || r2 || r3) FILTER (identity >= 95) AS ki, count(DISTINCT r1 || r2 || r3) FILTER (aln_length >= 10) AS kl FROM aff GROUP BY 1),
s AS (SELECT aff.*, ki <> k AS ai, kl <> k AS al, (ki = k OR identity >= 95) AND (kl = k OR aln_length >= 10) AS stays FROM aff JOIN g USING (query_id)),
q AS (SELECT query_id, any_value(ai) AS ai, any_value(al) AS al, count(*) FILTER (stays) AS l, count(*) AS n FROM s GROUP BY 1),
b AS (SELECT s.* FROM s JOIN q USING (query_id) WHERE stays OR l = 0),
cc AS (SELECT query_id, count(*) AS hits, CASE WHEN count(DISTINCT r1) > 1 THEN 'Multi-affiliation;Multi-affiliation;Multi-affiliation' WHEN count(DISTINCT r2) > 1 THEN min(r1) || ';Multi-affiliation;Multi-affiliation'
  WHEN count(DISTINCT r3) > 1 THEN min(r1) || ';' || min(r2) || ';Multi-affiliation' ELSE min(r1) || ';' || min(r2) || ';' || min(r3) END AS consensus FROM b GROUP BY 1),
r AS (SELECT q.query_id, hits, consensus, CASE WHEN l = 0 THEN 'impacted' WHEN l < n THEN 'changed' ELSE 'unchanged' END AS status,
  CASE WHEN l = 0 THEN concat_ws(',', CASE WHEN ai THEN 'identity' END, CASE WHEN al THEN 'length' END) ELSE '' END AS reasons FROM q JOIN cc USING (query_id))"""


def _filtered(spark, sf_dir):
    tests = {"identity": lambda a: a["identity"] >= 95, "length": lambda a: a["aln_length"] >= 10}
    return X.metric_filter(X.affiliations(alignments(spark, sf_dir)), tests)


def _shown(df):
    return df.select("query_id", F.size("affs").cast("long").alias("hits"), F.array_join("consensus", ";").alias("consensus"), "status", "reasons")


@query("affiliation_metric_filter", f"{_FILTERED} SELECT * FROM r")
def affiliation_metric_filter(spark, sf_dir):
    return _shown(_filtered(spark, sf_dir))


@query("affiliation_delete", f"{_FILTERED} SELECT query_id, CASE WHEN status = 'impacted' THEN 'ASV_deleted' ELSE status END AS status FROM r")
def affiliation_delete(spark, sf_dir):
    kept, gone = X.deleted(_filtered(spark, sf_dir))
    return kept.select("query_id", "status").unionByName(gone.select("query_id", "status"))


@query("affiliation_mask", f"""{_FILTERED} SELECT query_id, CASE WHEN status = 'impacted' THEN 0 ELSE hits END AS hits, CASE WHEN status = 'impacted' THEN '' ELSE consensus END AS consensus,
CASE status WHEN 'impacted' THEN 'Affiliation_masked' WHEN 'changed' THEN 'Blast_taxonomy_changed' ELSE status END AS status, reasons FROM r""")
def affiliation_mask(spark, sf_dir):
    return _shown(X.masked(_filtered(spark, sf_dir)))


@query("affiliation_taxon_toggle", """SELECT p_partkey AS obs_id, ((lower(p_name) LIKE '%red%') <> (p_brand LIKE '%2%')) <> (p_type LIKE 'E%') AS ignored FROM part""")
def affiliation_taxon_toggle(spark, sf_dir):
    joined = F.array_join("taxonomy", ";")
    return lineages(spark, sf_dir).select("obs_id", T.toggled(joined, [r"(?i);[^;]*red[^;]*$", r";[^;]*2[^;]*;", "^E"]).alias("ignored"))


@query("rdp_bootstrap_filter", "SELECT p_partkey AS obs_id, (p_retailprice % 100) / 100 < 0.5 AS impacted FROM part")
def rdp_bootstrap_filter(spark, sf_dir):
    boots = F.array(F.lit(1.0), F.col("p_retailprice") % 100 / 100)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), (F.element_at(boots, 2) < 0.5).alias("impacted"))


@query("shortest_reference", f"""WITH {AFF_SQL}, {BEST_SQL}, z AS (SELECT p_partkey AS subject, CASE WHEN p_partkey % 11 <> 0 THEN p_size END AS length FROM part),
k AS (SELECT best.query_id, subject, length, bool_or(length IS NULL) OVER (PARTITION BY query_id) AS missing, min(length) OVER (PARTITION BY query_id) AS least FROM best JOIN z USING (subject))
SELECT query_id, subject, length FROM k WHERE missing OR length = least""")
def shortest_reference(spark, sf_dir):
    lengths = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("subject"), F.when(F.col("p_partkey") % 11 != 0, F.col("p_size")).alias("length"))
    return X.shortest_reference(_best(spark, sf_dir), lengths).select("query_id", "subject", "length")


@query("reference_reduction", f"WITH {AFF_SQL} SELECT DISTINCT subject FROM (SELECT subject, dense_rank() OVER (PARTITION BY query_id ORDER BY bitscore DESC) AS d FROM aff) WHERE d <= 2")
def reference_reduction(spark, sf_dir):
    return X.reference_reduction(alignments(spark, sf_dir), 2)


@query("standard_taxonomy", f"{_CONS} SELECT o_orderkey AS query_id, coalesce({_JOINED}, 'Unclassified;Unclassified;Unclassified') AS taxonomy FROM orders LEFT JOIN cons ON o_orderkey = query_id")
def standard_taxonomy(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("query_id"))
    return X.standard(X.attached(obs, _cons(spark, sf_dir), "query_id"), 3)


@query("taxonomy_tree_counts", f"WITH {AB_SQL} SELECT p_type || ';' || p_brand || ';' || p_name AS lineage, sample_id, CAST(sum(n) AS BIGINT) AS count FROM ab JOIN part ON obs_id = p_partkey GROUP BY 1, 2")
def taxonomy_tree_counts(spark, sf_dir):
    return X.terminal_counts(abundance(spark, sf_dir), lineages(spark, sf_dir))


@query("taxonomy_rollup", f"""WITH {AB_SQL}, p AS (SELECT p_type, p_brand, p_name, n FROM ab JOIN part ON obs_id = p_partkey)
SELECT p_type AS lineage, 1::BIGINT AS depth, CAST(sum(n) AS BIGINT) AS count FROM p GROUP BY 1 UNION ALL SELECT p_type || ';' || p_brand, 2, CAST(sum(n) AS BIGINT) FROM p GROUP BY 1
UNION ALL SELECT p_type || ';' || p_brand || ';' || p_name, 3, CAST(sum(n) AS BIGINT) FROM p GROUP BY 1""")
def taxonomy_rollup(spark, sf_dir):
    return X.rollup(abundance(spark, sf_dir), lineages(spark, sf_dir))


@query("distinct_taxa_per_rank", "SELECT 1::BIGINT AS rank, count(DISTINCT p_type) FILTER (p_type <> 'ECONOMY') AS taxa FROM part UNION ALL SELECT 2, count(DISTINCT p_brand) FROM part UNION ALL SELECT 3, count(DISTINCT p_name) FROM part")
def distinct_taxa_per_rank(spark, sf_dir):
    return X.distinct_by_rank(lineages(spark, sf_dir), ["ECONOMY", "unknown species", T.MULTI])


@query("taxonomy_normalise", "SELECT p_partkey AS obs_id, p_type || '|' || p_brand || '|' || p_name AS lineage FROM part")
def taxonomy_normalise(spark, sf_dir):
    a, b, c = F.col("p_type"), F.col("p_brand"), F.col("p_name")
    plain = F.concat_ws(";", a, b, c)
    spelled = F.when(F.col("p_partkey") % 5 == 0, plain).when(F.col("p_partkey") % 5 == 1, F.concat(plain, F.lit(";"))).when(F.col("p_partkey") % 5 == 2, F.concat_ws(" ; ", a, b, c))
    spelled = spelled.when(F.col("p_partkey") % 5 == 3, F.concat(a, F.lit("(1.0);"), b, F.lit("(0.9);"), c, F.lit("(0.5);"))).otherwise(F.concat(F.lit(" "), plain, F.lit(" ; ")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), F.array_join(T.canonical(spelled), "|").alias("lineage"))


@query("bootstrap_distribution", "SELECT rank, bootstrap, count(*) AS clusters, CAST(sum(p_size) AS BIGINT) AS reads FROM (SELECT 1::BIGINT AS rank, 100::BIGINT AS bootstrap, p_size FROM part UNION ALL SELECT 2, CAST(round((p_size / 50::DOUBLE) * 100) AS BIGINT), p_size FROM part) GROUP BY 1, 2")
def bootstrap_distribution(spark, sf_dir):
    return X.bootstrap_distribution(table(spark, sf_dir, "part").select(F.array(F.lit(1.0), F.col("p_size") / 50).alias("bootstrap"), F.col("p_size").alias("reads")))


@query("alignment_distribution", f"""WITH {AFF_SQL}, {BEST_SQL}, f AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY ord, subject) = 1)
SELECT coalesce(identity, 0) AS identity, coalesce(coverage, 0) AS coverage, count(*) AS clusters, CAST(sum(o_custkey) AS BIGINT) AS reads FROM orders LEFT JOIN f ON o_orderkey = query_id GROUP BY 1, 2""")
def alignment_distribution(spark, sf_dir):
    reads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("query_id"), F.col("o_custkey").alias("reads"))
    return X.alignment_distribution(X.affiliations(_best(spark, sf_dir)), reads)


@query("identity_coverage_heatmap", f"""WITH {AFF_SQL}, b AS (SELECT * FROM aff QUALIFY row_number() OVER (PARTITION BY query_id, subject ORDER BY bitscore DESC, ord) = 1),
g AS (SELECT CAST(i AS BIGINT) AS identity, CAST(c AS BIGINT) AS coverage FROM (SELECT unnest(range(101)) AS i), (SELECT unnest(range(101)) AS c))
SELECT g.identity, g.coverage, count(b.query_id) AS n FROM g LEFT JOIN b ON g.identity = floor(b.identity + 0.5) AND g.coverage = floor(b.coverage + 0.5) GROUP BY 1, 2""")
def identity_coverage_heatmap(spark, sf_dir):
    return X.heat_map(alignments(spark, sf_dir))


@query("contaminant_filter", f"""WITH {AFF_SQL}, b AS (SELECT * FROM aff QUALIFY row_number() OVER (PARTITION BY query_id, subject ORDER BY bitscore DESC, ord) = 1),
x AS (SELECT DISTINCT query_id FROM b WHERE identity >= 99 AND coverage >= 98) SELECT o_orderkey AS query_id FROM orders WHERE o_orderkey NOT IN (SELECT query_id FROM x)""")
def contaminant_filter(spark, sf_dir):
    bad = X.contaminated(alignments(spark, sf_dir), 99, 98)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("query_id")).join(bad, "query_id", "left_anti")


@query("rdp_triples", "SELECT p_partkey AS obs_id, p_type || '=' || 1.0 || ';' || p_brand || '=' || 0.5 AS taxa FROM part")
def rdp_triples(spark, sf_dir):
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), F.lit(""), F.lit("Root"), F.lit("rootrank"), F.lit("1.0"), "p_type", F.lit("domain"), F.lit("1.0"), "p_brand", F.lit("genus"), F.lit("0.5"))
    out = X.rdp_triples(F.split(line, "\t"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), F.array_join(F.transform(out, lambda t: F.concat(t["taxon"], F.lit("="), t["bootstrap"].cast("string"))), ";").alias("taxa"))


@query("training_taxonomy", """WITH p AS (SELECT p_partkey AS ord, 0 AS pos, p_type AS path, p_type AS name, '' AS up, 1::BIGINT AS depth FROM part UNION ALL SELECT p_partkey, 1, p_type || ';' || p_brand, p_brand, p_type, 2 FROM part),
s AS (SELECT path, any_value(name) AS name, any_value(up) AS up, any_value(depth) AS depth, min(ord * 10 + pos) AS first_at FROM p GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY first_at) AS id FROM s)
SELECT k.id, k.name, coalesce(u.id, 0) AS parent, k.depth FROM k LEFT JOIN k u ON k.up = u.path""")
def training_taxonomy(spark, sf_dir):
    return X.training_nodes(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.array("p_type", "p_brand").alias("taxonomy")))


@query("link_by_prefix", """SELECT p_partkey AS obs_id, CASE WHEN p_type LIKE 'E%' THEN 'https://www.genome.jp/dbget-bin/www_bget?EC:' || p_size WHEN p_size < 10 THEN 'https://www.ncbi.nlm.nih.gov/research/cog/cog/xCOG' || p_size
WHEN p_size < 20 THEN 'https://pfam.xfam.org/family/PF' || p_size WHEN p_size < 30 THEN 'https://www.genome.jp/dbget-bin/www_bget?ko:K000' || p_size ELSE 'no link' END AS link FROM part""")
def link_by_prefix(spark, sf_dir):
    size = F.col("p_size").cast("string")
    name = F.when(F.col("p_type").startswith("E"), F.concat(F.lit("EC:"), size)).when(F.col("p_size") < 10, F.concat(F.lit("xCOG"), size)).when(F.col("p_size") < 20, F.concat(F.lit("PF"), size)).when(F.col("p_size") < 30, F.concat(F.lit("ko:K000"), size)).otherwise(size)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), T.link(name).alias("link"))


@query("clean_species", """SELECT p_partkey AS obs_id, CASE WHEN p_size < 5 THEN 'unknown species' WHEN p_size < 10 THEN p_brand || ' metagenome' WHEN p_size < 20 THEN 'G' || p_partkey || ' sp.'
WHEN p_size < 30 THEN 'G' || p_partkey || ' s' WHEN p_size < 40 THEN p_name ELSE p_name || ' DSM 20 x' END AS species FROM part""")
def clean_species(spark, sf_dir):
    s = F.col("p_size")
    name = F.when(s < 5, F.concat(F.lit("uncultured "), "p_name")).when(s < 10, F.concat("p_brand", F.lit(" metagenome"))).when(s < 20, F.concat(F.lit("G"), "p_partkey", F.lit(" sp. strain 1"))).when(s < 30, F.concat(F.lit("G"), "p_partkey", F.lit(" s subsp. x"))).when(s < 40, F.concat("p_name", F.lit(" DSM 20")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), T.cleaned_species(name.otherwise(F.concat("p_name", F.lit(" DSM 20 x")))).alias("species"))


@query("complete_ranks", "SELECT p_partkey AS obs_id, p_type || ';' || CASE WHEN p_size > 25 THEN p_brand || ';unknown genus' ELSE 'unknown family;unknown genus' END AS lineage FROM part")
def complete_ranks(spark, sf_dir):
    had = F.when(F.col("p_size") > 25, F.array("p_type", "p_brand")).otherwise(F.array("p_type"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), F.array_join(T.completed(had, ["domain", "family", "genus"]), ";").alias("lineage"))


@query("lowest_shared_rank", """SELECT p_partkey AS obs_id, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN 'domain' WHEN p_size < 30 THEN 'family' ELSE 'genus' END AS rank FROM part""")
def lowest_shared_rank(spark, sf_dir):
    s, own = F.col("p_size"), F.array("p_type", "p_brand", "p_name")
    other = F.array(F.when(s < 10, "x").otherwise(F.col("p_type")), F.when(s < 20, "x").otherwise(F.col("p_brand")), F.when(s < 30, "x").otherwise(F.col("p_name")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), T.lowest_shared(own, other, ["domain", "family", "genus"]).alias("rank"))


@query("convert_reference", """SELECT p_partkey AS obs_id, p_type || ';' || CASE WHEN p_size > 25 THEN p_brand ELSE 'unknown family' END || ';unknown genus' AS lineage, replace(replace(p_name, 'U', 'T'), 'u', 't') AS sequence FROM part WHERE p_type LIKE 'S%'""")
def convert_reference(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    kinds = [r[0] for r in p.where("p_type like 'S%'").select("p_type").distinct().collect()]  # the domains asked for
    had = F.when(F.col("p_size") > 25, F.array("p_type", "p_brand")).otherwise(F.array("p_type"))
    out = p.select(F.col("p_partkey").alias("obs_id"), F.array_join(T.converted(had, ["domain", "family", "genus"], kinds), ";").alias("lineage"), T.as_dna(F.col("p_name")).alias("sequence"))
    return out.where("lineage is not null")
