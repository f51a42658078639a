"""Queries on sampling, diversity and assessment."""

from __future__ import annotations

from pyspark.sql import functions as F

from amplicore.operators import assessment as A
from amplicore.operators import ecology as E
from amplicore.operators import sampling as P
from amplicore.plans.bridge import AB_SQL, SAMPLE_SQL, TAX_SQL, abundance, lineages, samples, table
from amplicore.plans.registry import query

_SMALL_SQL = """sm AS (SELECT p_brand AS obs_id, r_name AS sample_id, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
un AS (SELECT obs_id, sample_id, md5(obs_id || '|' || sample_id || '|' || i) AS h FROM (SELECT obs_id, sample_id, unnest(generate_series(1, n)) AS i FROM sm)),
rk AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY h) AS r, count(*) OVER (PARTITION BY sample_id) AS total FROM un)"""


#: Suppliers that are sent to all tasks; more are shuffled.
SENT_SUPPLIERS = 100_000


def _small(spark, sf_dir):
    """Lines are summed by part and region before they meet their parts, so that with few suppliers no shuffle holds them all."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("obs_id"))
    sup = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sup = sup.select("s_suppkey", F.col("r_name").alias("sample_id"))
    lines = table(spark, sf_dir, "lineitem").join(F.broadcast(sup) if sup.count() <= SENT_SUPPLIERS else sup, F.col("l_suppkey") == F.col("s_suppkey"))
    sums = lines.groupBy("l_partkey", "sample_id").agg(F.sum("l_quantity").alias("n"))
    return sums.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("obs_id", "sample_id").agg(F.sum("n").cast("long").alias("count"))


@query("subsample_to_min", f"WITH {_SMALL_SQL} SELECT obs_id, sample_id, count(*) AS count FROM rk WHERE r <= (SELECT min(total) FROM rk) GROUP BY 1, 2")
def subsample_to_min(spark, sf_dir):
    return P.subsampled(_small(spark, sf_dir))


@query("subsample_delete_small", f"WITH {_SMALL_SQL}, g AS (SELECT CAST(floor(avg(t)) AS BIGINT) AS g FROM (SELECT sum(n) AS t FROM sm GROUP BY sample_id)) SELECT obs_id, sample_id, count(*) AS count FROM rk, g WHERE total >= g AND r <= g GROUP BY 1, 2")
def subsample_delete_small(spark, sf_dir):
    ab = _small(spark, sf_dir)
    n = ab.groupBy("sample_id").agg(F.sum("count").alias("t")).agg(F.floor(F.avg("t"))).first()[0]
    return P.subsampled(ab, n=n, drop_small=True)


@query("subsample_ratio", f"WITH {_SMALL_SQL} SELECT obs_id, sample_id, count(*) AS count FROM rk WHERE r <= floor(total * 0.25) GROUP BY 1, 2")
def subsample_ratio(spark, sf_dir):
    return P.subsampled(_small(spark, sf_dir), ratio=0.25)


@query("rarefaction_curve", f"""WITH {_SMALL_SQL}, f AS (SELECT sample_id, obs_id, min(r) AS r FROM rk GROUP BY 1, 2), st AS (SELECT CAST(greatest(1, n // 35) AS BIGINT) AS step FROM (SELECT n, row_number() OVER (ORDER BY n, sample_id) AS r, count(*) OVER () AS k FROM (SELECT sample_id, sum(n) AS n FROM sm GROUP BY 1)) WHERE r = k // 4 + 1),
g AS (SELECT sample_id, any_value(step) AS step, unnest(generate_series(1, CAST(any_value(total) // any_value(step) AS BIGINT))) AS k FROM rk, st GROUP BY 1)
SELECT g.sample_id, k * step AS nb_sampled, count(f.r) AS taxa FROM g LEFT JOIN f ON f.sample_id = g.sample_id AND f.r <= k * step GROUP BY 1, 2""")
def rarefaction_curve(spark, sf_dir):
    ab = _small(spark, sf_dir)
    return P.rarefaction(ab, None, P.step_size(ab))


@query("rarefaction_ranks", f"""WITH {_SMALL_SQL}, x AS (SELECT obs_id, CASE WHEN obs_id LIKE '%1' THEN 'unknown;unknown' WHEN obs_id LIKE '%2' THEN lower(obs_id) || ';unknown' ELSE lower(obs_id) || ';' || substr(lower(obs_id), 7, 1) END AS taxon FROM (SELECT DISTINCT obs_id FROM sm)),
f AS (SELECT sample_id, taxon, min(r) AS r FROM rk JOIN x USING (obs_id) GROUP BY 1, 2), g AS (SELECT sample_id, unnest(generate_series(1, any_value(total) // 5000)) AS k FROM rk GROUP BY 1),
c AS (SELECT g.sample_id, k * 5000 AS nb_sampled, count(f.r) AS taxa FROM g LEFT JOIN f ON f.sample_id = g.sample_id AND f.r <= k * 5000 GROUP BY 1, 2)
SELECT nb_sampled, coalesce(max(CAST(taxa AS VARCHAR)) FILTER (sample_id = 'ASIA'), '') AS "ASIA", coalesce(max(CAST(taxa AS VARCHAR)) FILTER (sample_id = 'EUROPE'), '') AS "EUROPE" FROM c WHERE sample_id IN ('ASIA', 'EUROPE') GROUP BY 1""")
def rarefaction_ranks(spark, sf_dir):
    ab = _small(spark, sf_dir)
    own, last = F.col("obs_id"), F.substr("obs_id", F.length("obs_id"))
    names = F.when(last == "1", F.array(F.lit("Unknown brand"))).when(last == "2", F.array(own)).otherwise(F.array(own, F.substr("obs_id", F.lit(7), F.lit(1))))
    lin = ab.select("obs_id").distinct().select("obs_id", names.alias("taxonomy"))
    return P.rarefaction_table(P.rarefaction(ab, P.ranked_taxa(lin, 1, 2), 5000).where("sample_id in ('ASIA', 'EUROPE')"), ["ASIA", "EUROPE"])


@query("rarefaction_step", f"WITH {AB_SQL}, t AS (SELECT sample_id, sum(n) AS n FROM ab GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY n, sample_id) AS r, count(*) OVER () AS k FROM t) SELECT CAST(greatest(1, n // 35) AS BIGINT) AS step FROM r WHERE r = k // 4 + 1")
def rarefaction_step(spark, sf_dir):
    return spark.createDataFrame([(P.step_size(abundance(spark, sf_dir)),)], "step long")


@query("rarefied_richness", f"""WITH {_SMALL_SQL.split("un AS")[0].rstrip().rstrip(",")}, t AS (SELECT sample_id, sum(n) AS t FROM sm GROUP BY 1), c AS (SELECT sample_id, n, count(*) AS m FROM sm GROUP BY 1, 2),
d AS (SELECT sample_id, t, CAST(unnest(list_append(generate_series(10, CAST(t - 1 AS BIGINT), 10), CAST(t AS BIGINT))) AS BIGINT) AS depth FROM t)
SELECT d.sample_id, depth, round(sum(m * CASE WHEN t - n >= depth THEN 1 - exp(lgamma(t - n + 1) - lgamma(t - n - depth + 1) - lgamma(t + 1) + lgamma(t - depth + 1)) ELSE 1 END), 3) AS richness FROM d JOIN c ON c.sample_id = d.sample_id GROUP BY 1, 2""")
def rarefied_richness(spark, sf_dir):
    return P.rarefied_richness(_small(spark, sf_dir)).select("sample_id", "depth", F.round("richness", 3).alias("richness"))


@query("alpha_diversity", """WITH c AS (SELECT CAST(user_id AS VARCHAR) AS sample_id, event_type, count(*)::DOUBLE AS n FROM events GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY sample_id) AS t FROM c)
SELECT sample_id, count(*) AS observed, round(count(*) + (count(*) FILTER (n = 1) * (count(*) FILTER (n = 1) - 1))::DOUBLE / (2 * (count(*) FILTER (n = 2) + 1)), 6) AS chao1,
round(-sum(n / t * ln(n / t)), 6) AS shannon, round(1 / sum((n / t) * (n / t)), 6) AS inv_simpson FROM t GROUP BY 1""")
def alpha_diversity(spark, sf_dir):
    ab = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("obs_id"), F.col("user_id").cast("string").alias("sample_id")).agg(F.count("*").alias("count"))
    return E.alpha_diversity(ab)


_PAIRS = f"""WITH {AB_SQL}, s AS (SELECT DISTINCT sample_id FROM ab), o AS (SELECT DISTINCT obs_id FROM ab), d AS (SELECT obs_id, sample_id, coalesce(n, 0)::DOUBLE AS n FROM o CROSS JOIN s LEFT JOIN ab USING (obs_id, sample_id)),
p AS (SELECT a.sample_id AS sample_a, b.sample_id AS sample_b, a.n AS x, b.n AS y FROM d a JOIN d b ON a.obs_id = b.obs_id AND a.sample_id < b.sample_id WHERE a.n + b.n > 0)"""


def _beta(measure: str, formula: str) -> None:
    @query(f"beta_{measure}", f"{_PAIRS} SELECT sample_a, sample_b, round({formula}, 6) AS d FROM p GROUP BY 1, 2")
    def run(spark, sf_dir, measure=measure):
        return E.distances(abundance(spark, sf_dir), measure)


_beta("bray", "sum(abs(x - y)) / sum(x + y)")
_beta("jaccard", "1 - count(*) FILTER (x > 0 AND y > 0)::DOUBLE / count(*)")
_beta("euclidean", "sqrt(sum((x - y) * (x - y)))")
_beta("manhattan", "sum(abs(x - y))")
_beta("canberra", "sum(abs(x - y) / (x + y))")


@query("beta_unifrac", f"""WITH {AB_SQL}, b AS (SELECT p_partkey AS obs_id, p_type AS branch, 1.0::DOUBLE AS l FROM part UNION ALL SELECT p_partkey, p_type || p_brand, 0.5 FROM part UNION ALL SELECT p_partkey, CAST(p_partkey AS VARCHAR), 0.25 FROM part),
u AS (SELECT DISTINCT sample_id, branch, l FROM ab JOIN b USING (obs_id)), t AS (SELECT sample_id, sum(l) AS t FROM u GROUP BY 1),
m AS (SELECT x.sample_id AS sample_a, y.sample_id AS sample_b, sum(x.l) AS m FROM u x JOIN u y ON x.branch = y.branch AND x.sample_id < y.sample_id GROUP BY 1, 2)
SELECT sample_a, sample_b, round(1 - m / (a.t + c.t - m), 6) AS d FROM m JOIN t a ON a.sample_id = sample_a JOIN t c ON c.sample_id = sample_b""")
def beta_unifrac(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    levels = F.array(F.struct(F.col("p_type").alias("branch"), F.lit(1.0).alias("length")), F.struct(F.concat("p_type", "p_brand").alias("branch"), F.lit(0.5).alias("length")), F.struct(F.col("p_partkey").cast("string").alias("branch"), F.lit(0.25).alias("length")))
    return E.unifrac(abundance(spark, sf_dir), p.select(F.col("p_partkey").alias("obs_id"), F.explode(levels).alias("b")).select("obs_id", "b.branch", "b.length"))


@query("composition_top_taxa", f"""WITH {AB_SQL}, {SAMPLE_SQL}, o AS (SELECT grp AS sample_id, p_brand AS taxon, sum(n) AS n FROM ab JOIN smp USING (sample_id) JOIN part ON obs_id = p_partkey GROUP BY 1, 2),
t AS (SELECT taxon FROM (SELECT taxon, sum(n) AS s FROM o GROUP BY 1) ORDER BY s DESC, taxon LIMIT 9) SELECT sample_id, CASE WHEN taxon IN (SELECT taxon FROM t) THEN taxon ELSE 'Other' END AS taxon, CAST(sum(n) AS BIGINT) AS count FROM o GROUP BY 1, 2""")
def composition_top_taxa(spark, sf_dir):
    ab = abundance(spark, sf_dir).join(samples(spark, sf_dir), "sample_id").select("obs_id", F.col("group").alias("sample_id"), "count")
    return E.composition(ab, lineages(spark, sf_dir).select("obs_id", F.get("taxonomy", F.lit(1)).alias("taxon")), 9)


@query("anova_measure", """WITH g AS (SELECT s_nationkey % 5 AS k, count(*)::DOUBLE AS n, sum(s_acctbal) AS s, sum(s_acctbal * s_acctbal) AS q FROM supplier GROUP BY 1), t AS (SELECT count(*) AS k, sum(n) AS n, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM g)
SELECT k - 1 AS df_between, CAST(n - k AS BIGINT) AS df_within, round(((b - s * s / n) / (k - 1)) / ((q - b) / (n - k)), 6) AS f FROM t""")
def anova_measure(spark, sf_dir):
    return E.anova(table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 5).alias("k"), "s_acctbal"), "k", "s_acctbal")


@query("anova_depth", """WITH g AS (SELECT s_nationkey % 5 AS k, count(*)::DOUBLE AS n, sum(s_suppkey)::DOUBLE AS x, sum(s_acctbal) AS y, sum(s_suppkey::DOUBLE * s_suppkey) AS xx, sum(s_suppkey * s_acctbal) AS xy, sum(s_acctbal * s_acctbal) AS yy FROM supplier GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n) AS n, sum(xx) - sum(x) * sum(x) / sum(n) AS sxx, sum(xy) - sum(x) * sum(y) / sum(n) AS sxy, sum(yy) - sum(y) * sum(y) / sum(n) AS syy, sum(xx - x * x / n) AS wxx, sum(xy - x * y / n) AS wxy, sum(yy - y * y / n) AS wyy FROM g),
r AS (SELECT *, wyy - wxy * wxy / wxx AS f, syy - sxy * sxy / sxx AS d FROM t)
SELECT k - 1 AS df_group, CAST(n - k - 1 AS BIGINT) AS df_within, round((syy - d) / (f / (n - k - 1)), 4) AS f_depth, round(((d - f) / (k - 1)) / (f / (n - k - 1)), 4) AS f_group FROM r""")
def anova_depth(spark, sf_dir):
    out = E.anova_depth(table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 5).alias("k"), "s_acctbal", "s_suppkey"), "k", "s_acctbal", "s_suppkey")
    return out.select("df_group", "df_within", F.round("f_depth", 4).alias("f_depth"), F.round("f_group", 4).alias("f_group"))


@query("size_factors", f"""WITH {AB_SQL}, m AS (SELECT obs_id, sum(ln(n)) / (SELECT count(DISTINCT sample_id) FROM ab) AS m FROM ab GROUP BY 1), d AS (SELECT sample_id, quantile_cont(ln(n) - m, 0.5) AS l FROM ab JOIN m USING (obs_id) GROUP BY 1)
SELECT sample_id, round(exp(l - (SELECT avg(l) FROM d)), 6) AS factor FROM d""")
def size_factors(spark, sf_dir):
    return E.size_factors(abundance(spark, sf_dir))


@query("diff_table_split", f"""WITH {AB_SQL}, {SAMPLE_SQL}, x AS (SELECT obs_id, round(log2((sum(CASE WHEN grp = 'ASIA' THEN n ELSE 0 END) + 1)::DOUBLE / (sum(CASE WHEN grp = 'EUROPE' THEN n ELSE 0 END) + 1)), 6) AS log2fc FROM ab JOIN smp USING (sample_id)
WHERE grp IN ('ASIA', 'EUROPE') GROUP BY 1) SELECT obs_id, log2fc, CASE WHEN log2fc > 0 THEN 'over' ELSE 'under' END AS side FROM x""")
def diff_table_split(spark, sf_dir):
    return E.mean_log_ratio(abundance(spark, sf_dir), samples(spark, sf_dir), "ASIA", "EUROPE")


@query("differential_table", """SELECT p_partkey AS obs_id, p_brand AS brand, (p_size - 25) / 10::DOUBLE AS log2fc, CASE WHEN p_size > 25 THEN 'over' ELSE 'under' END AS side,
CASE WHEN p_size > 25 THEN CASE WHEN p_size < 35 THEN '#DE894E' WHEN p_size < 45 THEN '#B26E3E' ELSE '#9B6037' END
WHEN p_size < 25 THEN CASE WHEN p_size > 15 THEN '#B0C6C5' WHEN p_size > 5 THEN '#8EADAC' ELSE '#637978' END END AS colour,
CASE WHEN p_partkey % 100 < 1 THEN 'W11' WHEN p_partkey % 100 < 10 THEN 'W10' ELSE 'W9' END AS width FROM part WHERE p_partkey % 100 < 50""")
def differential_table(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    stats = p.select(F.col("p_partkey").alias("obs_id"), ((F.col("p_size") - 25) / 10).alias("log2fc"), (F.col("p_partkey") % 100 / 1000).alias("padj"))
    out = E.differential(stats, p.select(F.col("p_partkey").alias("obs_id"), F.col("p_brand").alias("brand")), 0.05)
    colour, width = E.map_style(F.col("log2fc"), F.col("padj"))
    return out.select("obs_id", "brand", "log2fc", "side", colour.alias("colour"), width.alias("width"))


@query("metagenome_functions", f"""WITH {AB_SQL} SELECT sample_id, p_type AS function, round(sum(n::DOUBLE / (1 + obs_id % 3) * p_size), 6) AS value FROM ab JOIN part ON obs_id = p_partkey GROUP BY 1, 2""")
def metagenome_functions(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), F.col("p_type").alias("function"), F.col("p_size").alias("copies"))
    return E.metagenome(abundance(spark, sf_dir), p, p.select("obs_id", (1 + F.col("obs_id") % 3).alias("marker")))


@query("nsti_confidence", "SELECT p_partkey AS obs_id, CASE WHEN p_size < 10 THEN 'Good' WHEN p_size < 20 THEN 'Medium' WHEN p_size < 40 THEN 'Bad' ELSE 'To exclude' END AS confidence FROM part")
def nsti_confidence(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), E.nsti_confidence(F.col("p_size") / 20).alias("confidence"))


@query("function_whole_numbers", "SELECT p_partkey AS obs_id, CAST(CASE WHEN p_size % 4 = 1 THEN p_size // 2 WHEN p_size % 4 = 3 THEN p_size // 2 + 1 ELSE p_size // 2 END AS BIGINT) AS a FROM part WHERE p_size > 1")
def function_whole_numbers(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), F.lit("x").alias("db_link"), (F.col("p_size") / 2).alias("a"))
    return E.whole_numbers(rows, ["a"])


@query("pathway_enrichment", """WITH e AS (SELECT DISTINCT p_name AS f, p_brand AS pathway FROM part), l AS (SELECT DISTINCT p_name AS f FROM part WHERE p_size > 40), w AS (SELECT count(DISTINCT f) AS n, count(DISTINCT f) FILTER (f IN (SELECT f FROM l)) AS d FROM e),
s AS (SELECT pathway, count(DISTINCT f) AS m, count(DISTINCT f) FILTER (f IN (SELECT f FROM l)) AS k FROM e GROUP BY 1), i AS (SELECT pathway, m, k, n, d, unnest(generate_series(k, least(m, d))) AS i FROM s, w WHERE true),
p AS (SELECT pathway, k, sum(CASE WHEN d - i <= n - m THEN exp(lgamma(m + 1) - lgamma(i + 1) - lgamma(m - i + 1) + lgamma(n - m + 1) - lgamma(d - i + 1) - lgamma(n - m - d + i + 1) - lgamma(n + 1) + lgamma(d + 1) + lgamma(n - d + 1)) ELSE 0 END) AS p FROM i GROUP BY 1, 2),
a AS (SELECT *, least(p * (SELECT count(*) FROM s), 1.0) AS a FROM p) SELECT pathway, k, round(p, 6) AS p, round(a, 6) AS p_adjusted, CASE WHEN a < 0.001 THEN '***' WHEN a < 0.01 THEN '**' WHEN a < 0.05 THEN '*' ELSE '' END AS stars FROM a""")
def pathway_enrichment(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    out = E.enrichment(p.where("p_size > 40").select(F.col("p_name").alias("function")).distinct(), p.select(F.col("p_name").alias("function"), F.col("p_brand").alias("pathway")).distinct())
    return out.withColumn("p", F.round("p", 6)).withColumn("p_adjusted", F.round("p_adjusted", 6))


def _flag(flag: str) -> str:
    return f"{flag.lower()}_ AS (SELECT l_partkey AS obs_id, sum(l_quantity) AS n FROM lineitem WHERE l_returnflag = '{flag}' GROUP BY 1)"


_RANKED = " UNION ALL ".join(f"SELECT {k}::BIGINT AS rank, {p} AS taxon, sum(n) AS n FROM {{0}}_ JOIN part ON obs_id = p_partkey GROUP BY 2" for k, p in ((1, "p_type"), (2, "p_type || ';' || p_brand"), (3, "p_type || ';' || p_brand || ';' || p_name")))


def _flagged(spark, sf_dir, flag):
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("obs_id")).agg(F.sum("l_quantity").alias("count"))


@query("abundance_by_rank", f"WITH {_flag('R')}, x AS ({_RANKED.format('r')}) SELECT rank, taxon, n AS count FROM x")
def abundance_by_rank(spark, sf_dir):
    return A.abundance_by_rank(_flagged(spark, sf_dir, "R"), lineages(spark, sf_dir))


@query("expected_vs_observed", f"""WITH {_flag('R')}, {_flag('A')}, e AS (SELECT rank, taxon, 100 * n / sum(n) OVER (PARTITION BY rank) AS e FROM ({_RANKED.format('r')})), o AS (SELECT rank, taxon, 100 * n / sum(n) OVER (PARTITION BY rank) AS o FROM ({_RANKED.format('a')}))
SELECT rank, round(100 - sum(least(coalesce(e, 0), coalesce(o, 0))), 6) AS divergence, count(*) FILTER (e IS NOT NULL AND o IS NOT NULL) AS common, count(*) FILTER (o IS NULL) AS only_expected, count(*) FILTER (e IS NULL) AS only_observed FROM e FULL JOIN o USING (rank, taxon) GROUP BY 1""")
def expected_vs_observed(spark, sf_dir):
    tax = lineages(spark, sf_dir)
    return A.divergence(A.abundance_by_rank(_flagged(spark, sf_dir, "R"), tax), A.abundance_by_rank(_flagged(spark, sf_dir, "A"), tax))


@query("duplicate_groups", "SELECT min(doc_id) AS first, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_groups(spark, sf_dir):
    return A.identical(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), F.col("text").alias("sequence")))


@query("recovered_references", """WITH w AS (SELECT DISTINCT source AS sample_id, text FROM documents), g AS (SELECT source AS sample_id, text, count(*) AS n FROM documents WHERE lang <> 'fr' GROUP BY 1, 2)
SELECT sample_id, count(*) AS expected, count(n) AS found, count(*) FILTER (n > 1) AS split FROM w LEFT JOIN g USING (sample_id, text) GROUP BY 1""")
def recovered_references(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("sample_id"), F.col("text").alias("sequence"), F.col("doc_id").alias("seq_id"), "lang")
    return A.recovered(d, d.where("lang <> 'fr'"))


@query("clean_foreign_taxonomy", f"WITH {TAX_SQL} SELECT obs_id, array_to_string(taxonomy, '|') AS lineage FROM tax")
def clean_foreign_taxonomy(spark, sf_dir):
    text = F.concat(F.lit('Root;"k__'), F.get("taxonomy", F.lit(0)), F.lit('"(1.0);p:'), F.get("taxonomy", F.lit(1)), F.lit("[id: 12];g__"), F.get("taxonomy", F.lit(2)), F.lit("(0.91);"))
    return lineages(spark, sf_dir).select("obs_id", F.array_join(A.cleaned(text), "|").alias("lineage"))
