"""Embedding near-duplicate links (operator 8).

Method: pivot-permutation index. Reference points are a bounded sample of the vectors, thinned so that no two are near
duplicates themselves (else the copies in a large group would each name other references); every vector is described by its
``NEAREST`` nearest references in order. Inverted lists hold the vectors of one label by each two references that they name,
so vectors meet in a list exactly if they share two at least; inside a list cosines are computed in double precision, block
against block. References grow with the vectors, so that lists stay as short up to ``SHARE * MOST_PIVOTS`` vectors (262,144);
beyond, lists grow in proportion. A vector is sent, in its own type, to those of its lists that another vector stands in. A
pair that meets in several lists counts in the one of its two smallest shared references only.

A list never gives its pairs away: each block pair returns, for each of its vectors, the number linked and the smallest id
it is tied to there. Equal vectors are one class from the start and count with their number. There is no cap on lists.

Vectors link if labels are equal and not null, lengths are equal, and the cosine is at least the threshold. Vectors that are
null, empty, zero, or hold null or non-finite components link with nothing, as do rows without a label; they come back with
no links and their own id. Rows that repeat an id are vectors of their own in the counts.

Measured recall: against brute force on the test tables all links are found (see tests).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import arrow_pass, joined_by_id, ship, stored, table, unit_hash
from amplicore.llm.components import components

NEAREST, BLOCK, SEED = 6, 1024, 31
#: Reference points: one of so many vectors, within these numbers; of points closer to each other than APART the first stays.
SHARE, LEAST_PIVOTS, MOST_PIVOTS, APART = 16, 64, 16_384, 0.9


def usable() -> Column:
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def thinned(pivots: np.ndarray) -> np.ndarray:
    """The points (of length one) that are near none of those before them that stay."""
    gone = np.zeros(len(pivots), bool)
    for at in range(0, len(pivots), 512):
        block = pivots[at : at + 512]
        before = np.flatnonzero(~gone[:at])
        for a in range(0, len(before), 4096):
            gone[at : at + 512] |= (block @ pivots[before[a : a + 4096]].T >= APART).any(1)
        near = block @ block.T >= APART
        for i in range(1, len(block)):
            gone[at + i] |= (near[i, :i] & ~gone[at : at + i]).any()
    return pivots[~gone]


def named_pairs(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest references of each vector, as ascending numbers."""
    k = min(NEAREST, len(pivots))
    near = vectors @ pivots.T
    near /= np.linalg.norm(vectors, axis=1, keepdims=True)
    order = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < len(pivots) else np.tile(np.arange(k), (len(vectors), 1))
    return np.sort(order, axis=1)


def linked_in_lists(rows: DataFrame, threshold: float, width: int) -> DataFrame:
    """rep, links, tied. rows: list (a number), ref (its two references as a number), own, i, j, rep, mult, near, vec."""

    def group_links(g: list[tuple]) -> dict[str, list]:
        (_, i, j), ref = g[0][0], g[0][1]
        own, rep, mult = (np.array([r[k] for r in g]) for k in (2, 3, 4))
        near = np.array([r[5] for r in g])
        x = np.array([r[6] for r in g], np.float64)
        x /= np.sqrt((x * x).sum(1))[:, None]
        first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
        links, tied = np.zeros(len(g), np.int64), rep.copy()
        at: list[np.ndarray] = []
        to: list[np.ndarray] = []
        for a in range(0, len(first), 256):
            p, q = np.nonzero(x[first[a : a + 256]] @ x[second].T >= threshold)
            p, q = first[a + p], second[q]
            ok = rep[p] < rep[q] if i == j else np.ones(len(p), bool)
            at.append(p[ok])
            to.append(q[ok])
        p, q = np.concatenate(at) if at else np.empty(0, int), np.concatenate(to) if to else np.empty(0, int)
        for a in range(0, len(p), 65536):  # a pair counts in the list of its two smallest shared references
            pp, qq = p[a : a + 65536], q[a : a + 65536]
            shared = (near[pp][:, :, None] == near[qq][:, None, :]).any(2)
            least = np.argmax(shared, 1)
            rows_ = np.arange(len(pp))
            shared[rows_, least] = False
            mine = near[pp][rows_, least] * width + near[pp][rows_, np.argmax(shared, 1)] == ref
            np.add.at(links, pp[mine], mult[qq[mine]])
            np.add.at(links, qq[mine], mult[pp[mine]])
        while len(p):  # the smallest id of each vector's component here
            low = np.minimum(tied[p], tied[q])
            was = tied.copy()
            np.minimum.at(tied, p, low)
            np.minimum.at(tied, q, low)
            if (was == tied).all():
                break
        some = (links > 0) | (tied != rep)
        return {"rep": rep[some].tolist(), "links": links[some].tolist(), "tied": tied[some].tolist()}

    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("tied", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            x = batch.to_pydict()
            for row in zip(zip(x["list"], x["i"], x["j"], strict=True), x["ref"], x["own"], x["rep"], x["mult"], x["near"], x["vec"], strict=True):
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        yield pa.RecordBatch.from_pydict(group_links(group), schema)
                    group = []
                group.append(row)
        if len(group) > 1:
            yield pa.RecordBatch.from_pydict(group_links(group), schema)

    dealt = rows.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")
    return dealt.mapInArrow(run, "rep long, links long, tied long")


def near_links(embeddings: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding, label)."""
    spark = embeddings.sparkSession
    ship(spark)
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    e = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"), F.col("label").cast("string"))
    e = e.withColumn("usable", usable())
    e = e.withColumn("dim", F.size("embedding")).withColumn("h1", F.when(F.col("usable"), F.xxhash64("embedding")).otherwise(F.xxhash64("vec_id"))).withColumn("h2", F.xxhash64(F.lit(SEED), "embedding"))
    same = ["label", "dim", "h1", "h2"]
    # counted before the shuffle; only classes of several members are joined back, so that no task gets the rows of a large one
    classes = e.where("usable").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"))
    classes = stored(classes.where("mult > 1"), "vec-classes")
    placed = joined_by_id(e, classes, same, "left").withColumn("rep", F.when(F.col("usable"), F.coalesce("rep", "vec_id")).otherwise(F.col("vec_id"))).withColumn("mult", F.when(F.col("usable"), F.coalesce("mult", F.lit(1))).otherwise(1))
    placed = stored(placed.select("vec_id", "rep", "mult", "usable", "label", "dim", F.when(F.col("usable") & (F.col("vec_id") == F.col("rep")), F.col("embedding")).alias("embedding")), "vectors")
    base = placed.select("vec_id", "rep", "mult", "usable")
    reps = placed.where("embedding is not null")
    twice = stored(reps.groupBy("rep").count().where("count > 1").select("rep"), "twice")  # equal rows, ids and all
    if not twice.isEmpty():
        reps = stored(joined_by_id(reps, twice, "rep", "left_anti").union(joined_by_id(reps, twice, "rep", "left_semi").dropDuplicates(["rep"])), "vectors")
    reps = reps.select("rep", "mult", "label", "dim", "embedding")
    n = reps.count()
    if n == 0:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, n // SHARE))
    sample = reps.where(unit_hash(F.col("rep"), SEED) < min(1.0, wanted / n)).select("rep", "dim", "embedding").collect()
    pivots: dict[int, np.ndarray] = {}
    for r in sorted(sample):
        v = np.array(r["embedding"], float)
        pivots.setdefault(r["dim"], []).append(v / np.sqrt(v @ v))
    pivots = {d: thinned(np.array(v)) for d, v in pivots.items()}
    pivots = {d: v for d, v in pivots.items() if len(v) > 1}
    sent = spark.sparkContext.broadcast(pivots)
    width = max([2, *map(len, pivots.values())])

    def run(part: dict[str, list]) -> dict[str, list]:
        out = {"near": [None] * len(part["rep"]), "refs": [None] * len(part["rep"])}
        for d in set(part["dim"]):
            at = [i for i, x in enumerate(part["dim"]) if x == d]
            p = sent.value.get(d)
            if p is None:  # no references of this length: all such vectors of a label meet in one list
                for i in at:
                    out["near"][i], out["refs"][i] = [0, 1], [1]
                continue
            near = named_pairs(np.array([part["embedding"][i] for i in at], float), p)
            a, b = np.triu_indices(near.shape[1], 1)
            refs = near[:, a] * width + near[:, b]
            for i, x, y in zip(at, near.tolist(), refs.tolist(), strict=True):
                out["near"][i], out["refs"][i] = x, y
        return {"rep": part["rep"], "mult": part["mult"], "label": part["label"], "dim": part["dim"]} | out

    described = stored(arrow_pass(reps, run, "rep long, mult long, label string, dim int, near array<int>, refs array<int>"), "described")
    lists = described.select("rep", "label", "dim", F.explode("refs").alias("ref")).withColumn("list", F.xxhash64("label", "dim", "ref"))
    sizes = lists.groupBy("list").agg(F.count("*").alias("size")).where("size > 1")
    met = lists.join(sizes, "list").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("list", "ref", "rep", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    full = met.join(described.select("rep", "mult", "near"), "rep").join(reps.select("rep", F.col("embedding").alias("vec")), "rep")
    found = stored(linked_in_lists(full, threshold, width), "vec-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    tied = components(found.select(F.col("rep").alias("a"), F.col("tied").alias("b")))
    out = base.join(links, "rep", "left").join(tied.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("component", "rep")
    return out.select("vec_id", F.when(F.col("usable"), F.col("mult") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op8_pivot_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_links(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.usable AND b.usable AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS low FROM v UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.id)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.low AS component_id, c.low = v.vec_id AS kept
FROM v JOIN (SELECT id, min(low) AS low FROM r GROUP BY 1) c ON c.id = v.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY 1) n ON n.a = v.vec_id
"""
