"""Mixing sources to target weights (operator 5).

Method: Sainte-Lague apportionment. Sources are dealt into shards by a hash of the id; the mix's words go
to sources, and a source's words to its shards, by highest quotients. A shard lays its
documents on a ring in seeded order and takes its quota of consecutive words from a seeded place on; where the quota goes
once around, documents are taken twice. So a shard takes its quota to the word, and all but two of its documents whole.

The driver sees one row for each source and one for each shard (``SHARDS`` and one more for each source at most). Equal
shares of a source's ring stand for the whole source, however large; no task holds more than a shard.

A null text has size 0; sources sort by code point, null last, as one source. A source without words has target 0. With
repeated ids each row counts for itself. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amplicore.llm._common import stored, table

SEED, SHARDS = 5, 8192
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of total by weight; none above most times its size, what is above shared again by weight among the rest."""
    out = [0.0] * len(sizes)
    free = [i for i, w in enumerate(weights) if w > 0]
    left = float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        gone = set(over)
        free = [i for i in free if i not in gone]
    return out


def apportioned(votes: Sequence[float], seats: int) -> list[int]:
    """Seats by highest quotients votes / (2 * seats held + 1), the earlier of equals first."""
    whole = sum(votes)
    if whole <= 0 or seats <= 0:
        return [0] * len(votes)
    held = [int(v * seats / whole + 0.5) for v in votes]  # what the quotients give, but for a few seats
    n = sum(held)
    up = [(-v / (2 * h + 1), i) for i, (v, h) in enumerate(zip(votes, held, strict=True)) if v > 0]
    heapq.heapify(up)
    while n < seats:
        _, i = heapq.heappop(up)
        held[i] += 1
        n += 1
        heapq.heappush(up, (-votes[i] / (2 * held[i] + 1), i))
    down = [(votes[i] / (2 * h - 1), -i) for i, h in enumerate(held) if h > 0]
    heapq.heapify(down)
    while n > seats:
        _, i = heapq.heappop(down)
        held[-i] -= 1
        n -= 1
        if held[-i] > 0:
            heapq.heappush(down, (votes[-i] / (2 * held[-i] - 1), i))
    return held


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies (times that half of the document or more is taken).

    weights repeat over the sources in order; share: words of the mix by words there are; most: times that a document, and
    a source, is taken at most (1 or 2).
    """
    spark = docs.sparkSession
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")), "sizes")
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    sources = sorted(((r["source"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    total = sum(n for _, n in sources)
    aims = targets([n for _, n in sources], [weights[i % len(weights)] for i in range(len(sources))], share * total, most)
    quota = apportioned(aims, round(sum(aims)))
    rows = [("n" if s is None else "s" + s, i, max(1, -(-n * SHARDS // max(total, 1))), n, aims[i]) for i, (s, n) in enumerate(sources)]
    of = spark.createDataFrame(rows, "key string, sid int, shards int, source_size long, target double")
    # the hash of the id and size places a row; equal rows lie beside each other, whichever comes first
    dealt = sized.withColumn("key", key).join(of, "key").withColumn("place", F.xxhash64(F.lit(SEED), "doc_id", "size")).withColumn("shard", F.pmod(F.col("place"), F.col("shards")).cast("int"))
    by_shard = sorted((r["sid"], r["shard"], r["n"]) for r in dealt.groupBy("sid", "shard").agg(F.sum("size").alias("n")).collect())
    taken, at = [], 0
    for sid in range(len(sources)):  # one walk over the sorted shards
        end = at
        while end < len(by_shard) and by_shard[end][0] == sid:
            end += 1
        taken += zip(by_shard[at:end], apportioned([n for _, _, n in by_shard[at:end]], quota[sid]), strict=True)
        at = end
    rings = []
    for (sid, shard, n), q in taken:
        words = min(q, most * n)
        laps = words // n if n else 0
        rings.append((sid, shard, n, laps, words - laps * n, random.Random(f"{SEED}/{sid}/{shard}").randrange(max(n, 1))))
    ring = spark.createDataFrame(rings, "sid int, shard int, ring long, laps long, rest long, start long")
    order = Window.partitionBy("sid", "shard").orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id", "size"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = dealt.withColumn("end", F.sum("size").over(order)).join(ring, ["sid", "shard"])
    begin = F.col("end") - F.col("size")
    stop = F.col("start") + F.col("rest")

    def overlap(a: Column, b: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("end"), b) - F.greatest(begin, a))

    once = overlap(F.col("start"), stop) + overlap(F.lit(0), stop - F.col("ring"))
    out = laid.withColumn("taken", F.col("laps") * F.col("size") + once)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), copies.alias("copies"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source", "copies")
