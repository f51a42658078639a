"""MinHash near-duplicate classes (operator 7).

Method: every whole text becomes its set of distinct word shingles (64-bit hashes). Equal sets are one class from the
start. ``BANDS`` bands of ``ROWS`` universal hash minima each give bucket keys; pairs that share a bucket are compared by
their signatures (eight bits of every minimum), and what may reach the threshold is confirmed on the full sets.
Components come from alternating large-star and small-star.

A bucket never gives all its pairs. First each member is held against the bucket's smallest id; buckets whose members
then lie in one component are done. In the others, members of different components are compared by signature: in buckets of
at most ``SMALL`` rows with each other; in larger ones the members outside the bucket's main component are sent to the
documents with their full sets, if they are few, and only links leave a task; else block meets block of at most ``BLOCK``
rows. Near pairs of different components are confirmed on full sets.

At similarity 0.8 a pair shares no bucket with probability (1 - 0.8**6)**32 = 6e-5, and fails the signature test with
3e-6; no cap is set on buckets, candidates or partners.

Null texts and texts without words have empty sets and link with nothing. A null id links with nothing and is kept.
Repeated rows of one id and text are one class. Other columns pass through ``near_classes`` untouched, by the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import SENT_IDS, SLICE, arrow_pass, joined_by_id, ship, stored, table
from amplicore.llm.components import components

BANDS, ROWS, BLOCK = 32, 6, 1024
#: Signatures that agree in fewer places than this can't reach 0.8 (4.5 standard deviations).
SIGMAS = 4.5
#: A centre's pairs are confirmed in so many parts at least, each with its own copy of the centre, and of so many pairs at most.
PARTS, PART_PAIRS = 64, 50_000
#: Buckets of so many rows at most are searched pair by pair within their task.
SMALL = 64
#: Of larger buckets, rows outside their main component that are sent to all executors, and the words in their texts (32 MB).
SENT_ROWS, SENT_SHINGLES = 100_000, 4_000_000

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_A = _RNG.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _Q
    x = (x ^ (x >> np.uint64(29))) * _P
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _P, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse_powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(pow(int(_P), -1, 2**64)), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[str | None], n_words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Words are runs of other than ASCII white space, A-Z in lower case."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    x = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    white = _WHITE[x]
    begin = np.flatnonzero(~white & np.r_[True, white[:-1]])
    stop = np.flatnonzero(white & np.r_[False, ~white[:-1]])
    # a word's hash: the sum of its bytes' numbers times powers by place, from running sums
    words = np.empty(len(begin), np.uint64)
    if len(begin):
        sums = np.cumsum(np.r_[np.zeros(1, np.uint64), _BYTE[x] * _powers(len(x))], dtype=np.uint64)
        words = _mix((sums[stop] - sums[begin]) * _inverse_powers(len(x))[begin])
    of = np.searchsorted(begin, np.r_[0, ends])  # where each text's words begin
    if len(words) >= n_words:
        k = len(words) - n_words + 1
        grams = np.zeros(k, np.uint64)
        for j in range(n_words):
            grams = grams * _P + words[j : j + k]
        grams = _mix(grams)
    out = []
    for i in range(len(texts)):
        a, b = of[i], of[i + 1]
        if b - a >= n_words:
            out.append(np.unique(grams[a : b - n_words + 1]))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _Q + w
            out.append(_mix(np.array([h], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minima(s: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash over a set."""
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(low, (_A[:, None] * x[None, at : at + 1024] + _B[:, None]).min(1), out=low)
    return low


def signatures(docs: DataFrame, n_words: int, id_col: str, text_col: str) -> DataFrame:
    """doc, n, k1, k2 (what tells sets apart), bands (bucket keys) and sig (a byte of each minimum) of each row."""
    import xxhash

    band = np.arange(BANDS, dtype=np.uint64) * _Q

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc": part["doc"], "n": [], "k1": [], "k2": [], "bands": [], "sig": []}
        for doc, s in zip(part["doc"], shingle_sets(part["text"], n_words), strict=True):
            out["n"].append(len(s))
            if not len(s):
                out["k1"].append(xxhash.xxh64_intdigest(str(doc)) - 2**63)
                out["k2"].append(0)
                out["bands"].append(None)
                out["sig"].append(None)
                continue
            d = xxhash.xxh3_128_digest(s.tobytes())
            low = minima(s)
            key = band.copy()
            for r in range(ROWS):
                key = _mix(key * _P + low.reshape(BANDS, ROWS)[:, r])
            out["k1"].append(int.from_bytes(d[:8], "little", signed=True))
            out["k2"].append(int.from_bytes(d[8:], "little", signed=True))
            out["bands"].append(key.view(np.int64).tolist())
            out["sig"].append((low >> np.uint32(9)).astype(np.uint8).tobytes())
        return out

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return arrow_pass(rows, run, "doc long, n int, k1 long, k2 long, bands array<long>, sig binary")


def least_agreement(percent: int) -> int:
    """Places in which signatures of sets as similar as percent agree at least."""
    p = percent / 100
    return int(BANDS * ROWS * p - SIGMAS * (BANDS * ROWS * p * (1 - p)) ** 0.5)


def alike(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose signatures come near the threshold."""
    cut = least_agreement(percent)
    sig_a, sig_b = sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a")), sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                one, two = (np.frombuffer(b"".join(x.column(c).to_pylist()), np.uint8).reshape(x.num_rows, -1) for c in ("sig_a", "sig_b"))
                yield x.filter(pa.array((one == two).sum(1) >= cut)).select(["a", "b"])

    return pairs.join(sig_b, "b").join(sig_a, "a").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, n_words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Of pairs (a, b) those with 100 * intersection >= percent * union of the full sets of their texts."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    part = F.pmod(F.xxhash64("b"), F.lit(max(PARTS, -(-pairs.count() // PART_PAIRS)))).alias("part")
    rows = pairs.select("a", part, F.col("b").alias("doc"), F.lit(True).alias("member"))
    rows = rows.union(pairs.select("a", part, F.col("a").alias("doc"), F.lit(False)).distinct())
    ids = stored(rows.select("doc").distinct(), "ids")
    if ids.count() <= SENT_IDS:  # thins the texts before their shuffle
        texts = texts.join(F.broadcast(ids), "doc", "left_semi")
    dealt = rows.join(texts, "doc").repartition("a", "part").sortWithinPartitions("a", "part", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre = None, np.empty(0, np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                x = batch.slice(at, SLICE).to_pydict()
                a, b = [], []
                for s, k, doc, member in zip(shingle_sets(x["text"], n_words), zip(x["a"], x["part"], strict=True), x["doc"], x["member"], strict=True):
                    if not member:
                        key, centre = k, s
                    elif k == key:
                        both = len(np.intersect1d(centre, s, assume_unique=True))
                        if 100 * both >= percent * (len(centre) + len(s) - both):
                            a.append(k[0])
                            b.append(doc)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.select("a", "part", "doc", "member", "text").mapInArrow(run, "a long, b long")


def apart(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of different components that share a bucket and have like signatures. rows: key, doc, component, sig, size."""
    cut = least_agreement(percent)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "component", "sig")
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs(group: list[tuple]) -> tuple[list[int], list[int]]:
        doc, comp, own = (np.array([g[k] for g in group]) for k in (1, 2, 4))
        sig = np.frombuffer(b"".join(g[3] for g in group), np.uint8).reshape(len(group), -1)
        within = group[0][0][1] == group[0][0][2]
        a, b = [], []
        for at in range(0, len(group), 64):
            near = (sig[at : at + 64, None, :] == sig[None, :, :]).sum(2) >= cut
            near &= (doc[at : at + 64, None] < doc[None, :]) & (comp[at : at + 64, None] != comp[None, :])
            if not within:
                near &= own[at : at + 64, None] != own[None, :]
            i, j = np.nonzero(near)
            a += doc[at + i].tolist()
            b += doc[j].tolist()
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def made() -> pa.RecordBatch:
            a, b = pairs(group) if len(group) > 1 else ([], [])
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for batch in batches:
            x = batch.to_pydict()
            for row in zip(zip(x["key"], x["i"], x["j"], strict=True), x["doc"], x["component"], x["sig"], x["own"], strict=True):
                if group and group[0][0] != row[0]:
                    yield made()
                    group = []
                group.append(row)
        if group:
            yield made()

    return dealt.mapInArrow(run, "a long, b long").distinct()


def beside(heads: DataFrame, minor: DataFrame, docs: DataFrame, n_words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) of the rows (key, doc, component) outside their bucket's main component, where these are few enough to be
    sent to all executors with their full sets. Each document looks its buckets up among them; those that find a like
    signature there are confirmed on full sets at once, so only links leave a task, and of those between one document and one
    component the first. heads: doc, component, bands, sig."""
    cut = least_agreement(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    few = heads.select("doc", "component", "sig").join(F.broadcast(minor.select("doc").distinct()), "doc").join(texts, "doc").dropDuplicates(["doc"])

    def full(part: dict[str, list]) -> dict[str, list]:
        return {"doc": part["doc"], "component": part["component"], "sig": part["sig"], "own": [s.tobytes() for s in shingle_sets(part["text"], n_words)]}

    own = arrow_pass(few, full, "doc long, component long, sig binary, own binary").collect()
    at = {r["doc"]: i for i, r in enumerate(own)}
    index: dict[int, list[int]] = {}
    for r in minor.select("key", "doc").collect():
        index.setdefault(r["key"], []).append(at[r["doc"]])
    held = {
        "index": {k: tuple(v) for k, v in index.items()},
        "doc": np.array([r["doc"] for r in own], np.int64),
        "component": np.array([r["component"] for r in own], np.int64),
        "sig": np.frombuffer(b"".join(r["sig"] for r in own), np.uint8).reshape(len(own), -1),
        "own": [r["own"] for r in own],
    }
    sent = heads.sparkSession.sparkContext.broadcast(held)

    def candidates(doc: int, component: int, bands: list[int], sig: bytes) -> np.ndarray:
        m = sent.value
        met = sorted({i for k in bands for i in m["index"].get(k, ())})
        i = np.array(met, np.int64)
        return i[(m["component"][i] != component) & ((m["sig"][i] == np.frombuffer(sig, np.uint8)).sum(1) >= cut)] if met else i

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            yield batch.filter(pa.array([len(candidates(*r)) > 0 for r in zip(x["doc"], x["component"], x["bands"], x["sig"], strict=True)], pa.bool_()))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        done: set[tuple[int, int]] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                x = batch.slice(start, SLICE).to_pydict()
                a, b = [], []
                for s, doc, comp, bands, sig in zip(shingle_sets(x["text"], n_words), x["doc"], x["component"], x["bands"], x["sig"], strict=True):
                    for i in candidates(doc, comp, bands, sig).tolist():
                        if (i, comp) in done:
                            continue
                        t = np.frombuffer(m["own"][i], np.uint64)
                        near = t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s
                        both = int(near.sum())
                        if 100 * both >= percent * (len(s) + len(t) - both):
                            done.add((i, comp))
                            a.append(int(m["doc"][i]))
                            b.append(doc)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = heads.select("doc", "component", "bands", "sig")
    met = stored(rows.mapInArrow(meeting, rows.schema), "meeting")
    return joined_by_id(texts.where("doc is not null"), met, "doc", "inner").select("doc", "component", "bands", "sig", "text").mapInArrow(linked, "a long, b long")


def near_classes(docs: DataFrame, n_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n_shingles, component_id, kept of each row of docs. Ids are whole numbers (others are an error: number the rows first)."""
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{id_col} isn't a whole number")
    ship(docs.sparkSession)
    sigs = stored(signatures(docs, n_words, id_col, text_col), "signatures")
    some = sigs.where("n > 0 and doc is not null")
    # counted before the shuffle; only sets of several members are joined back, so that no task gets the rows of a large class
    classes = stored(some.groupBy("k1", "k2").agg(F.min("doc").alias("rep"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "sets")
    placed = joined_by_id(sigs, classes, ["k1", "k2"], "left").withColumn("rep", F.when(F.col("n") > 0, F.coalesce("rep", "doc")).otherwise(F.col("doc")))
    first = (F.col("n") > 0) & (F.col("doc") == F.col("rep"))
    placed = stored(placed.select("doc", "n", "rep", F.when(first, F.col("bands")).alias("bands"), F.when(first, F.col("sig")).alias("sig")), "classes")
    base = placed.select("doc", "n", "rep")
    heads = placed.where("sig is not null").select("doc", "bands", "sig")
    twice = stored(heads.groupBy("doc").count().where("count > 1").select("doc"), "twice")  # repeated ids
    if not twice.isEmpty():
        heads = stored(joined_by_id(heads, twice, "doc", "left_anti").union(joined_by_id(heads, twice, "doc", "left_semi").dropDuplicates(["doc"])), "heads")
    bands = heads.select("doc", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("doc").alias("first"), F.count("*").alias("size")).where("size > 1")
    shared = stored(bands.join(buckets, "key").select("key", "doc", "first", "size"), "buckets")

    star = stored(alike(shared.where("doc != first").select(F.col("first").alias("a"), F.col("doc").alias("b")).distinct(), heads, percent), "star")
    links = stored(confirmed(star, docs, n_words, percent, id_col, text_col), "links")
    found = stored(components(links), "components")
    placed = shared.join(found.withColumnRenamed("id", "doc"), "doc", "left").select("key", "doc", "size", F.coalesce("component", "doc").alias("component"))
    kinds = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_ = stored(kinds.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1").select("key", "main"), "open")
    minor = placed.where(F.col("size") > SMALL).join(open_, (placed["key"] == open_["key"]) & (placed["component"] != open_["main"]))
    minor = stored(minor.select(placed["key"], "doc", "component"), "minor")
    weight = minor.select("doc").distinct().join(base.select("doc", "n"), "doc").agg(F.sum("n")).first()[0] or 0
    few = weight <= SENT_SHINGLES and minor.count() <= SENT_ROWS
    rows = placed.join(open_.select("key"), "key", "left_semi")
    rows = rows.where(F.col("size") <= SMALL) if few else rows
    more = apart(rows.join(heads.select("doc", "sig"), "doc"), percent)
    more = stored(more.join(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "apart")
    if not more.isEmpty():
        links = links.union(stored(confirmed(more, docs, n_words, percent, id_col, text_col), "links"))
    if few and weight:
        placed_heads = heads.join(found.withColumnRenamed("id", "doc"), "doc", "left").select("doc", F.coalesce("component", "doc").alias("component"), "bands", "sig")
        links = links.union(stored(beside(placed_heads, minor, docs, n_words, percent, id_col, text_col), "links"))
    found = stored(components(links), "components")
    out = base.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("component", "rep")
    return out.select("doc", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"), n_words=4).withColumnRenamed("doc", "doc_id")
