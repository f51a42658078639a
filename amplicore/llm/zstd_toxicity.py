"""Toxicity by compression distance (operator 6).

Method: two zstandard dictionaries, trained by zstandard on toxic and on ordinary text. A text is cut into windows of about
``WINDOW`` bytes at spaces; each is compressed with either dictionary, and the bytes that the toxic one saves are its gain. What
each window of the whole text gains beyond a threshold (that only ``NOISE`` of ordinary windows exceed) is summed; scores
are calibrated by isotonic regression on such sums of rows under dictionaries of other rows.

What the trainer is given decides: on windows of either class as they are, both dictionaries hold the same frequent prose (AUC
0.62 to 0.74 on the test tables, by size). So each dictionary has a part for prose, trained on ordinary windows and equal in
both, and a part for its class. The samples of a class's part are words out of its windows that it uses ``CONTRAST`` times as
often as the other, counted by distinct contexts, so that copies of one text count once, and (of the ordinary class, which
has few such words) windows that the prose part hasn't seen. Texts are lower-cased, runs of white space and marks become one
space, and each word is turned by a mask of its first bytes, so that a match must begin where a word does. Words of one or two
letters are too short for a match. Every window begins with ``LEAD``, which both dictionaries hold: so short windows are never
stored uncompressed.

Training reads a bounded sample of labelled rows: about ``max_rows`` and ``max_bytes`` of text, by a stable hash of the id, with
whole texts; of their ordinary windows the prose part is trained on about ``PROSE`` chosen by their hash. The fits (one for
each fold and the last) run as tasks.

A null text counts as empty; an empty text has gain 0 and the score calibrated for it. Without labels of both classes each
score is the share of ones (0.5 without any). Equal texts get equal scores; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Container

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import arrow_pass, built, crc_mod, ship, stored, table, unit_hash
from amplicore.llm.rff_quality import isotonic

SEED, WINDOW, NOISE = 41, 64, 0.002
CONTRAST, SURE, LEAST = 30.0, 5.5, 5
#: Bytes of the parts for prose and for a class; segments and their shortest repeats in training; ordinary windows to train on.
PROSE_BYTES, CLASS_BYTES, SEGMENT, REPEAT, PROSE = 6000, 1400, 16, 6, 12_000
FOLDS = 4
LEAD = bytes(range(31)) * 2
_BETWEEN = re.compile(rb"[\x00-\x20.,;:!?|*$%&#\"'()<>\[\]{}=/+~_@\\-]+")


def plain(text: str | None) -> bytes:
    return b" " + _BETWEEN.sub(b" ", (text or "").lower().encode("utf-8", "surrogatepass")).strip() + b" "


def marked(raw: bytes) -> bytes:
    """Each word's bytes turned by a mask of its first three, so that words match from where they begin or not at all."""
    x = np.frombuffer(raw, np.uint8)
    space = x == 32
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if not len(begin):
        return raw
    ahead = np.append(x, np.array([32, 32], np.uint8)).astype(np.int64)
    mask = (ahead[begin] * 73 + ahead[begin + 1] * 151 + ahead[begin + 2] * 29 + 128) & 255
    of = np.cumsum(np.bincount(begin, minlength=len(x)))
    return np.where(space | (of == 0), x, x ^ mask[of - 1].astype(np.uint8)).astype(np.uint8).tobytes()


def windows(raw: bytes) -> list[bytes]:
    """Marked parts of about WINDOW bytes, cut at spaces."""
    out, at, n, turned = [], 0, len(raw), marked(raw)
    while at < n:
        end = at + WINDOW
        if end < n and (cut := raw.rfind(b" ", at + 1, end)) > 0:
            end = cut
        out.append(turned[at:end])
        at = end
    return out


def contexts(texts: list[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many distinct contexts (the word before it) each word stands, and all distinct contexts."""
    number: dict[bytes, int] = {}
    pairs = np.empty(0, np.int64)
    parts: list[np.ndarray] = []
    for k, t in enumerate(texts):
        words = t.split()
        ids = np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int64, len(words))
        parts.append(np.concatenate([[0], ids[:-1]]).astype(np.int64) << 32 | ids if len(ids) else ids)
        if k % 500 == 499:
            pairs, parts = np.unique(np.concatenate([pairs, *parts])), []
    pairs = np.unique(np.concatenate([pairs, *parts]))
    n = np.bincount(pairs & 0xFFFFFFFF, minlength=len(number) + 1)
    return {w: int(n[i]) for w, i in number.items()}, max(1, len(pairs))


def fragments(words: dict[bytes, int], wanted: Container[bytes] | None = None) -> dict[bytes, int]:
    """Contexts of words and of their beginnings: of those wanted, or of all that have LEAST at least. One length at a time, to hold few."""
    out: dict[bytes, int] = {}
    for cut in (4, 5, 6, 7, 8, 10, None):
        n: Counter = Counter()
        for w, k in words.items():
            if cut is None or len(w) > cut:
                f = b" " + (w + b" " if cut is None else w[:cut])
                if wanted is None or f in wanted:
                    n[f] += k
        out.update((f, k) for f, k in n.items() if wanted is not None or k >= LEAST)
    return out


def typical(own: tuple[dict[bytes, int], int], other: tuple[dict[bytes, int], int]) -> list[bytes]:
    """What a class uses CONTRAST times as often as the other, surest first; of a word's beginnings the one that says most."""
    all_n, all_m = own[1], other[1]
    n = fragments(own[0])
    m: Counter = Counter(fragments(other[0], wanted=n))
    sure = {}
    for f, k in n.items():
        if (k + 0.5) / all_n >= CONTRAST * (m[f] + 0.5) / all_m:
            share = all_n / (all_n + all_m)
            g = k * math.log(k / ((k + m[f]) * share)) + (m[f] * math.log(m[f] / ((k + m[f]) * (1 - share))) if m[f] else 0.0)
            if (z := math.sqrt(2 * g)) >= SURE:
                sure[f] = z
    out: list[bytes] = []
    for f in sorted(sure, key=lambda f: (-sure[f], -len(f), f)):
        kin = [i for i, g in enumerate(out) if f.startswith(g.rstrip()) or g.startswith(f.rstrip())]
        if not kin:
            out.append(f)
        elif len(kin) == 1 and f.startswith(out[kin[0]].rstrip()) and n[f] >= 0.9 * n[out[kin[0]]]:
            out[kin[0]] = f
    return out


class Model:
    def __init__(self, toxic: bytes, ordinary: bytes, level: int = 0, knots: np.ndarray | None = None, values: np.ndarray | None = None) -> None:
        self.toxic, self.ordinary, self.level, self.knots, self.values = toxic, ordinary, level, knots, values
        self._pair = None

    def _compress(self):
        if self._pair is None:
            import zstandard

            def one(content: bytes):
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                p = zstandard.ZstdCompressionParameters.from_level(7, source_size=128, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0, min_match=5)
                d.precompute_compress(compression_params=p)
                return zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress

            self._pair = one(self.toxic), one(self.ordinary)
        return self._pair

    def saved(self, window: bytes) -> int:
        toxic, ordinary = self._compress()
        return len(ordinary(LEAD + window)) - len(toxic(LEAD + window))

    def gain(self, text: str | None) -> float:
        toxic, ordinary = self._compress()
        return float(sum(max(0, len(ordinary(LEAD + w)) - len(toxic(LEAD + w)) - self.level) for w in windows(plain(text))))

    def score(self, text: str | None) -> float:
        return float(np.clip(np.interp(self.gain(text), self.knots, self.values), 0, 1))

    def state(self) -> dict:
        return {"toxic": self.toxic, "ordinary": self.ordinary, "level": self.level, "knots": self.knots, "values": self.values}


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """What zstandard's trainer makes of the samples, without entropy tables; the samples' end if they are too few to train."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=REPEAT).as_bytes()[-size:]
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def samples_of(fragments_: list[bytes], parts: list[bytes]) -> list[bytes]:
    """The words of distinct windows that begin like (or are) one of the fragments."""
    turned = [marked(f + b" ")[: len(f)] for f in fragments_]
    out = []
    for w in parts:
        for f in turned:
            at = w.find(f)
            if at >= 0:
                end = w.find(b" ", at + len(f) - 1)
                out.append(w[at:] if end < 0 else w[at : end + 1])
    return out


def dictionaries(toxic: list[str | None], ordinary: list[str | None]) -> Model:
    own, other = [plain(t) for t in toxic], [plain(t) for t in ordinary]
    own_parts, parts = ({w for t in texts for w in windows(t)} for texts in (own, other))
    dealt = sorted((zlib.crc32(w), w) for w in parts)
    third = min(PROSE, -(-len(dealt) // 3))
    prose, apart, rest = ([w for _, w in dealt[i * third : (i + 1) * third]] for i in range(3))
    one, two = contexts(own), contexts(other)
    shared = trained(prose, PROSE_BYTES, SEGMENT + 8)
    of_ordinary = trained(apart, CLASS_BYTES, SEGMENT)
    both = shared + of_ordinary
    for_ordinary = samples_of(typical(two, one), sorted(parts))
    for_toxic = samples_of(typical(one, two), sorted(own_parts))
    mine, its = (trained(x, CLASS_BYTES, SEGMENT) if x else b"" for x in (for_toxic, for_ordinary))
    n = max(len(mine), len(its))  # equally far from what is shared
    fill = bytes(range(1, 31)) * (n // 30 + 1)
    model = Model(both + fill[: n - len(mine)] + mine + LEAD, both + fill[: n - len(its)] + its + LEAD)
    gains = np.array([model.saved(w) for w in rest] or [0])
    model.level = max(0, int(np.quantile(gains, 1 - NOISE, method="higher")))
    return model


def made(rows: list[tuple[str | None, int]]) -> Model:
    return dictionaries([t for t, y in rows if y], [t for t, y in rows if not y])


def part_fit(rows: list[tuple[str | None, int, float]], k: int) -> tuple[list[float], list[int], Model | None]:
    """Of (text, label, fold in [0, 1)): gains and labels of fold k under dictionaries of the others; of fold FOLDS, the last
    model of all rows."""
    if k == FOLDS:
        return [], [], made([r[:2] for r in rows])
    own = [r for r in rows if int(r[2] * FOLDS) == k]
    other = [r[:2] for r in rows if int(r[2] * FOLDS) != k]
    if not own or not other:
        return [], [], None
    m = made(other)
    return [m.gain(t) for t, _, _ in own], [y for _, y, _ in own], None


def calibrated(model: Model, gains: list[float], labels: list[int], share: float) -> Model | float:
    if not gains:
        return share
    order = np.lexsort((labels, gains))
    model.knots, model.values = isotonic(np.array(gains)[order], np.array(labels, float)[order])
    return model


def fit(rows: list[tuple[str | None, int, float]]) -> Model | float:
    """A model of (text, label, fold in [0, 1)), all in this process."""
    ones = sum(y for _, y, _ in rows)
    if not rows or ones in (0, len(rows)):
        return ones / len(rows) if rows else 0.5
    parts = [part_fit(rows, k) for k in range(FOLDS + 1)]
    return calibrated(parts[FOLDS][2], [g for p in parts for g in p[0]], [y for p in parts for y in p[1]], ones / len(rows))


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 5000, max_bytes: int = 64 << 20) -> Model | float:
    """A model from about max_rows labelled rows, and about max_bytes of their text. Each fit is a task that holds the sample."""
    labels = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    n = labels.count()
    if n == 0:
        return 0.5
    place = unit_hash(F.col("id"), SEED)
    some = place < min(1.0, max_rows / n)  # on the id, so either side is thinned before the join
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(some).join(labels.where(some), "id")
    rows = stored(rows.select("id", "text", "y", unit_hash(F.col("id"), SEED + 1).alias("fold")), "labelled")
    size, count, ones = rows.agg(F.sum(F.octet_length("text")), F.count("*"), F.sum("y")).first()
    if (size or 0) > max_bytes:
        rows = rows.where(unit_hash(F.col("id"), SEED + 2) < max_bytes / size)
        count, ones = rows.agg(F.count("*"), F.sum("y")).first()
    if not count or ones in (0, count):
        return ones / count if count else 0.5
    ship(docs.sparkSession)

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["fold", "id", "y", "text"], na_position="first")
        texts = [t if isinstance(t, str) else None for t in part["text"]]
        gains, ys, model = part_fit(list(zip(texts, part["y"].tolist(), part["fold"].tolist(), strict=True)), int(key[0]))
        out = pd.DataFrame({"gain": gains, "y": ys, "toxic": None, "ordinary": None, "level": None})
        return out if model is None else pd.DataFrame({"gain": [None], "y": [None], "toxic": [model.toxic], "ordinary": [model.ordinary], "level": [model.level]})

    dealt = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(FOLDS)))).repartitionByRange(FOLDS + 1, "k")  # a task each
    got = dealt.groupBy("k").applyInPandas(run, "gain double, y int, toxic binary, ordinary binary, level int").collect()
    last = next(r for r in got if r["toxic"] is not None)
    pairs = [(r["gain"], r["y"]) for r in got if r["gain"] is not None]
    return calibrated(Model(bytes(last["toxic"]), bytes(last["ordinary"]), last["level"]), [g for g, _ in pairs], [y for _, y in pairs], ones / count)


def score(docs: DataFrame, model: Model | float, carry: list[Column], text_col: str = "text") -> DataFrame:
    """The carried columns with score. One pass, no exchange."""
    if not isinstance(model, Model):
        return docs.select(*carry, F.lit(float(model)).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model.state())
    key = uuid.uuid4().hex
    rows = docs.select(*carry, F.col(text_col).alias("__text"))

    def run(part: dict[str, list]) -> dict[str, list]:
        m: Model = built(key, lambda: Model(**sent.value))  # type: ignore[assignment]
        return part | {"score": [m.score(t) for t in part.pop("__text")]}

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "__text")
    return arrow_pass(rows, run, kept + "score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(crc_mod(F.col("doc_id"), 3) != 1), "toxic")
    held = crc_mod(F.col("doc_id"), 3) == 1
    return score(docs, model, [F.col("doc_id"), held.alias("held_out")]).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
