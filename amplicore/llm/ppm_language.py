"""Language identification (operator 1).

Method: prediction by partial matching. For each language the counts of bytes after each context of up to three bytes form
a context tree, of all contexts that were seen; escape probabilities (method C, with exclusion of what a longer context has seen) blend the orders. The
counts are frozen after training, so the code length of a byte after its context is a number known beforehand; a text's
code length under each language is a sum of table entries, and the language with the shortest code wins.

Training reads a bounded sample of labelled rows: about ``per_language`` rows of each language, by a stable hash of the id,
each with its whole text. The tables then score all rows and whole texts.

A null text, or one without a letter, is ``und`` with score 0; so is every text if no language was learned. Ties go to the
first language by code point. Texts are lower-cased first. Equal rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import arrow_pass, built, crc_mod, table, unit_hash

#: Bytes of the longest contexts. Before a text's first byte, as if lines had ended there: PAD.
ORDER = 3
PAD = b"\n" * ORDER
#: Texts are scored together up to so many characters; bounds a worker's memory.
PART = 2_000_000
#: Bits of evidence count in full up to so many bytes of text; beyond, as their mean.
EVIDENCE = 128
SEED = 11


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The gram (three bytes of context and one more, as a number) of each byte of all texts, and where each text begins."""
    raw = [PAD + t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0, *map(len, raw)])
    x = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    at = np.ones(len(x), bool)
    at[(starts[:-1, None] + np.arange(ORDER)).ravel()] = False
    grams = x.copy()
    for k in range(1, ORDER + 1):
        grams[k:] |= x[:-k] << np.uint32(8 * k)
    return grams[at].astype(np.int64), starts - ORDER * np.arange(len(starts))


def count_grams(rows: DataFrame) -> DataFrame:
    """lang, gram (three bytes of context and one more, as a number), n: over all rows of (lang, text)."""

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"lang": [], "gram": [], "n": []}
        by: dict[str, list[str]] = {}
        for lang, text in zip(part["lang"], part["text"], strict=True):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            grams, n = np.unique(_grams(texts)[0], return_counts=True)
            out["lang"] += [lang] * len(grams)
            out["gram"] += grams.tolist()
            out["n"] += n.tolist()
        return out

    return arrow_pass(rows, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Tree:
    """One language's context tree as sorted tables: by order, the grams (context and byte) with their counts, and the contexts
    with what they hold and what they leave to the next shorter one.

    What a context has seen, its suffix has seen too. So exclusion leaves the suffix its total less the counts there of the
    longer context's bytes, whatever byte comes: two numbers a context tell all code lengths, and nothing is dense."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.grams: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.whole: list[np.ndarray] = []
        self.kinds: list[np.ndarray] = []
        self.left: list[np.ndarray] = []  # of the suffix's total, after exclusion
        self.left_kinds: list[np.ndarray] = []
        for k in range(ORDER + 1):
            key, at = np.unique(grams & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            n = np.bincount(at, counts, len(key))
            contexts, of = np.unique(key >> 8, return_inverse=True)
            whole, kinds = np.bincount(of, n), np.bincount(of).astype(float)
            if k:
                shorter = key & ((1 << 8 * k) - 1)
                spent = np.bincount(of, self.counts[k - 1][np.searchsorted(self.grams[k - 1], shorter)])
                suffix = np.searchsorted(self.contexts[k - 1], contexts & ((1 << 8 * (k - 1)) - 1))
                self.left.append(self.whole[k - 1][suffix] - spent)
                self.left_kinds.append(self.kinds[k - 1][suffix] - kinds)
            else:
                self.left.append(np.zeros(len(contexts)))
                self.left_kinds.append(np.zeros(len(contexts)))
            for to, what in ((self.grams, key), (self.counts, n), (self.contexts, contexts), (self.whole, whole), (self.kinds, kinds)):
                to.append(what)

    def cost(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram after its others."""
        out, spent = np.zeros(len(grams)), np.zeros(len(grams))
        todo = np.ones(len(grams), bool)
        above = np.full(len(grams), -1)  # the longer context, if there is one
        for k in range(ORDER, -1, -1):
            context, own = _place(self.contexts[k], grams >> 8 & ((1 << 8 * k) - 1))
            whole, kinds = np.where(own, self.whole[k][context], 0), np.where(own, self.kinds[k][context], 0)
            if k < ORDER:
                whole = np.where(above >= 0, self.left[k + 1][above], whole)
                kinds = np.where(above >= 0, self.left_kinds[k + 1][above], kinds)
            at, seen = _place(self.grams[k], grams & ((1 << 8 * (k + 1)) - 1))
            with np.errstate(divide="ignore", invalid="ignore"):
                here = todo & seen
                out[here] = (spent - np.log2(self.counts[k][at] / (whole + kinds)))[here]
                todo &= ~seen
                spent = spent + np.where(todo & (kinds > 0), -np.log2(kinds / (whole + kinds)), 0)
            above = np.where(own, context, -1)
        out[todo] = spent[todo] + np.log2(max(1, 256 - len(self.grams[0])))
        return out

    def size(self) -> int:
        return sum(x.nbytes for table_ in vars(self).values() for x in table_)


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key stands, and whether it does."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """langs, and the tree of each. Its size is the sum of the trees': with about 1,000 texts of 2.5 kB each, 0.5 to 1 MB a
    language (see ``size``), so 50 to 100 MB for 100 languages (measured: 2.1 MB for the four of the test tables)."""

    def __init__(self, langs: list[str], trees: list[Tree]) -> None:
        self.langs, self.trees = langs, trees

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code length of each text under each language, and its bytes. Each distinct gram is looked up once."""
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= PART:
                size += len(texts[end])
                end += 1
            grams, starts = _grams(texts[at:end])
            n[at:end] = np.diff(starts)
            kinds, of = np.unique(grams, return_inverse=True)
            some = np.flatnonzero(n[at:end])
            for k, tree in enumerate(self.trees):
                if len(some):
                    total[at + some, k] = np.add.reduceat(tree.cost(kinds)[of], starts[:-1][some])
            at = end
        return total, n

    def size(self) -> int:
        return sum(t.size() for t in self.trees)


def build(grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The trees of counted grams by language: all contexts that were seen."""
    langs = sorted(grams)
    return Model(langs, [Tree(grams[lang][0].astype(np.int64), grams[lang][1].astype(float)) for lang in langs])


def _received(langs: list[str], tables: list[dict]) -> Model:
    trees = [Tree.__new__(Tree) for _ in tables]
    for tree, t in zip(trees, tables, strict=True):
        vars(tree).update(t)
    return Model(langs, trees)


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 1000) -> Model | None:
    """A model of rows with text and lang, from about per_language rows of each language; None if there are none."""
    rows = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    share = {r[0]: per_language / r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not share:
        return None
    part = F.element_at(F.create_map(*[F.lit(x) for p in share.items() for x in p]), F.col(lang_col))
    sample = rows.where(unit_hash(F.col(id_col), SEED) < part).select(F.col(lang_col).alias("lang"), F.lower(text_col).alias("text"))
    got = count_grams(sample).toPandas()
    grams = {lang: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(np.int64)) for lang, g in got.groupby("lang")}
    return build(grams) if grams else None


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", carry: list[Column] | None = None, prefix: str = "") -> DataFrame:
    """Each row's id (and carried columns) with lang_pred, score, and bits_per_byte under the language found (their names after
    prefix, if carried columns have such names). One pass, no exchange."""
    text = F.col(text_col)
    cols = [F.col(id_col).alias("__id"), *(carry or [])]
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if model is None:
        none = docs.select(*cols, F.lit("und").alias(f"{prefix}lang_pred"), F.lit(0.0).alias(f"{prefix}score"), F.lit(None).cast("double").alias(f"{prefix}bits_per_byte"))
        return none.withColumnRenamed("__id", id_col)
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, [vars(t) for t in model.trees]))
    key = uuid.uuid4().hex
    rows = docs.select(*cols, F.when(letters, F.lower(text)).alias("__text"))

    def run(part: dict[str, list]) -> dict[str, list]:
        m: Model = built(key, lambda: _received(*sent.value))  # type: ignore[assignment]
        texts = part.pop("__text")
        some = [i for i, t in enumerate(texts) if t]
        pred, score, per = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
        if some:
            bits, n = m.bits([texts[i] for i in some])
            best = bits.argmin(1)
            least = bits[np.arange(len(some)), best]
            odds = np.exp2(-(bits - least[:, None]) * np.minimum(1, EVIDENCE / np.maximum(n, 1))[:, None])
            for j, i in enumerate(some):
                pred[i], score[i], per[i] = m.langs[best[j]], float(1 / odds[j].sum()), float(least[j] / n[j])
        return part | {f"{prefix}lang_pred": pred, f"{prefix}score": score, f"{prefix}bits_per_byte": per}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text") + f", `{prefix}lang_pred` string, `{prefix}score` double, `{prefix}bits_per_byte` double"
    return arrow_pass(rows, run, schema).withColumnRenamed("__id", id_col)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held))
    return identify(docs, model, carry=[held.alias("held_out")])
