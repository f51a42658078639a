"""SentencePiece encoding and decoding (operator 9).

Method: exact merge-type encoding by backtracking. An Aho-Corasick automaton over the pieces gives, at each position,
the longest match, and each piece knows the longest piece that begins it; a piece is accepted after another only if merging the two again from their
parts would leave the border between them standing; positions from which no way leads on are kept as bits of an
integer and never tried again. The result is what greedy merging by score gives, without the queue of merges.

A text is cut first where no piece can reach across: before a run of spaces, and around line feeds, as no piece holds
one. Segments that hold a piece whose own merge order isn't ascending (runs of spaces, all of one score) are merged in the
plain way, by a heap.

Null texts count as empty; an empty text encodes to the end id alone.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import arrow_pass, built, table

SPACE = "▁"
#: Segments kept in each of the two generations of the cache of a worker (25 MB each), and judged pairs of pieces (40 MB).
CACHE = 80_000
FITS = 250_000


def read_model(path: str) -> dict:
    """The pieces, scores and special ids of a model file; plain values, to be broadcast."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {
        "pieces": [sp.id_to_piece(i) for i in range(n)],
        "scores": {i: sp.get_score(i) for i in plain},
        "bytes": [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
        "end": sp.eos_id(),
        "control": [i for i in range(n) if sp.is_control(i)],
    }


def merged(chars: list[str], score: dict[str, float], split: list | None = None) -> list[str]:
    """Greedy merging: the best score first, the leftmost of equals. split, if given, gets the parts of the last merge."""
    n = len(chars)
    part: list[str | None] = list(chars)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j < n and (s := score.get(both := part[i] + part[j])) is not None:
            heapq.heappush(heap, (-s, i, j, both))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, both = heapq.heappop(heap)
        if part[i] is None or part[j] is None or right[i] != j or part[i] + part[j] != both:
            continue
        if split is not None:
            split[:] = (part[i], part[j])
        part[i], part[j] = both, None
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        offer(left[i], i)
        offer(i, right[i])
    return [x for x in part if x is not None]


def merge_tables(model: dict) -> dict:
    """model with the two parts of each piece, and the pieces that only plain merging treats rightly."""
    score = {model["pieces"][i]: s for i, s in model["scores"].items()}
    rank = {p: -s for p, s in score.items()}
    parts: dict[str, tuple[str, str]] = {}
    odd: set[str] = set()
    for p in sorted(score, key=lambda x: (rank[x], len(x))):
        if len(p) == 1:
            continue
        last: list[str] = []
        if len(merged(list(p), score, last)) != 1:
            odd.add(p)
            continue
        a, b = last
        parts[p] = (a, b)
        if any(len(x) > 1 and (x in odd or rank[x] >= rank[p]) for x in (a, b)):
            odd.add(p)
    return model | {"parts": parts, "odd": odd}


class LongestMatches:
    """An Aho-Corasick automaton over the reversed pieces: one pass from a string's end tells the longest piece that begins
    at each position. Moves over failure links are kept once taken, so a character usually costs one lookup."""

    def __init__(self, words: list[str]) -> None:
        self.moves: list[dict[str, int]] = [{}]
        self.best: list[str] = [""]
        for w in words:
            at = 0
            for c in reversed(w):
                if (to := self.moves[at].get(c)) is None:
                    to = self.moves[at][c] = len(self.moves)
                    self.moves.append({})
                    self.best.append("")
                at = to
            self.best[at] = w
        self.fail = [0] * len(self.moves)
        level = list(self.moves[0].values())
        while level:
            below = []
            for at in level:
                for c, to in self.moves[at].items():
                    f = self.fail[at]
                    while f and c not in self.moves[f]:
                        f = self.fail[f]
                    self.fail[to] = self.moves[f].get(c, 0)
                    below.append(to)
            for at in level:
                if not self.best[at]:
                    self.best[at] = self.best[self.fail[at]]
            level = below

    def moved(self, at: int, c: str) -> int:
        f = at
        while f and c not in self.moves[f]:
            f = self.fail[f]
        to = self.moves[at][c] = self.moves[f].get(c, 0)
        return to

    def __call__(self, s: str) -> list[str]:
        """By position from the end: the longest piece that begins there."""
        at, out, moves, best = 0, [], self.moves, self.best
        for c in reversed(s):
            if (to := moves[at].get(c)) is None:
                to = self.moved(at, c)
            at = to
            out.append(best[at])
        return out


class Encoder:
    def __init__(self, tables: dict) -> None:
        self.pieces, self.byte_ids, self.end = tables["pieces"], tables["bytes"], tables["end"]
        self.score = {self.pieces[i]: s for i, s in tables["scores"].items()}
        self.id_of = {self.pieces[i]: i for i in tables["scores"]}
        self.rank = {p: -s for p, s in self.score.items() if len(p) > 1}
        self.parts, self.odd = tables["parts"], tables["odd"]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.silent = frozenset(tables["control"])
        self.longest = LongestMatches(list(self.score))
        self.chars = frozenset(p for p in self.score if len(p) == 1)
        self.shorter: dict[str, str | None] = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.score), None) for p in self.score}
        least = [p for p in self.odd if not any(q != p and q in p for q in self.odd)]
        self.odd_in = re.compile("|".join(map(re.escape, least)) or "(?!)").search
        feed = "\n" if not any("\n" in p for p in self.score) else ""
        self.segments = re.compile(rf"{feed}+|{SPACE}*[^{SPACE}{feed}]+|{SPACE}+" if feed else rf"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.tails = "".join(c for c in ".,;!|%$*&#\"?" if c in self.score and not any(c in p and not p.startswith(c) and p[p.index(c) - 1].isalpha() for p in self.score))
        self.new: dict[str, tuple[str, int, str]] = {}
        self.old: dict[str, tuple[str, int, str]] = {}
        self.fits: dict[tuple[str, str], bool] = {}

    def compatible(self, a: str, b: str) -> bool:
        """Whether the border between two pieces stands when both are merged again from their parts."""
        if (known := self.fits.get((a, b))) is not None:
            return known
        key, rank, parts = (a, b), self.rank, self.parts
        until_a = until_b = float("inf")  # when a, and when b, goes into a larger piece
        while True:
            if (r := rank.get(a + b)) is not None and r < until_a and r <= until_b:
                ok = False
                break
            at_a, at_b = rank.get(a, -1.0), rank.get(b, -1.0)
            if at_a < 0 and at_b < 0:
                ok = True
                break
            if at_a > at_b:
                until_a, a = at_a, parts[a][1]
            else:
                until_b, b = at_b, parts[b][0]
        if len(self.fits) > FITS:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def known(self, s: str) -> list[str]:
        """The pieces of a string of which every character is a piece."""
        n = len(s)
        if n == 1:
            return [s]
        if self.odd_in(s):
            return merged(list(s), self.score)
        at = self.longest(s)
        shorter, fits, compatible = self.shorter, self.fits, self.compatible
        way: list[str] = []
        failed, pos, last = 0, 0, ""
        p: str | None = at[-1]
        while True:
            while p is not None:
                if not (failed and failed >> (pos + len(p)) & 1):
                    if not last:
                        break
                    if (ok := fits.get((last, p))) is None:
                        ok = compatible(last, p)
                    if ok:
                        break
                p = shorter[p]
            if p is not None:
                way.append(p)
                pos += len(p)
                if pos == n:
                    return way
                last, p = p, at[-1 - pos]
            else:
                if not way:
                    return merged(list(s), self.score)
                failed |= 1 << pos
                p = way.pop()
                pos -= len(p)
                p, last = shorter[p], way[-1] if way else ""

    def parted(self, segment: str) -> tuple[list[int], str]:
        """Ids of a segment, and what they decode to but that spaces are still marked; known pieces say what they are."""
        if self.chars.issuperset(segment):
            way = self.known(segment)
            id_of = self.id_of
            return [id_of[p] for p in way], segment
        ids = self.ids(segment)
        return ids, self.decode(ids, first=False)

    def ids(self, segment: str) -> list[int]:
        out: list[int] = []
        run: list[str] = []
        for c in segment:
            if c in self.chars:
                run.append(c)
                continue
            if run:
                out += [self.id_of[p] for p in self.known("".join(run))]
                run = []
            out += [self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")]
        if run:
            out += [self.id_of[p] for p in self.known("".join(run))]
        return out

    def decode(self, ids: list[int], first: bool = True) -> str:
        """Text of ids; first: the space put before the text goes."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            if i not in self.silent:
                out.append(self.pieces[i].replace(SPACE, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if first and text[:1] == " " else text

    def segment(self, w: str) -> tuple[str, int, str]:
        """Ids as text, their number, and what they decode to."""
        if (e := self.new.get(w)) is not None:
            return e
        if (e := self.old.get(w)) is None:
            base = w.rstrip(self.tails)
            if base and len(base) < len(w) and base[-1].isalpha():  # no piece reaches from a letter to such a mark
                a, b = self.segment(base), self.segment(w[len(base):])
                e = (f"{a[0]} {b[0]}", a[1] + b[1], a[2] + b[2])
            else:
                ids, said = self.parted(w)
                e = (" ".join(map(str, ids)), len(ids), said)
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        if len(w) <= 64:
            self.new[w] = e
        return e

    def document(self, text: str | None) -> tuple[list[str], int, str]:
        """Id strings in order with the end id, their number, and the decoded text."""
        if not text:
            return [str(self.end)], 1, ""
        out: list[str] = []
        said: list[str] = []
        n, segment, get = 1, self.segment, self.new.get
        for w in self.segments(SPACE + text.replace(" ", SPACE)):
            if (e := get(w)) is None:
                e, get = segment(w), self.new.get
            out.append(e[0])
            n += e[1]
            said.append(e[2])
        out.append(str(self.end))
        text = "".join(said).replace(SPACE, " ")
        return out, n, text[1:] if text[:1] == " " else text


#: Merge tables by model path, as the driver has read them.
_TABLES: dict[str, dict] = {}


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = True) -> DataFrame:
    """Each row's id with n_tokens, ids_sha256 and decoded_sha256; with full, also ids (array) and decoded (text).

    One pass over the rows, no exchange; the tables (a few MB, the size of the model file) are broadcast. Rows with equal
    ids or texts are encoded each for itself; columns beside the two named are ignored.
    """
    if model_path not in _TABLES:
        _TABLES[model_path] = merge_tables(read_model(model_path))
    sent = docs.sparkSession.sparkContext.broadcast(_TABLES[model_path])
    key = uuid.uuid4().hex

    def run(rows: dict[str, list]) -> dict[str, list]:
        enc: Encoder = built(key, lambda: Encoder(sent.value))  # type: ignore[assignment]
        out: dict[str, list] = {"id": rows["id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
        for text in rows["text"]:
            parts, n, said = enc.document(text)
            joined = " ".join(parts)
            out["n_tokens"].append(n)
            out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest())
            if full:
                out["ids"].append(list(map(int, joined.split(" "))))
                out["decoded"].append(said)
        return out

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * full
    return arrow_pass(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema).withColumnRenamed("id", id_col)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), default_model(), full=False)
