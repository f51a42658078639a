"""HTML main text by equivalence-class template deduction (operator 4).

Method: a page is a sequence of tokens: its elements, each by the path of tags and classes that leads to it, and its text
blocks, each by path and text. The pages of one host give every token an occurrence vector (how often it stands on each
page); tokens with equal vectors form an equivalence class. Classes that occur on at least half of the host's pages, and on
three, are valid. They nest along their elements' paths into the host's template, and what stands between their tokens fills
the template's slots. Words of constant blocks don't count as a slot's; so a menu's slot is empty, however long the menu.

The main slot is found from the root of the template on: the element that stands once on a page and whose slots hold
``DEEPER`` of all varying words is entered, as long as there is one. Main text is what stands in the main slot, and in plain
text elements (headings, paragraphs) directly in the elements around it, up to an article or main element. Where no element holds so much, the slots
beneath the last one entered are main text but for lists of links (``LINKS`` of the words).

Tags, roles and names (AWAY_TAGS, AWAY_WORDS, AWAY_ROLES) break ties: an element named like a menu or an advert goes only if
the rest holds ``REST`` of the words; else the largest of them is taken for misnamed and stays (a form around a whole page,
an article in a "promotion" box). Where the slots leave several elements, a single article or main element with that
share is entered. A name counts if all of its words are such words, or words of boxes.

A constant block inside the main slot is template if its class's slots hold at least three distinct contents, of as many
words as the class's own blocks at least, or as the block itself if the element around it belongs to the class too (there never
stands anything else). So a story that many pages copy stays, as nothing but a date varies beside it, while a notice
repeated in different articles goes. Constant text longer than what varies beside it stays: it can't be told from a copied
article.

A vector is kept as a sum of per-page hashes, which can be added in any order: however many pages a host has, no task holds
its pages, and counts cover all of them. A page that hasn't its host's main slot, and pages of hosts with fewer than three
pages, are judged by the same rules from their own elements alone, where nothing is known to be constant.

A null or empty page gives an empty text. Cut-off tags, comments and character references at the end of a page are read as
browsers do. A null url belongs to the host "". Repeated rows are pages of their own. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import arrow_pass, stored, table

LEAST_PAGES, LEAST_SHARE = 3, 0.5
DEEPER, REST, LINKS = 0.75, 0.25, 0.6
#: Template tokens that are sent to all executors (about 20 MB); more are joined by a shuffle on the host and one of SALTS.
SENT_TOKENS, SALTS = 1_000_000, 64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")

#: Fixed values of HTML: elements without an end tag, elements that end a text block, elements whose content is no text for
#: the parser, and elements that show no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DEAD = frozenset("script style noscript template head title iframe button select textarea svg canvas audio video object datalist xmp noembed noframes".split())
#: Block elements that hold text, not slots.
PLAIN = frozenset("address blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 hr legend p pre summary".split())
#: Elements and names that mark what isn't main text, and words that say nothing in a name.
AWAY_TAGS = frozenset("nav footer header aside form menu dialog".split())
AWAY_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer sidebar aside widget ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login form search share sharing social related recommended recommendations comment comments disqus reply replies discussion pagination pager toolbar copyright disclaimer".split()
)
BOX_WORDS = frozenset("area bar block box button buttons container content inner item items left links list main panel posts right section site slot stories top bottom unit wrap wrapper".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Ends the name of an element in a path if tags or names mark it.
MARK = "!"

JOIN = "\x1f"

Path = tuple[str, ...]


class Block:
    __slots__ = ("path", "parts", "linked")

    def __init__(self, path: Path) -> None:
        self.path, self.parts, self.linked = path, [], 0

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw.strip(" /") else {}


@lru_cache(4096)
def _away_name(name: str) -> bool:
    words = [w.lower() for w in _WORD.findall(name)]
    return any(w in AWAY_WORDS for w in words) and all(w in AWAY_WORDS or w in BOX_WORDS for w in words)


def marked(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether tag, role or names say that an element isn't main text. Headers inside an article hold its headline."""
    if tag in AWAY_TAGS and not (tag == "header" and inside):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if attributes.get("role", "").lower() in AWAY_ROLES:
        return True
    names = [*attributes.get("class", "").split(), attributes.get("id", "")]
    return any(_away_name(n) and not (inside and n.lower() == "header") for n in names)


def hidden(attributes: dict[str, str]) -> bool:
    return bool(attributes) and ("hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower())


def parsed(page: str | None) -> tuple[list[Block], list[Path]]:
    """The visible text blocks of a page and the paths of its elements, in order."""
    blocks: list[Block] = []
    paths: list[Path] = []
    stack: list[tuple[str, Path, bool, bool, bool]] = [("", (), False, False, False)]  # tag, path, dead, inside an article, a link
    now: Block | None = None
    raw_until = ""
    page = page or ""
    at, n = 0, len(page)
    match = _TOKEN.match
    while at < n:
        if raw_until:
            end = re.compile(rf"</{re.escape(raw_until)}[\s/>]", re.I).search(page, at)
            at, raw_until = (end.start() if end else n), ""
            continue
        m = match(page, at)
        at = m.end()
        text, closing, tag, rest = m[7], m[1] or m[4], m[2] or m[5], m[3] or m[6] or ""
        if text is not None:
            top = stack[-1]
            if top[2]:
                continue
            if now is None:
                now = Block(top[1])
                blocks.append(now)
            now.parts.append(text)
            if top[4]:
                now.linked += len(text.split())
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            if now is not None:
                now.parts.append(" ")
            continue
        if tag in BLOCK:
            now = None
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    if stack[k - 1][1] != stack[-1][1]:
                        now = None
                    del stack[k:]
                    break
            continue
        if tag in BLOCK:  # a paragraph ends where a block begins, a list item where the next does
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p" or tag == stack[k][0] and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK and stack[k][0] != "p":
                    break
        attributes = _attributes(rest)
        _, path, dead, inside, link = stack[-1]
        if tag in BLOCK and len(path) < 40:
            name = tag + "".join("." + c for c in sorted(attributes.get("class", "").split())[:4] if sum(x.isdigit() for x in c) < 3)
            path = (*path, name + MARK * marked(tag, attributes, inside))
        elif tag not in BLOCK and tag not in DEAD and attributes and marked(tag, attributes, inside):
            path, now = (*path, tag + MARK), None
        if path is not stack[-1][1]:
            paths.append(path)
        dead = dead or hidden(attributes)
        if tag in VOID or rest.rstrip().endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        inside = inside or tag in ("article", "main") or attributes.get("role", "").lower() == "main"
        stack.append((tag, path, dead or tag in DEAD, inside, link or tag == "a"))
        if tag in RAW:
            raw_until = tag
    return blocks, paths


def _hash(*parts: object) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")) - 2**63


class Slots:
    """What decides the roles: words and linked words under each path, and the paths that stand once on a page."""

    def __init__(self) -> None:
        self.words: dict[Path, float] = defaultdict(float)
        self.linked: dict[Path, float] = defaultdict(float)
        self.single: set[Path] = set()

    def add(self, path: Path, words: float, linked: float) -> None:
        for k in range(len(path) + 1):
            self.words[path[:k]] += words
            self.linked[path[:k]] += linked


def outermost_mark(path: Path, misnamed: Iterable[Path]) -> int | None:
    """How long the path of the outermost element is that its mark sends away."""
    return next((k for k, name in enumerate(path, 1) if name.endswith(MARK) and path[:k] not in misnamed), None)


def _container(path: Path) -> Path:
    """The innermost element of a path that can hold slots."""
    k = len(path)
    while k and path[k - 1].rstrip(MARK).split(".")[0] in PLAIN:
        k -= 1
    return path[:k]


class Roles:
    """main: the path of the main slot; misnamed: marked paths that stay; linky: paths of lists of links."""

    def __init__(self, main: Path = (), misnamed: Iterable[Path] = (), linky: Iterable[Path] = ()) -> None:
        self.main, self.misnamed, self.linky = main, frozenset(misnamed), frozenset(linky)
        self.least = next((k for k in range(1, len(main) + 1) if _is_article(main[:k])), 0)  # nothing around an article is main text

    def keeps(self, path: Path) -> bool:
        if outermost_mark(path, self.misnamed) is not None:
            return False
        at = _container(path)
        if at[: len(self.main)] != self.main and (at != self.main[: len(at)] or len(at) < self.least):
            return False
        return not any(path[:k] in self.linky for k in range(1, len(path) + 1))


def decided(slots: Slots) -> Roles:
    """The roles of a template's slots (or of a page's own elements)."""
    words = slots.words
    misnamed: set[Path] = set()
    while True:
        away = {p for p in words if p and outermost_mark(p, misnamed) == len(p) and words[p] > 0}
        rest = words[()] - sum(words[p] for p in away)
        if not away or rest >= REST * words[()]:
            break
        misnamed.add(max(away, key=lambda p: (words[p], p)))
    kept = defaultdict(float, words)
    for p in away:
        for k in range(len(p) + 1):
            kept[p[:k]] -= words[p]
    below: dict[Path, list[Path]] = defaultdict(list)
    for p in words:
        if p and outermost_mark(p, misnamed) is None:
            below[p[:-1]].append(p)
    main: Path = ()
    while children := [p for p in below[main] if p in slots.single and p == _container(p)]:
        best = max(children, key=lambda p: (kept[p], p))
        if kept[best] <= 0 or kept[best] < DEEPER * kept[main]:
            break
        main = best
        if _is_article(main):
            break
    if not Roles(main).least:
        articles = [p for p in slots.single if p[: len(main)] == main and _is_article(p) and outermost_mark(p, misnamed) is None and not any(_is_article(p[:k]) for k in range(1, len(p)))]
        if len(articles) == 1 and kept[articles[0]] >= REST * kept[()] and kept[articles[0]] > 0:
            main = articles[0]
    linky = set()
    if not Roles(main).least:
        for p in words:
            if len(p) > len(main) and p[: len(main)] == main and p == _container(p) and 0 < words[p] < DEEPER * kept[main] and slots.linked[p] >= LINKS * words[p]:
                linky.add(p)
    return Roles(main, misnamed, linky)


def _is_article(path: Path) -> bool:
    return bool(path) and path[-1].split(".")[0] in ("article", "main")


def alone(blocks: list[Block], paths: list[Path]) -> Roles:
    """The roles of a page's elements by themselves."""
    slots, n = Slots(), defaultdict(int)
    for b in blocks:
        slots.add(b.path, len(b.text().split()), b.linked)
    for p in paths:
        n[p] += 1
    slots.single = {p for p, k in n.items() if k == 1}
    return decided(slots)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def _tokens(page: str | None) -> dict[tuple[int, str], list[int]]:
    """Of each token of a page, with its path: how often it stands, where first, its words and linked words. Token 0 is an
    element, whose words are all beneath it; the whole page is the element without a path."""
    blocks, paths = parsed(page)
    slots = Slots()
    out: dict[tuple[int, str], list[int]] = {}
    for b in blocks:
        if t := b.text():
            n = len(t.split())
            slots.add(b.path, n, b.linked)
            own = out.setdefault((_hash("t", *b.path, t), JOIN.join(b.path)), [0, len(out), 0, 0])
            own[0] += 1
            own[2] += n
            own[3] += b.linked
    for k, p in enumerate([(), *paths]):
        out.setdefault((0, JOIN.join(p)), [0, k, int(slots.words[p]), int(slots.linked[p])])[0] += 1
    return out


def templates(pages: DataFrame) -> DataFrame:
    """host, token (0: an element), path, class, pages, all_pages, times, place, words, linked of the tokens of each host's
    valid equivalence classes. pages: host, html."""

    def run(part: dict[str, list]) -> dict[str, list]:
        sums: dict[tuple[str, int, str], list[int]] = defaultdict(lambda: [0] * 6)
        for host, page in zip(part["host"], part["html"], strict=True):
            own = _hash("p", page)
            for (token, path), (n, place, words, linked) in _tokens(page).items():
                s = sums[host, token, path]
                s[0] += 1
                s[1] = (s[1] + _hash(own, n)) & 0xFFFFFFFFFFFF
                s[2] += place
                s[3] += n
                s[4] += words
                s[5] += linked
        out = {k: [s[i] for s in sums.values()] for i, k in enumerate(("pages", "vector", "place", "times", "words", "linked"))}
        return out | {"host": [h for h, _, _ in sums], "token": [t for _, t, _ in sums], "path": [p for _, _, p in sums]}

    rows = arrow_pass(pages, run, "host string, token long, path string, pages long, vector long, place long, times long, words long, linked long")
    sums = [F.sum(c).alias(c) for c in ("pages", "place", "times", "words", "linked")]
    tokens = rows.groupBy("host", "token", "path").agg(F.pmod(F.sum("vector"), F.lit(1 << 48)).alias("vector"), *sums).where(F.col("pages") >= LEAST_PAGES)
    tokens = stored(tokens, "page-tokens")
    whole = tokens.where("token = 0 and path = ''").select("host", F.col("pages").alias("all_pages"))
    valid = tokens.join(whole, "host").where(F.col("pages") >= LEAST_SHARE * F.col("all_pages"))
    return valid.select("host", "token", "path", F.xxhash64("host", "vector", "pages").alias("class"), "pages", "all_pages", "times", (F.col("place") / F.col("pages")).alias("place"), "words", "linked")


def _split(path: str) -> Path:
    return tuple(path.split(JOIN)) if path else ()


def roles(found: DataFrame) -> DataFrame:
    """host, main, misnamed, linky (paths), and t: token, class and pages of the constant blocks in the main slot, and whether
    the element around belongs to their class. found: templates.

    A host's rows are the tokens that half of its pages have: bounded by what pages hold, not by the number of pages."""
    fields = ("token", "path", "class", "pages", "times", "words", "linked")
    by_host = found.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", *fields))).alias("t")).select("host", *[F.col(f"t.{f}").alias(f) for f in fields])

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"host": part["host"], "main": [], "misnamed": [], "linky": [], "t": []}
        for row in zip(*(part[f] for f in fields), strict=True):
            tokens = [(token, _split(path), *rest) for token, path, *rest in zip(*row, strict=True)]
            slots, elements = Slots(), {}
            for token, p, group, pages, times, words, linked in tokens:
                if token == 0:
                    elements[p] = group
                    slots.words[p], slots.linked[p] = words, linked
                    if times == pages:
                        slots.single.add(p)
            varying = Slots()
            varying.words |= slots.words
            varying.linked |= slots.linked
            varying.single = slots.single
            for token, p, _, _, _, words, linked in tokens:
                if token:
                    varying.add(p, -words, -linked)
            r = decided(varying if varying.words[()] > 0 else slots)  # where nothing varies, all pages are copies
            out["main"].append(JOIN.join(r.main))
            out["misnamed"].append([JOIN.join(p) for p in sorted(r.misnamed)])
            out["linky"].append([JOIN.join(p) for p in sorted(r.linky)])
            out["t"].append([{"token": t, "class": g, "pages": n, "own": elements.get(p) == g} for t, p, g, n, *_ in tokens if t and r.keeps(p)])
        return out

    return arrow_pass(by_host, run, "host string, main string, misnamed array<string>, linky array<string>, t array<struct<token:long,class:long,pages:long,own:boolean>>")


def main_blocks(page: str | None, roles_: Roles | None) -> list[tuple[Block, str]]:
    """The blocks with text that a host's roles keep; by the page's own, if there are none or the page hasn't the main slot."""
    blocks, paths = parsed(page)
    if roles_ is None or roles_.main and roles_.main not in paths:
        roles_ = alone(blocks, paths)
    return [(b, t) for b in blocks if roles_.keeps(b.path) and (t := b.text())]


def beside(page: str | None, roles_: Roles, classes: dict[int, tuple[int, int, bool]]) -> list[tuple[int, int]]:
    """token, content: constant blocks of the page that its slots speak for as template, with a hash of what fills the slots
    of their class. classes: of each constant block its class, the pages, and whether the element around is of the class."""
    texts = [(t, _hash("t", *b.path, t)) for b, t in main_blocks(page, roles_)]
    found = [classes.get(token) for _, token in texts]
    words = [len(t.split()) for t, _ in texts]
    filled = {}
    for c, pages in {f[:2] for f in found if f}:
        rest = [i for i, f in enumerate(found) if f is None or f[1] < pages]
        own = sum(w for w, f in zip(words, found, strict=True) if f and f[0] == c)
        filled[c] = own, sum(words[i] for i in rest), _hash("s", *(texts[i][0] for i in rest))
    out = []
    for (_, token), f, n in zip(texts, found, words, strict=True):
        if f:
            own, varying, content = filled[f[0]]
            if varying >= (n if f[2] else own):
                out.append((token, content))
    return out


def with_host(rows: DataFrame, by_host: DataFrame, n: int, how: str = "left") -> DataFrame:
    """rows with their host's row, which is sent to all executors if the rows by host hold few tokens (n) in all, else met by a
    shuffle in which a host's pages are dealt to SALTS tasks."""
    if n <= SENT_TOKENS:
        return rows.join(F.broadcast(by_host), "host", how)
    salted = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], how).drop("salt")


def _cached(make: Callable) -> Callable:
    """Builds what a host's row says once for the pages that follow each other."""
    seen: dict = {}

    def get(key: object, *args: object) -> object:
        if key not in seen:
            if len(seen) > 256:
                seen.clear()
            seen[key] = make(*args)
        return seen[key]

    return get


def _roles(main: str | None, misnamed: list[str] | None, linky: list[str] | None) -> Roles | None:
    return None if main is None else Roles(_split(main), map(_split, misnamed or ()), map(_split, linky or ()))


def constant(rows: DataFrame, by_host: DataFrame, n: int) -> DataFrame:
    """host, token: the constant blocks in main slots that are template. rows: host, html; by_host: roles, stored."""

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[tuple[str, int, int], None] = {}

        get = _cached(lambda main, misnamed, linky, t: (_roles(main, misnamed, linky), {x["token"]: (x["class"], x["pages"], x["own"]) for x in t}))
        for host, page, *row in zip(part["host"], part["html"], part["main"], part["misnamed"], part["linky"], part["t"], strict=True):
            for t, content in beside(page, *get(host, *row)):
                out[host, t, content] = None
        return {"host": [k[0] for k in out], "token": [k[1] for k in out], "content": [k[2] for k in out]}

    joined = with_host(rows, by_host.where(F.size("t") > 0), n, "inner")
    seen = arrow_pass(joined.select("host", "html", "main", "misnamed", "linky", "t"), run, "host string, token long, content long")
    return seen.distinct().groupBy("host", "token").count().where(F.col("count") >= LEAST_PAGES).select("host", "token")


def main_text(page: str | None, roles_: Roles | None = None, template: Iterable[int] = ()) -> str:
    """What fills the main slot of a page; template: tokens of constant blocks."""
    return "\n".join(t for b, t in main_blocks(page, roles_) if not template or _hash("t", *b.path, t) not in template)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.col("html").alias("html"), host_of(F.col("url")).alias("host"))
    by_host = stored(roles(templates(rows.select("host", "html"))), "template")
    n = by_host.agg(F.sum(F.size("t") + F.size("misnamed") + F.size("linky") + 1)).first()[0] or 0
    gone = stored(constant(rows.select("host", "html"), by_host, n), "constant")
    by_host = by_host.join(gone.groupBy("host").agg(F.collect_set("token").alias("template")), "host", "left").select("host", "main", "misnamed", "linky", "template")

    def run(part: dict[str, list]) -> dict[str, list]:
        get = _cached(lambda main, misnamed, linky, template: (_roles(main, misnamed, linky), frozenset(template or ())))
        out = [main_text(page, *get(host, *row)) for host, page, *row in zip(part["host"], part["html"], part["main"], part["misnamed"], part["linky"], part["template"], strict=True)]
        return {"page_id": part["page_id"], "url": part["url"], "text": out, "n_chars": [len(t) for t in out]}

    kind = pages.schema["page_id"].dataType.simpleString()
    return arrow_pass(with_host(rows, by_host, n).select("host", "page_id", "url", "html", "main", "misnamed", "linky", "template"), run, f"page_id {kind}, url string, text string, n_chars long")


def op4_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
