"""Main text of web pages by the maximum-scoring run: words score for it, tags against it, and one linear scan finds the best run.

The weights come from labelled pages: on a bounded sample of pages (about ``SAMPLE``, by the hash of id and html) that mark
their article up as such, words and each kind of tag are counted inside and outside of it; a weight is the log of how much more
often the item comes inside, held between 0.5 and 2 for words, -0.5 and -0.05 for words of links and between -6 and -0.05 for tags. A tag the sample does not hold
tells nothing and costs ``UNSEEN``; without any labelled page fixed priors stand in.

The run tells which region of the page is its main text. Where most of its words stand in elements marked as article
(or, outside of any, as main), the whole of these elements is returned; elsewhere the run is widened to the first and last
block directly in the innermost division that holds all of it. Left out, wherever they stand: elements that are never
part of an article by their name or role; by class or id, those whose whole name is made of known words with one of ``CUT`` among them
(``ad-slot``, ``comment-list``); and those made of known words with one of ``CUT_IF_LINKS`` among them (``share``, ``related-posts``), if at
least half of their words are links or they hold a form's fields. A name with any other word in it (``side-effects``) cuts nothing.

Null and empty pages give an empty text. Pages cut off in the middle are read to their end. Repeated rows give repeated
rows; null ids and urls stay. Of two runs of the same score the first wins. Other columns are left out. Empty tables give an
empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled

SAMPLE = 500
WORD_PRIOR, TAG_PRIOR, UNSEEN = 0.5, -0.5, -0.05
LINKED = "a word"
#: Names of elements, and what names, roles and classes say that an element is no part of an article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav aside footer form menu dialog button select option fieldset".split())
CUT = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos cookie cookies consent gdpr notice notices popup modal newsletter "
    "subscribe signup sidebar menu menus nav navbar breadcrumb breadcrumbs comment comments commentlist disqus masthead pagination pager".split())
CUT_IF_LINKS = frozenset("alert banner side aside replies respond discussion related share sharing social footer header topbar toolbar tags search login links widget widgets navigation promotion".split())
BESIDE = frozenset(
    "site page main top bottom left right inline reader readers user users post posts article articles blog global primary secondary google list block box slot unit container "
    "wrapper wrap section area bar body item items thread button buttons icons media form inner outer content sticky fixed mobile desktop".split())
FIELDS = frozenset("input textarea select button option form fieldset".split())
DIVISIONS = frozenset("div section main article".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ITEM = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|noscript|template|textarea|svg|iframe|object|canvas|math)\b.*?(?:</\1\s*>|\Z)|"
    r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*)>|<[/!?][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<""", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORD = re.compile(r"\S+")


def _named(value: str) -> int:
    """2: a name in the list is noise; 1: one is if its content is links or fields; 0: none."""
    worst = 0
    for name in value.lower().split():
        parts = [x for x in re.split(r"[-_]+", name) if not x.isdigit()]
        if all(x in CUT or x in CUT_IF_LINKS or x in BESIDE for x in parts):
            worst = max(worst, 2 if any(x in CUT for x in parts) else 1 if any(x in CUT_IF_LINKS for x in parts) else 0)
    return worst


def _noise(name: str, attributes: str, in_article: bool) -> int:
    """As ``_named``, of an element."""
    if name in OUTSIDE or name == "header" and not in_article:
        return 2
    worst = 0
    if attributes and name not in ("body", "html", "main", "article"):
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "role" and value.lower() in ROLES or key == "hidden":
                return 2
            if key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return 2
            if key in ("class", "id"):
                worst = max(worst, _named(value))
    return worst


class Place:
    """An open element that texts are told apart by: a division, or one that may turn out as noise."""

    __slots__ = ("above", "name", "doubtful", "article", "words", "links", "fields")

    def __init__(self, above: Place | None, name: str, doubtful: bool):
        self.above, self.name, self.doubtful = above, name, doubtful
        inherited = above.article if above else None
        self.article = inherited if inherited and (inherited.name == "article" or name != "article") else self if name in ("article", "main") else None
        self.words = self.links = self.fields = 0

    def up(self) -> Iterator[Place]:
        place: Place | None = self
        while place:
            yield place
            place = place.above

    def is_noise(self) -> bool:
        return self.doubtful and (2 * self.links >= self.words or 20 * self.fields >= self.words)

    def close(self) -> Place:
        """What is inside counts for what is around it."""
        above = self.above
        above.words, above.links, above.fields = above.words + self.words, above.links + self.links, above.fields + self.fields
        return above


def items(page: str, all_words: bool = False) -> Iterator[tuple[str, str, int, Place]]:
    """(tag name, or empty or ``LINKED`` for text, text, block, place) of the page in order; places are complete when the page is read to its end.

    What is never part of an article is left out; its words are given, as of no article, where all words are asked for.
    """
    root = place = Place(None, "", False)
    open_names: dict[str, int] = {}
    block = link = 0

    def closed(place: Place, name: str) -> Place:
        """Where an end tag leads; one that closes nothing leads nowhere."""
        while open_names.get(name):
            open_names[place.name] -= 1
            last, place = place.name, place.close()
            if last == name:
                break
        return place

    noise: list[str] = []  # open elements since the outermost one of noise
    for m in ITEM.finditer(page):
        name = m[3]
        if name is None:
            if m[0][0] != "<" or m[0] == "<":
                if not noise:
                    if place is not root:
                        n = len(_WORD.findall(m[0]))
                        place.words += n
                        place.links += n if link else 0
                    yield LINKED if link else "", m[0], block, place
                elif all_words:
                    yield LINKED if link else "", m[0], block, root
            continue
        name, closing = name.lower(), bool(m[2])
        if name in BLOCKS:
            block += 1
        if noise:
            if name in FIELDS:
                place.fields += 1
            if name == "a":
                link = 0 if closing else 1
            if name in VOID:
                continue
            if not closing:
                if noise[-1] in ("p", "li", "option") and name in BLOCKS and (name == noise[-1] or noise[-1] == "p"):
                    noise.pop()  # these end where the next block begins
                    if not noise:
                        yield name, "", block, place
                        continue
                noise.append(name)
            elif name in noise:
                del noise[len(noise) - 1 - noise[::-1].index(name):]
            elif name in ("body", "html", "article", "main"):
                noise.clear()  # never closed itself
                place = closed(place, name)
            continue
        opened = not closing and name not in VOID and not m[4].endswith("/")
        level = _noise(name, m[4], place.article is not None) if opened else 0
        if name in FIELDS:
            place.fields += 1
        if level == 2:
            noise.append(name)
            continue
        if opened and place.name in ("p", "li") and name in BLOCKS and place.name in ("p", name):
            place = closed(place, place.name)  # these end where the next block begins
        if opened and (name in DIVISIONS or level or open_names.get(name)):
            place = Place(place, name, level == 1)
            open_names[name] = open_names.get(name, 0) + 1
        elif closing:
            place = closed(place, name)
        if name == "a":
            link = 0 if closing else 1
        if name == "br":
            yield "", " ", block, place
        else:
            yield ("/" if closing else "") + name, "", block, place
    while place.above:  # elements that the page leaves open
        place = place.close()


def best_run(scored: list[tuple[float, int | None]]) -> tuple[int, int]:
    """First and last block of the best-scoring run, from (score, block of a text with words, else null); (0, -1): none scores."""
    best = total = 0.0
    run, first = (0, -1), None
    for score, block in scored:
        total += score
        if block is None:
            if total <= 0:
                total, first = 0.0, None
            continue
        if first is None:
            first = block
        if total > best:
            best, run = total, (first, block)
    return run


def extract(page: str, weights: dict[str, float]) -> str:
    """The blocks of the region that the best run points to."""
    word, other = weights.get("", WORD_PRIOR), UNSEEN if weights else TAG_PRIOR
    found = list(items(page))
    noise: dict[int, bool] = {}
    texts: dict[int, list[str]] = {}
    places: dict[int, Place] = {}
    words: dict[int, int] = {}
    scored: list[tuple[float, int | None]] = []
    for name, text, block, place in found:
        if id(place) not in noise:
            chain = []
            for p in place.up():
                chain.append(p)
                if id(p) in noise:
                    break
            for p in reversed(chain):
                noise[id(p)] = noise.get(id(p), False) or p.is_noise() or bool(p.above and noise.get(id(p.above)))
        if noise[id(place)]:
            continue
        if name and name != LINKED:
            scored.append((weights.get(name, other), None))
            continue
        texts.setdefault(block, []).append(text)
        places[block] = place
        n = len(_WORD.findall(text))
        if n:
            words[block] = words.get(block, 0) + n
            scored.append((n * (weights.get(LINKED, -word) if name else word), block))
    start, end = best_run(scored)
    inside = [b for b in words if start <= b <= end]
    marked = {id(places[b].article) for b in inside if places[b].article}
    if 2 * sum(words[b] for b in inside if places[b].article) >= sum(words[b] for b in inside) > 0:
        region = {b for b in texts if id(places[b].article) in marked}
    else:
        region = {b for b in texts if start <= b <= end}
        around = _around([places[b] for b in inside])
        if around is not None and around.above:
            direct = [b for b in words if places[b] is around]
            region |= {b for b in texts if direct and min(direct) <= b <= max(direct) and any(p is around for p in places[b].up())}
    blocks = (" ".join(html.unescape("".join(texts[b])).split()) for b in sorted(region))
    return "\n".join(b for b in blocks if b)


def _around(places: list[Place]) -> Place | None:
    """The innermost element that holds all of them."""
    common: list[Place] | None = None
    for place in {id(p): p for p in places}.values():
        chain = list(place.up())
        common = chain if common is None else [p for p in common if any(p is q for q in chain)]
    return common[0] if common else None


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often words and tags come inside and outside the articles of pages that mark one."""
    total: dict[tuple[str, bool], int] = {}
    for batch in batches:
        for page in batch.column("html").to_pylist():
            if not re.search("<(?:article|main)[\\s>]", page, re.I):
                continue
            for name, text, _, place in items(page, True):
                inside = place.article is not None and name not in ("article", "/article", "main", "/main")  # not the edge itself
                total[name, inside] = total.get((name, inside), 0) + (len(_WORD.findall(text)) if name in ("", LINKED) else 1)
    keys = [k for k, v in total.items() if v and len(k[0]) <= 30]
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())], ["name", "inside", "n"])


def train(pages: DataFrame) -> dict[str, float]:
    """Weights of words ("") and tags; the 300 most frequent names reach the driver."""
    sample = sampled(pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")), SAMPLE)
    rows = sample.select("html").mapInArrow(_count, "name string, inside boolean, n long").groupBy("name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("o")).orderBy(F.desc(F.col("i") + F.col("o")), "name").limit(300).collect()
    inside, outside = sum(r.i for r in rows), sum(r.o for r in rows)
    out = {}
    for r in rows:
        ratio = math.log((r.i + 1) / (inside + len(rows))) - math.log((r.o + 1) / (outside + len(rows)))
        least, most = {"": (0.5, 2.0), LINKED: (-0.5, -0.05)}.get(r.name, (-6.0, -0.05))
        out[r.name] = min(most, max(least, ratio))
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """Query form: the main text of every page and its size in code points."""
    weights = train(pages)

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = [extract(p or "", weights) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(use, rows.drop("html").schema.add("text", "string").add("n_chars", "long"))
