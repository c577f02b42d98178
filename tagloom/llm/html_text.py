"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. A block's features are its word count and link density,
those of the blocks before and after it, and whether its markup names it as furniture (a menu,
footer, advert, form, comment ...), as article text or as a heading. The tree is trained by Spark ML on the
small labelled table in ``labelled_pages``; the fitted tree is a few nested rules that go to the tasks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.labelled_pages import PAGES

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|title|textarea|select|button)\b[^>]*+(?:>.*?(?:</(?P=raw)\s*+>|\Z)|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
#: Only tags with one of these are looked at more closely.
TELLING = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)

# The elements of HTML by their effect on text.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr output picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = set("nav header footer aside form menu dialog fieldset head".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ARTICLE = set("article main".split())
# An element ends open ones of these kinds when another begins.
CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
FURNITURE_WORDS = set(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar widget footer header masthead toolbar topbar related recommended share sharing social login search"
    " comment comments disqus discussion replies reply respond copyright legal disclaimer".split()
)
# Parts that leave a name what its other parts make it: site-footer is a footer, has-sidebar is no sidebar.
NEUTRAL = set("site main page global top bottom left right primary secondary inner outer wrap wrapper container box block bar area list item items link links title button btn icon form text posts articles stories".split())
FURNITURE_NAMES = set("legal-notice post-footer entry-footer article-footer post-navigation post-comments article-comments social-media".split())
# As the id of a section these are as often its topic.
TOPICS = set("discussion legal copyright disclaimer advertising promotion navigation search menu alert notice cookies consent gdpr".split())
WHITE = re.compile(r"\s+")
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "heading")


def _names_furniture(name: str) -> bool:
    """Whether a whole class, id or role is furniture: one of the words, or several with nothing but neutral parts."""
    parts = [part.rstrip("0123456789") for part in re.split("[-_]+", name)]
    found = [part in FURNITURE_WORDS for part in parts]
    return name in FURNITURE_NAMES or any(found) and all(f or not part or part in NEUTRAL for f, part in zip(found, parts))


def _furniture(tag: str, rest: str) -> int:
    """0 for none, 1 where only a name says so, 2 for an element that is furniture by its kind or is hidden."""
    named = 0
    if TELLING.search(rest):
        seen = set()
        for name, *values in ATTRIBUTE.findall(rest):
            name, value = name.lower(), html.unescape("".join(values)).strip().lower()
            if name in seen:  # the first of equal attributes counts
                continue
            seen.add(name)
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and NOT_SHOWN.search(value):
                return 2
            if name == "id" and tag in HEADINGS:  # an anchor
                continue
            if name in ("class", "id", "role"):
                named |= any(_names_furniture(w) for w in value.split() if not (name == "id" and tag == "section" and w in TOPICS))
    return 2 if tag in FURNITURE else int(named)


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """(text, features) of every block that has text, in page order."""
    out: list[tuple[str, list[float]]] = []
    open_: list[tuple[str, int, bool, bool]] = []  # tag, furniture, article, heading: each its own or above
    parts: list[str] = []
    linked: list[str] = []
    anchors = 0

    def close() -> None:
        if parts:
            text = WHITE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                words = text.count(" ") + 1
                links = len(html.unescape("".join(linked)).split())
                _, furniture, article, heading = open_[-1] if open_ else ("", 0, False, False)
                out.append((text, [float(words), min(1.0, links / words), 0.0, 0.0, 0.0, 0.0, float(furniture > 0), float(article), float(heading)]))
            parts.clear()
            linked.clear()

    def text(piece: str) -> None:
        parts.append(piece)
        if anchors:
            linked.append(piece + " ")

    end = 0
    for m in MARKUP.finditer(page):
        if m.start() > end:
            text(page[end : m.start()])
        end = m.end()
        if m["tag"] is None:
            if m["raw"] is not None and m["raw"].lower() not in ("svg", "math", "button"):
                close()
            continue
        tag, rest = m["tag"].lower(), m["rest"]
        if tag == "a":
            anchors = 0 if m["end"] else 1
        if tag == "br":
            parts.append(" ")
        if tag in INLINE and (m["end"] or tag in EMPTY or not _furniture(tag, rest)):
            if not m["end"] or not any(t == tag for t, *_ in open_):
                continue
        close()
        if m["end"]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    del open_[k:]
                    break
        elif tag not in EMPTY:
            if tag in CLOSES and open_ and open_[-1][0] in CLOSES[tag]:
                open_.pop()
            above = open_[-1] if open_ else ("", 0, False, False)
            furniture = 0 if tag in ("html", "body") else _furniture(tag, rest)
            # What holds the page's main part is its layout, whatever its name.
            inherited = 0 if tag == "main" and above[1] == 1 else above[1]
            open_.append((tag, max(furniture, inherited), tag in ARTICLE or above[2], tag in HEADINGS))
            anchors = 0
    if end < len(page):
        text(page[end:])
    close()
    for i, (_, f) in enumerate(out):
        if i:
            f[2:4] = out[i - 1][1][0:2]
        if i + 1 < len(out):
            f[4:6] = out[i + 1][1][0:2]
    return out


def labelled() -> list[tuple]:
    """(label, *features) of the blocks of ``PAGES``."""
    rows = []
    for page in PAGES:
        labels = [(label, [t for t, _ in blocks(fragment)]) for label, fragment in page]
        found = blocks("".join(fragment for _, fragment in page))
        expected = [label for label, texts in labels for _ in texts]
        if len(found) != len(expected):
            raise ValueError("the fragments of a page have other blocks than the page")
        rows += [(float(label), *f) for label, (_, f) in zip(expected, found)]
    return rows


@lru_cache(maxsize=8)
def trained(spark: SparkSession, depth: int = 5) -> tuple:
    """The fitted tree as nested (feature, threshold, at most, above), leaves as 0.0 or 1.0."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = spark.createDataFrame(labelled(), ["label", *FEATURES]).coalesce(1)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    fitted = DecisionTreeClassifier(maxDepth=depth, seed=4).fit(rows)

    def nested(node) -> object:
        if node.numDescendants() == 0:
            return node.prediction()
        split = node.split()
        return (split.featureIndex(), split.threshold(), nested(node.leftChild()), nested(node.rightChild()))

    return nested(fitted._call_java("rootNode"))


def main_text(page: str, tree: object) -> str:
    kept = []
    for text, features in blocks(page):
        node = tree
        while isinstance(node, tuple):
            feature, threshold, below, above = node
            node = below if features[feature] <= threshold else above
        if node:
            kept.append(text)
    return "\n".join(kept)


def _extracted(tree: object):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(page, tree) for page in batch.column("html").to_pylist()], pa.string())
            names = [n for n in batch.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], names=[*names, "text"])

    return work


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row; the text has one line per block of the main text.

    Null and empty pages, and pages of furniture alone, have an empty text. Markup that is cut off or
    badly nested ends where the page does. Rows and ids may repeat. Further columns are ignored.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    kinds = dict(rows.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return rows.mapInArrow(_extracted(trained(pages.sparkSession)), schema)
