"""Main text of HTML pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Each word has a weight by the zone it stands in
(article, navigation, advert, comments, ...) and by whether it is part of a link; each tag
has a negative weight. The weights are log odds counted on labelled pages: pages that mark
exactly one article themselves, whose words inside it are content and all others are not.
A linear scan finds the contiguous region of the largest sum. Blocks of that region whose
own words weigh negative (an advert between two paragraphs) are left out. Boilerplate inside
an article weighs nothing, so however long it is, it parts no article; its words stay out.
Elsewhere a stretch of boilerplate between two parts of one parent element costs no more than
INSERT_LIMIT, so that a long insert does not cut off what stands before it. Linked blocks of an
article stay; outside of one, a block of links goes if the block before or after it is one too,
as in a menu.

Null and empty pages, and pages without words of positive weight, give an empty text. Of
regions with equal sums the first counts. Pages are read whole, however long; broken markup
is read as far as it goes. Rows keep their number, repeated rows too, and only the columns
asked for are carried. Without any labelled page the prior counts decide alone.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import map_batches

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
HINTS = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
HIDDEN = re.compile(
    r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden",
    re.IGNORECASE,
)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names of HTML.
RAW = {"script", "style", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "br",
}
SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}

# Zones by element name, and by parts of class, id, role and itemprop names.
ZONE_OF_ELEMENT = {
    "article": "article", "main": "article", "nav": "menu", "menu": "menu", "header": "header", "footer": "footer",
    "aside": "sidebar", "form": "form", "button": "form", "select": "form", "textarea": "form", "label": "form",
    "fieldset": "form", "dialog": "notice", "head": "head", "svg": "head", "object": "head", "audio": "head",
    "video": "head", "canvas": "head",
}
ZONE_OF_NAME = {
    "comment": "comment comments comentarios discussion disqus reply replies respond responses",
    "advert": "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pager pagination tabs toolbar",
    "notice": "notice notices cookie cookies consent gdpr popup modal alert newsletter subscribe paywall disclaimer",
    "sidebar": "sidebar aside related recommended widget widgets trending popular share sharing social tags",
    "form": "form search login signup signin",
    "footer": "footer colophon copyright",
    "header": "header masthead topbar",
    "article": "article content main post entry story",
}
ZONE_BY_PART = {part: zone for zone, parts in ZONE_OF_NAME.items() for part in parts.split()}
ZONE_ORDER = list(ZONE_OF_NAME)
CONTENT_ZONES = ("body", "article")

#: Prior counts of words (inside, outside) of a labelled article, by zone and link.
PRIOR_CONTENT, PRIOR_LINK, PRIOR_BOILERPLATE = (8, 1), (1, 2), (1, 8)
#: Largest absolute weights of a word and of a tag.
WEIGHT_LIMIT, TAG_LIMIT = 6.0, 3.0
#: Part of the cost that a tag inside a line has, as a link or bold words.
INLINE_COST = 0.1
#: Most that a stretch of boilerplate between two parts of one element takes off the sum.
INSERT_LIMIT = 24.0
#: Pages that a fit reads, about; more pages are sampled by a hash of their key.
FIT_PAGES = 5_000


def zone_of(name: str, attributes: str, inherited: str) -> str:
    """Zone of an element; what lies in boilerplate stays there."""
    if inherited not in CONTENT_ZONES:
        return inherited
    if HIDDEN.search(attributes):
        return "notice"
    own = ZONE_OF_ELEMENT.get(name)
    if own not in (None, "article"):
        return own
    parts = {
        part.lower() for _, value in HINTS.findall(attributes) for part in NAME_PART.findall(value)
    } if name not in ("html", "body", "main") else set()
    zones = {ZONE_BY_PART[part] for part in parts if part in ZONE_BY_PART}
    if "article" in zones and "header" in zones:  # the heading of an article
        zones.discard("header")
    if name == "article":  # an article may be a comment, but its class may name anything else
        zones &= {"comment"}
    named = next((zone for zone in ZONE_ORDER if zone in zones), None)
    return named or own or inherited


@dataclass(slots=True)
class Run:
    """Words between two tags, or a tag (without text)."""

    block: int
    zone: str = "body"
    link: bool = False
    inside: bool = False
    tag: str = ""
    text: str = ""
    words: int = 0
    nested: bool = False  # in boilerplate inside an article
    parent: Open | None = None  # of boilerplate: the content element around it
    seen: int = 0  # words of content before it

    @property
    def between(self) -> bool:
        """Boilerplate with content before and after it in the element around it."""
        return self.parent is not None and self.parent.started < self.seen < self.parent.ended

    @property
    def feature(self) -> str:
        return f"tag {self.tag}" if self.tag else f"word {self.zone} {'link' if self.link else 'plain'}"


@dataclass(slots=True)
class Open:
    name: str
    zone: str
    link: bool
    article: bool
    parent: Open | None = None  # of boilerplate: the content element around it
    started: int = 0  # words of content before it, and before its end
    ended: int = 0

    @property
    def nested(self) -> bool:
        return self.article and self.zone not in CONTENT_ZONES


@dataclass(slots=True)
class Page:
    runs: list[Run] = field(default_factory=list)
    articles: int = 0


def parse(source: str) -> Page:
    """The runs of words and tags of a page, in order, with their blocks and zones."""
    page, stack, counts = Page(), [Open("", "body", False, False)], Counter()
    block, at, size, seen = 0, 0, len(source), 0

    def close(depth: int) -> None:
        for element in stack[depth:]:
            counts[element.name] -= 1
            element.ended = seen
        del stack[depth:]

    def say(text: str) -> None:
        nonlocal seen
        if text:
            text = html.unescape(text)
            top, words = stack[-1], len(text.split())
            page.runs.append(
                Run(block, top.zone, top.link, top.article, "", text, words, top.nested, top.parent, seen)
            )
            if top.zone in CONTENT_ZONES:
                seen += words

    while at < size:
        found = MARKUP.search(source, at)
        if not found:
            say(source[at:])
            break
        say(source[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        ending = found[1] or found[4]
        attributes = found[3] or found[6] or ""
        if name in RAW:
            if not ending:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                at = end.end() if end else size
            continue
        top = stack[-1]
        tag = Run(block, inside=top.article, tag=name, nested=top.nested, parent=top.parent, seen=seen)
        page.runs.append(tag)
        if name == "br":
            page.runs.append(Run(block, stack[-1].zone, text=" "))
        if name not in INLINE:
            block += 1
        if ending:
            if counts[name] > 0:
                close(max(i for i, element in enumerate(stack) if element.name == name))
        elif name not in VOID and not attributes.endswith("/"):
            if name not in INLINE and counts["p"] > 0:
                depth = max(i for i, element in enumerate(stack) if element.name == "p")
                if all(element.name in INLINE for element in stack[depth + 1 :]):
                    close(depth)
            if name in SELF_CLOSING and stack[-1].name == name:
                close(len(stack) - 1)
            above = stack[-1]
            zone = zone_of(name, attributes, above.zone)
            article = above.article or (zone == "article" and above.zone == "body")
            page.articles += article and not above.article
            counts[name] += 1
            parent = None if zone in CONTENT_ZONES else above.parent or above
            stack.append(Open(name, zone, above.link or name == "a", article, parent, seen))
            tag.nested, tag.parent = stack[-1].nested, parent
    close(0)
    for run in page.runs:
        run.inside = run.inside and (bool(run.tag) or run.zone in CONTENT_ZONES)
    return page


def tally(page: Page) -> Iterator[tuple[str, bool, int]]:
    """Feature, whether inside the article, and count, of a page with exactly one article."""
    if page.articles == 1:
        counts: Counter = Counter()
        for run in page.runs:
            amount = 1 if run.tag else run.words
            if amount:
                counts[run.feature, run.inside] += amount
        for (feature, inside), amount in counts.items():
            yield feature, inside, amount


def weight(feature: str, inside: int, outside: int) -> float:
    """Log odds of words; of tags a cost that grows with their share outside articles."""
    if feature.startswith("tag "):
        share = INLINE_COST if feature[4:] in INLINE else 1.0
        return -min(TAG_LIMIT, share * math.log1p((outside + 1) / (inside + 1)))
    _, zone, kind = feature.split()
    prior = PRIOR_BOILERPLATE if zone not in CONTENT_ZONES else PRIOR_LINK if kind == "link" else PRIOR_CONTENT
    odds = math.log((inside + prior[0]) / (outside + prior[1]))
    return max(-WEIGHT_LIMIT, min(WEIGHT_LIMIT, odds))


class Weights(dict):
    """Weights by feature; a feature that no labelled page has gets its prior."""

    def __missing__(self, feature: str) -> float:
        self[feature] = weight(feature, 0, 0)
        return self[feature]


def best_region(scores: Sequence[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch of the largest positive sum; (0, 0) if none."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, region = total, (start, at + 1)
    return region


def run_scores(runs: Sequence[Run], weights: Weights) -> list[float]:
    """Scores of runs; what lies between parts of one element is scaled to INSERT_LIMIT."""
    scores = []
    for run in runs:
        score = 0.0 if run.nested else weights[run.feature] * (1 if run.tag else run.words)
        # Links of an article are part of it.
        scores.append(max(score, 0.0) if run.inside and run.link and not run.tag else score)
    for _, stretch in groupby(range(len(runs)), lambda i: runs[i].seen if runs[i].between else None):
        places = list(stretch)
        if runs[places[0]].between:
            cost = -sum(scores[i] for i in places)
            if cost > INSERT_LIMIT:
                for i in places:
                    scores[i] *= INSERT_LIMIT / cost
    return scores


def main_text(source: str | None, weights: Weights) -> str:
    """The text of the best region, an empty line between its blocks."""
    runs = parse(source or "").runs
    scores = run_scores(runs, weights)
    first, last = best_region(scores)
    texts: dict[int, list[str]] = {}
    plain: set[int] = set()  # blocks with words outside links, or in an article
    for run, score in zip(runs[first:last], scores[first:last]):
        if not run.tag and (run.zone in CONTENT_ZONES or score > 0):
            texts.setdefault(run.block, []).append(run.text)
            if run.words and (run.inside or not run.link):
                plain.add(run.block)
    blocks = [(block in plain, text) for block, parts in texts.items() if (text := " ".join("".join(parts).split()))]
    kept = [
        text
        for i, (own, text) in enumerate(blocks)
        if own or all(blocks[k][0] for k in (i - 1, i + 1) if 0 <= k < len(blocks))
    ]
    return "\n\n".join(kept)


def fit(pages: DataFrame, key: str = "page_id", source: str = "html", at_most: int = FIT_PAGES) -> Weights:
    """Weights from the labelled pages of a sample of about ``at_most`` pages; the driver
    gets one row a feature."""
    rows = pages.count()
    sampled = pages.where(F.pmod(F.xxhash64(key), F.lit(max(rows, 1))) < at_most)
    names = ["feature", "inside", "amount"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                for feature, inside, amount in tally(parse(page.as_py() or "")):
                    # Unknown elements are endless; only those of HTML are told apart.
                    known = not feature.startswith("tag ") or feature[4:] in KNOWN_TAGS
                    total[feature if known else "tag other", inside] += amount
        rows = [(feature, inside, amount) for (feature, inside), amount in total.items()]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64())],
            names,
        )

    counted = map_batches(
        sampled.select(F.col(source).cast("string").alias("__html")).where("__html is not null"),
        run, "feature string, inside boolean, amount bigint",
    )
    rows = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("inside"), F.col("amount")).otherwise(0)).alias("inside"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("amount"))).alias("outside"),
    ).collect()
    return Weights({row["feature"]: weight(*row) for row in rows})


KNOWN_TAGS = INLINE | VOID | set(ZONE_OF_ELEMENT) | {
    "html", "body", "div", "section", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
    "table", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "address",
    "details", "summary", "caption", "center", "hgroup", "picture",
}


def extract(pages: DataFrame, weights: Weights, keys: Sequence[str] = ("page_id", "url"), source: str = "html") -> DataFrame:
    """The keys and ``text``, the main text, of each page."""
    picked = pages.select(*keys, F.col(source).cast("string").alias("__html"))
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField("text", T.StringType())])
    known = dict(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Weights(known)
        for batch in batches:
            made = pa.array([main_text(page.as_py(), lookup) for page in batch.column(len(keys))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*keys, "text"])

    return map_batches(picked, run, schema)
