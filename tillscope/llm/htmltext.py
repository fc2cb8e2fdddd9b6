"""Main text of web pages by the maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score positive and tags negative; the run of
tokens with the largest sum is the content. The scores are log ratios of how often a kind of
token occurs inside and outside of the content in labelled pages; pages that mark their article
label themselves. What is never content, wherever it stands, is taken out first: scripts and
the like, and the parts of a page that their element or their class names as a menu, header,
footer, sidebar, notice, advert, form or reader comments; never what holds the whole article.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.llm.common import only

#: Element names of HTML, by what they mean here.
CONTENT = frozenset("article main".split())
DROPPED = frozenset("""aside button canvas datalist dialog embed fieldset footer form head header iframe input
 map menu nav noscript object option script search select style svg template textarea title""".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark
 q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
#: Elements that hold text or lay it out. All others are one kind, so kinds are bounded.
BLOCKS = frozenset("""html body div section p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption colgroup thead
 tbody tfoot tr td th blockquote pre figure figcaption picture audio video address details summary center""".split())
KNOWN = CONTENT | DROPPED | VOID | INLINE | BLOCKS
OTHER = "other"
#: Elements that are a block of text each: a compound name such as "article-header" only dresses them.
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li td".split())
#: Beginnings of names that say what a layout has or lacks, and not what the element is.
HAVING = frozenset("has have no not with without is hide show".split())
#: Words of a class, id or role that name such parts.
PART_NAMES = frozenset("""ad ads advert adverts advertisement advertisements adsense sponsored sponsor promo promotion
 banner menu nav navbar navigation breadcrumb breadcrumbs header footer sidebar aside cookie cookies consent gdpr
 notice notices alert popup modal overlay comment comments reply replies respond disqus share sharing social related
 subscribe newsletter widget toolbar pagination pager skip complementary contentinfo search form login signup""".split())
#: Scores without labelled pages, largest number of labelled pages, and the least sizes of scores.
WORD, TAG, LINK = 1.0, -0.2, -3.0
LABELLED = 2000
LEAST_WORD, LEAST_TAG = 0.1, -0.01

TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:/?>|\Z)"
    r"|[^<]+|<",
    re.S,
)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, text): kinds are open, close and text; contents of raw elements are left out."""
    out, at = [], 0
    while found := TOKENS.match(page, at):
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            if not found.group().startswith(("<!", "<?")):
                out.append(("text", "", found.group()))
            continue
        out.append(("close" if found["close"] else "open", name, found["rest"] or ""))
        if name in RAW and not found["close"]:
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    return out


def ends(stream: list[tuple[str, str, str]]) -> dict[int, int]:
    """For each opening tag that is closed: the place of its closing tag."""
    waiting: dict[str, list[int]] = {}
    found = {}
    for i, (kind, name, _) in enumerate(stream):
        if kind == "open" and name not in VOID:
            waiting.setdefault(name, []).append(i)
        elif kind == "close" and waiting.get(name):
            found[waiting[name].pop()] = i
    return found


def named(name: str, rest: str) -> str:
    """What class, id and role say of an element: "part" if one of them, as a whole or in all its
    words, names a menu and the like, "maybe" if its first or last word does, else "".

    "has-sidebar" says what a layout has, and a paragraph is no part for a compound name.
    """
    said = ""
    for found in NAMES.finditer(rest):
        for one in (found[1] or found[2] or found[3] or "").lower().split():
            words = [w for w in re.split(r"[^a-z]+", one) if w]
            if words and all(w in PART_NAMES for w in words):
                return "part"
            if words and words[0] not in HAVING and name not in TEXTS and {words[0], words[-1]} & PART_NAMES:
                said = "maybe"
    return said


def without_parts(stream: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """The stream without menus and the like. One that is never closed ends with its opening tag,
    but for raw elements, whose contents are not in the stream.

    What holds all articles of a page is no part of it but its frame, whatever its name; where a
    name is not clear, neither is what holds more than half of the words.
    """
    closing = ends(stream)
    says = [named(name, rest) if kind == "open" and rest and name not in ("html", "body") else "" for kind, name, rest in stream]
    articles = [i for i, (kind, name, _) in enumerate(stream) if kind == "open" and name in CONTENT and says[i] != "part"]
    before: list[int] = []

    def frame(i: int) -> bool:
        return bool(articles) and i <= articles[0] and articles[-1] < closing.get(i, i)

    def most(i: int) -> bool:
        if not before:
            sizes = (len(text_words(text)) if kind == "text" else 0 for kind, _, text in stream)
            before.extend(accumulate(sizes, initial=0))
        return 2 * (before[closing.get(i, i)] - before[i]) > before[-1]

    def is_part(i: int, name: str) -> bool:
        if name in RAW:
            return True
        if name in DROPPED or says[i] == "part":
            return not frame(i)
        return says[i] == "maybe" and name not in CONTENT and not frame(i) and not most(i)

    out, i = [], 0
    while i < len(stream):
        kind, name, rest = stream[i]
        if kind == "open" and name not in VOID and is_part(i, name):
            i = closing.get(i, i)
        elif kind == "text" or name not in DROPPED:
            out.append(stream[i])
        i += 1
    return out


def text_words(text: str) -> list[str]:
    return html.unescape(text).split()


def counted(page: str) -> Counter:
    """Tokens by (kind, inside): kinds are tag names and "" for a word; of pages that mark content."""
    stream = tokens(page)
    closing = ends(stream)
    start = next((i for i, t in enumerate(stream) if t[0] == "open" and t[1] in CONTENT), None)
    counts: Counter = Counter()
    if start is None:
        return counts
    end = closing.get(start, len(stream))
    for i, (kind, name, text) in enumerate(stream):
        inside = start < i < end
        if kind == "text":
            counts["", inside] += len(text_words(text))
        elif i not in (start, end):
            counts[name if name in KNOWN else OTHER, inside] += 1
    return counts


def scores(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log ratios of the shares inside and outside, words at least LEAST_WORD, tags at most LEAST_TAG."""
    total = {side: sum(n for (_, s), n in counts.items() if s is side) for side in (True, False)}
    if not total[True]:
        return {}
    found = {}
    for kind in {k for k, _ in counts}:
        share = [(counts.get((kind, s), 0) + 1) / (total[s] + 2) for s in (True, False)]
        ratio = math.log(share[0] / share[1])
        found[kind] = min(ratio, LEAST_TAG) if kind else max(ratio, LEAST_WORD)
    return found


def learned(pages: DataFrame, html_col="html") -> dict[str, float]:
    """Scores from at most about LABELLED pages, taken by a hash of the whole page.

    Only sums by element name come to the driver.
    """
    rows = pages.select(F.col(f"`{html_col}`").alias("html")).filter("html IS NOT NULL")
    n = rows.count()
    share = min(1.0, LABELLED / n) if n else 1.0
    drawn = rows.filter(F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                counts.update(counted(page))
        kinds, sides, numbers = [k for k, _ in counts], [s for _, s in counts], list(counts.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(sides, pa.bool_()), pa.array(numbers, pa.int64())],
            names=["kind", "inside", "n"],
        )

    sums = drawn.mapInArrow(run, "kind STRING, inside BOOLEAN, n BIGINT").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    # Bounded: the elements of KNOWN, OTHER and words, inside and outside.
    return scores({(r["kind"], r["inside"]): r["n"] for r in sums.collect()})


def main_text(page: str, weight: dict[str, float]) -> str:
    """The words of the best run, one line for each block."""
    stream = without_parts(tokens(page))
    word = weight.get("", WORD)
    total = best = 0.0
    start = first = last = 0
    words: list[list[str]] = []
    for i, (kind, name, text) in enumerate(stream):
        words.append(text_words(text) if kind == "text" else [])
        if kind == "text":
            total += word * len(words[-1])
        elif name not in CONTENT:
            total += weight.get(name if name in KNOWN else OTHER, LINK if not weight and name in ("a", "li") else TAG)
        if total > best:
            best, first, last = total, start, i + 1
        if total <= 0:
            total, start = 0.0, i + 1
    blocks: list[str] = []
    line: list[str] = []
    for kind, name, text in stream[first:last]:
        if kind == "text":
            line.append(html.unescape(text))
        elif name in INLINE:
            if name == "br":
                line.append(" ")
        else:
            blocks.append(" ".join("".join(line).split()))
            line = []
    blocks.append(" ".join("".join(line).split()))
    return "\n".join(b for b in blocks if b)


def extracted(pages: DataFrame, id_col="page_id", url_col="url", html_col="html", weight: dict | None = None) -> DataFrame:
    """(page_id, url, text) of every row.

    NULL, empty and wordless pages have the empty text. Repeated rows are repeated, an empty
    table gives an empty result. `weight` holds scores by element name ("" for a word); without
    it they are learned from the pages themselves.
    """
    weight = learned(pages, html_col) if weight is None else weight
    rows = only(pages, page_id=id_col, url=url_col, html=html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", weight) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kind = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, kind)
