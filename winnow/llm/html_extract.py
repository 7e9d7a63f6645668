"""Main text of web pages: page structure, and a suffix array of each host's page furniture."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Words of the prefixes that the suffix array is sorted by: a run of this many words that
#: stands on two pages of a host is a repeated substring.
RUN = 5
#: Share of a block's words that repeated runs must cover for the block to go.
COVERED = 0.8

# Element names of HTML.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
DROPPED = {"head", "noscript", "template", "svg", "math", "canvas", "object", "audio", "video", "select", "button", "datalist", "nav", "footer", "aside",
           "form", "dialog", "menu", "header"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
          "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
          "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: A class, id or role made of these words alone names page furniture, a notice, an advert or reader comments.
FURNITURE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs",
             "comment", "comments", "commentlist", "complementary", "contentinfo", "cookie", "cookies", "consent", "disqus",
             "footer", "form", "gdpr", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
             "notices", "pagination", "popup", "promo", "promoted", "related", "replies", "respond", "search", "share",
             "sharing", "sidebar", "signup", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
#: Words that may stand beside them in such a name.
_BESIDE = {"area", "bar", "block", "box", "container", "content", "inner", "item", "link", "links", "list", "message", "outer", "panel", "section", "site",
           "slot", "top", "bottom", "left", "right", "unit", "wrap", "wrapper", "global", "page", "primary", "secondary"}
#: Elements whose names are anchors of the text: id for a section; class and id for headings and paragraphs.
_ANCHORS = {"section": ("class", "role"), **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "p", "a", "li", "dt", "dd"), ("role",))}
#: An opening tag that ends an open paragraph, as browsers do.
_CLOSES_P = BLOCKS - {"body", "html", "head"}

#: Roles of a block: inside an article or main element, named as furniture by the markup, neither.
MAIN_TEXT, MARKED, OPEN = "main", "marked", "open"
#: What makes an article element a comment, an advert or a teaser.
_NOT_THE_ARTICLE = {"ad", "ads", "advert", "advertisement", "comment", "comments", "promo", "related", "sponsored"}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PART = re.compile(r"[a-z0-9]+")


def _names_furniture(name: str, words: set[str]) -> bool:
    parts = set(_PART.findall(name))
    return not words.isdisjoint(parts) and parts <= words | _BESIDE


def _hides_or_names(attributes: str, words: set[str] = FURNITURE, which: tuple[str, ...] = ("class", "id", "role")) -> tuple[bool, bool]:
    """Does the element hide its text; does a whole name among its classes, id and role name furniture?"""
    named = False
    for name, *values in _NAMES.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True, named
        named = named or name in which and any(_names_furniture(x, words) for x in value.split())
    return False, named


def blocks(page: str | None, names: bool = True) -> list[tuple[str, str]]:
    """(text, role) of each non-empty block of a page, in page order, without markup, scripts
    and styles.  Roles: ``MARKED`` if the page itself names it as menu, header, footer, sidebar,
    form, notice, advert or comments; ``MAIN_TEXT`` inside an article or main element; else ``OPEN``.
    Character references are decoded, white space is one space, trimmed.  A missing end tag
    is closed with its parent; a page cut off in a tag ends there.

    A name marks an element only if it is a whole name of furniture ("sidebar", not "has-sidebar"), and not
    what holds a main element or the page's only article.  Without ``names`` only elements and hidden text are marked.
    """
    out: list[tuple[str, str]] = []
    # name, marked, in main, muted: in marked inline text, which leaves the block around it whole
    open_tags: list[tuple[str, bool, bool, bool]] = []
    parts: list[str] = []
    marked = in_main = muted = False
    text, at = page or "", 0
    unnamed = {"main"} | ({"article"} if len(re.findall(r"<article[\s>]", text, re.I)) == 1 else set())
    by_name = -1  # depth of the element whose name marks what is in it

    def end_block() -> None:
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                out.append((joined, MARKED if marked else MAIN_TEXT if in_main else OPEN))
            parts.clear()

    def close(deep: int) -> None:
        nonlocal marked, in_main, muted
        del open_tags[deep:]
        marked, in_main, muted = open_tags[-1][1:] if open_tags else (False, False, False)

    def innermost(name: str) -> int:
        return next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name), -1)

    while at < len(text):
        m = _MARKUP.search(text, at)
        end = m.start() if m else len(text)
        if end > at and not muted:
            parts.append(html.unescape(text[at:end]))
        if m is None:
            break
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            deep = innermost(name)
            if name in BLOCKS or deep >= 0 and open_tags[deep][1] != (open_tags[deep - 1][1] if deep else False) and not open_tags[deep][3]:
                end_block()
            if deep >= 0:
                close(deep)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW:
            raw_end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(text, at)
            at = raw_end.end() if raw_end else len(text)
            continue
        if name in _CLOSES_P:
            end_block()
            deep = innermost("p")
            # an open paragraph ends here, unless something that holds blocks was opened in it
            if deep >= 0 and not any(t[0] in _CLOSES_P for t in open_tags[deep + 1:]):
                close(deep)
        if name in VOID or m[0].endswith("/>"):
            continue
        by_name = by_name if by_name < len(open_tags) else -1
        hidden, named = _hides_or_names(m[3], _NOT_THE_ARTICLE if name == "article" else FURNITURE, _ANCHORS.get(name, ("class", "id", "role")))
        named = named and names and name not in ("html", "body", "main")
        if name == "article":
            furniture = hidden or named
        elif name == "header" and in_main:  # the article's own
            furniture = named = False
        else:
            furniture = name in DROPPED or hidden and name not in ("html", "body", "main") or named
        if name in unnamed and by_name >= 0 and not furniture:
            end_block()
            marked, by_name = False, -1
        if named and not marked and not hidden and name not in DROPPED:
            by_name = len(open_tags)
        if furniture and not marked:
            if name in BLOCKS:
                end_block()
            muted = name not in BLOCKS
        elif furniture and not named:
            by_name = -1  # the element itself is furniture, whatever it is in
        marked, in_main = marked or furniture, in_main or name in MAIN
        open_tags.append((name, marked, in_main, muted))
    end_block()
    return out


def judged(page: str | None) -> list[tuple[str, str]]:
    """The blocks of a page; if names mark all its text, they do not tell furniture, and are not heeded."""
    found = blocks(page)
    return found if any(role != MARKED for _, role in found) else blocks(page, names=False)


def _suffixes(run: int):
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The starts in the page's stream of words with the hash of their next ``run`` words;
        a block shorter than that is one start."""
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            rows = []
            for host, key, page in zip(batch["host"].tolist(), batch["key"].tolist(), batch["html"].tolist()):
                for b, (text, role) in enumerate(judged(page)):
                    if role == MAIN_TEXT:
                        continue
                    words = text.split(" ")
                    for i in range(max(1, len(words) - run + 1)):
                        digest = xxh3_64_intdigest(" ".join(words[i:i + run]).encode("utf-8", "replace"))
                        rows.append((host, key, b, i, len(words), digest - (1 << 63), role == OPEN))
            out = pd.DataFrame(rows, columns=["host", "key", "block", "start", "words", "prefix", "open"])
            yield out.astype({"key": "int64", "block": "int32", "start": "int32", "words": "int32", "prefix": "int64", "open": bool})

    return emit


def boilerplate_blocks(pages: DataFrame, run: int = RUN, covered: float = COVERED) -> DataFrame:
    """(key, gone): numbers of the open blocks of each page (``key``: hash of its html) that
    runs repeated on other pages of the host cover.

    All text outside the main elements, furniture included, is one stream of words per page.
    The suffix array of a host's streams is cut at prefixes of ``run`` words: suffixes that
    share one stand together in it, so a group by (host, prefix) finds the neighbours, and a
    prefix that belongs to two different pages begins a substring that both hold.  Longer
    substrings are chains of such starts; a block's covered words are the union of its
    repeated starts' runs.  Groups keep two numbers each, so that a footer on a third of all
    pages is counted before it is shuffled.  Pages with equal html are one page.
    """
    starts = written(pages.select("host", "key", "html").mapInPandas(
        _suffixes(run), "host string, key long, block int, start int, words int, prefix long, open boolean"), "page-starts")
    groups = starts.groupBy("host", "prefix").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.max("open").alias("asked"))
    repeated = written(groups.filter("low <> high AND asked").select("host", "prefix"), "page-repeats")
    hits = starts.filter("open").join(repeated, ["host", "prefix"], "left_semi")
    # per block of one page; a start covers its run, or what is left to the next repeated start
    by_block = hits.groupBy("key", "block", "words").agg(F.array_sort(F.collect_set("start")).alias("at"))
    spans = F.transform("at", lambda x, i: F.least(F.coalesce(F.get("at", i + 1), F.col("words")) - x, F.lit(run)))
    n_covered = F.aggregate(spans, F.lit(0), lambda s, x: s + x)
    gone = by_block.filter(n_covered >= F.lit(covered) * F.col("words"))
    return written(gone.groupBy("key").agg(F.array_sort(F.collect_set("block")).alias("gone")), "page-boilerplate")


def extract_main_text(pages: DataFrame, page_html: str = "html", url: str = "url", **options) -> DataFrame:
    """``pages`` with ``__text``: the blocks of main text in page order, joined by line ends.

    Blocks inside an article or main element stay, repeated or not (articles quote each
    other); what the markup names as furniture goes; every other block goes if substrings
    repeated on other pages of its host cover it and stays if it is unique.  Where that
    would take all of a page's text, the page is a copy of another, and its open blocks stay.
    A null or empty html gives an empty text.  Pages without a host share one.
    """
    hosted = pages.withColumn("__host", F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))
    hosted = hosted.withColumn("__key", F.xxhash64("__host", F.coalesce(F.col(f"`{page_html}`"), F.lit(""))))
    gone = boilerplate_blocks(hosted.select(F.col("__host").alias("host"), F.col("__key").alias("key"), F.col(f"`{page_html}`").alias("html")), **options)
    gone = gone.withColumnRenamed("key", "__gone_key").withColumnRenamed("gone", "__gone")

    @F.pandas_udf("string")
    def main_text(html_texts: pd.Series, drop: pd.Series) -> pd.Series:
        out = []
        for page, numbers in zip(html_texts, drop):
            found = [(i, t) for i, (t, role) in enumerate(judged(page)) if role != MARKED]
            dropped = frozenset(numbers) if numbers is not None else frozenset()
            out.append("\n".join([t for i, t in found if i not in dropped] or [t for _, t in found]))
        return pd.Series(out)

    joined = hosted.join(gone, F.col("__key") == F.col("__gone_key"), "left")
    names = [F.col(f"`{c}`") for c in pages.columns]
    return joined.select(*names, main_text(F.col(f"`{page_html}`"), F.col("__gone")).alias("__text"))
