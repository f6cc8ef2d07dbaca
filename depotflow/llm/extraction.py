"""Main text of web pages: markup decides where it can, and a suffix array per host decides the rest.

A page that declares its article is taken at its word: the article's blocks without menus, notices, forms and the like.
Of a page that does not, everything outside boilerplate elements is a candidate, and the words of all pages of its host
say which of it is boilerplate: the pages' token streams are laid end to end, and every substring of ``RUN`` words or
more that occurs on at least two and on one in ``SHARE`` of the host's distinct pages is removed. Equal pages under
several ids or URLs are one page, and so are several versions of one page. A passage or phrase that fewer pages share,
however long, is prose.

A substring of at least ``RUN`` words is repeated exactly where each of its windows of ``RUN`` words is, so it is enough
to know the suffixes by their first ``RUN`` words: equal neighbours in the sorted suffix array are groups of equal
windows, and sorting becomes grouping, with one row per window and task before the shuffle. No host is one task's.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from depotflow.llm.words import Slice, sequences, slices
from depotflow.session import frozen

RUN = 6
#: Boilerplate is on one in so many of the distinct pages of a host that have a run.
SHARE = 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<",
    re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

RAW = {"script", "style", "title", "textarea", "xmp"}
INVISIBLE = {"head", "noscript", "template", "iframe", "object", "svg", "canvas", "math", "audio", "video", "map"}
BOILERPLATE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "label"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "img"}
SPACED = {"br", "td", "th"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
         "menu", "menubar", "toolbar"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored",
         "promo", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead",
         "cookie", "cookies", "consent", "gdpr", "notice", "notification", "newsletter", "subscribe", "signup", "comment",
         "comments", "reply", "replies", "disqus", "share", "sharing", "social", "related", "popup", "modal",
         "pagination", "pager", "toolbar", "login"}
BODY = re.compile(r"\b(?:article|post|entry|story|main)[-_]?(?:body|content|text)\b")

#: Boilerplate in which an article is a reader's, never the page's own.
COMMENTS = {"comment", "comments", "reply", "replies", "disqus"}

ARTICLE, MAIN, OPEN, CHROME = "article", "main", "open", "chrome"
#: Boilerplate by its name or as a form only: it may be the wrapper of the whole page, so main regions open inside it.
NAMED, FORM = "named", "form"
#: An article named like boilerplate, or inside something that is: the page's own or a teaser.
WRAPPED = "wrapped"


@dataclass
class Page:
    """Blocks of a page in order, each with the region it lies in."""

    blocks: list[tuple[str, str]] = field(default_factory=list)

    @property
    def declared(self) -> str | None:
        kinds = {kind for kind, _ in self.blocks}
        return ARTICLE if ARTICLE in kinds else MAIN if MAIN in kinds else None

    def of(self, kind: str) -> list[str]:
        return [text for own, text in self.blocks if own == kind]


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): html.unescape(value.strip("\"'")).lower() for name, value in _ATTRIBUTE.findall(text)}


def _region(tag: str, attributes: dict[str, str], kind: str) -> str | None:
    """What an element opens, if anything: text that is never shown, boilerplate, or a main region."""
    if tag in INVISIBLE or "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return ""
    role, named = attributes.get("role", ""), f"{attributes.get('class', '')} {attributes.get('id', '')}"
    form = tag == "form" or role == "form"
    header = tag == "header" and kind not in (ARTICLE, MAIN, WRAPPED)
    if header or not form and tag in BOILERPLATE or role in ROLES and role != "form":
        return CHROME
    names = NAMES & set(re.split(r"[^a-z0-9]+", named)) if tag not in ("html", "body") else set()
    if tag == "main" or role == "main":
        return MAIN
    if names & COMMENTS:
        return CHROME
    if "articlebody" in attributes.get("itemprop", ""):
        return ARTICLE
    if tag == "article" or BODY.search(named) and not form:
        return WRAPPED if names or kind == NAMED else ARTICLE if tag == "article" else MAIN
    return NAMED if names else FORM if form else None


def _opened(tag: str, attributes: dict[str, str], regions: list[list]) -> str | None:
    """The region that an element opens inside others, or none where it changes nothing."""
    kind = regions[-1][0] if regions else OPEN
    holder = next((own for own, *_ in reversed(regions) if own in (ARTICLE, MAIN, WRAPPED)), None)
    opened = _region(tag, attributes, kind)
    if holder in (ARTICLE, WRAPPED) and opened == MAIN:
        return None
    if holder == WRAPPED and opened == ARTICLE:
        return WRAPPED if kind != WRAPPED else None
    if kind in (NAMED, FORM) and (opened == FORM or opened == kind):
        return None
    return opened


def _settled(blocks: list[tuple[str, str, int, int]]) -> list[tuple[str, str]]:
    """Blocks (kind, text, depth and number of the wrapped article) with every wrapped article judged.

    The longest of a depth decides. If it has more words than all that the page declares otherwise, those articles are the
    page's own, else teasers. On a page that declares nothing else they are its own if the longest has half as many
    words as the text outside boilerplate; if not, markup leaves them open.
    """
    found = [kind for kind, *_ in blocks]
    for depth in sorted({depth for kind, _, depth, _ in blocks if kind == WRAPPED}):
        places = [n for n, block in enumerate(blocks) if block[0] == WRAPPED and block[2] == depth]
        sizes: dict[int, int] = {}
        for n in places:
            sizes[blocks[n][3]] = sizes.get(blocks[n][3], 0) + len(blocks[n][1].split())
        longest = max(sizes.values())
        held = {kinds: sum(len(block[1].split()) for block, kind in zip(blocks, found, strict=True) if kind in kinds)
                for kinds in ((ARTICLE, MAIN), (OPEN,))}
        if held[ARTICLE, MAIN]:
            verdict = ARTICLE if longest > held[ARTICLE, MAIN] else CHROME
        else:
            verdict = ARTICLE if 2 * longest >= held[OPEN,] else OPEN
        for n in places:
            found[n] = verdict
    return [(kind, block[1]) for kind, block in zip(found, blocks, strict=True)]


def parse(source: str) -> Page:
    """Blocks of a page. Markup that is never closed is closed by the end of the page or of what holds it."""
    blocks, words = [], []
    # Open regions: kind, the tag that opened it, how many elements of that tag are open inside it, and for wrapped
    # articles the depth and a number.
    regions: list[list] = []
    kind, wrapped = OPEN, 0

    def close() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text and kind != "":
            blocks.append((CHROME if kind in (NAMED, FORM) else kind, text, *(regions[-1][3:] if regions else (0, 0))))

    at = 0
    while match := _TOKEN.match(source, at):
        at = match.end()
        end, tag, rest = match.groups()
        if tag is None:
            token = match[0]
            if token[0] != "<" or token == "<":
                words.append(html.unescape(token))
            continue
        tag = tag.lower()
        if tag in RAW and not end:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = stop.end() if stop else len(source)
            continue
        if tag not in INLINE:
            if tag in SPACED:
                words.append(" ")
            else:
                close()
        if end:
            for place in range(len(regions) - 1, -1, -1):
                if regions[place][1] == tag:
                    regions[place][2] -= 1
                    if regions[place][2] == 0:
                        close()
                        del regions[place:]
                        kind = regions[-1][0] if regions else OPEN
                    break
            continue
        if tag in VOID or rest.endswith("/"):
            continue
        opened = None
        if kind not in (CHROME, ""):
            opened = _opened(tag, _attributes(rest) if rest.strip() else {}, regions)
        if opened is None:
            for region in reversed(regions):
                if region[1] == tag:
                    region[2] += 1
                    break
            continue
        close()
        depth, number = next((own[3:] for own in reversed(regions) if own[0] == WRAPPED), (0, 0))
        # The body of a wrapped article is part of it.
        if opened == WRAPPED and not (depth and "articlebody" in rest.lower()):
            wrapped += 1
            depth, number = depth + 1, wrapped
        regions.append([opened, tag, 1, depth, number])
        kind = opened
    close()
    return Page(_settled(blocks))


def host_of(url: str = "url") -> Column:
    """Host of a URL in lower case; what has none shares the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[^:/?#]*:?//([^/?#]*)", 1), F.lit("")))


#: What joins starts back to their rows: rows that agree in id and URL, null ones among them, may differ in html.
VERSION = ["page", "one", "two"]


def _page_key() -> Column:
    """Tells distinct pages apart."""
    return F.xxhash64("page_id", "url")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of the pages that declare a main region."""
    for batch in batches:
        for part in slices(batch.column(2)):
            rows, texts = [], []
            for row in range(part.rows):
                page = parse(part.text(row).decode())
                if (kind := page.declared) or not page.of(OPEN):
                    rows.append(part.first + row)
                    texts.append("\n".join(page.of(kind)) if kind else "")
            held = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*held.columns, pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _outside(page: Page) -> list[str]:
    """Blocks that no main region holds."""
    return [text for kind, text in page.blocks if kind in (OPEN, CHROME)]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of ``RUN`` words of every page's text outside its main region, and a null for every page that has one.

    ``body`` is a hash of that text, the same for equal pages.
    """
    for batch in batches:
        for part in slices(batch.column(2)):
            texts = [" ".join(_outside(parse(part.text(row).decode()))) for row in range(part.rows)]
            for own in slices(pa.array(texts, pa.large_string())):
                inside, owners = _windows(own)
                bodies = np.array([_body(own.text(row)) for row in range(own.rows)], dtype=np.int64)
                pages = np.unique(owners)
                owners = np.concatenate([owners, pages])
                runs = pa.concat_arrays([pa.array(inside.view(np.int64)), pa.nulls(len(pages), pa.int64())])
                held = batch.select([0, 1]).take(pa.array(part.first + own.first + owners))
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(bodies[owners]), runs], ["host", "page", "body", "run"])


def _body(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _windows(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    n = max(0, len(part.starts) - RUN + 1)
    whole = np.arange(n) + RUN <= np.repeat(part.words[1:], part.counts)[:n]
    return sequences(part.hashes(), RUN)[whole], part.owners[:n][whole]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages without a main region: which blocks are candidates, all blocks, and the run that starts at each word."""
    for batch in batches:
        for part in slices(batch.column(6)):
            rows, blocks, free, runs = [], [], [], []
            for row in range(part.rows):
                page = parse(part.text(row).decode())
                if page.declared or not page.of(OPEN):
                    continue
                outside = [(kind, text) for kind, text in page.blocks if kind in (OPEN, CHROME)]
                joined = " ".join(text for _, text in outside)
                hashes = [own.hashes() for own in slices(pa.array([joined], pa.large_string()))][0]
                rows.append(part.first + row)
                blocks.append([text for _, text in outside])
                free.append([kind == OPEN for kind, _ in outside])
                runs.append(sequences(hashes, RUN).view(np.int64))
            held = batch.select([0, 1, 2, 3, 4, 5]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array(blocks, pa.list_(pa.string())), pa.array(free, pa.list_(pa.bool_())),
                 pa.array(runs, pa.list_(pa.int64()))], ["page_id", "url", "host", *VERSION, "blocks", "free", "runs"])


def uncovered(blocks: list[str], free: list[bool], starts: list[int]) -> str:
    """The free blocks without the words that a repeated run covers; ``starts`` are those runs' first words."""
    total = sum(len(block.split()) for block in blocks)
    covered = np.zeros(total + RUN, dtype=bool)
    for start in starts:
        covered[start:start + RUN] = True
    lines, at = [], 0
    for block, own in zip(blocks, free, strict=True):
        words = block.split()
        left = [word for n, word in enumerate(words, start=at) if not covered[n]]
        at += len(words)
        if own and left:
            lines.append(" ".join(left))
    return "\n".join(lines)


def _remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [uncovered(*row) for row in zip(
            *(batch.column(name).to_pylist() for name in ("blocks", "free", "starts")), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """Page id, URL and main text of every row of ``pages`` (page_id, url, html); ``n_chars`` counts code points.

    A page without text, null html among them, gives an empty text. A null URL belongs to the empty host. Rows that agree
    in id and URL are one page and no evidence against each other, and neither are pages with equal words. Extra columns are left aside, an empty table stays
    empty. Words for the suffix array are separated by white space.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    declared = rows.mapInArrow(_texts, f"page_id {kind}, url string, text string")
    hosted = rows.withColumn("host", host_of()).withColumn("page", _page_key()).withColumn(
        "one", F.xxhash64("html")).withColumn("two", F.xxhash64(F.lit(1), "html"))
    runs = hosted.select("host", "page", "html").mapInArrow(_runs, "host string, page long, body long, run long")
    counted = frozen(runs.groupBy("host", "run").agg(
        F.least(F.count_distinct("page"), F.count_distinct("body")).alias("n")).where("n > 1"))
    sizes = frozen(counted.where("run IS NULL").select("host", F.col("n").alias("total")))
    # Written, so that the join has exchanges of its own, and a run that all pages of a host share can be split.
    repeated = frozen(counted.where("run IS NOT NULL").join(sizes, "host").where(F.col("n") * SHARE >= F.col("total")).select(
        "host", "run"))
    candidates = hosted.select("page_id", "url", "host", *VERSION, "html").mapInArrow(
        _candidates, f"page_id {kind}, url string, host string, page long, one long, two long, blocks array<string>, "
        "free array<boolean>, runs array<long>")
    places = candidates.select("host", *VERSION, F.posexplode("runs").alias("start", "run"))
    starts = places.join(repeated, ["host", "run"], "left_semi").groupBy(*VERSION).agg(
        F.collect_set("start").alias("starts"))
    remaining = candidates.drop("runs").join(starts, VERSION, "left").select(
        "page_id", "url", "blocks", "free", F.coalesce("starts", F.array().cast("array<int>")).alias("starts"))
    texts = declared.unionByName(remaining.mapInArrow(_remaining, f"page_id {kind}, url string, text string"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


#: For pages whose markup is that of the stored ones: one article of headings and paragraphs, with ``b`` and ``br``.
SQL = r"""
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body FROM pages),
blocks AS (
    SELECT page_id, url, list_transform(
        string_split_regex(replace(replace(replace(body, '<br>', ' '), '<b>', ''), '</b>', ''), '</?(?:p|h1)>'),
        lambda x: trim(regexp_replace(replace(replace(replace(replace(
            x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) AS lines FROM articles)
SELECT page_id, url, array_to_string(list_filter(lines, lambda x: x <> ''), chr(10)) AS text,
       length(array_to_string(list_filter(lines, lambda x: x <> ''), chr(10)))::BIGINT AS n_chars
FROM blocks
"""
