"""Main text of web pages by two-pass block rules (the classification of jusText, Pomikálek 2011).

A page is cut into blocks at block-level tags.  Per-row Python only parses: a small ``HTMLParser`` gives each block its
text (character references decoded, white space made one space, trimmed), its length, the characters inside links,
whether it is a heading, and whether it lies inside an element that is not the article by its tag or by its class, id
or role (menus, headers, footers, sidebars, notices, adverts, forms, comments).  Scripts, styles, the head and markup
never reach a block.  The corpus statistics are Spark aggregates; the passes run per page (see :func:`main_text`):

* Words are runs of letters in lower case; stop words are the most frequent words of each page language over
  the blocks that are kept (those outside every non-article element) of all pages that together make ``STOP_SHARE`` of its words (see :func:`stop_words`).
* Pass one decides each block by itself: link density over ``MAX_LINK_DENSITY`` is bad; shorter than ``LENGTH_LOW`` is
  short (bad if it has a link); otherwise stop-word density of ``STOP_HIGH`` or more is good when longer than
  ``LENGTH_HIGH`` and near-good when not, of ``STOP_LOW`` or more near-good, else bad.  Inside an ``article`` or
  ``main`` element (or role main) the stop-word rules lean one step to the article: near-good becomes good and bad
  (by stop words alone) near-good.  A short or near-good heading
  followed by a good block within ``HEADING_DISTANCE`` characters becomes near-good.
* Pass two decides the others from the nearest decided (good or bad) blocks before and after it: near-good is bad only if both are bad; short takes the label that both give, or the one
  that there is, or, where they differ, that of the nearer (the one before on a tie); without either, it is good
  inside an article and bad elsewhere.
* Good blocks are joined in page order by one newline.

Blocks inside a non-article element are not taken and are no one's neighbours.

Defined results: a null or empty html, or one without good blocks, gives the empty text and 0; a null page_id or url
is kept as it is; repeated rows each get their own row; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeledger.llm.common import stored

STOP_SHARE = 0.5
SALT = 16
MAX_LINK_DENSITY = 0.2
LENGTH_LOW = 70
LENGTH_HIGH = 200
STOP_LOW = 0.30
STOP_HIGH = 0.32
HEADING_DISTANCE = 200

# What is not the article.
SKIPPED = {"script", "style", "noscript", "template", "head", "svg", "iframe", "object", "canvas", "select", "textarea", "button"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
OUTSIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adverti[sz]ement|banner|comments?|sidebar|menu|nav|navigation|footer|header|cookies?"
    r"|notice|share|social|related|promo|newsletter|subscribe|breadcrumbs?|popup|modal|sponsor\w*)(?:$|[\s_-])",
    re.I,
)
BLOCKS = {
    "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "tr", "td", "th",
    "blockquote", "pre", "section", "article", "main", "body", "figure", "figcaption", "address", "hr", "caption",
}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
WHITE = re.compile(r"\s+")  # Unicode white space, no-break space included
WORD = "\\p{L}+"
LETTERS = regex.compile(r"\p{L}+")
MAX_STOP_WORDS = 200_000  # stop words sent to every task at most, about 10 MB

BLOCK = "idx int, text string, n_chars int, link_chars int, heading boolean, outside boolean, main boolean"
FIELDS = [f.split()[0] for f in BLOCK.split(", ")]
PARSED = f"rid long, page_id long, url string, lang string, blocks array<struct<{BLOCK.replace(' ', ':').replace(',:', ', ')}>>"


class _Blocks(HTMLParser):
    """Blocks of one page in order; a stack of open elements tells where text lies."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool, bool]] = []  # tag, outside, skipped, main
        self.blocks: list[tuple] = []
        self.parts: list[str] = []
        self.link_parts: list[str] = []
        self.heading = False
        self.lang = ""

    def _state(self) -> tuple[bool, bool, bool, bool]:
        return (
            any(e[1] for e in self.stack),
            any(e[2] for e in self.stack),
            any(e[0] == "a" for e in self.stack),
            any(e[3] for e in self.stack),
        )

    def _cut(self) -> None:
        text = WHITE.sub(" ", "".join(self.parts)).strip()
        if text:
            links = len(WHITE.sub(" ", "".join(self.link_parts)).strip())
            outside = self._state()[0] if self.parts_outside is None else self.parts_outside
            self.blocks.append((len(self.blocks), text, len(text), links, self.heading, outside, self._state()[3]))
        self.parts, self.link_parts, self.heading, self.parts_outside = [], [], False, None

    parts_outside: bool | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        found = dict(attrs)
        if tag == "html" and found.get("lang"):
            self.lang = (found["lang"] or "").split("-")[0].lower()
        if tag in BLOCKS:
            self._cut()
        if tag in VOID:
            if tag in ("br", "img"):
                self.parts.append(" ")
            return
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id"))
        outside = tag in OUTSIDE or (found.get("role") or "").lower() in OUTSIDE_ROLES or bool(OUTSIDE_NAMES.search(names))
        if tag in OUTSIDE or outside:
            self._cut()
        main = tag in MAIN or (found.get("role") or "").lower() == "main"
        self.stack.append((tag, outside, tag in SKIPPED, main))
        if tag in HEADINGS:
            self.heading = True

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if not any(e[0] == tag for e in self.stack):
            return
        if tag in BLOCKS or any(e[1] for e in self.stack if e[0] == tag):
            self._cut()
        while self.stack:
            if self.stack.pop()[0] == tag:
                break

    def handle_data(self, data: str) -> None:
        outside, skipped, link, _ = self._state()
        if skipped:
            return
        if self.parts_outside is None and data.strip():
            self.parts_outside = outside
        self.parts.append(data)
        if link:
            self.link_parts.append(data)

    def close(self) -> None:
        super().close()
        self._cut()


def blocks_of(html: str | None) -> tuple[str, list[tuple]]:
    """``(lang, blocks)`` of one page; each block is ``idx, text, n_chars, link_chars, heading, outside, main``."""
    parser = _Blocks()
    if html:
        parser.feed(html)
    parser.close()
    return parser.lang, parser.blocks


def _inside(blocks: list[tuple]) -> list[dict]:
    """The blocks that are not inside a non-article element, numbered again from 0."""
    kept = [b for b in blocks if not b[5]]
    return [dict(zip(FIELDS, (i, *b[1:]))) for i, b in enumerate(kept)]


def parsed(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages with a number ``rid`` each, their language and the blocks outside no non-article element.

    They are written once, compressed with zstd, and read by both the statistics and the passes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [blocks_of(h if isinstance(h, str) else None) for h in batch["h"]]
            yield pd.DataFrame(
                {
                    "rid": batch["rid"].values,
                    "page_id": batch["p"].values,
                    "url": batch["u"].values,
                    "lang": [lang for lang, _ in out],
                    "blocks": [_inside(bs) for _, bs in out],
                }
            )

    rows = pages.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(page_id).cast("long").alias("p"),
        F.col(url).cast("string").alias("u"),
        F.col(html).alias("h"),
    )
    return stored(rows.mapInPandas(run, PARSED), "html-blocks", compression="zstd")


def _words(text: str) -> Column:
    """Words of a block for stop words: runs of letters, in lower case."""
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), 0)


def stop_words(blocks: DataFrame) -> DataFrame:
    """``lang, word``: the most frequent words of each language, as many as hold ``STOP_SHARE`` of its words.

    Counts fall into buckets of powers of two (at most 64 a language); the stop words are those of the highest buckets
    that together reach the share.  So the list follows the language and the corpus at every size, and no window runs
    over all the words of a language.
    """
    words = blocks.select("lang", F.explode(_words("text")).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).withColumn("b", F.floor(F.log2("n")))
    buckets = counted.groupBy("lang", "b").agg(F.sum("n").alias("held"))
    down = Window.partitionBy("lang").orderBy(F.desc("b"))
    held = buckets.withColumn("above", F.sum("held").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    held = held.withColumn("all", F.sum("held").over(Window.partitionBy("lang")))
    cut = held.where(F.col("above") >= STOP_SHARE * F.col("all")).groupBy("lang").agg(F.max("b").alias("cut"))
    return counted.join(cut, "lang").where(F.col("b") >= F.col("cut")).select("lang", "word")


def classified(blocks: DataFrame, stop_list: DataFrame) -> DataFrame:
    """Blocks with the label of pass one, ``first``: good, near, short or bad."""
    words = blocks.select("rid", "idx", "lang", F.explode(_words("text")).alias("word"))
    # Words are counted in each block before the join; a very common word is spread over SALT parts of the list.
    per_block = words.groupBy("rid", "idx", "lang", "word").agg(F.count(F.lit(1)).alias("k"))
    per_block = per_block.withColumn("salt", F.pmod(F.xxhash64("rid", "idx"), F.lit(SALT)))
    stops = stop_list.select("lang", "word", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    marked = per_block.join(stops.withColumn("stop", F.lit(True)), ["lang", "word", "salt"], "left")
    density = marked.groupBy("rid", "idx").agg(
        (F.sum(F.when(F.col("stop"), F.col("k")).otherwise(0)) / F.sum("k")).alias("stop_density")
    )
    scored = blocks.join(density, ["rid", "idx"], "left").fillna({"stop_density": 0.0})
    links = F.col("link_chars") / F.col("n_chars")
    first = (
        F.when(links > MAX_LINK_DENSITY, "bad")
        .when(F.col("n_chars") < LENGTH_LOW, F.when(F.col("link_chars") > 0, "bad").otherwise("short"))
        .when(F.col("stop_density") >= STOP_HIGH, F.when(F.col("main") | (F.col("n_chars") > LENGTH_HIGH), "good").otherwise("near"))
        .when(F.col("stop_density") >= STOP_LOW, F.when(F.col("main"), "good").otherwise("near"))
        .otherwise(F.when(F.col("main"), "near").otherwise("bad"))
    )
    return scored.withColumn("first", first)


def labelled(blocks: DataFrame, stop_list: DataFrame) -> DataFrame:
    """Blocks of the article with their final ``label``; blocks outside it are left out."""
    inside = classified(blocks.where(~F.col("outside")), stop_list)
    page = Window.partitionBy("rid").orderBy("idx")
    after = page.rowsBetween(1, Window.unboundedFollowing)
    before = page.rowsBetween(Window.unboundedPreceding, -1)
    # Start of each block in characters, to measure how far a heading is from the next good block.
    at = F.sum("n_chars").over(page.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_chars")
    good_at = F.first(F.when(F.col("first") == "good", at), ignorenulls=True).over(after)
    heading_near = F.col("heading") & F.col("first").isin("short", "near") & ((good_at - at - F.col("n_chars")) <= HEADING_DISTANCE)
    step = inside.withColumn("at", at).withColumn("first", F.when(heading_near, "near").otherwise(F.col("first")))
    decided = F.when(F.col("first").isin("good", "bad"), F.struct("first", "idx"))
    prev = F.last(decided, ignorenulls=True).over(before)
    nxt = F.first(decided, ignorenulls=True).over(after)
    p, n = F.col("prev.first"), F.col("next.first")
    nearer_prev = (F.col("idx") - F.col("prev.idx")) <= (F.col("next.idx") - F.col("idx"))
    short = (
        F.when(p.isNull() & n.isNull(), F.when(F.col("main"), "good").otherwise("bad"))
        .when(p.isNull(), n)
        .when(n.isNull(), p)
        .when(p == n, p)
        .when(nearer_prev, p)
        .otherwise(n)
    )
    near = F.when(F.coalesce(p, F.lit("bad")) == "bad", F.when(F.coalesce(n, F.lit("bad")) == "bad", "bad")).otherwise("good")
    near = F.coalesce(near, F.lit("good"))
    label = F.when(F.col("first") == "short", short).when(F.col("first") == "near", near).otherwise(F.col("first"))
    return step.withColumn("prev", prev).withColumn("next", nxt).withColumn("label", label)


def decide(lang: str, blocks: list, stops: set[str]) -> str:
    """The text of one page from its blocks: both passes in order, as :func:`labelled` does with windows."""
    inside = [b for b in blocks if not b["outside"]]
    first = []
    for b in inside:
        words = LETTERS.findall(b["text"].lower())
        density = sum(w in stops for w in words) / len(words) if words else 0.0
        n, links, main = b["n_chars"], b["link_chars"], b["main"]
        if links / n > MAX_LINK_DENSITY:
            label = "bad"
        elif n < LENGTH_LOW:
            label = "bad" if links else "short"
        elif density >= STOP_HIGH:
            label = "good" if main or n > LENGTH_HIGH else "near"
        elif density >= STOP_LOW:
            label = "good" if main else "near"
        else:
            label = "near" if main else "bad"
        first.append(label)
    # A short or near-good heading before a good block that starts close enough.
    start, next_good = [], [None] * len(inside)
    at = 0
    for b in inside:
        start.append(at)
        at += b["n_chars"]
    for i in range(len(inside) - 2, -1, -1):
        next_good[i] = start[i + 1] if first[i + 1] == "good" else next_good[i + 1]
    for i, b in enumerate(inside):
        if b["heading"] and first[i] in ("short", "near") and next_good[i] is not None:
            if next_good[i] - start[i] - b["n_chars"] <= HEADING_DISTANCE:
                first[i] = "near"
    # Nearest decided blocks before and after each block.
    before, after = [None] * len(inside), [None] * len(inside)
    for i in range(1, len(inside)):
        before[i] = (i - 1, first[i - 1]) if first[i - 1] in ("good", "bad") else before[i - 1]
    for i in range(len(inside) - 2, -1, -1):
        after[i] = (i + 1, first[i + 1]) if first[i + 1] in ("good", "bad") else after[i + 1]
    kept = []
    for i, b in enumerate(inside):
        label, p, n = first[i], before[i], after[i]
        if label == "near":
            label = "bad" if (p is None or p[1] == "bad") and (n is None or n[1] == "bad") else "good"
        elif label == "short":
            if p is None and n is None:
                label = "good" if b["main"] else "bad"
            elif p is None or n is None:
                label = (p or n)[1]
            else:
                label = p[1] if p[1] == n[1] or i - p[0] <= n[0] - i else n[1]
        if label == "good":
            kept.append(b["text"])
    return "\n".join(kept)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    The stop words go to every task when there are at most ``MAX_STOP_WORDS`` of them (checked by counting them
    first); each page is then decided in its own task, nothing is shuffled but the word counts.  A longer list is
    joined with the words of the blocks by a shuffle, and the passes run as windows over the blocks of a page.
    """
    rows = parsed(pages, page_id, url, html)
    blocks = rows.select("rid", "lang", F.inline("blocks"))
    stops = stored(stop_words(blocks), "html-stops")
    if stops.count() > MAX_STOP_WORDS:
        good = labelled(blocks, stops).where(F.col("label") == "good")
        joined = good.groupBy("rid").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "text"))), lambda b: b["text"]), "\n").alias("text")
        )
        out = rows.select("rid", "page_id", "url").join(joined, "rid", "left")
    else:
        by_lang: dict[str, set[str]] = {}
        for r in stops.collect():
            by_lang.setdefault(r.lang, set()).add(r.word)
        shared = pages.sparkSession.sparkContext.broadcast(by_lang)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            words = shared.value
            for batch in batches:
                texts = [decide(lang, list(bs), words.get(lang, set())) for lang, bs in zip(batch["lang"], batch["blocks"])]
                yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

        out = rows.select("page_id", "url", "lang", "blocks").mapInPandas(run, "page_id long, url string, text string")
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
