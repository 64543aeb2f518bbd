"""Main text of pages: fixed cases, a plain-Python version of both passes, and the article of the given pages."""

import html as entities
import math
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from conftest import rows
from treeledger.llm import html_text as H
from treeledger.llm.queries import QUERIES

ARTICLE = (
    "<p>The quick brown fox and the lazy dog are in the story of the day, and it is the one that we tell to all "
    "of the children in the town when the night is long and the fire is warm.</p>"
)
PAGE = (
    "<html lang='en'><head><title>T</title><style>p{x}</style><script>var t='</p>';</script></head><body>"
    "<header><h1>Site name</h1></header><nav><a href='/'>Home</a> <a href='/a'>About</a></nav>"
    "<div class='ad-box'>Buy now and save on all of the things that you want to have</div>"
    "<article><h1>A &amp; B&nbsp;title</h1>" + ARTICLE + "<p>Short one.</p>" + ARTICLE +
    "<div id='comments'><p>I think that the article is the best one of all that I have read in the year.</p></div>"
    "</article><aside>Related: the other things</aside><form>Name <input> of the user</form>"
    "<footer>&copy; 2024 the site</footer></body></html>"
)
CLEAN = ARTICLE[3:-4]


@pytest.fixture()
def pages(spark):
    data = [
        (1, "http://a", PAGE), (2, None, None), (3, "http://c", ""), (None, "http://d", "<p>" + "word " * 50_000 + "</p>"),
        (1, "http://a", PAGE), (5, "http://e", "<article><p>Only a short line.</p></article>"),
        (6, "http://f", "<div><a href='x'>" + "link " * 40 + "</a></div>"),
    ]
    return spark.createDataFrame([(*p, "x", 0) for p in data], "page_id long, url string, html string, text string, rid long")


@pytest.mark.parametrize("broadcast", [True, False])
def test_fixed_cases(spark, pages, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(H, "MAX_STOP_WORDS", 0)
    got = {(r.page_id, r.url): r for r in H.main_text(pages).collect()}
    assert H.main_text(pages).count() == 7
    first = got[(1, "http://a")].text
    assert first == "A & B title\n" + CLEAN + "\nShort one.\n" + CLEAN
    assert got[(1, "http://a")].n_chars == len(first)
    assert got[(2, None)].text == "" and got[(2, None)].n_chars == 0
    assert got[(3, "http://c")].text == ""
    assert got[(5, "http://e")].text == "Only a short line."
    assert got[(6, "http://f")].text == ""
    assert got[(None, "http://d")].n_chars == len(("word " * 50_000).strip())


def test_parser_leaves_out_scripts_and_markup():
    lang, blocks = H.blocks_of(PAGE)
    assert lang == "en"
    texts = [b[1] for b in blocks]
    assert not any("var t" in t or "p{x}" in t or "<" in t for t in texts)
    outside = {b[1] for b in blocks if b[5]}
    assert "Site name" in outside and "Home About" in outside and "© 2024 the site" in outside
    assert any("best one" in t for t in outside)


def plain(pages):
    """Both passes in plain Python over the blocks of the parser."""
    parsed = [(p, H.blocks_of(h)) for p, h in pages]
    words = defaultdict(Counter)
    for _, (lang, blocks) in parsed:
        for b in blocks:
            if b[5]:
                continue
            words[lang].update(re.findall(r"[^\W\d_]+", b[1].lower()))
    stops = {}
    for lang, c in words.items():
        held = Counter()
        for n in c.values():
            held[math.floor(math.log2(n))] += n
        total, above, cut = sum(held.values()), 0, None
        for b in sorted(held, reverse=True):
            above += held[b]
            if above >= H.STOP_SHARE * total:
                cut = b
                break
        stops[lang] = {w for w, n in c.items() if math.floor(math.log2(n)) >= cut}
    out = []
    for p, (lang, blocks) in parsed:
        inside = [b for b in blocks if not b[5]]
        first = []
        for _, text, n, links, heading, _, main in inside:
            ws = re.findall(r"[^\W\d_]+", text.lower())
            d = sum(w in stops[lang] for w in ws) / len(ws) if ws else 0.0
            if links / n > H.MAX_LINK_DENSITY:
                c = "bad"
            elif n < H.LENGTH_LOW:
                c = "bad" if links else "short"
            elif d >= H.STOP_HIGH:
                c = "good" if main or n > H.LENGTH_HIGH else "near"
            elif d >= H.STOP_LOW:
                c = "good" if main else "near"
            else:
                c = "near" if main else "bad"
            first.append(c)
        starts = [sum(b[2] for b in inside[:i]) for i in range(len(inside))]
        for i, b in enumerate(inside):
            if b[4] and first[i] in ("short", "near"):
                later = [j for j in range(i + 1, len(inside)) if first[j] == "good"]
                if later and starts[later[0]] - starts[i] - b[2] <= H.HEADING_DISTANCE:
                    first[i] = "near"
        final = []
        for i, b in enumerate(inside):
            c = first[i]
            prev = next(((i - j, first[j]) for j in range(i - 1, -1, -1) if first[j] in ("good", "bad")), None)
            nxt = next(((j - i, first[j]) for j in range(i + 1, len(inside)) if first[j] in ("good", "bad")), None)
            if c == "near":
                c = "bad" if (prev is None or prev[1] == "bad") and (nxt is None or nxt[1] == "bad") else "good"
            elif c == "short":
                if prev is None and nxt is None:
                    c = "good" if b[6] else "bad"
                elif prev is None or nxt is None:
                    c = (prev or nxt)[1]
                else:
                    c = prev[1] if prev[1] == nxt[1] or prev[0] <= nxt[0] else nxt[1]
            final.append(c)
        text = "\n".join(b[1] for b, c in zip(inside, final) if c == "good")
        out.append((p, text, len(text)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_query_matches_plain_version(spark, sf_dir, monkeypatch, broadcast):
    """With the stop words sent to every task, and with the shuffle and windows that a longer list takes."""
    if not broadcast:
        monkeypatch.setattr(H, "MAX_STOP_WORDS", 0)
    got = rows(QUERIES["op12_html_text"](spark, sf_dir), "page_id", "text", "n_chars")
    pages = [(r["page_id"], r["html"]) for r in pq.read_table(f"{sf_dir}/pages.parquet").to_pylist()]
    assert got == plain(pages)


def test_article_found(spark, sf_dir):
    """The planted article of each page (heading and paragraphs), for nearly all pages."""
    got = {r.page_id: r.text for r in QUERIES["op12_html_text"](spark, sf_dir).collect()}
    same = 0
    table = pq.read_table(f"{sf_dir}/pages.parquet").to_pylist()
    for r in table:
        body = re.search(r"<article>(.*)</article>", r["html"] or "", re.S)
        parts = re.split(r"<(?:h1|p)>", body.group(1) if body else "")
        clean = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]+>", " ", x))).strip() for x in parts]
        same += got[r["page_id"]] == "\n".join(x for x in clean if x)
    assert same >= 0.95 * len(table)


def test_empty_table(spark):
    assert H.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
