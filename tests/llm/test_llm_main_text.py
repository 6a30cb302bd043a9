import html
import re

import duckdb
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import main_text as mt
from forecourt.llm.queries import QUERIES

SITE = """<!DOCTYPE html><html class="has-sidebar"><head><title>Site</title><style>p{{}}</style></head><body>
<header class="top"><h2>My Site</h2></header><div id="nav-menu"><a href=1>Home</a> <a href=2>News</a></div>
<div class="cookie-notice">We use cookies for all kinds of good reasons, please do agree to them</div>
<script>if (a < b) document.write("<p>no</p>")</script>
{article}
<div class="sidebar"><p>Some side text that is rather long, really quite long to be honest, so it goes on.</p></div>
<form><input><p>Sign up for our letter</p></form><section id="comments"><p>Great post, thanks a lot!</p></section>
<!-- <p>remark</p> --><footer>&copy; foot</footer></body></html>"""
BODY = """<h1>Title here</h1><p>First paragraph of the&nbsp;text with &lt;b&gt; and more   words
in it.</p><div class="ad-slot">Buy now!</div><p>Second <b>par</b>agraph that is<br>long too.<p>Third, unclosed<ul><li>item one<li>item <a href=x>two</a></ul>"""
TEXT = "Title here First paragraph of the text with <b> and more words in it. Second paragraph that is long too. Third, unclosed item one item two"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div class="post">{}</div>', "<div>{}</div>"])
def test_article_without_its_surroundings(wrap):
    assert mt.main_text(SITE.format(article=wrap.format(BODY))) == TEXT


def test_unclosed_menu_and_tail():
    page = "<nav><ul><li><a>Home</a><article><h1>T</h1><p>Some text.</article><footer>f"
    assert mt.main_text(page) == "T Some text."


def test_classes_that_leave_nothing_are_ignored():
    assert mt.main_text('<div class="widget"><p>All there is on this page.</p></div>') == "All there is on this page."


def test_hidden_and_roles():
    page = '<div role="navigation">menu</div><p>Seen text is here to stay.</p><p style="display: none">no</p><p hidden>no</p>'
    assert mt.main_text(page) == "Seen text is here to stay."


def test_stretches_end_where_a_whole_window_is_silent():
    assert mt.stretches([0, 5, 0, 0, 7, 0, 0, 0, 2]) == [(1, 5, 12), (8, 9, 2)]
    assert mt.stretches([]) == []


def test_little_stretches_far_from_the_text_go():
    page = "<p>" + "long text " * 50 + "</p><div></div>" + "<p><a>x</a></p>" * 3 + "<p>tiny</p>"
    assert "tiny" not in mt.main_text(page)


TEN = [f"<p>Paragraph {i} of a story that runs on for quite some words, as stories do.</p>" for i in range(10)]
PLAIN = " ".join(p[3:-4] for p in TEN)


@pytest.mark.parametrize("removed", ['<div class="share">Share me</div>', '<div class="ad-slot">Buy now</div>', "<form>f</form>", "<aside>a</aside>"])
@pytest.mark.parametrize("wrap", ['<div class="post">{}</div>', "<body>{}</body>", "{}"])
def test_removed_elements_do_not_cut_a_run_of_blocks(removed, wrap):
    page = wrap.format(f"<h1>Title</h1>{removed}" + "".join(TEN[:-1]) + removed + "<p>The end.</p>")
    assert mt.main_text(page) == "Title " + PLAIN.rpartition(" Paragraph 9")[0] + " The end."


def test_title_and_deeper_blocks_are_one_run():
    page = f'<div class="post"><h1>Title</h1><div><b class="share">s</b></div><div>{"".join(TEN)}</div></div>'
    assert mt.main_text(page) == "Title " + PLAIN
    assert mt.main_text('<div>One <span class="ad">ad</span> two' + "".join(TEN) + "</div>") == "One two " + PLAIN


def test_removed_elements_between_parts_of_the_page_cut():
    page = f"<body><div>Slogan</div><nav>n</nav><div>{''.join(TEN)}</div><footer>f</footer><div>Imprint</div></body>"
    assert mt.main_text(page) == PLAIN


def test_a_marked_article_is_left_if_the_text_outside_is_denser():
    story, cards = "".join(TEN), "".join(f'<article class="card"><h3>Post {i}</h3></article>' for i in range(3))
    assert mt.main_text(f'<body><div class="content">{story}</div>{cards}</body>') == PLAIN
    assert mt.main_text(f'<body><article><h1>Title</h1></article><div class="content">{story}</div></body>') == "Title " + PLAIN
    assert mt.main_text(f"<body><article>{story}</article><div>Imprint and more</div></body>") == PLAIN


@pytest.mark.parametrize("tag", ["svg", "math", "object", "canvas", "audio", "video"])
def test_self_closed_elements_delete_nothing(tag):
    page = f'One<{tag}/> two <{tag} class="x" /> three <{tag} id="a>b"/> four <{tag} a="1">gone</{tag}> five'
    assert mt.main_text(page) == "One two three four five"


def test_stretches_are_compared_by_their_densest_window():
    far = "<p><a>x</a></p>" * 3
    assert mt.main_text("".join(TEN * 5) + far + TEN[0]).count("Paragraph 0") == 6


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/pdiv a=\"'!-&;\n#x3", max_size=200))
def test_broken_markup_never_fails(page):
    assert isinstance(mt.main_text(page), str)


def test_long_broken_markup_takes_linear_time():
    assert mt.main_text("<" * 200_000) and mt.main_text('<a b="' * 20_000) is not None
    assert mt.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"


def test_given_pages_give_their_articles(spark):
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_DIR}/pages.parquet'").fetchall()
    found = {r.page_id: r for r in QUERIES["op1_main_text"](spark, SF_DIR).collect()}
    assert len(found) == len(pages)
    for page_id, url, page in pages:
        blocks = re.split(r"</?(?:h1|p)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
        plain = [" ".join(html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in blocks]
        text = " ".join(filter(None, plain))
        assert (found[page_id].url, found[page_id].text, found[page_id].n_chars) == (url, text, len(text))


def test_odd_rows_and_empty_table(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a", "x"), (3, "u", long, "x"), (3, "u", long, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = mt.extract(pages).collect()
    assert [(r.page_id, r.url, r.text[:9], r.n_chars) for r in found] == [
        (1, "u", "", 0), (2, None, "", 0), (None, "u", "a", 1), (3, "u", "word & wo", 359_999), (3, "u", "word & wo", 359_999),
    ]
    assert mt.extract(pages.limit(0)).count() == 0


STORY = "".join(TEN)
SIDE = "<div><p>read this too</p></div>"
COMMENTS = "<p>Bob: well said, I would have put it just like that myself.</p>" * 2


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<body><div class="comment-piece">{STORY}</div><nav>n</nav>{SIDE}</body>', PLAIN),
        (f'<body><div class="comment">{STORY}</div><nav>n</nav>{SIDE}</body>', PLAIN),
        (f'<body><div class="post">{STORY}<section class="related-work">{TEN[0]}</section></div></body>', f"{PLAIN} {TEN[0][3:-4]}"),
        (f'<body><article>{STORY}<section class="legal-case"><p>The case.</p></section></article></body>', f"{PLAIN} The case."),
        ("<body><div>" + "".join(f'<p><a href="{i}">{p[3:-4]}</a></p>' for i, p in enumerate(TEN)) + "</div></body>", PLAIN),
        (f"<body><article>{STORY}<div><h3>2 Comments</h3>{COMMENTS}</div></article></body>", PLAIN),
        (f'<body><article>{STORY}<div><h3>2 Comments</h3><p class="x">Bob: well</article></body>', PLAIN),
        (f'<body><div class="post">{STORY}<ul class="related-links"><li>{TEN[3][3:-4]}</li></ul></div></body>', PLAIN),
    ],
)
def test_names_are_evidence_and_no_switch(page, text):
    assert mt.main_text(page) == text


def test_names_inside_a_name_that_is_not_believed_hold():
    page = f'<body><div class="comments">{"".join(TEN[:5])}<div class="ad">Buy now</div>{"".join(TEN[5:])}</div></body>'
    assert mt.main_text(page) == PLAIN


def test_dense_text_beside_a_marked_article_is_kept_by_its_windows():
    other = "<div>" + "<p>" + "far more text than in the article " * 20 + "</p></div>"
    assert mt.main_text(f"<body><article><p>Short.</p></article><nav>n</nav>{other}</body>").startswith("far more")


def plain_choice(texts, masses):
    """Line by line: part at windows without mass, keep the parts with a window of enough mass."""
    padded = [0] * 2 + list(masses) + [0] * 2
    parts, part = [], []
    for i, (text, mass) in enumerate(zip(texts, masses)):
        part.append((text, mass))
        if sum(padded[i + 3 : i + 5]) + mass == 0 or sum(padded[i + 1 : i + 4]) == 0 or sum(padded[i : i + 3]) == 0:
            parts.append(part)
            part = []
    parts.append(part)

    def peak(lines):
        return max((sum(m for _, m in lines[i : i + 3]) for i in range(len(lines))), default=0)

    most, kept = peak(list(zip(texts, masses))), []
    for part in parts:
        with_mass = [i for i, (_, mass) in enumerate(part) if mass]
        if with_mass and peak(part) >= 0.25 * most:
            kept += [text for text, _ in part[with_mass[0] : with_mass[-1] + 1] if text]
    return " ".join(kept)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1, 5, 40]), max_size=40))
def test_stretches_match_a_plain_choice(masses):
    texts = [f"t{i}" for i in range(len(masses))]
    inside, most = mt._Densest(masses), mt.densest(masses)
    kept = [(s, e) for s, e, _ in mt.stretches(masses) if inside.within(s, e) >= 0.25 * most]
    assert " ".join(t for s, e in kept for t in texts[s:e]) == plain_choice(texts, masses)


def test_given_pages_match_a_plain_distribution_and_need_no_article_tag():
    pages = [h for (h,) in duckdb.sql(f"SELECT html FROM '{SF_DIR}/pages.parquet'").fetchall()]
    found = wanted = 0
    for page in pages:
        tagged = mt.main_text(page)
        untagged = page.replace("<article>", "<div>").replace("</article>", "</div>")
        for one in (page, untagged):
            lines = mt.lines_of(one)
            assert mt.main_text(one) == plain_choice(lines.texts, lines.masses)
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:h1|p|b|br)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])]
        text = mt.main_text(untagged)
        wanted += len(tagged)
        found += len(tagged) if text == tagged else sum(len(b) for b in blocks if b in text)
    assert found / wanted >= 0.99
