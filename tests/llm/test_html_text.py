import re

from horavento.llm import html_text as ht
from horavento.llm.common import QUERIES, table
from tests.llm.helpers import SF

PROSE = "The cat was in the house and it is the one that we had seen on the road with all of them there."


def test_article_without_boilerplate():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a><li><a href=/b>News</a></ul></nav>
    <div class="ad">{PROSE}</div><div class='cookie-notice'>{PROSE}</div><aside>{PROSE}</aside>
    <article><h1>Title&nbsp;&amp; more</h1><p><b>First &lt;b&gt;   line<br><p>{PROSE}<p>Short.
    <form><label>Name</label><input value="x"><button>Go</button></form>
    <div class="comments"><p>{PROSE}</p></div><p>x&#233;y &eacute; a<b>b</b>c <a href="#">link</a> end</p></article>
    <section id="comments"><article class="comment"><p>{PROSE}</p></article></section>
    <footer>&copy; {PROSE}</footer></body></html>"""
    assert ht.main_text(page).split("\n") == [
        "Title & more", "First <b> line", PROSE, "Short.", "xéy é abc link end"]


def test_pages_without_article_use_the_block_rules():
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in "alpha beta gamma delta".split())
    page = f"<body><ul>{menu}</ul><h2>Heading</h2><p>{PROSE}</p><p>Yes.</p><p>{PROSE} {PROSE}</p><p>Copyright</p><ul>{menu}</ul>"
    got = ht.main_text(page).split("\n")
    assert got[0] == "Heading" and PROSE in got and "Yes." in got
    assert not any(w in got for w in ("alpha", "delta"))


def test_keeps_odd_articles():
    body = "De%%% êeux*** ouier### onaiaux%%%"
    assert ht.main_text(f"<article><p>{body * 5}</p><p>x</p></article>") == body * 5 + "\nx"


def test_article_cards_beside_a_div_body():
    body = f"<div><h2>Heading</h2><p>{PROSE}</p><p>Yes.</p><p>{PROSE} {PROSE}</p></div>"
    card = f"<h3><a href='/n'>News</a></h3><p>{PROSE}</p><p>More</p>"
    want = ["Heading", PROSE, "Yes.", f"{PROSE} {PROSE}"]
    for cards in (f"<article class='teaser'>{card}</article>" * 3, f"<aside><article>{card}</article></aside>",
                  f"<nav><article>{card}</article></nav>", f"<div class='related'><article>{card}</article></div>",
                  "<article><h3><a href='/n'>News of today</a></h3><p><a href='/n'>More</a></p></article>" * 2):
        assert ht.main_text(f"<body>{body}{cards}</body>").split("\n") == want
        assert ht.main_text(f"<body>{cards}{body}</body>").split("\n") == want
    # a class around the whole page does not hide its article
    assert ht.main_text(f"<div class='has-sidebar'><article><p>{PROSE}</p><p>x</p></article></div>") == f"{PROSE}\nx"
    assert ht.main_text(f"<form><article><p>{PROSE}</p></article></form>") == PROSE


def test_short_blocks_in_an_article_stay_ambiguous():
    links = "".join(f"<p><a href='/{w}'>{w}</a></p>" for w in ("alpha", "beta", "gamma"))
    got = ht.main_text(f"<article><p>{PROSE}</p><p>Yes.</p><p>{PROSE}</p>{links}<p>Tags</p>{links}</article>")
    assert got.split("\n") == [PROSE, "Yes.", PROSE]


def test_malformed_pages_do_not_crash():
    for page in (None, "", " ", "<", "<>", "</", "<p", "<p>a", "a < b > c", "<!-- x", "<script>x", "<a b='", "<div class=\"x>y",
                 "<p>" * 20_000 + "x", "<div>" * 5_000, "</div>" * 5_000, "<a \"" * 3_000, "&#xD800;&#99999999;&bogus;&amp",
                 "<article>" + "<br>" * 1_000, "\x00<p>\x00", "<![CDATA[x]]>", "<?php x ?>y", "x" * 500_000):
        assert isinstance(ht.main_text(page), str)
    assert ht.main_text("<article><p>a\n\t b<p>c</article>") == "a b\nc"
    assert ht.main_text("<div class='ad'><p>spam<article><p>text</article>") == "text"


def test_whole_table(spark):
    got = {r.page_id: r for r in QUERIES["op3_html_text"](spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    assert len(got) == len(pages)
    import html
    for p in pages:
        # brute force for these pages: the blocks inside the article element
        inner = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[p.page_id].text == "\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_nulls_repeats_empty_clashes(spark):
    rows = spark.createDataFrame([(1, None, None), (None, "u", "<article><p>x</article>"), (1, None, None)],
                                 "page_id long, url string, html string").selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = ht.extract(rows).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), ("x", 1)]
    assert ht.extract(rows.limit(0)).collect() == []


def test_a_state_class_hides_no_page():
    body = f"<div><p>{PROSE}</p><p>{PROSE} {PROSE}</p></div>"
    for page in (f"<body class='single no-sidebar'>{body}", f"<body><div class='has-banner'>{body}</div>",
                 f"<body class='sidebar'>{body}", f"<html class='menu'><body>{body}"):
        assert ht.main_text(page).split("\n") == [PROSE, f"{PROSE} {PROSE}"]


def test_a_class_around_most_of_the_text_is_no_evidence():
    body = f"<p>{PROSE}</p>" * 4
    page = f"<body><div class='sticky-header'><div class='cookie'><p>{PROSE}</p></div>{body}</div><div class='ad'>{PROSE}</div>"
    assert ht.main_text(page).split("\n") == [PROSE] * 4
    # comments and elements that are boilerplate by name stay out
    assert ht.main_text(f"<p>{PROSE}</p><div class='comments'>{body}</div><footer>{body}</footer>") == PROSE


def test_unclosed_elements_do_not_swallow_the_page():
    for name in "button option noscript svg object canvas select template math".split():
        assert ht.main_text(f"<div><{name}>x<p>{PROSE}</p><p>{PROSE}</p></div>").split("\n") == [PROSE, PROSE], name
        assert ht.main_text(f"<div><p>{PROSE}</p><{name}><b>no</b></{name}><p>{PROSE}</p></div>").split("\n") == [PROSE, PROSE], name
    assert ht.main_text(f"<button>a<p>{PROSE}</p><button>b</button><p>{PROSE}</p>").split("\n") == [PROSE, PROSE]
    assert ht.main_text(f"<svg>a<svg>b</svg><text>c</text></svg><p>{PROSE}</p>") == PROSE
    assert ht.main_text(f"<p>{PROSE}<script>var a = '<script>'; <p>no</p></script></p>") == PROSE


def test_other_languages_go_by_length_and_links():
    ru = "Сегодня утром жители города увидели необычное явление над рекой, которое продолжалось почти целый час подряд."
    ja = "今朝、市民は川の上空でほぼ一時間続いた珍しい現象を目撃した。" * 4
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("один", "два", "три"))
    for text in (ru, ja):
        assert ht.main_text(f"<ul>{menu}</ul><div><h1>Заголовок</h1><p>{text}</p><p>{text}</p></div>").split("\n")[-2:] == [text, text]
        assert "один" not in ht.main_text(f"<ul>{menu}</ul><div><p>{text}</p></div>")


def test_a_page_of_short_paragraphs_is_text():
    lines = ["We met at the old bridge.", "Nobody had come before us.", "Then it began to rain."]
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in "alpha beta gamma".split())
    got = ht.main_text(f"<ul>{menu}</ul><div>" + "".join(f"<p>{x}</p>" for x in lines) + "</div>").split("\n")
    assert got == lines


def test_marked_paragraphs_and_inline_elements_go():
    page = f"<div><p>{PROSE}</p><p class='advert'>{PROSE}</p><p>{PROSE} <span class='cookie-notice'>We use <span>cookies</span>.</span>End.</p>"
    assert ht.main_text(page).split("\n") == [PROSE, f"{PROSE} End."]
    assert ht.main_text(f"<h2><span class='header'>Title</span></h2><p>{PROSE}</p>").split("\n") == ["Title", PROSE]


def test_an_unclosed_link_ends_with_its_paragraph():
    rare = "Quarterly revenue figures published yesterday showed considerable growth across several regional divisions"
    page = f"<div><p>{PROSE} <a href='/x'>more<p>{rare}<p>{PROSE}</div>"
    assert rare in ht.main_text(page)
