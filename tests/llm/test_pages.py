"""Main text and URL rules on small pages and URLs."""

import fnmatch

from hypothesis import given, settings
from hypothesis import strategies as st

from foldwright.llm.main_text import extract_text, main_blocks
from foldwright.llm.url_filter import Automaton, Rule, canonical, filter_urls

PROSE = "It is the habit of the old harbour that the boats come in with the tide and that the nets are dried on the wall by the road. " * 2
FR = "La mer est plus calme le soir et les bateaux sont dans le port avec un peu de vent qui vient du sud pour la nuit. " * 2


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body class='has-sidebar'>{body}</body></html>"


def test_chrome_goes_and_the_article_stays():
    body = f"""
    <header class="site"><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li></ul></nav>
    <div class="cookie-notice">{PROSE}</div><div class='ad'>{PROSE}</div>
    <main><article><header><h1>Title &amp; more</h1></header><p>Short.</p><p>{PROSE}</p>
    <ul><li>first point</li><li>second point</li></ul>
    <aside>{PROSE}</aside><p><b>Bold<br>line<p>{FR}</p><form><label>Name</label><input name=x>send</form>
    <script>var x = "<p>no</p>";</script><p>Last&nbsp; one &lt;x&gt;</p>
    <section id="comments"><h2>Comments</h2><p>{PROSE}</p></section></article></main>
    <div id="sidebar"><p>{PROSE}</p></div><footer>&copy; us</footer>"""
    want = ["Title & more", "Short.", PROSE.strip(), "first point", "second point", "Bold line", FR.strip(), "Last one <x>"]
    assert main_blocks(page(body, "<style>p{}</style>")) == want


def test_without_a_named_part_densities_decide():
    links = "".join(f'<li><a href="/{i}">the link of the day {i}</a></li>' for i in range(8))
    body = f"<div><ul>{links}</ul></div><div><h2>Heading</h2><p>{PROSE}</p><p>Yes.</p><p>{FR}</p></div><div><a href=x>more of the same</a> | <a>next</a></div>"
    assert main_blocks(page(body)) == ["Heading", PROSE.strip(), "Yes.", FR.strip()]


def test_a_part_of_a_name_hides_nothing():
    for name in ("content no-sidebar", "has-sidebar", "withSidebar", "content-sidebar-wrap", "header-image", "md:hidden"):
        assert main_blocks(page(f'<div class="{name}"><article><h1>Title</h1><p>{PROSE}</p></article></div>')) == ["Title", PROSE.strip()]
        assert main_blocks(page(f'<div class="{name}"><p>{PROSE}</p><p>{FR}</p></div>')) == [PROSE.strip(), FR.strip()]
    for name in ("sidebar", "site-header", "cookie-notice", "siteFooter", "ad-300x250", "widget widget_text", "nav-links"):
        assert main_blocks(page(f'<div class="{name}"><p>{PROSE}</p></div><p>{FR}</p>')) == [FR.strip()]


def test_a_name_above_hides_no_article():
    for tag in ("article", "main"):
        assert main_blocks(page(f'<div class="widget"><div id="main"><{tag}><p>{PROSE}</p><p class="ad">{FR}</p></{tag}></div></div>')) == [PROSE.strip()]
    assert main_blocks(page(f"<aside><article><p>{PROSE}</p></article></aside>")) == []
    body = f'<main><p>{PROSE}</p><div id="comments"><article><p>{FR}</p></article></div></main><div class="related"><article><p>{FR}</p></article></div>'
    assert main_blocks(page(body)) == [PROSE.strip()]


def test_a_named_title_is_not_the_whole_article():
    for name in ("article-title", "article", "main article-meta"):
        assert main_blocks(page(f'<h1 class="{name}">Title</h1><div><p>{PROSE}</p><p>{FR}</p></div>')) == ["Title", PROSE.strip(), FR.strip()]
    body = f'<div class="article-body"><p>{PROSE}</p></div><div><p>{FR}</p></div>'
    assert main_blocks(page(body)) == [PROSE.strip()]


def test_broken_markup():
    assert main_blocks(f"<article><p>{PROSE}<p>a < b & c > d</article><footer>x") == [PROSE.strip(), "a < b & c > d"]
    assert main_blocks("<article><p>one<p title='x>two</article>")[0] == "one"
    assert main_blocks("<!-- never closed <p>x</p>") == []
    assert main_blocks("") == [] and main_blocks("<") == [] and main_blocks("<nav>x</nav>") == []
    assert main_blocks("<article><h1>only a title</h1></article>") == ["only a title"]
    assert main_blocks("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>") == ["yes"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<br>", "<a href='", "'>", "</a>", "<", ">", "text ", "&amp;", "<!--", "-->", "<script>", "</article>", "<article>"]), max_size=40))
def test_any_markup_is_read(parts):
    for block in main_blocks("".join(parts)):
        assert block and block == " ".join(block.split())


def test_extract_text(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p><p>é</p></article>", "x"), (2, None, None, "y"), (None, "u", "", None), (1, "u", "<p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract_text(df).collect()), key=str)
    text = f"{PROSE.strip()}\n\né"
    assert got == sorted([(1, "u", text, len(text)), (2, None, "", 0), (None, "u", "", 0), (1, "u", "", 0)], key=str)
    assert extract_text(df.limit(0)).count() == 0


RULES = [
    Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"), Rule("allow", "com/fr/"),
    Rule("block", "com/de/"), Rule("block", "*.shop?.net/*/buy"), Rule("allow", "same.io/a"), Rule("block", "same.io/*"),
]


def plain(rule, host, path):
    own_host, _, own_path = rule.pattern.partition("/")
    glob = lambda s: s.replace("[", "[[]")
    return fnmatch.fnmatchcase("." + host, "*." + glob(own_host)) and fnmatch.fnmatchcase(path, "/" + glob(own_path) + "*")


def test_canonical():
    assert canonical("HTTP://A.B.C:80/X?y#z") == ("a.b.c:80", "/X") and canonical("x://h?/p") == ("h", "")
    assert canonical(None) == canonical("no scheme") == canonical("") == ("", "")
    assert canonical("a://b/c://d/e") == ("b", "/c://d/e") and canonical("://É.com#/") == ("É.com", "")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "org", "x.org", "xorg", "example.org", "www.example.org", "com", "a.com", "my.shop1.net", "shop1.net", "same.io", "é.org"]), st.sampled_from(["", "/", "/es/", "/es", "/en/1", "/en/12", "/fr/x", "/de/", "/a/buy", "/a/b/buy/z", "/a", "/org/"])), min_size=1, max_size=8))
def test_all_rules_at_once(urls):
    found = Automaton(RULES).matches(urls)
    assert found.tolist() == [[plain(r, h, p) for r in RULES] for h, p in urls]


def test_many_rules_span_words():
    rules = [Rule("block", f"host{i}.example.com/path/{i}/") for i in range(60)]
    found = Automaton(rules).matches([(f"a.host{i}.example.com", f"/path/{j}/x") for i in range(0, 60, 7) for j in (i, i + 1)])
    assert [(r.nonzero()[0].tolist()) for r in found] == [x for i in range(0, 60, 7) for x in ([i], [])]


def test_filter_urls(spark):
    rows = [
        (1, "http://A.org/x?y", "r"), (2, "http://example.org/es/", "r"), (3, "http://www.example.org/en/1?x", "r"), (4, "http://example.org/en/2", "r"),
        (5, "http://a.com/fr/x", "r"), (6, "http://com/de/", None), (7, "http://a.com/de", None), (8, None, None), (None, "nothing", None),
        (9, "http://a.org", None), (10, "http://a.org/" + "x" * 100_000, None), (1, "http://A.org/x?y", "r"), (11, "x://same.io/ab", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = sorted(((r.page_id, r.host, len(r.path), r.rule, r.verdict) for r in filter_urls(df, RULES).collect()), key=str)
    want = [
        (1, "a.org", 2, "org/", "allow"), (2, "example.org", 4, "example.org/es/", "block"), (3, "www.example.org", 5, "example.org/en/1", "block"),
        (4, "example.org", 5, "org/", "allow"), (5, "a.com", 5, "com/fr/", "allow"), (6, "com", 4, "com/de/", "block"), (7, "a.com", 3, None, "allow"),
        (8, "", 0, None, "allow"), (None, "", 0, None, "allow"), (9, "a.org", 0, None, "allow"), (10, "a.org", 100_001, "org/", "allow"),
        (1, "a.org", 2, "org/", "allow"), (11, "same.io", 3, "same.io/*", "block"),
    ]
    assert got == sorted(want, key=str)
    assert {r.verdict for r in filter_urls(df, [], "block").collect()} == {"block"}
    assert filter_urls(df.limit(0), RULES).count() == 0


EN = "It is the habit of the old harbour that the boats come in with the tide and that the nets are dried on the wall by the road, as they were in the days of our own fathers and of theirs before."


def test_a_link_line_says_nothing_about_its_neighbours():
    more = "<p><a href='/x'>Read more: the story of the boats and of the nets in the old harbour</a></p>"
    assert 180 < len(EN) < 200 < len(EN + EN)
    assert main_blocks(page(f"<article><p>{EN}</p>{more}<p>{EN} {EN}</p></article>")) == [EN, f"{EN} {EN}"]
    assert main_blocks(page(f"<article><p>{EN}</p>{more}<p>{EN}</p></article>")) == [EN, EN]
    assert main_blocks(page(f"<article><ul><li><a href='#a'>Part one</a></li></ul><p>{EN}</p><p>{EN}</p></article>")) == [EN, EN]
    menu = "<ul><li><a href='/'>Home</a></li><li><a href='/b'>Boats</a></li></ul>"
    assert main_blocks(page(f"<nav>{menu}</nav><div><p>{EN}</p><p>{EN}</p></div><footer>{menu} and so on</footer>")) == [EN, EN]


def test_a_language_without_stop_words_is_judged_by_length_and_links():
    text = "Vanha satama herää aikaisin aamulla ja veneet palaavat sinne vuoroveden mukana samalla kun verkot kuivuvat muurilla tien vieressä. " * 2
    links = "".join(f"<a href='/{i}'>sivu numero {i} ja vielä lisää luettavaa</a> " for i in range(9))
    assert main_blocks(page(f"<div><p>{text}</p><p>{text}</p></div><div>{links}</div>")) == [text.strip()] * 2
    # but a page of a known language does not take such a block for text
    assert main_blocks(page(f"<div><p>{PROSE}</p><p>{PROSE}</p><p>{FR}</p></div><div><p>{text}</p></div>")) == [PROSE.strip(), PROSE.strip(), FR.strip()]


def test_a_form_round_the_page_is_no_chrome():
    form = "<form><p>Give your name and your address and we will send the news to you on the first day of the month</p></form>"
    assert main_blocks(page(f"<form action='/'><div><p>{PROSE}</p><p>{FR}</p></div></form>")) == [PROSE.strip(), FR.strip()]
    assert main_blocks(page(f"<div><p>{PROSE}</p>{form}<p>{FR}</p></div>")) == [PROSE.strip(), FR.strip()]


def test_many_unclosed_elements_take_no_more_than_their_length():
    import time

    start = time.perf_counter()
    for tag in ("li", "div", "span class='ad'", "b"):
        big = f"<article><p>{PROSE}</p></article>" + f"<{tag}><a href='/x'>link</a></i></section>" * 40_000
        assert main_blocks(big)[0] == PROSE.strip()
    assert time.perf_counter() - start < 30
