import random
import time

import pytest

from loomline.llm import wrappers
from tests.llm.data import words

PAGES = "page_id bigint, url string, html string, host string, regions int, text string"


def page(i, art, extra=""):
    return f"""<!DOCTYPE html><html><head><title>T{i}</title><script>var a="<p>x</p>"</script></head><body>
<div class="c1"><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></div><div class="c2">{art}</div>
<div class="c9"><h4>Most read</h4><a href=1>Link one {i}</a></div>{extra}
<div id="comments"><p>Nice post {i}</p></div><form><p>Sign up</p><input></form><footer>(c) {i}</footer>"""


def own_text(html):
    """The main text of a page by its own wrapper."""
    return wrappers.text_of(html, wrappers._Rule(wrappers.main_regions(wrappers.of_page(html))))


ARTICLES = [
    ("<h1>Title &amp; one</h1><p>First para <b>bo</b>ld &lt;x&gt;<p>Second &eacute; para", "Title & one First para bold <x> Second é para"),
    ("<h1>Two</h1><p>Line\n one<br>line   two</p>", "Two Line one line two"),
    ("<h1>Three</h1><ul><li>one<li>two</ul><p>x <i>y</i> z</p>", "Three one two x y z"),
    ("<h1>Four</h1><!-- <p>no</p> --><p>a&nbsp;b</p><style>p{}</style><p></p>", "Four a b"),
]


def test_wrapper_finds_an_unnamed_region(spark):
    rows = [(i, f"http://h.org/{i}", page(i, a, '<div class="cookie-notice">We use</div>' * (i % 2)), "q", 1, "z")
            for i, (a, _) in enumerate(ARTICLES)]
    rows += [(100, "http://h.org/x", None, "q", 1, "z"), (101, "http://h.org/y", "", "q", 1, "z"), (102, None, "bare text", "q", 1, "z"),
             (103, "http://g.org/", "<p>unclosed <", None, None, None), (100, "http://h.org/x", None, "q", 1, "z")]
    got = [(r.page_id, r.url, r.text) for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()]
    assert len(got) == len(rows)
    text = {i: t for i, _, t in got}
    assert [text[i] for i in range(4)] == [t for _, t in ARTICLES]
    assert (text[100], text[101], text[102], text[103]) == ("", "", "bare text", "unclosed <")


def test_named_articles_and_comments():
    html = ('<body><nav>menu</nav><main><article><header>h</header><h1>A</h1><p>B<aside>side</aside><section class="comments">'
            '<p>c</p></section></article><article class="comment">no</article></main>')
    assert own_text(html) == "A B"


def test_mismatches_become_slots_optionals_and_repeats():
    pages = ["<body><h1>x</h1><p>same</p><p>same</p></body>", "<body><h1>y</h1><h2>odd</h2><p>same</p></body>",
             "<body><h1>z</h1><dl><dt>a<dd>b<dt>c<dd>d</dl></body>"]
    one = wrappers.of_page(pages[0])
    for p in pages[1:]:
        one = wrappers._merge(one, wrappers.of_page(p))
    said = one.expression()
    assert said == '<><body><h1>#</> <h2>"odd"</>? <p>"same"</>+? <dl>(<dt>#</> <dd>#</>)+</>?</></>'


def test_hot_host_and_copies(spark):
    copy = page(1, ARTICLES[0][0])
    rows = [(i, f"http://h.org/{i % 7}", copy, "q", 1, "z") for i in range(200)]
    got = wrappers.main_text(spark.createDataFrame(rows, PAGES).repartition(9))
    assert {r.text for r in got.collect()} == {ARTICLES[0][1]}


def test_long_and_odd_pages(spark):
    long = "<body><article>" + "".join(f"<p>{' '.join(words(50, i))}</p>" for i in range(400)) + "</article>"
    rows = [(1, "http://a.org/", long, "q", 1, "z"), (2, "http://a.org/", "<" * 3000, "q", 1, "z"),
            (3, "http://a.org/", "<div " * 300 + ">x", "q", 1, "z"), (4, "http://a.org/", "</p></div></x>" * 100, "q", 1, "z")]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[1] == " ".join(" ".join(words(50, i)) for i in range(400))
    assert wrappers.main_text(spark.createDataFrame([], PAGES)).collect() == []


def consonants(rng):
    return "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7))


ODD = {
    "nested": lambda rng: "<body>" + "<div>" * 5000 + "deep text" + "</div>" * 5000,
    "no end": lambda rng: "<p>deep text</p>" + "<a " * 340_000,
    "quotes": lambda rng: "<p>deep text</p>" + '<a "x" ' * 150_000,
    "open quotes": lambda rng: "<p>deep text</p>" + "<a \"x '" * 130_001,
    "unlike": lambda rng: "<body>" + "".join(f"<div class={consonants(rng)}>deep text</div>" for _ in range(20_000)),
    "list": lambda rng: "<body><div>" * 300 + "<ul>" + "<li>deep text" * 5000,
    "stray ends": lambda rng: "<ul><li>" + "<div>" * 3000 + "<p>deep text" * 2000 + "</section>" * 5000,
    "classes": lambda rng: '<div class="' + "a-" * 400_000 + '">deep text',
}


@pytest.mark.parametrize("kind", ODD)
def test_odd_pages_take_linear_time(kind):
    """Deep nesting, tags without end, thousands of unlike siblings: read without error, in seconds."""
    html, start = ODD[kind](random.Random(1)), time.process_time()
    assert "deep text" in own_text(html)
    assert time.process_time() - start < 8


def test_class_names_that_differ_by_page_stay_bounded():
    rng, one = random.Random(2), None
    for i in range(400):
        names = [consonants(rng) for _ in range(10)]
        own = wrappers.of_page("<body><div id=main>" + "".join(f"<div class={n}>text {n}</div>" for n in names) + "</div><footer>f</footer>")
        one = own if one is None else wrappers._merge(one, own)
    assert len(wrappers.encoded(one)) < 20_000
    assert wrappers.decoded(wrappers.encoded(one)).expression() == one.expression()
    assert wrappers.main_regions(one)["regions"] == [("body", "div.main")]


@pytest.mark.parametrize("named", ['class="content no-sidebar"', 'id="page-with-header"', 'class="market-share-report"', 'class="sidebar-layout"'])
def test_class_words_never_lose_the_article(named):
    html = f"<body><nav>menu</nav><div {named}><h1>T</h1><p>{'word ' * 30}</p></div><footer>f</footer>"
    assert own_text(html) == "T " + " ".join(["word"] * 30)


def test_small_groups_with_class_words_go():
    html = ('<body><article><p>One two three.</p><div class="share-buttons">Share it</div><p>Let <math><mi>x</mi></math> be.</p>'
            '<div class="newsletter-signup"><p>Sign up</p></div><section id="post-comments"><p>' + "reader " * 90 + "</p></section></article>")
    assert own_text(html) == "One two three. Let x be."


def test_texts_on_all_pages_go_but_copies_stay(spark):
    """A sentence that every article of a host repeats is left out; a host of copies keeps its text."""
    rows = [(i, f"http://h.org/{i}", f"<body><article><h1>Title {i}</h1><p>{' '.join(words(60, i))}</p><p>Read more of us.</p></article>", "q", 1, "z")
            for i in range(6)]
    rows += [(10 + i, f"http://c.org/{i}", "<body><article><h1>Copy</h1><p>the same words</p></article>", "q", 1, "z") for i in range(6)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == f"Title 3 {' '.join(words(60, 3))}"
    assert got[12] == "Copy the same words"


def plain_alignment(a, b):
    """Length of the longest common alignment of two lists of labels, by recursion."""
    if not a or not b:
        return 0
    if a[0] == b[0]:
        return 1 + plain_alignment(a[1:], b[1:])
    return max(plain_alignment(a[1:], b), plain_alignment(a, b[1:]))


def test_alignment_matches_brute_force():
    """What both sequences have is never optional and as long as can be; every part of either is matched."""
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([f"t{x}" for x in rng.sample(range(7), rng.randint(0, 6))] for _ in range(2))
        out = wrappers._align([wrappers.Node(x) for x in a], [wrappers.Node(x) for x in b])
        flat = [p for n in out for p in (n.parts if n.label == wrappers.GROUP else [n])]
        assert sum(not p.optional and not p.repeated for p in flat) <= plain_alignment(a, b)
        assert {p.label for p in flat} == {*a, *b}
        if len(flat) == len({*a, *b}):  # nothing folded
            assert sum(not p.optional for p in flat) == plain_alignment(a, b)


def test_labels_leave_out_machine_made_names():
    assert wrappers._label("div", ' class="css-1x2ab9 mainText post-123" id=top') == "div.css.main-text.post.top"
    assert wrappers.around("div.post-comments") and not wrappers.around("div.no-sidebar") and not wrappers.around("div.market-share-report")
