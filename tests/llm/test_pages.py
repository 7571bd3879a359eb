import math
import re
from html import unescape
from html.parser import HTMLParser

from gapweave.llm import pages
from gapweave.llm.pages import extract, main_text


def fold(text):
    return " ".join(unescape(text).split())


def test_whole_table_against_the_article_elements(spark, folder):
    """The generated pages hold one article of h1, p, b and br."""
    rows = spark.read.parquet(f"{folder}/pages.parquet")
    want = {}
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))
        want[r["page_id"]] = " ".join(x for x in map(fold, parts) if x)
    got = extract(rows).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


STORY = "<p>The first paragraph tells how it began, with enough words to stand as text.</p><p>The second one says how it went on, &amp; on.</p>"
TOLD = "The first paragraph tells how it began, with enough words to stand as text. The second one says how it went on, & on."
AROUND = [
    '<nav><a href="/">Home</a><a href="/b">Blog and more words in a long menu entry</a></nav>',
    '<div class="menu"><ul><li><a>one</a><li><a>two</a></ul></div>',
    '<header class="site"><p>The site of many words, as a header holds them often enough.</p></header>',
    '<aside><p>A sidebar tells other things, and it may be long as well, longer than all.</p></aside>',
    '<div id="cookie-notice"><p>We use cookies, which is told at length to everyone who comes here.</p></div>',
    '<div class="ad"><p>Buy now, this is the best of all things that you can buy in this world.</p></div>',
    '<form><p>Your name and address and whatever else we want to know of you, dear reader.</p><input name="x"></form>',
    '<script>var t = "<p>not a paragraph at all, though it looks like one</p>";</script>',
    '<style>p { margin: 0 }</style>',
    '<section class="comments"><p>I am a reader and I say this is great, great, great, great and great again.</p></section>',
    '<footer><p>All rights reserved, and here follow many more words on rights and reserves.</p></footer>',
]


def page(before, middle, after):
    return f"<!DOCTYPE html><html><head><title>No text</title></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>"


def test_everything_around_is_left_out():
    for middle in (f"<article>{STORY}</article>", f"<main><div>{STORY}</div></main>", f'<div class="post">{STORY}</div>'):
        for piece in AROUND:
            assert main_text(page([piece], middle, [])) == TOLD, piece
            assert main_text(page([], middle, [piece])) == TOLD, piece
        assert main_text(page(AROUND[:5], middle, AROUND[5:])) == TOLD
    for piece in AROUND:
        assert main_text(page([], f"<article>{STORY}{piece}</article>", [])) == TOLD, piece


def test_blocks_white_space_and_references():
    assert main_text("<article><h1>Ti<b>t</b>le</h1>\n <p> a \n\t b&nbsp;c<br>d<p>e&lt;p&gt; &#233;</article>") == "Title a b c d e<p> é"
    assert main_text("<table><tr><td>one<td>two<tr><td>three</table>") == "one two three"
    assert main_text("<ul><li>a<li>b</ul>") == "a b"


def test_odd_pages(spark):
    for odd in (None, "", " ", "<", "<p", "<!-- open", "<script>x", "</p></div>", "<a href='x>y", "<br/><br/>"):
        assert isinstance(main_text(odd), str)
    assert main_text("plain &amp; simple") == "plain & simple"
    deep = "<div>" * 3000 + "<p>deep down</p>" + "</div>" * 3000
    assert main_text(deep) == "deep down"
    long = "<article>" + "<p>word word word</p>" * 20000 + "</article>"
    assert len(main_text(long)) == 20000 * 15 - 1
    rows = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "<p>a</p>", "x"), (None, None, "<p>a</p>", "y")],
                                 "page_id long, url string, html string, text string")
    assert sorted(map(str, (r["text"] for r in extract(rows).collect()))) == ["", "a", "a"]
    assert extract(rows.limit(0)).count() == 0


WRAPPERS = ['class="content-sidebar-wrap"', 'class="with-sidebar"', 'class="no-sidebar"', 'id="page" class="nav-open"', 'class="has-banner"']


def test_wrappers_named_like_junk_do_not_hide_the_article():
    for middle in (f"<article>{STORY}</article>", f"<main><div>{STORY}</div></main>", f'<div class="post">{STORY}</div>'):
        for wrapper in WRAPPERS:
            for inner in (middle, f'<div class="no-sidebar">{middle}</div>'):
                assert main_text(page(AROUND[:1], f"<div {wrapper}>{inner}</div>", AROUND[-1:])) == TOLD, wrapper
                assert main_text(page([], f"<main><div {wrapper}>{inner}{AROUND[5]}</div></main>", [])) == TOLD, wrapper


def test_articles_in_junk_beside_the_article_stay_out():
    other = "<article><p>" + "Another story is told here at great length. " * 20 + "</p></article>"
    for name in ("related", "comments", "sidebar"):
        junk = f'<div class="{name}">{other}</div>'
        for whole in (f"<article>{STORY}</article>{junk}", f"<main><article>{STORY}</article>{junk}</main>"):
            assert main_text(page([], whole, [])) == TOLD, name
            assert main_text(page([], f'<div class="with-sidebar">{whole}</div>', [])) == TOLD, name
    talk = '<section class="comments"><p>' + "I read this and say so. " * 30 + "</p></section>"
    assert main_text(page([], f"<article>{STORY}{talk}</article>", [])) == TOLD


def test_bare_text_beside_the_chosen_node_is_taken():
    lead = "The lead stands bare in the body and tells in many words, and in <b>bold</b> ones too, what the story will be about."
    told = re.sub("</?b>", "", lead)
    assert main_text(page([lead], f"<div>{STORY}</div>", [])) == f"{told} {TOLD}"
    assert main_text(page([], f"<div>{STORY}</div>", [f"{lead}<br>{lead}"])) == f"{TOLD} {told} {told}"
    assert main_text(page(["Menu |"], f"<div>{STORY}</div>", ["(c) us"])) == TOLD


def test_an_articles_header_keeps_its_headings():
    header = '<header class="entry"><div><h1>The title</h1></div><p>Posted in a section of the site</p><h2>And below</h2></header>'
    assert main_text(page([], f"<article>{header}{STORY}</article>", [])) == f"The title And below {TOLD}"


class Tree(HTMLParser):
    """Elements of a well-formed page as [tag, children]."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.open = [["page", []]]
        self.feed(html)
        self.body = self.open[0][1][0]

    def handle_starttag(self, tag, attrs):
        self.open[-1][1].append([tag, []])
        self.open.append(self.open[-1][1][-1])

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][1].append(data)


def counts(node):
    """Characters, tags, link characters, link tags below a node."""
    c = t = lc = lt = 0
    for child in node[1]:
        if isinstance(child, str):
            c += len(child.strip())
        else:
            a, b, d, e = counts(child)
            link = child[0] == "a"
            c, t, lc, lt = c + a, t + b + 1, lc + (a if link else d), lt + e + link
    return c, t, lc, lt


def density(node, body):
    c, t, lc, lt = counts(node)
    cb, _, lcb, _ = counts(body)
    if not c:
        return 0.0
    t, gain = max(t, 1), max(c * max(t, 1) / (max(lc, 1) * max(lt, 1)), 1.0)
    return c / t * math.log(gain) / math.log(math.log(lc * c / max(c - lc, 1) + c * lcb / cb + math.e**math.e))


def paths(node, above=()):
    yield (node, *above)
    for child in node[1]:
        if not isinstance(child, str):
            yield from paths(child, (node, *above))


def test_densities_and_threshold_against_brute_force():
    import random

    rng = random.Random(2)
    words = "it is told at length how all began and went on".split()

    def part(depth):
        kind = rng.choice(["p", "div", "a", "section", "text"] if depth else ["div", "section"])
        if kind == "text" or depth > 4:
            return " ".join(rng.choices(words, k=rng.randint(1, 30)))
        return f"<{kind}>{''.join(part(depth + 1) if kind in ('div', 'section') else part(9) for _ in range(rng.randint(1, 4)))}</{kind}>"

    for _ in range(200):
        html = f"<body>{''.join(part(0) for _ in range(3))}</body>"
        root = pages.parse(html)
        pages._measure(root)
        got = pages._path(root)
        body = Tree(html).body
        best = max(sum(density(c, body) for c in p[0][1] if not isinstance(c, str)) for p in paths(body))
        assert math.isclose(got[0].total, best)
        reached = [p for p in paths(body) if math.isclose(sum(density(c, body) for c in p[0][1] if not isinstance(c, str)), best)]
        assert any(math.isclose(pages._threshold(got), min(density(n, body) for n in p)) for p in reached)


def test_parts_of_a_story_in_sibling_articles_stay_together():
    more = f"<article>{STORY}</article>"
    assert main_text(page(AROUND, more * 3, AROUND)) == " ".join([TOLD] * 3)
    assert main_text(page([], f"{more}<article><a>Read on</a></article>", [])) == TOLD
    assert main_text(page([], f"<main><h1>The title</h1>{more}</main>", [])) == f"The title {TOLD}"


def test_names_that_hold_a_junk_word_do_not_take_text_away():
    long = "He told of it again and again, to all who came by and to those who did not, for as long as there was time to tell it."
    for block in (f'<div class="overflow-hidden"><p>{long}</p></div>', f'<section id="social-history"><p>{long}</p></section>'):
        assert main_text(page([], f"<article>{STORY}{block}</article>", [])) == f"{TOLD} {long}", block
    inline = '<p>He used the <span class="search-term">word</span> twice, and <math><mi>x</mi></math> once.</p>'
    assert main_text(page([], f"<article>{STORY}{inline}</article>", [])) == f"{TOLD} He used the word twice, and x once."
    pressed = "<p>Then press the <button>left</button> one and read its <label>name</label> aloud.</p><button>Share</button>"
    assert main_text(page([], f"<article>{STORY}{pressed}</article>", [])) == f"{TOLD} Then press the left one and read its name aloud."
    for junk in ("sidebar-left", "comment-list", "ad-container", "site-footer", "related-posts", "ad-slot-1"):
        assert main_text(page([], f'<article>{STORY}<div class="{junk}"><p>{long}</p></div></article>', [])) == TOLD, junk
    links = f'<div class="social-history"><a href="/x">{long}</a><a href="/y">more</a></div>'
    assert main_text(page([], f"<article>{STORY}{links}</article>", [])) == TOLD
