import itertools
import random
import re
from html import unescape

from widelog.llm.html_text import Page, extracted, main_text, minimum_cut


def test_small_table_against_its_article(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r["page_id"]: r for r in extracted(pages).collect()}
    for r in pages.collect():
        body = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub("</?b>", "", x)).split()) for x in re.split("<(?:p|/p|h1|/h1|br)>", body)]
        want = " ".join(x for x in parts if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


def test_minimum_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 8)
        lean = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 1.5)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(side):
            return sum(-x for x, k in zip(lean, side) if k) + sum(w for a, b, w in edges if side[a] != side[b])

        assert abs(cost(minimum_cut(lean, edges)) - min(map(cost, itertools.product([False, True], repeat=n)))) < 1e-9


PAGE = """<html><head><title>T</title></head><body><header><h2>Site</h2></header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies. Accept them.</div>
<main><h1>The title</h1><p>First paragraph of the story &amp; more, with <b>bo</b>ld   text.</p><script>var x = "<p>no</p>";</script><p>Second one, which has a <a href=y>link</a> in it.</p>
<form><label>Name</label><input></form><div class=ad>Buy this now.</div></main><div id="comments"><p>Great article, I liked it very much.</p></div><aside>Related things</aside><footer>Copyright</footer></body></html>"""


def test_parts_of_a_page():
    assert main_text(PAGE) == "The title First paragraph of the story & more, with bold text. Second one, which has a link in it."


ARTICLE = "<h1>The story</h1><p>First paragraph of three ordinary ones, with a few words.</p><p>Second paragraph, also ordinary.</p><p>Third.</p>"
TOLD = "The story First paragraph of three ordinary ones, with a few words. Second paragraph, also ordinary. Third."


def test_names_of_whole_pages_condemn_nothing():
    for page in (
        f'<body class="single-post no-sidebar comments-open">{ARTICLE}</body>',
        f'<body class="has-sidebar"><article>{ARTICLE}</article></body>',
        f'<div class="content-with-share-bar">{ARTICLE}</div>',
        f'<main id="search-landing-main">{ARTICLE}</main>',
        f'<div class="sidebar-layout"><nav><a href=x>Home</a></nav><article>{ARTICLE}</article></div>',
        f"<form id=page>{ARTICLE}<input></form>",
        f"<div data-hidden='false' title='A hidden gem'>{ARTICLE}</div>",
    ):
        assert main_text(page) == TOLD
    assert main_text("<div><p>Short.</p><p>Also short.</p><p>Done.</p></div>") == "Short. Also short. Done."


def test_parts_that_go():
    comment = "I really do not think that this is a good article at all, since it does not say anything that I did not know before, and it says so at length. So there."
    for more in (
        f'<section id="comments"><article class="comment"><div class="comment-body"><p>{comment}</p></div></article></section>',
        "<aside><h3>More</h3><p>Something else is over here.</p></aside>",
        '<div class="related"><article><h3><a href=q>Next</a></h3><p>Teaser of the next one, short.</p></article></div>',
        "<footer><div><div><p>All rights are reserved, and nothing here may be copied without a written word from us, ever, and we mean it.</p></div></div></footer>",
        '<div style="display: none"><p>Nobody is to see this sentence, however long it goes on and on.</p></div>',
        "<select><option>One</option><option>Two</option></select><template><p>A sentence that is never shown to anyone at all.</p></template>",
    ):
        assert main_text(f"<body><article>{ARTICLE}</article>{more}</body>") == TOLD


def test_attributes_are_read_by_the_standard():
    assert main_text(f"<article>{ARTICLE}<p title='it's fine'>Here it isn't.</p><p>Don't worry.</p></article>") == TOLD + " Here it isn't. Don't worry."
    assert main_text('<article><p data-x=a>b" c>One.</p><p class = "x>y" / id=z>Two.</p></article>') == 'b" c>One. Two.'
    assert main_text("<article><p>Let <math><mi>x</mi> = 2</math> be.</p><!--> <p>So.</p><!-- > --> <p>End.</article>") == "Let x = 2 be. So. End."


def test_cut_decides_where_the_sign_is_wrong():
    """Short lines between paragraphs lean to boilerplate, a sentence in a menu to content; their neighbours say otherwise."""
    long = "This paragraph goes on for long enough to be taken as content without any doubt, since it has words and a full stop."
    menu = "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(6))
    page = Page(f"<div><p>{long}</p><p>A short line</p><p>{long}</p><p>Another one</p><p>{long}</p></div><ul>{menu}<li>We open at nine.</li>{menu}</ul>")
    odds = [page.leaning(k) for k in range(len(page.blocks))]
    kept = minimum_cut(odds, page.edges())
    wrong = {page.blocks[k][0] for k, x in enumerate(odds) if (x > 0) != kept[k]}
    assert wrong == {"A short line", "Another one", "We open at nine."}
    assert [page.blocks[k][0] for k, x in enumerate(kept) if x] == [long, "A short line", long, "Another one", long]


def test_broken_pages_take_linear_time():
    assert main_text("<div>" * 30_000 + "</p></span></b>" * 30_000 + "<article><p>One sentence is here.</p>") == "One sentence is here."


def test_plain_and_broken_markup():
    long = "This is a long enough sentence of plain text that has no landmark around it at all, and it goes on. "
    assert main_text(f"<div><p>{long}<p>{long}<div") .startswith("This is a long enough")
    assert main_text("<article><p>a < b and c > d &lt;p&gt; &#233;&nbsp;x <!-- no --> y") == "a < b and c > d <p> é x y"
    assert main_text("<article><p title='a > b \" c'>Unclosed <b>and <i>nested") == "Unclosed and nested"
    assert main_text("") == main_text(None) == main_text("<script>never closed") == ""
    assert len(main_text("<article>" + "<p>word word word.</p>" * 20_000)) > 100_000


def test_awkward_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (None, "u", "", "t"), (2, "u", PAGE, "t"), (2, "u", PAGE, "t")], "page_id long, url string, html string, text string")
    rows = extracted(pages).collect()
    assert len(rows) == 4 and [r["n_chars"] for r in rows[:2]] == [0, 0] and rows[0]["text"] == ""
    assert extracted(pages.limit(0)).count() == 0
