from __future__ import annotations

from fernlink.llm import style_tree


def test_tree_judges_inside_and_outside_articles(spark):
    """Neutral tags and classes: only the style tree can tell the notice inside the article and the box outside, and that the body is in plain divs."""
    page = "<body><div class='b7'>Same box {{0}}</div><article><h1>Head {0}</h1><div class='x7'>Read this <b>everywhere</b></div><p>Body {0} and a <b>note</b> more</p></article></body>".replace("{{0}}", "of all")
    small = "<body><div class='wrap'><div class='x1'>Same top</div><div class='x2'>Same mid</div><div class='x3'>Same low</div><div class='x4'>Same end</div><div class='t'><p>Story {0} in plain divs</p></div><article><p>Teaser</p></article></div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(40)] + [(100 + i, f"http://s.example/{i}", small.format(i)) for i in range(40)]
    rows += [(200, "http://one.example/", page.format(1))]
    out = {r.page_id: r.text for r in style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[7] == "Head 7\n\nBody 7 and a note more"
    assert out[107] == "Story 7 in plain divs"
    assert out[200] == "Same box of all\n\nHead 1\n\nRead this everywhere\n\nBody 1 and a note more"  # one page is no evidence


def test_names_that_an_article_uses_itself_stay(spark):
    """Inside an article, only names that cannot be its own text drop a block; headings never go by their name."""
    html = (
        '<html><body><div class="site-header">Site</div><div class="search">Find</div><article><h1 class="post-header">Title</h1><h2 class="related">Related work</h2><p>One &amp; two.</p>'
        '<div class="legal">The law of it.</div><p class="side">Aside of it.</p><div class="comment-list">Nice!</div><div class="ad">Buy</div></article></body></html>'
    )
    got = style_tree.extract(spark.createDataFrame([(1, "https://a.example/x", html)], "page_id long, url string, html string")).first()
    assert got.text == "Title\n\nRelated work\n\nOne & two.\n\nThe law of it.\n\nAside of it."


def test_very_long_page_and_extra_columns(spark):
    body = "".join(f"<p>Block {i} of a very long page.</p>" for i in range(60_000))
    rows = [(1, "https://a.example/x", f"<html><body><nav>Menu</nav><article>{body}</article></body></html>", "x", 1), (1, "https://a.example/x", None, "x", 1), (None, None, "", None, None)]
    got = style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, page long")).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, sum(len(f"Block {i} of a very long page.") for i in range(60_000)) + 2 * 59_999]
