"""Main text of pages built from known blocks."""

import html
import random

import pytest

from hitloom.llm import html_template as H

SCHEMA = "page_id long, url string, html string, host string, template int"


def article_page(rng, k, blocks):
    body = "".join(f"<h1>{html.escape(blocks[0])}</h1>" if not i else f"<p>{html.escape(b)}" + ("</p>" if rng.random() < 0.7 else "") for i, b in enumerate(blocks))
    return (
        f"<!DOCTYPE html><html><head><title>T{k}</title><style>p{{x:'</p>'}}</style><script>var a='</p><p>no</p>';</script></head><body>"
        f"<header>Site name</header><nav><ul><li><a href='/'>Home {rng.random()}</a></li></ul></nav><div class=\"cookie-notice\">We use <b>cookies</b></div>"
        f"<div class='ad'>Buy {rng.random()}</div><article>{body}<form><input value=x>Search</form><section class='comments'><p>First!</p></section></article>"
        f"<aside>Related</aside><footer>&copy; me</footer></body></html>"
    )


def soup_page(rng, k, blocks):
    body = "".join(f"<div class=x>{html.escape(b)}</div>" for b in blocks)
    return f"<html><body><div><a href=/a>All news</a> <a href=/b>{rng.random()}</a></div><div>Daily Paper since 1901</div><div>{body}</div><div>Printed by machines</div></body></html>"


@pytest.fixture(scope="module")
def site():
    rng = random.Random(8)
    pages = []
    for k in range(60):
        blocks = [f"Block {k} {i} " + " ".join(rng.choice("alpha beta & <gamma> 'delta' é".split()) for _ in range(rng.randrange(1, 30))) for i in range(rng.randrange(1, 6))]
        make = article_page if k % 2 else soup_page
        pages.append((k, f"http://{'a' if k % 2 else 'soup'}.example/{k}", make(rng, k, blocks), blocks))
    return pages


def test_blocks_come_back(spark, site):
    df = spark.createDataFrame([(i, u, h, "clash", 1) for i, u, h, _ in site], SCHEMA)
    got = {r.page_id: r for r in H.extract(df).collect()}
    for page_id, url, _, blocks in site:
        want = "\n\n".join(" ".join(b.split()) for b in blocks)
        assert got[page_id].text == want and got[page_id].n_chars == len(want) and got[page_id].url == url


def test_edges(spark):
    rows = [
        (1, None, None, "", 1), (2, "", "", "", 1), (3, "http://x/", "plain  text\n&amp; more", "", 1), (3, "http://x/", "plain  text\n&amp; more", "", 1),
        (4, "http://x/", "<article><p><b>one<br>two<p>three</article>", "", 1), (None, "http://x/", "<!-- <p>a</p> <article>x", "", 1),
        (5, "http://x/", "<main>" + "<p>long &eacute;</p>" * 50_000 + "</main>", "", 1), (6, "http://x/", "<article><p>1 < 2 and a<b", "", 1),
        (7, "http://x/", "<article><h1>T</h1><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "", 1),
        (8, "http://x/", "<div class=ad>x<article><p>kept</p></article>", "", 1), (9, "http://x/", "<article><header><h1>Head</h1></header><p>t</p></article>", "", 1),
    ]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == "" and got[2] == "" and got[None] == ""
    assert got[3] == "plain text & more" and got[4] == "one two\n\nthree"
    assert got[5] == "\n\n".join(["long é"] * 50_000)
    assert got[6].startswith("1 < 2 and a")
    assert got[7] == "T\n\na\n\nb\n\nc d" and got[8] == "kept" and got[9] == "Head\n\nt"
    assert H.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_template_has_constant_tokens_and_nested_classes(spark, site):
    df = spark.createDataFrame([(i, u, h, "clash", 1) for i, u, h, _ in site], SCHEMA).select("page_id", "html", H.host(H.F.col("url")).alias("host"))
    learned = {r.host: r.template for r in H.templates(df).collect()}
    tokens, nodes = H.parse(site[0][2])
    mine = {t.token for t in learned["soup.example"]}
    constant = {n.text.strip() for n in nodes if tokens[n.at] in mine}
    assert {"Daily Paper since 1901", "Printed by machines", "All news"} <= constant
    assert not any(t.startswith("Block") for t in constant)


def test_classes_out_of_order_are_not_used():
    tokens = [1, 2, 9, 1, 2, 3, 4]
    slots, used = H._slots(tokens, {1: 50, 2: 50, 3: 60, 4: 60})
    assert used >= {5, 6} and slots == [0, 0, 0, 0, 0, 1, 2]
    _, used = H._slots([1, 1, 2, 2], {1: 50, 2: 50})
    assert used == set()


def test_regions_pass_through_the_template(spark):
    """Unnamed boilerplate within articles goes; text outside articles of teasers stays."""
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice("alpha beta gamma delta eps".split()) + str(rng.randrange(999)) for _ in range(n))
    rows, want = [], {}
    for k in range(20):
        want[k] = say(30)
        rows.append((k, f"http://a/{k}", f"<html><body><article><div class=k1>All rights with us</div><p>{want[k]}</p><div class=k2>Sent by wire</div></article></body></html>", "", 1))
        body = say(60)
        want[100 + k] = body
        teasers = "".join(f"<article><a href=/{say(1)}>{say(3)}</a></article>" for _ in range(3))
        rows.append((100 + k, f"http://t/{k}", f"<html><body><h2>Our paper</h2><div class=z>{body}</div><h2>More</h2><section>{teasers}</section></body></html>", "", 1))
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_classes_that_merely_hold_a_listed_word(spark):
    pages = [
        "<body class='single no-sidebar'><article><p>kept text</p></article></body>",
        "<body><div class='content with-banner'><p>kept text</p></div></body>",
        "<body><article class='post has-comments'><p>kept text</p></article></body>",
        "<body><article><p>kept text</p><div class='share-price'>12.50</div></article></body>",
        "<html id=comments class=widget><body class=menu><main id=login class=popup><p>kept text</p></main></body>",
        "<body><article><p>kept text</p><div class='site-footer'>x</div><ul id=comment-list><li>y</ul><div class='x cookie_notice'>z</div><p class=related>r</p></article></body>",
    ]
    rows = [(k, f"http://h{k}/", page, "", 1) for k, page in enumerate(pages)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: "kept text\n\n12.50" if k == 3 else "kept text" for k in range(6)}
