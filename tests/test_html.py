from conftest import plan_text, rows
from hypothesis import given
from hypothesis import strategies as st

from lakeloom.sources.html import _Elements, page_elements, page_links, page_titles, parse_html, product_items
from lakeloom.sources.tables import inline_rows

CARD = """
<article class="product_pod">
  <div class="image_container"><a href="catalogue/{n}/index.html"><img src="x.jpg" alt="{title}" class="thumbnail"></a></div>
  <p class="star-rating {stars}"><i class="icon-star"></i></p>
  <h3><a href="catalogue/{n}/index.html">short</a></h3>
  <div class="product_price"><p class="price_color">£{price}</p>
    <p class="instock availability"><i class="icon-ok"></i>

        In stock

    </p><form></form></div>
</article>"""


def test_product_items(spark):
    html = (
        "<!DOCTYPE html><html><body><p>unclosed<br><script>var t='</p><article class=\"product_pod\">';</script>"
        + CARD.format(n=1, title="Tipping &amp; Velvet", stars="One", price="53.74")
        + CARD.format(n=2, title="Soumission", stars="Three", price="50.10")
        + '<article class="other"></article><article class="product_pod"></article>'
    )
    pages = spark.createDataFrame([(7, html), (8, "<p>none"), (9, None)], "page_id bigint, html string")
    assert rows(product_items(pages)) == [
        (7, 0, "Tipping & Velvet", "£53.74", "In stock", "One", "catalogue/1/index.html"),
        (7, 1, "Soumission", "£50.10", "In stock", "Three", "catalogue/2/index.html"),
        (7, 2, None, None, "", None, None),
    ]


def test_titles_and_links(spark):
    html = "<title>A &lt;b&gt;</title><a href='/x'>to <b>x</b></a><a name=q>no</a><!-- <a href='/c'> --><a href=/y>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert rows(page_titles(pages), "title") == [("A <b>",)]
    assert rows(page_links(pages), "pos", "href", "link_text") == [(0, "/x", "to x"), (1, "/y", "")]


def test_text_keeps_page_order(spark):
    html = "<a href='/1'>foo <b>bar</b> baz <i>x<u>y</u></i>z</a><ul><li><a href=/2>one<li><a href=/3>two</ul>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert rows(page_links(pages), "href", "link_text") == [("/1", "foo bar baz xyz"), ("/2", "one"), ("/3", "two")]


def test_open_paragraphs_end_at_blocks(spark):
    card = CARD.format(n=1, title="T", stars="One", price="1").replace('</i></p>\n  <h3>', '</i>\n  <h3>')
    assert card.count("</p>") == 2
    pages = spark.createDataFrame([(1, card)], "page_id int, html string")
    assert rows(product_items(pages)) == [(1, 0, "T", "£1", "In stock", "One", "catalogue/1/index.html")]
    drawing = spark.createDataFrame([(1, "<title>Page</title><svg><title>Icon</title></svg>")], "page_id int, html string")
    assert rows(page_titles(drawing), "title") == [("Page",)]


PIECES = [
    '<a href="x">', "<a>", '<A HREF=y name="z">', "</a>", "<p>", "</p>", "<div>", "</div>", "<svg>", "</svg>", "<title>", "</title>", "<li>", "<ul>", "</ul>",
    "<br>", "<br/>", "<svg/>", "<td>", "</table>", "text ", "&amp;", "<script>a</script>", "<!-- c -->", '<a href="s"/>', "</x>", "<math>", '<a href="q" href>',
]


@given(st.lists(st.sampled_from(PIECES), max_size=25))
def test_elements_equal_those_of_the_tree(pieces):
    """Titles and links without a tree are those that a walk over the tree finds."""
    html = "".join(pieces)
    root, events = parse_html(html), _Elements()
    events.feed(html)
    events.close()
    links = [(n.attrs["href"], n.all_text()) for n in root.walk() if n.tag == "a" and "href" in n.attrs]
    titles = [n.all_text() for n in root.titles()]
    assert [(h, "".join(t)) for k, h, t in events.found if k == "link"] == links
    assert ["".join(t) for k, _, t in events.found if k == "title"] == titles


def test_titles_and_links_from_one_parse(spark):
    pages = inline_rows(spark, [(1, '<title>T</title><a href="a">x<b>y</b></a><a href="b">z'), (2, None), (3, "")], "page_id int, html string")
    found = page_elements(pages)
    assert rows(found) == [(1, "link", 0, "a", "xy"), (1, "link", 1, "b", "z"), (1, "title", 0, None, "T")]
    assert plan_text(found).count("MapInArrow") == 1


def test_products_are_parsed_by_all_cores(spark, tables):
    from lakeloom.plans.catalog import REGISTRY

    found = REGISTRY["html_products"](spark, tables.root)
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
