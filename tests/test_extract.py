import pytest

from shelfwise.operators import extract

AMAZON = '''<html><div class="s" data-component-type="s-search-result"><h2 class="t"><a class="l" href="/dp/1?x=1&amp;y=2">
<span>Mens <b>Shirt</b> &amp; Tie </span></a></h2><span class="a-price-whole">1,299</span>
<i class="x a-icon-alt">4.3 out of 5 stars</i><img class="s-image" src="https://i/1.jpg"></div>
<div data-component-type='s-search-result'><h2><a href="https://www.amazon.in/dp/2"><span>Bare</span></a></h2></div>
<div data-component-type="s-search-result"><span class="a-price-whole">5</span></div></html>'''
FLIPKART = '''<div data-id="A"><a title="Kurta" href="/k/1"><img src="//i/k.jpg"></a><div class="x _30jeq3">₹499</div>
<div class="_3LWZlK">4.1</div></div><div data-id="B"><a href="/no-title">x</a></div>'''
MYNTRA = '''<li class="product-base"><a href="roadster/1"><img class="img product-image" src="u.jpg"/></a>
<h3 class="product-brand">Roadster</h3><h4 class="product-product">Tee</h4>
<span class="product-discountedPrice">Rs. 599</span><span class="product-rating">4.4</span></li>'''
VOGUE = "".join(f'<article><a href="/a/{i}"><h2 class="h">{"Fashion" if i % 2 else "Food"} {i}</h2></a></article>'
                for i in range(20))
HM = '''<article class="item hm"><img src="a.jpg"><h3 class="item-heading"><a href="/p.1.html">Dress</a></h3>
<span class="price regular">Rs. 999</span></article><article class="itemized"><h3>not an item</h3></article>'''


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "https://www.amazon.in/s?k=a", "Amazon", AMAZON),
            (2, "https://www.flipkart.com/search?q=a", "Flipkart", FLIPKART),
            (3, "https://www.myntra.com/mens-shirts", "Myntra", MYNTRA),
            (4, "https://www.vogue.in/fashion", "Vogue", VOGUE),
            (5, "https://www2.hm.com/en_in/search", "H&M", HM),
            (6, "https://www.amazon.in/s?k=b", "Amazon", "<html>robot check</html>")]
    return spark.createDataFrame(rows, "page_id long, url string, source string, html string")


@pytest.fixture(scope="module")
def records(spark, pages):
    rows = extract.harvest(pages, extract.rules_table(spark)).orderBy("page_id", "pos").collect()
    return {s: [r for r in rows if r["source"] == s] for s in ("Amazon", "Flipkart", "Myntra", "Vogue", "H&M")}


def fields(row):
    return tuple(row[f] for f in ("name", "price", "rating", "image_url", "product_url"))


def test_prefixed_price_and_missing_fields(records):
    assert [fields(r) for r in records["Amazon"]] == [
        ("Mens Shirt & Tie", "₹1,299", "4.3 out of 5 stars", "https://i/1.jpg",
         "https://www.amazon.in/dp/1?x=1&y=2"),
        ("Bare", "N/A", "N/A", "N/A", "https://www.amazon.in/dp/2")]


def test_attribute_names(records):
    assert [fields(r) for r in records["Flipkart"]] == [
        ("Kurta", "₹499", "4.1", "//i/k.jpg", "https://www.flipkart.com/k/1")]


def test_list_items(records):
    assert [fields(r) for r in records["Myntra"]] == [
        ("Roadster", "Rs. 599", "4.4", "u.jpg", "https://www.myntra.com/roadster/1")]


def test_articles_are_limited_before_the_keyword(records):
    assert [r["name"] for r in records["Vogue"]] == [f"Fashion {i}" for i in range(1, 15, 2)]
    assert {fields(r)[1:3] for r in records["Vogue"]} == {("N/A", "N/A")}


def test_source_without_rating(records):
    assert [fields(r) for r in records["H&M"]] == [
        ("Dress", "Rs. 999", "N/A", "a.jpg", "https://www2.hm.com/p.1.html")]


def test_pages_without_items_are_listed(spark, pages):
    unruled = spark.createDataFrame([(7, "u", "Unknown", "<li>x</li>"), (8, "u", None, "x"), (9, "u", "Amazon", None)], pages.schema)
    skipped = extract.skipped_pages(pages.union(unruled), extract.rules_table(spark))
    assert sorted((r["page_id"], r["reason"]) for r in skipped.collect()) == [
        (6, "no item"), (7, "no rule"), (8, "no rule"), (9, "no item")]


INDENTED = {
    "Amazon": ("""<div data-component-type="s-search-result">
  <div><h2>
     <a href="/dp/9"> <span>
        Red   dress&nbsp;&#8377;&#x2019;
     </span></a></h2></div>
</div>
<footer><span class="a-price-whole">0</span><img class="s-image" src="/logo.png"><a href="/privacy">p</a></footer>""",
               ("Red dress ₹’", "N/A", "N/A", "N/A", "https://www.amazon.in/dp/9")),
    "Flipkart": ("""<div data-id="A">\n <div> <a title="Kurta  Set" href="/k"></a> </div>\n</div>
<div class="_30jeq3">0</div><img src="/logo.png">""", ("Kurta Set", "N/A", "N/A", "N/A", "https://www.flipkart.com/k")),
    "Myntra": ("""<ul><li class="product-base">
   <h3 class="product-brand">
      Road\tster </h3></li></ul><a href="/privacy">x</a><span class="product-rating">1</span>""",
               ("Road ster", "N/A", "N/A", "N/A", "N/A")),
    "Vogue": ("""<article>\n<h2>\n  Fashion &amp;\n now </h2></article><footer><img src="/logo.png"><a href="/privacy">x</a></footer>""",
              ("Fashion & now", "N/A", "N/A", "N/A", "N/A")),
    "H&M": ("""<article class="item">
   <h3 class="item-heading">
      Red dress
   </h3>
   <span class="price">
      1,299
   </span></article><div><span class="price">0</span><img src="/logo.png"><a href="/privacy">x</a></div>""",
            ("Red dress", "1,299", "N/A", "N/A", "N/A")),
}


@pytest.mark.parametrize("source", INDENTED)
def test_items_end_with_their_element(spark, source):
    html, expected = INDENTED[source]
    page = spark.createDataFrame([(1, "https://x.example/p", source, html)], "page_id long, url string, source string, html string")
    rows = extract.harvest(page, extract.rules_table(spark)).collect()
    assert [fields(r) for r in rows] == [expected]


def test_nested_and_unclosed_elements(spark):
    html = "a<li>1<ul><LI >in</LI></ul>2</li>out<li>3<b>x</b><li>4</li >after"
    page = spark.createDataFrame([(1, "u", "s", html)], "page_id long, url string, source string, html string")
    rule = extract.rules_table(spark, [extract.Rule("s", None, "<li>", "x", None, None, None, None)])
    items = extract.explode_items(page, rule).orderBy("pos").collect()
    assert [r["item"] for r in items] == ["<li>1<ul><LI >in</LI></ul>2</li>", "<li>3<b>x</b>", "<li>4</li >"]


def test_items_cover_the_page_from_the_first_mark(spark, pages):
    items = extract.explode_items(pages, extract.rules_table(spark))
    counts = {r["page_id"]: r["count"] for r in items.groupBy("page_id").count().collect()}
    assert counts == {1: 3, 2: 2, 3: 1, 4: 20, 5: 1}
