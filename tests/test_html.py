from pyspark.sql import functions as F

from shelfwise.functions import html as H
from shelfwise.operators import extract
from shelfwise.plans import daily

PAGE = """<html lang="bn"><body><div class="important-banner">sale</div>
<section><div class="x imageWrapper y"><div class="name">Nor Power &amp; Co</div><div class="subText">1 kg</div>
  <div class="price"><span>৳ 1,200</span></div><div class="discountedPrice">৳ 1,100</div><br><img src=a></div>
<div class="imageWrapper"><div class="name">Vela <b>soap</b></div><p>no quantity</p>
  <div class="price">৳ 45</div></div>
<div class="imageWrapperX"><div class="name">not a card</div></div>
<div class='imageWrapper'><div class="imageWrapper"><div class="name">inner</div></div></div>
<script>var s = '<div class="imageWrapper">';</script></section></body></html>"""


def _pages(spark, html=PAGE):
    return spark.createDataFrame([(1, "Nor", html), (2, "Vela", None), (3, "Opal", "<p>no cards</p>")],
                                 "page_id long, brand string, html string")


def test_parser_cards_by_class_token(spark):
    cards = extract.parse_cards(_pages(spark), daily.SEARCH_CARD, daily.SEARCH_FIELDS, keep=("page_id", "brand"))
    rows = [r.asDict() for r in cards.orderBy("page_id", "pos_in_pg").collect()]
    assert [r["pos_in_pg"] for r in rows] == [1, 2, 3, 4]
    assert rows[0]["sku"] == "Nor Power & Co" and rows[0]["quantity"] == "1 kg"
    assert rows[0]["price_text"] == "৳ 1,200" and rows[0]["discounted_price_text"] == "৳ 1,100"
    assert rows[1]["sku"] == "Vela soap" and rows[1]["quantity"] is None and rows[1]["discounted_price_text"] is None
    # nested matches are both cards, the outer one sees the inner one's fields
    assert rows[2]["sku"] == "inner" and rows[3]["sku"] == "inner"
    assert all(r["page_id"] == 1 for r in rows)


def test_regex_form_equals_parser_on_flat_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    a = extract.parse_cards(pages, ("div", "ad")).collect()
    b = extract.class_cards(pages, "div", "ad").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == pages.count()


def test_flat_helpers(spark):
    df = _pages(spark).filter("page_id = 1")
    r = df.select(H.first_text("html", "div", "name"), H.first_text("html", "div", "nothere"),
                  extract.layout_section("html"), H.attr_value("html", "html", "lang"),
                  extract.card_count(H.all_texts("html", "div", "name")),
                  extract.nth(H.all_texts("html", "div", "name"), 9),
                  extract.fallback(H.tag_text("html", "h2"), F.lit("x"))).collect()[0]
    assert tuple(r) == ("Nor Power & Co", None, 3, "bn", 4, None, "x")


def test_positions_are_dense_and_without_global_window(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    from shelfwise.plans import views as V
    cards = V.nav_cards(spark, "/root/testdata/sf0.001")
    per = cards.groupBy("page_id").agg(F.count("*").alias("n"), F.max("pos_in_pg").alias("m"),
                                       F.min("pos_in_pg").alias("lo"))
    assert per.filter("n != m or lo != 1").count() == 0
    plan = cards._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_native_filter_sits_below_python_stage(spark):
    pages = _pages(spark)
    plan = daily.search_cards(pages)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    mip = next(i for i, line in enumerate(lines) if "MapInPandas" in line or "MapInArrow" in line)
    below = lines[mip:]
    assert any("Filter" in line and "isnotnull(brand" in line for line in below)
    assert any("Filter" in line and "Contains(html" in line and "imageWrapper" in line for line in below)


def test_regex_and_parser_agree_on_random_flat_markup(spark):
    import random
    rnd = random.Random(21)
    tokens = ["card", "cardx", "xcard", "big", "card-2", "a", "Card"]
    words = ["soap", "1 kg", "x&amp;y", "৳ 45", "", "plain text"]

    def element():
        cls = " ".join(rnd.sample(tokens, rnd.randint(0, 3)))
        q = rnd.choice(['"', "'"])
        extra = rnd.choice(["", ' id="k"', " data-x='1'"])
        tag = rnd.choice(["div", "div", "DIV", "span"])
        name = rnd.choice(["class", "class", "CLASS"])
        attrs = f"{extra} {name}={q}{cls}{q}" if rnd.random() < 0.9 else extra
        return f"<{tag}{attrs}>{rnd.choice(words)}</{tag}>"

    pages = [(i, "<body>" + "".join(element() for _ in range(rnd.randint(0, 8))) + "</body>") for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    a = sorted(map(tuple, extract.parse_cards(df, ("div", "card")).collect()))
    b = sorted(map(tuple, extract.class_cards(df, "div", "card").collect()))
    assert a == b and len(a) > 100


def test_regex_and_parser_agree_on_odd_tags(spark):
    import random
    rnd = random.Random(5)
    parts = ['<div class="card">a&nbsp;b &#233; &#xE9; &#38;lt; &amp;#39;</div>', "<div data-class='card'>no</div>",
             '<div title="x > y" class="b card">after a bracket</div>', "<div title='class=\"card\"'>no</div>",
             '<!-- <div class="card">no</div> -->', "<script>s = '<div class=\"card\">';</script>",
             '<STYLE>x<div class="card"></style>', "<DIV\nCLASS=card\nid=k>bare</DIV>", "<div class=cards>no</div>",
             '<div id=a/b class="card" disabled>slash</div>', '<div class="x" class="card">second class</div>',
             '<divx class="card">no</divx>', "<div disabled class='card x'>flag</div>", "<div class=\"a'card\">no</div>",
             '<span class="card">other tag</span>']
    pages = [(i, "".join(rnd.sample(parts, rnd.randint(1, 6)))) for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    a = sorted(map(tuple, extract.parse_cards(df, ("div", "card")).collect()))
    b = sorted(map(tuple, extract.class_cards(df, "div", "card").collect()))
    assert a == b and len(a) > 100
    values = spark.createDataFrame([("<html dir=x lang='bn'>",), ('<html lang="a&amp;b">',), ("<html LANG=fr>",),
                                    ("<html data-lang='no'>",)], "html string")
    assert [r[0] for r in values.select(H.attr_value("html", "html", "lang")).collect()] == ["bn", "a&b", "fr", None]


def test_parser_batch_without_cards(spark):
    pages = spark.createDataFrame([(1, "Nor", "<p>imageWrapper mentioned only</p>"), (2, "Nor", None),
                                   (3, "Nor", "<script>'<div class=\"imageWrapper\">'</script>")],
                                  "page_id long, brand string, html string")
    assert daily.search_cards(pages).count() == 0


def test_cards_without_text_and_in_pieces(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f'<div class="a"><b>x{i}</b> y</div>' * (i % 4)) for i in range(50)],
                                  "page_id long, html string").coalesce(1)
    whole = extract.parse_cards(pages, ("div", "a"), {"b": ("b", None)}).collect()
    fields = extract.parse_cards(pages, ("div", "a"), {"b": ("b", None)}, card_text=False)
    assert fields.columns == ["page_id", "pos_in_pg", "b"]
    assert [(r.page_id, r.pos_in_pg, r.b) for r in whole] == [tuple(r) for r in fields.collect()]
    monkeypatch.setattr(extract, "PIECE_ROWS", 2)
    assert extract.parse_cards(pages, ("div", "a"), {"b": ("b", None)}).collect() == whole
    assert {r.card_text for r in whole if r.page_id == 3} == {"x3 y"} and len(whole) == 73


def test_parser_keeps_cdata_text_and_skips_comments():
    from shelfwise.functions.html import collect_cards
    got = collect_cards('<div class="a"><![CDATA[zz]]>y<!-- no --><script>s</script></div>', ("div", "a"), {})
    assert got == [{"card_text": "zzy"}]


def test_unclosed_elements_take_linear_time():
    import time
    for markup, want in (("<li>x<a>y", 64_000_000), ("<li>x", 0)):
        begin, n, chars = time.process_time(), 0, 0
        for r in H.card_rows(markup * 8000, ("li", None), {"a": ("a", None)}, card_text=False):
            n, chars = n + 1, chars + len(r["a"] or "")
        assert (n, chars) == (8000, want) and time.process_time() - begin < 2


def test_select_by_class_alone_and_void_elements(spark):
    html = '<p class="c">a<img class="c d" id=i>b</p><SPAN class=c>x</SPAN><i class="cc">n</i><br class="c"/>t'
    assert H.collect_cards(html, (None, "c"), {"d": (None, "d")}) == [
        {"card_text": "ab", "d": ""}, {"card_text": "", "d": None}, {"card_text": "x", "d": None}, {"card_text": "", "d": None}]
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>none</p>")], "page_id bigint, html string")
    assert extract.parse_cards(pages, (None, "c")).count() == 4
    assert extract.parse_cards(pages, (None, None)).count() == 6


def test_element_table_equals_a_plain_tree():
    """Cards, fields and paths on random nested markup, against a tree walked node by node."""
    import random
    rnd = random.Random(12)

    def grow(depth):
        kids = [grow(depth + 1) if rnd.random() < .7 else rnd.choice(["t", "u v", ""]) for _ in range(rnd.randint(0, 4))] \
            if depth < 5 else ["leaf"]
        return (rnd.choice("aabbc"), rnd.choice(["", "k", "k m", "km"]), kids)

    def write(n):
        return n if isinstance(n, str) else f'<{n[0]} class="{n[1]}">' + "".join(map(write, n[2])) + f"</{n[0]}>"

    def text(n):
        return n if isinstance(n, str) else "".join(map(text, n[2]))

    def below(n):
        for k in n[2]:
            if not isinstance(k, str):
                yield k
                yield from below(k)

    def at(n, steps, pos=0):
        if not steps:
            yield pos, n
            return
        (tag, want), rest = steps[0], steps[1:]
        same = [k for k in n[2] if not isinstance(k, str) and tag in (k[0], "*")]
        for i, k in enumerate(same, 1):
            if want in (None, i, H.POS):
                yield from at(k, rest, i if want == H.POS else pos)

    for _ in range(200):
        top = ("div", "", [grow(0) for _ in range(3)])
        html = '<div id="page">' + "".join(map(write, top[2])) + "</div>"
        for card, field in ((("a", "k"), ("b", None)), ((None, "m"), (None, "k"))):
            def hit(n, sel):
                return sel[0] in (None, n[0]) and (sel[1] is None or sel[1] in n[1].split())
            want = [{"card_text": text(n), "f": next((text(k) for k in below(n) if hit(k, field)), None)}
                    for n in below(top) if hit(n, card)]
            assert H.collect_cards(html, card, {"f": field}) == want
        for path in ("#page/a/b[$pos]/a", "#page/*[2]/a[1]", "#page/a[$pos]", "#page/*[$pos]/b", "#page/c/c/c"):
            first = {}
            for pos, n in at(top, H.element_path(path)[1]):
                first.setdefault(pos, text(n))
            table = H.ElementTable(html)
            assert {p: table.text_of(i) for p, i in table.by_path(H.element_path(path)).items()} == first


def test_locate_by_path(spark):
    import pytest
    page = '<div id=page><div>m</div>{}<div><div><p>x</p><p>y</p><i>z</i></div><div><p>w</p><b>v</b></div></div></div>'
    banner = "<div class='important-banner'>b</div>"
    pages = spark.createDataFrame([(1, page.format("")), (2, page.format(banner)), (3, None), (4, "<p>other</p>")],
                                  "page_id bigint, html string")
    field = {"t": ["#page/div[$section]/div[$pos]/i", "#page/div[$section]/div[$pos]/b"], "p": "#page/div[$section]/div[$pos]/p[2]"}
    rows = [(1, 1, "z", "y"), (1, 2, "v", None), (2, 1, "z", "y"), (2, 2, "v", None)]
    assert sorted(map(tuple, extract.locate(pages, field).collect())) == rows
    fixed = extract.locate(pages, field, section=F.lit(2))             # the other layout only
    assert sorted(map(tuple, fixed.collect())) == rows[:2]
    whole = extract.locate(pages, {"m": "#page/div[1]", "o": "/p"})
    assert sorted(map(tuple, whole.collect())) == [(1, "m", None), (2, "m", None), (3, None, None), (4, None, "other")]
    for bad in ("page/div", "#page", "#page/div[0]", "#page/div[$pos]/p[$pos]", "#page//div"):
        with pytest.raises(ValueError):
            H.element_path(bad)
    with pytest.raises(ValueError):
        extract.locate(pages, {"a": "#page/div[$pos]", "b": "#page/div"})
