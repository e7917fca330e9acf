import os

from shelfwise.plans import daily
from shelfwise.sources import landed
from shelfwise.sources.tables import read_table


def test_read_landed_html_files(spark, scratch):
    for brand, name, body in [("Nor", "p1.html", '<div class="imageWrapper"><div class="name">Nor x</div></div>'),
                              ("Dr. Moss", "p2.html", '<div class="imageWrapper"><div class="name">Dr. Moss y</div>'
                                                        '</div>\n<div class="imageWrapper"></div>')]:
        d = os.path.join(scratch, f"brand={brand}")
        os.makedirs(d)
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    pages = landed.read_landed_html(spark, scratch)
    rows = {r.brand: r for r in pages.collect()}
    assert set(rows) == {"Nor", "Dr. Moss"}
    assert rows["Nor"].html.startswith('<div class="imageWrapper">') and rows["Nor"].captured_at is not None
    assert rows["Nor"].page_id != rows["Dr. Moss"].page_id
    cards = daily.search_cards(pages).collect()
    assert sorted((c.brand, c.pos_in_pg, c.sku) for c in cards) == \
        [("Dr. Moss", 1, "Dr. Moss y"), ("Dr. Moss", 2, None), ("Nor", 1, "Nor x")]
    out = os.path.join(scratch, "landed.parquet")
    pages.write.parquet(out)
    assert landed.read_landed_parquet(spark, out).count() == 2


def test_brand_urls(spark):
    brands = spark.createDataFrame([("Sun & Sand",), ("Nor",)], "brand string")
    got = {r.brand: (r.url, r.url_encoded) for r in landed.brand_urls(brands, "https://shop.example/search/").collect()}
    assert got["Nor"] == ("https://shop.example/search/Nor", "https://shop.example/search/Nor")
    assert got["Sun & Sand"][1] == "https://shop.example/search/Sun+%26+Sand"


def test_tables_are_read_with_pruning(spark):
    df = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_command_line_reads_landed_html(spark, scratch):
    from shelfwise.__main__ import main
    from shelfwise.schemas import DESCRIPTIONS, STOCK_OBSERVATIONS
    root = os.path.join(scratch, "landing")
    os.makedirs(os.path.join(root, "brand=Nor"))
    with open(os.path.join(root, "brand=Nor", "p.html"), "w") as f:
        f.write('<div class="imageWrapper"><div class="name">Nor x</div><div class="price">Tk 9</div></div>')
    spark.createDataFrame([], DESCRIPTIONS).write.parquet(os.path.join(scratch, "desc"))
    spark.createDataFrame([], STOCK_OBSERVATIONS).write.parquet(os.path.join(scratch, "obs"))
    rows = main(["--pages", root, "--html", "--descriptions", os.path.join(scratch, "desc"),
                 "--observations", os.path.join(scratch, "obs"), "--brands", "Nor,Opal",
                 "--out", os.path.join(scratch, "out"), "--day", "2024-03-01"])
    assert rows[0].skus == 1 and rows[0].skus_failed_stock == 1 and rows[0].brands_failed_stock == 1
