import random


from shelfwise.operators import relevance as R

SKUS = ["Nor Power 1kg", "nord cleaner", "Wave Nor", "NOR", None, "Dr. Moss scrub", "dr. mossX", "a%b soap",
        "axb soap", "a_b gel", "Vela soap", "vela", "Sun & Sand", "Ri", ""]
BRANDS = ["Nor", "Nord", "Dr. Moss", "a%b", "a_b", "Vela", "Sun & Sand"]


def brute_prefix(skus, brands):
    out = []
    for i, s in enumerate(skus):
        for b in brands:
            if s is not None and s.lower().startswith(b.lower()):
                out.append((i, b))
    return sorted(out)


def test_prefix_filter_is_literal_and_case_insensitive(spark):
    rows = [(i, s, b) for i, s in enumerate(SKUS) for b in BRANDS]
    df = spark.createDataFrame(rows, "i int, sku string, brand string")
    got = sorted((r.i, r.brand) for r in R.brand_prefix_filter(df).collect())
    assert got == brute_prefix(SKUS, BRANDS)
    assert (SKUS.index("axb soap"), "a%b") not in got            # '%' is text, not a wildcard
    assert (SKUS.index("nord cleaner"), "Nor") in got             # not bounded by a word


def test_prefix_join_equals_theta_join(spark):
    rnd = random.Random(5)
    skus = SKUS + ["".join(rnd.choice("NnOoRrDd . ") for _ in range(rnd.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(skus)], "i int, sku string")
    got = sorted((r.i, r.brand) for r in R.brand_prefix_join(df, BRANDS).collect())
    assert got == brute_prefix(skus, BRANDS)
    plan = R.brand_prefix_join(df, BRANDS)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_prefix_join_keeps_duplicate_rows(spark):
    df = spark.createDataFrame([(1, "Nor x"), (1, "Nor x")], "i int, sku string")
    assert R.brand_prefix_join(df, ["Nor"]).count() == 2


def test_portfolio_flag_case_sensitive(spark):
    df = spark.createDataFrame([("Vela soap",), ("vela soap",), ("Sea Salt",), (None,)], "sku string")
    got = [r[0] for r in df.select(R.portfolio_flag("sku", ["Vela", "Sea Salt"])).collect()]
    assert got == [1, 0, 1, None]
    assert R.portfolio_filter(df, ["Vela", "Sea Salt"]).count() == 2


def test_semi_join_paths_agree(spark):
    rnd = random.Random(9)
    skus = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(0, 12))) for _ in range(500)] + [None, "abc", "abc"]
    brands = ["abc", "e e", "dd", "b"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(skus)], "i int, sku string")
    expect = sorted(i for i, s in enumerate(skus) if s is not None and any(b in s for b in brands))
    small = sorted(r.i for r in R.portfolio_semi_join(df, brands).collect())
    bdf = spark.createDataFrame([(b,) for b in brands], "brand string")
    large = sorted(r.i for r in R.portfolio_semi_join(df, bdf).collect())
    assert small == expect == large


def test_quote_and_wildcards_in_brand_are_text(spark):
    df = spark.createDataFrame([(1, "O'Neil shampoo"), (2, "ONeil"), (3, "100% pure"), (4, "100x pure")],
                               "i int, sku string")
    got = sorted((r.i, r.brand) for r in R.brand_prefix_join(df, ["O'Neil", "100%"]).collect())
    assert got == [(1, "O'Neil"), (3, "100%")]


def test_semi_join_of_many_brands_equals_contains(spark):
    rnd = random.Random(31)
    skus = ["".join(rnd.choice("abcdé 𝟘\n") for _ in range(rnd.randint(0, 30))) for _ in range(400)] + [None, "", "abcdabcd"] * 3
    brands = ["".join(rnd.choice("abcdé 𝟘\n") for _ in range(rnd.randint(1, 7))) for _ in range(60)] + [None, "", "𝟘𝟘", "zz", "z"]
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(skus)], "i int, sku string, brand string")
    for subset in (brands, [b for b in brands if b and len(b) > 4], ["é"], [None, ""]):
        want = [i for i, s in enumerate(skus) if s is not None and any(b in s for b in subset if b)]
        listed = spark.createDataFrame([(b,) for b in subset], "brand string")
        for q in (2, 4):
            assert sorted(r.i for r in R.portfolio_semi_join(df, listed, q=q).collect()) == want


def test_semi_join_moves_no_texts(spark):
    df = spark.range(1000).selectExpr("id", "concat('name ', id) as sku")
    plan = R.portfolio_semi_join(df, ["name 7", "9", "x"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
