import random
import re
import unicodedata

from pyspark.sql import functions as F

from shelfwise.functions import text as TX
from shelfwise.functions import timefmt as TF

NBSP = " "


def py_token(t, n):
    if t is None:
        return None
    parts = t.split()
    return parts[n - 1] if len(parts) >= n else None


def _ascii(tok):
    # Python's float() and int() read decimal digits of every script
    return "".join(str(unicodedata.decimal(ch)) if unicodedata.category(ch) == "Nd" else ch for ch in tok)


def py_money(t, n=2):
    tok = py_token(t, n)
    if tok is None:
        return None
    tok = _ascii(tok).replace(",", "")
    # documented: nan / inf / 1_000 are refused although Python's float takes them
    if not re.fullmatch(TX.DECIMAL_TEXT, tok):
        return None
    return float(tok)


def py_units(t, n=1):
    tok = py_token(t, n)
    if tok is None:
        return None
    tok = _ascii(tok).replace(",", "")
    if not re.fullmatch(TX.INTEGER_TEXT, tok):
        return None
    v = int(tok)
    return v if -2**63 <= v < 2**63 else None


EDGE_PRICES = [
    ("৳ 1,200", 1200.0), ("  ৳ 45.50", 45.5), ("৳" + NBSP + "99", 99.0), ("Sold out", None),
    ("৳", None), ("৳ 12d", None), ("৳ 1_000", None), ("৳ nan", None), ("৳ inf", None),
    ("", None), (None, None), ("৳ .5", 0.5), ("৳ 5.", 5.0), ("৳ 1e3", 1000.0),
    ("৳ -1,2,3", -123.0), ("৳ 1.2.3", None), ("৳ 0x10", None), ("৳ 12 ", 12.0),
    ("\t৳\t7", 7.0), ("৳ ,", None), ("৳ ১,২০০", 1200.0),
]

EDGE_UNITS = [
    ("1,200 in bag", 1200), ("  12", 12), ("1.5 left", None), ("add to bag", None), ("", None), (None, None),
    ("+7", 7), ("-3 x", -3), ("99999999999", 99999999999), ("9" * 20, None), ("12" + NBSP + "x", 12), ("1_000", None),
]


def test_money_edges(spark):
    df = spark.createDataFrame([(t,) for t, _ in EDGE_PRICES], "t string")
    got = [r[0] for r in df.select(TX.money("t")).collect()]
    assert got == [e for _, e in EDGE_PRICES]


def test_units_edges(spark):
    df = spark.createDataFrame([(t,) for t, _ in EDGE_UNITS], "t string")
    got = [r[0] for r in df.select(TX.units("t")).collect()]
    assert got == [e for _, e in EDGE_UNITS]


def test_money_units_match_python_on_random_text(spark):
    rnd = random.Random(7)
    alphabet = [" ", " ", NBSP, "\t", "0", "1", "2", "9", ",", ",", ".", "e", "-", "+", "a", "d", "_", "৳",
                "১", "৯", "٣", "５", "\x85", "\u2003"]   # other digits and separators, as Python reads them
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 10))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", TX.money("t").alias("m"), TX.units("t").alias("u"), TX.token("t", 1).alias("k")).collect()
    for r in rows:
        t = texts[r.i]
        assert r.m == py_money(t), t
        assert r.u == py_units(t), t
        assert r.k == py_token(t, 1), t


def test_small_text_helpers(spark):
    df = spark.createDataFrame([("a b\nc", None, 3), (None, "x", None)], "s string, q string, n int")
    r = df.select(TX.strip_spaces("s"), TX.one_line("s"), TX.row_label("s", "q"), TX.row_label("q", "n"),
                  TX.empty_if_null("q"), TX.first_token("s")).collect()
    assert tuple(r[0]) == ("ab\nc", "a b c", "a b\nc None", "None 3", "", "a")
    assert tuple(r[1]) == (None, None, "None x", "x None", "x", None)


def test_span_text_and_formats(spark):
    df = spark.sql("""select timestamp_ntz'2024-01-05 13:04:05.9' a, timestamp_ntz'2024-01-06 14:05:07.1' b,
                             '2024-01-05 13:04:05' t, 'bad' u""")
    r = df.select(TF.span_seconds("a", "b").alias("s"), TF.span_text(TF.span_seconds("a", "b")),
                  TF.format_time("a", TF.SHEET_TIME), TF.format_time("a", TF.MAIL_DATE),
                  TF.format_time("a", TF.FILE_DATE), TF.parse_report_time("t"), TF.parse_report_time("u"),
                  TF.elapsed_minutes(F.lit(125))).collect()[0]
    assert r[0] == 86400 + 3600 + 62
    assert r[1] == "01:01:02"          # days dropped, as the run report prints spans
    assert r[2] == "05-Jan-24, 01:04 PM"
    assert r[3] == "05-Jan-24"
    assert r[4] == "2024-01-05"
    assert str(r[5]) == "2024-01-05 13:04:05"
    assert r[6] is None
    assert r[7] == 2.08


def test_time_helpers_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:15.75' t, '2024-03-10 02:30:15' s")
        r = df.select(TF.to_seconds_ntz("t"), TF.parse_report_time("s"),
                      TF.span_seconds(F.col("t"), F.lit("2024-03-10 03:30:15").cast("timestamp_ntz"))).collect()[0]
        # 02:30 does not exist in that zone (DST gap); zone-free helpers keep the wall clock
        assert str(r[0]) == "2024-03-10 02:30:15" and str(r[1]) == "2024-03-10 02:30:15" and r[2] == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_spans_match_python_datetime_on_random_times(spark):
    import datetime as dt
    import random
    rnd = random.Random(5)
    lo = dt.datetime(1990, 1, 1).timestamp()
    hi = dt.datetime(2040, 12, 31).timestamp()

    def rand_ts():
        return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=rnd.randrange(int(lo * 1e6), int(hi * 1e6)))

    pairs = [(i, a, a + dt.timedelta(microseconds=rnd.randrange(0, 40 * 86400 * 10**6)))
             for i, a in ((i, rand_ts()) for i in range(2000))]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(pairs, "i int, a timestamp_ntz, b timestamp_ntz")
        got = {r.i: (r.s, r.t, r.ta) for r in df.select(
            "i", TF.span_seconds("a", "b").alias("s"), TF.span_text(TF.span_seconds("a", "b")).alias("t"),
            TF.to_seconds_ntz("a").alias("ta")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for i, a, b in pairs:
        s = int((b.replace(microsecond=0) - a.replace(microsecond=0)).total_seconds())
        m = s % 86400
        assert got[i] == (s, f"{m // 3600:02d}:{m % 3600 // 60:02d}:{m % 60:02d}", a.replace(microsecond=0)), (a, b)
