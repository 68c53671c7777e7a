"""Hosts as a URL parser writes them, and what a browser takes for a date."""

import random

import pytest
from pyspark.sql import functions as F

from civigrid.functions import text as T
from civigrid.functions import urls as U

HOSTS = [
    ("faß.de", "xn--fa-hia.de"), ("☕.example", "xn--53h.example"), ("127.1", "127.0.0.1"), ("0x7f.0.0.1", "127.0.0.1"), ("[::0:1]", "[::1]"), ("a:b@c@ex.com", "a:b%40c@ex.com"), ("xn--", None),
    ("Bücher.de", "xn--bcher-kva.de"), ("例え.テスト", "xn--r8jz45g.xn--zckzah"), ("ＥＸ.com", "ex.com"), ("ex。com", "ex.com"), ("FASS.de", "fass.de"), ("straße.STRAẞE.de", "xn--strae-oqa.xn--strae-oqa.de"), ("😀.com", "xn--e28h.com"), ("xn--bcher-kva.de", "xn--bcher-kva.de"), ("xn--a-ä.de", None),
    ("1.2.3.4.5", None), ("256.1", None), ("4294967295", "255.255.255.255"), ("4294967296", None), ("010.0.0.1", "8.0.0.1"), ("1.2.3.4.", "1.2.3.4"), ("a.1b", "a.1b"), ("0x", "0.0.0.0"), ("09.1", None), ("1.2.99999", None), ("1.2.65535", "1.2.255.255"), ("a.1", None),
    ("[1:0:0:2:0:0:0:3]", "[1:0:0:2::3]"), ("[1:0:0:2:0:0:3:4]", "[1::2:0:0:3:4]"), ("[::ffff:1.2.3.4]", "[::ffff:102:304]"), ("[1::2::3]", None), ("[12345::]", None), ("[::]", "[::]"), ("[1:2:3:4:5:6:7:8]", "[1:2:3:4:5:6:7:8]"), ("[1:2:3:4:5:6:7::]", "[1:2:3:4:5:6:7:0]"), ("[0:0:1::]", "[0:0:1::]"), ("[::1.2.3.256]", None), ("[1:2]", None), ("[]", None), ("a[b", None),
    ("a:b:c@h", "a:b%3Ac@h"), (":@h", "h"), ("h:80:80", None),
]


def test_hosts(spark):
    rows = [(f"http://{given}/P?q", None if wanted is None else f"http://{wanted}/P") for given, wanted in HOSTS]
    got = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "i int, url string").select("i", U.layer_key(F.col("url")).alias("key"), U.is_http(F.col("url")).alias("http"))
    for r in got.collect():
        wanted = rows[r.i][1]
        assert (r.http, r.key if r.http else None) == (wanted is not None, wanted), rows[r.i]


def test_punycode_against_another(spark):
    rng = random.Random(1)
    letters = [*map(chr, range(97, 123)), "-", "é", "ß", *map(chr, range(0x4E00, 0x4F00)), *map(chr, range(0x1F600, 0x1F630)), *map(chr, range(0x430, 0x450))]
    labels = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) + "é" for _ in range(300)} | {"é" * 60, "\U0010fff0\u0080"}
    got = spark.createDataFrame([(x,) for x in labels], "x string").select("x", U.punycode(F.col("x")).alias("p")).collect()
    assert all(r.p == r.x.encode("punycode").decode() for r in got) and len(got) == len(labels)


DATES = {
    True: ["2026-1-2", "Jan 2026", "12/25/1995 10:00 PM", "12/25/1995 12:00 am", "Tue Mar 01 2022 00:00:00 GMT+0100 (CET)", "2026-01-02T03:04:05z", "1", "32", "12.25.1995", "Dec 25, 1995 13:30 PST", "hello 2026", "2026-01-02 24:00", "1/2/3 10:00:00.123 GMT-8", "1995-12-17T03:24:00+01:00", "Dec 25, 1995 (a (b) c)", "25 December 1995", "12:30:15 1/2/2026", "2026-", "+002026-01-02", " 2026 "],
    False: [None, "", "  ", "13", "hello", "hello2026", "2026 hello", "10:00", "2026-01-02T25:00", "2026-01-02T3:04", "2026-01-02T", "12/25/1995 13:00 PM", "1 2 3 4", "2026-01-02 10:60", "2026-01-02 24:01", "Jan 32 2026", "2026/13/01", "1/2/3 10:00 GMT-12345", "Dec 25, 1995)", "99999999999", "2026--01", "T10", "1:2:3:4:5 1/2/2026"],
}


@pytest.mark.parametrize("wanted", [True, False])
def test_dates(spark, wanted):
    got = spark.createDataFrame([(x,) for x in DATES[wanted]], "x string").select("x", T.is_date(F.col("x")).alias("ok")).collect()
    assert [r.x for r in got if r.ok != wanted] == []


def test_accents_on_all_code_points(spark):
    import unicodedata

    def plain(x):
        return "".join(c for c in unicodedata.normalize("NFKD", x) if not "̀" <= c <= "ͯ")

    points = [*range(0xD800), *range(0xE000, 0x30000), *range(0xE0000, 0xE0200), 0x10FFFF]
    got = spark.createDataFrame([("a" + chr(c) + "b",) for c in points], "x string").repartition(4).select("x", T.unaccented(F.col("x")).alias("p"))
    assert [r.x for r in got.collect() if r.p != plain(r.x)] == []
    mixed = ["Cañon ½ ﬁ 한국 각", "é̀́", "", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(mixed)], "i int, x string").select("i", T.unaccented(F.col("x")).alias("p"), T.place_key(F.col("x")).alias("k")).collect()
    assert {r.i: r.p for r in rows} == {i: None if x is None else plain(x) for i, x in enumerate(mixed)}
    assert "Python" not in got._jdf.queryExecution().toString()


def test_rounding_is_that_of_the_binary_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    rng = random.Random(1)
    xs = [0.575, 0.125, 1.005, 0.0, -0.005, -1.255, 2.675, 0.5, 1e13, 123456.785] + [rng.random() for _ in range(2000)] + [k / 1000 + 0.005 for k in range(500)] + [i / j for i in range(30) for j in range(1, 30)]
    for digits in (1, 2, 3):
        got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", T.fixed(F.col("x"), digits).alias("p")).collect()
        assert [(r.x, r.p) for r in got if r.p != str(Decimal(r.x).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))] == []


def test_ports_are_compared_without_casts(spark):
    given = ["https://e.com:65535/a", "https://e.com:065535/a", "https://e.com:65536/a", "https://e.com:443/a", "https://e.com:/a", "https://e.com:999999/a", "https://e.com:0/a", "https://u:p@e.com/a/../b"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "i int, u string")
    found = rows.select("i", U._plain(F.col("u")).alias("p"))
    assert [r.p for r in found.orderBy("i").collect()] == ["https://e.com:65535/a", "https://e.com:65535/a", None, "https://e.com/a", "https://e.com/a", None, "https://e.com:0/a", "https://u:p@e.com/b"]


def test_rows_of_url_cases_are_dealt_by_their_number(spark, monkeypatch):
    from civigrid import registered_geo
    from civigrid.operators import staging

    monkeypatch.setattr(staging, "ROWS_OF_A_TASK", 50)
    found = registered_geo.QUERIES["q_url_cases"](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() == -(-found.count() // 50) > 1
