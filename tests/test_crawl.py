"""Discovery in waves: requests, failures of the run's own, and runs that go on."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from civigrid import cli
from civigrid.plans import crawl
from civigrid.plans.discovery import summary
from civigrid.sources import recorded as old
from civigrid.sources import requests

BASE = "https://e.com/rest/services"
LAYER = json.dumps({"name": "Ward Boundary", "geometryType": "esriGeometryPolygon", "fields": [{"name": "WARD"}]})


def places(spark, *cities):
    return spark.createDataFrame([(str(i), c, "AZ") for i, c in enumerate(cities)], "place_fips string, city string, state string")


def search(city, term="wards"):
    """A search's address as a browser writes it."""
    import urllib.parse

    return f"{crawl.ENDPOINT}?{urllib.parse.urlencode({'q': f'"{city}" AZ {term}', 'num': 50, 'start': 1, 'f': 'json'})}"


def answers(spark, rows):
    return spark.createDataFrame([(u, s, b if b is None or isinstance(b, str) else json.dumps(b)) for u, s, b in rows], "url string, status int, body string")


def hits(*urls):
    return {"results": [{"title": "Wards", "url": u} for u in urls]}


GIVEN = [
    (search("Good"), 200, hits(f"{BASE}/Good/MapServer", "", None)),
    (f"{BASE}/Good/MapServer?f=json", 200, {"name": "Good service", "layers": [{"id": 0, "name": "Parks"}, {"id": 4, "name": "Wards"}]}),
    (f"{BASE}/Good/MapServer/4?f=json", 200, LAYER),
    (search("Odd"), 200, hits(f"{BASE}/Good/MapServer/4", 7)),
    (search("Array"), 200, hits(["x"])),
    (search("Zero"), 200, hits(0, False, f"{BASE}/Gone/FeatureServer/1", "no address", "https://[bad/FeatureServer/2")),
    (f"{BASE}/Gone/FeatureServer/1?f=json", 404, LAYER),
    (search("Named"), 200, hits(f"{BASE}/Number/FeatureServer/0", f"{BASE}/Text/FeatureServer")),
    (f"{BASE}/Number/FeatureServer/0?f=json", 200, {"name": 5}),
    (f"{BASE}/Text/FeatureServer?f=json", 200, "[1]"),
    (search("Broken"), 200, "<html>"),
    (search("List"), 200, {"results": 5}),
    (search("Ends"), 200, {"results": [5, {"title": "a", "url": f"{BASE}/Good/MapServer/4"}, None, {"url": 7}]}),
    (search("Down"), 503, hits(f"{BASE}/Good/MapServer/4")),
]
CITIES = ("Good", "Odd", "Array", "Zero", "Named", "Broken", "List", "Ends", "Down", "Silent", "O'Brien & Söhne~*")


def test_a_run_with_failures_of_its_own(spark):
    run = crawl.crawled(places(spark, *CITIES), requests.recorded(answers(spark, [*GIVEN, *GIVEN])))
    found = {r.city: r for r in run["results"].collect()}
    assert [c for c in CITIES if found[c].error] == ["Odd", "Array"] and found["Odd"].error == "url.trim is not a function"
    assert {c: found[c].n_candidates for c in CITIES} == {"Good": 1, "Odd": 0, "Array": 0, "Zero": 3, "Named": 2, "Broken": 0, "List": 0, "Ends": 1, "Down": 0, "Silent": 0, CITIES[-1]: 0}
    assert {c: found[c].n_chosen for c in ("Good", "Zero", "Named", "Ends")} == {"Good": 1, "Zero": 0, "Named": 0, "Ends": 1}
    assert found["Named"].n_inspected == 1 and [(r.place_fips, r.url) for r in run["uninspected"].collect()] == [("4", f"{BASE}/Number/FeatureServer/0")]
    assert {r.place_fips for r in run["candidates"].collect()} == {"0", "3", "4", "7"}
    assert [r.url for r in run["chosen"].orderBy("place_fips").collect()] == [f"{BASE}/Good/MapServer/4"] * 2
    assert summary(run["results"]).first().failed == 2
    asked = {r.url: (r.status, r.error) for r in run["requests"].collect()}
    assert asked[f"{BASE}/Gone/FeatureServer/1?f=json"] == (404, "status 404") and asked[search("Silent")] == (None, "no recorded answer") and asked[search("Down")][1] == "status 503"
    assert asked["https://[bad/FeatureServer/2?f=json"][1] == "no recorded answer" and "no address?f=json" not in asked
    assert len(asked) == 6 * len(CITIES) + 6 and all(u.startswith(crawl.ENDPOINT) or u.endswith("?f=json") for u in asked)


def test_an_empty_run(spark):
    run = crawl.crawled(places(spark, "x").limit(0), requests.recorded(answers(spark, GIVEN)))
    assert run["results"].count() == 0 and run["requests"].count() == 0


@pytest.mark.parametrize("stop", [0, 1, 2])
def test_a_run_that_broke_off_goes_on(spark, tmp_path, stop):
    asked = []

    def counted(fail_at):
        given = requests.recorded(answers(spark, GIVEN))

        def transport(table):
            if len(asked) == fail_at:
                raise ConnectionError("gone")
            out = given(table)
            asked.append(sorted(r.url for r in table.collect()))
            return out

        return transport

    some, folder = places(spark, "Good", "Odd"), str(tmp_path / "run")
    with pytest.raises(ConnectionError):
        crawl.gathered(some, counted(stop), folder, batch=7)
    run = crawl.gathered(some, counted(-1), folder, batch=7)
    urls = [u for batch in asked for u in batch]
    assert len(urls) == len(set(urls)) == 14 and max(map(len, asked)) < 12  # each once, in batches
    assert [(r.place_fips, r.error) for r in run["failures"].collect()] == [("1", "url.trim is not a function")]
    assert sorted(r.url for r in run["metadata"].where("body IS NOT NULL").collect()) == [f"{BASE}/Good/MapServer", f"{BASE}/Good/MapServer/4"] and run["hits"].count() == 5
    n = len(asked)
    crawl.gathered(some, counted(-1), folder)
    assert len(asked) == n  # all is answered
    if stop:
        return
    crawl.gathered(some, counted(-1), folder, again=True)
    assert [u for batch in asked[n:] for u in batch] == sorted(search(c, t) for c in ("Good", "Odd") for t in ("council districts", "city council", "ward boundaries", "council district boundaries", "municipal districts"))


def test_many_recorded_requests(spark):
    n = 100_000
    wanted = spark.range(n).select(F.concat(F.lit("https://e.com/"), F.col("id").cast("string"), F.lit("?f=json")).alias("url")).union(spark.createDataFrame([("http://a b/x",), ("no address",)], "url string"))
    given = spark.range(0, n, 2).select(F.concat(F.lit("https://e.com/"), F.col("id").cast("string"), F.lit("?f=json")).alias("url"), F.lit("{}").alias("body"))
    got = requests.recorded(given)(wanted)
    assert got.columns == ["url", "status", "body", "error"]
    assert {(r.error, r["count"]) for r in got.groupBy("error").count().collect()} == {(None, n // 2), ("no recorded answer", n // 2 + 2)}


@pytest.fixture
def server():
    class Handler(http.server.BaseHTTPRequestHandler):
        now, most, seen = 0, 0, []

        def do_GET(self):
            with lock:
                Handler.now += 1
                Handler.most = max(Handler.most, Handler.now)
                Handler.seen.append(self.path)
            threading.Event().wait(0.02)
            body = {"/ok": b"\xef\xbb\xbf{}", "/bytes": b"{\"name\":\"\xff\"}", "/empty": b""}.get(self.path.split("?")[0], b"{}")
            self.send_response(404 if "/gone" in self.path else 200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)
            with lock:
                Handler.now -= 1

        def log_message(self, *args):
            pass

    lock = threading.Lock()
    httpd = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", Handler
    httpd.shutdown()


def test_live_requests_fail_one_by_one(spark, server):
    base, handler = server
    odd = ["no address?f=json", "https://[bad/?f=json", "http://a b/x", "file:///etc/hostname", "http://127.0.0.1:1/x", "http://☃.invalid/", ""]
    urls = [f"{base}/{p}" for p in ("ok", "bytes", "empty", "gone")] + [f"{base}/n{i}" for i in range(30)] + odd
    got = {r.url: r for r in requests.live(per_host=2, tasks=8, timeout=5)(spark.createDataFrame([(u,) for u in urls], "url string")).collect()}
    assert len(got) == len(urls) and all(got[u].error and got[u].body is None for u in odd)
    assert got[f"{base}/ok"].body == "{}" and json.loads(got[f"{base}/bytes"].body) == {"name": "�"} and got[f"{base}/empty"].body == ""
    assert got[f"{base}/gone"].error == "status 404 Not Found" and got[f"{base}/gone"].status == 404
    assert handler.most <= 2 and len(handler.seen) == 34  # two lanes, each address once
    for u in odd:
        assert old.answer({}, u, u) is None or u.startswith("file:")


def test_discover_command(spark, tmp_path, capsys, monkeypatch):
    from pyspark.sql import SparkSession

    listed = [{"placeFips": "0477000", "city": "Good", "state": "AZ", "placeType": "incorporated-place"}, {"placeFips": "0477001", "city": "Odd", "state": "AZ", "placeType": "incorporated-place"}]
    (tmp_path / "places.json").write_text(json.dumps({"places": listed}))
    (tmp_path / "answers.json").write_text("\n".join(json.dumps({"url": u, "status": s, "body": b if isinstance(b, str) else json.dumps(b)}) for u, s, b in GIVEN))
    monkeypatch.setattr(SparkSession.builder, "getOrCreate", lambda: spark)
    assert cli.main(["discover", str(tmp_path / "places.json"), str(tmp_path / "out"), "--recorded", str(tmp_path / "answers.json"), "--folder", str(tmp_path / "run"), "--verbose"]) == 0
    said = capsys.readouterr().out
    assert "failed: 1" in said and "failed: Odd, AZ: url.trim is not a function" in said and "canonical: 1" in said
