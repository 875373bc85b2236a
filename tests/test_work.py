"""Crawls and downloads that fail, are broken off, and go on."""

from __future__ import annotations

import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from aridspan.sources import crawl
from aridspan.sources.work import WorkTable, document, host_of

REF = '<catalog xmlns:xlink="http://www.w3.org/1999/xlink">{}</catalog>'
PAGES = {
    "/catalog.xml": REF.format('<catalogRef name="M1"/><catalogRef name="M2"/><catalogRef name="M3"/>'),
    "/M1/catalog.xml": REF.format('<catalogRef name="historical"/>'), "/M2/catalog.xml": REF.format('<catalogRef name="historical"/>'),
    "/M1/historical/catalog.xml": REF.format('<catalogRef name="r1"/>'), "/M2/historical/catalog.xml": REF.format('<catalogRef name="r1"/>'),
    "/M1/historical/r1/catalog.xml": REF.format('<catalogRef name="pr"/>'), "/M2/historical/r1/catalog.xml": REF.format('<catalogRef name="tas"/>'),
    "/a.nc": "a", "/b.nc": "b",
}


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        asked, fails, now, most, lock = Counter(), {}, 0, 0, threading.Lock()

        def do_GET(self):
            kind = type(self)
            with kind.lock:
                kind.asked[self.path] += 1
                kind.now += 1
                kind.most = max(kind.most, kind.now)
                fail = kind.fails.get(self.path, 0)
                kind.fails[self.path] = fail - 1
            time.sleep(0.05)
            try:
                page, tag = PAGES.get(self.path), f'"{hash(PAGES.get(self.path))}"'
                if fail > 0:
                    self.send_error(503)
                elif page is None:
                    self.send_error(404)
                elif self.headers.get("If-None-Match") == tag:
                    self.send_response(304)
                    self.end_headers()
                else:
                    self.send_response(200)
                    self.send_header("ETag", tag)
                    self.end_headers()
                    self.wfile.write(page.encode())
            finally:
                with kind.lock:
                    kind.now -= 1

        def log_message(self, *_):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", Handler
    httpd.shutdown()


def test_a_crawl_goes_on_after_failures(spark, server, tmp_path):
    base, kind = server
    kind.fails |= {"/catalog.xml": 2, "/M1/historical/r1/catalog.xml": 1}
    table = crawl.crawl(spark, base, f"{tmp_path}/c", pause=0.01)
    want = {("M1", "historical", "r1", ("pr",)), ("M2", "historical", "r1", ("tas",))}
    rows = lambda t: {(r.model, r.experiment, r.run, tuple(r.variables)) for r in t.collect()}
    assert rows(table) == want and kind.asked["/catalog.xml"] == 3
    failures = spark.read.parquet(f"{tmp_path}/c/failures").collect()
    assert [r.url for r in failures] == [f"{base}/M3/catalog.xml"] and "404" in failures[0].error and kind.asked["/M3/catalog.xml"] == 1
    kind.asked.clear()
    assert rows(crawl.crawl(spark, base, f"{tmp_path}/c", pause=0.01)) == want and not kind.asked  # done: nothing is fetched
    assert rows(crawl.crawl(spark, base, f"{tmp_path}/c", again=True, pause=0.01)) == want  # asked for again, not changed
    assert kind.asked["/M1/catalog.xml"] == 1


def test_work_is_resumed_bounded_by_host_and_given_up(spark, server, tmp_path):
    base, kind = server
    kind.fails |= {"/a.nc": 99}
    work = WorkTable(spark, f"file://{tmp_path}/w", most=2, pause=0.01, per_host=1)
    urls = spark.createDataFrame([(f"{base}/{n}",) for n in ("a.nc", "b.nc", "catalog.xml", "M1/catalog.xml")], "url string")
    work.add(urls.selectExpr("url AS key", f"{host_of('url')} AS host", "url AS payload"))

    def broken(payload, etag, modified):
        raise RuntimeError("the machine is gone")

    with pytest.raises(Exception, match="the machine is gone"):
        work.step(broken, time.time())
    got = {r.key.removeprefix(base): (r.state, r.tries) for r in WorkTable(spark, f"file://{tmp_path}/w", 2, 0.01, 1).run(document).collect()}
    assert got == {"/a.nc": ("failed", 2), "/b.nc": ("done", 1), "/catalog.xml": ("done", 1), "/M1/catalog.xml": ("done", 1)}
    assert kind.most == 1
    assert work.step(document, time.time()) == 0


def test_downloads_are_tried_again(spark, server, tmp_path):
    base, kind = server
    kind.fails |= {"/b.nc": 1}
    plan = spark.createDataFrame(
        [("M", "pr", "historical", 2000, 0, "x.nc", f"{base}/x.nc"), ("M", "pr", "historical", 2000, 1, "a.nc", f"{base}/a.nc"),
         ("M", "pr", "historical", 2001, 0, "b.nc", f"{base}/b.nc"), ("M", "pr", "historical", 2002, 0, "y.nc", f"{base}/y.nc")],
        "model string, variable string, experiment string, year int, priority int, file string, url string",
    )
    got = {r.year: (r.file, r.error) for r in crawl.download(plan, f"{tmp_path}/d", WorkTable(spark, f"file://{tmp_path}/w", pause=0.01)).collect()}
    assert got[2000] == ("a.nc", None) and got[2001] == ("b.nc", None) and got[2002][0] is None and "y.nc" in got[2002][1]
    assert {p.name: p.read_text() for p in tmp_path.glob("d/pr/M/historical/*")} == {"a.nc": "a", "b.nc": "b"}
    assert kind.asked["/y.nc"] == 1 and kind.asked["/b.nc"] == 2
