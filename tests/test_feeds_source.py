import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tidemark.sources import feeds, landing

RSS = "<rss><channel><item><title>Judul {k}</title><link>https://x.com/{k}</link></item></channel></rss>"


@pytest.fixture
def site(tmp_path):
    """A server of three feeds: a and b know validators, c is broken; asked: the requests in order."""
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            name = self.path.strip("/")
            asked.append((name, self.headers.get("If-None-Match")))
            code = 500 if name == "c" else 304 if self.headers.get("If-None-Match") == f"e-{name}" else 200
            body = RSS.format(k=name).encode() if code == 200 else b""
            self.send_response(code)
            self.send_header("ETag", f"e-{name}")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    front = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=front.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{front.server_address[1]}"
    path = tmp_path / "feeds.json"
    path.write_text(json.dumps([{"source": s, "channel": "x", "kanal": "k", "url": f"{base}/{s}"} for s in "abc"]))
    yield {"feeds": str(path), "state": str(tmp_path / "state.json"), "delay": 0, "retries": 1, "base": 0}, asked
    front.shutdown()
    front.server_close()


def test_batch(spark, site):
    options, asked = site
    df = feeds.answers(spark, **options)
    assert df.rdd.getNumPartitions() == 1
    asked.clear()
    first = {r["source"]: r for r in df.collect()}
    assert [first[s]["status"] for s in "abc"] == ["ok", "ok", "failed"] and first["c"]["body"] is None
    assert [n for n, _ in asked] == ["a", "b", "c", "c"]
    again = {r["source"]: r["status"] for r in df.collect()}
    assert again == {"a": "not_modified", "b": "not_modified", "c": "failed"} and asked[4:6] == [("a", "e-a"), ("b", "e-b")]
    df.collect()
    assert {r["source"]: r["status"] for r in df.collect()}["c"] == "skipped_breaker"


def test_answers_are_parsed(spark, site):
    options, _ = site
    got = landing.parse_feed(feeds.answers(spark, **options).where("status = 'ok'").drop("status")).collect()
    assert sorted(r["canonical_url"] for r in got) == ["https://x.com/a", "https://x.com/b"]


def test_stream(spark, site, tmp_path):
    options, asked = site
    options["log"] = str(tmp_path / "log")

    def run(cycles):
        seen = []
        q = feeds.answers(spark, streaming=True, **options).writeStream.foreachBatch(lambda df, k: seen.append((k, sorted((r["source"], r["status"]) for r in df.collect())))).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
        until = time.time() + 60
        while len(seen) < cycles and q.isActive and time.time() < until:
            time.sleep(0.2)
        q.stop()
        if q.exception():
            raise q.exception()
        return seen

    first = run(2)
    assert first[0] == (0, [("a", "ok"), ("b", "ok"), ("c", "failed")]) and first[1][1][:2] == [("a", "not_modified"), ("b", "not_modified")]
    later = run(1)
    assert later[0][0] >= 2 and later[0][1][0] == ("a", "not_modified")


def test_a_cycle_is_asked_for_once(site, tmp_path):
    options, asked = site
    reader = feeds.Cycles(options | {"log": str(tmp_path / "log")})
    rows, end = reader.read(reader.initialOffset())
    rows, n = list(rows), len(asked)
    again, same = reader.read({"cycle": 0})
    assert list(again) == rows and same == end == {"cycle": 1} and len(asked) == n
    assert list(reader.readBetweenOffsets({"cycle": 0}, end)) == rows
    reader.read(end)
    reader.commit({"cycle": 2})
    assert list(reader.readBetweenOffsets({"cycle": 1}, {"cycle": 2})) and not (tmp_path / "log" / "000000000.json").exists()
