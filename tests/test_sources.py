import email.message
import json
import urllib.error

from tidemark.sources import landing as L
from tidemark.sources.tables import Snapshots
from tidemark.streaming import ingest

RSS = """<rss><channel><item><title>Harga &lt;b&gt;emas&lt;/b&gt; naik</title><link>https://www.x.com/a/?utm_source=feed</link><description>ANTARA - Isi berita</description><pubDate>Wed, 29 Jul 2026 14:00:00 +0700</pubDate></item>
<item><title>again</title><link>https://x.com/a</link></item><item><title>no link</title></item></channel></rss>"""


def record(key, source="s", fetched="2026-07-29T08:00:00+00:00", **more):
    return {"article_key": key, "canonical_url": f"https://x/{key}", "title_fingerprint": "f", "title": "t", "summary": None, "kanal": "k", "source": source, "channel": "c", "feed_id": "s:c", "raw_link": "r", "published_at": None, "fetched_at": fetched, "schema_version": 1, "extra": json.dumps({"a": 1})} | more


def frame(spark, rows):
    return spark.createDataFrame(rows, L.RECORD)


def test_parse_feed(spark):
    bodies = spark.createDataFrame([("s", "c", "k", "s:c", RSS, "2026-07-29T08:00:00+00:00")], "source string, channel string, kanal string, feed_id string, body string, fetched_at string")
    rows = L.parse_feed(bodies).collect()
    good = [r for r in rows if r.failure is None]
    assert len(good) == 1 and len(rows) == 2
    assert (good[0].title, good[0].summary, good[0].canonical_url, good[0].published_at) == ("Harga emas naik", "Isi berita", "https://x.com/a", "2026-07-29T07:00:00Z")


ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title><link href="https://y.com/"/>
<entry><title type="html">Harga &lt;i&gt;beras&lt;/i&gt;</title><link rel="edit" href="https://y.com/edit/1"/><link href="https://y.com/b"/><id>1</id><summary>Isi</summary><updated>2026-07-29T07:00:00Z</updated><author><name>A</name></author><rights>free</rights><category term="x"/></entry>
<entry><title>other</title><link rel="alternate" href="https://y.com/c"/><published>2026-07-29T08:00:00+01:00</published><updated>2026-07-30T07:00:00Z</updated></entry></feed>"""
MORE = """<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title><item><title>t</title><link> https://x.com/d </link><guid>9</guid><category>sports</category><dc:creator>Rina</dc:creator><dc:subject>sports</dc:subject><comments>3</comments></item>
<item><link>https://x.com/e</link></item><item><title>a</title></item><item><title>b</title></item><item><title>c</title></item></channel></rss>"""


def bodies(spark, *texts):
    rows = [("s", "c", "k", f"s:{i}", t, "2026-07-29T08:00:00+00:00") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source string, channel string, kanal string, feed_id string, body string, fetched_at string")


def test_atom(spark):
    rows = {r.raw_link: r for r in L.parse_feed(bodies(spark, ATOM)).collect()}
    assert set(rows) == {"https://y.com/b", "https://y.com/c"} and all(r.failure is None for r in rows.values())
    first, second = rows["https://y.com/b"], rows["https://y.com/c"]
    assert (first.title, first.summary, first.published_at, second.published_at) == ("Harga beras", "Isi", "2026-07-29T07:00:00Z", "2026-07-29T07:00:00Z")
    assert json.loads(first.extra) == {"rights": "free"} and json.loads(second.extra) == {}


def test_extra_holds_no_label(spark):
    got = [r for r in L.parse_feed(bodies(spark, MORE)).collect() if r.failure is None]
    assert [json.loads(r.extra) for r in got] == [{"dc:creator": "Rina", "comments": "3"}]
    assert [r.raw_link for r in got] == ["https://x.com/d"]


def test_parse_report(spark):
    empty = "<rss><channel><title>c</title></channel></rss>"
    rows = {r.feed_id: r for r in L.parse_report(bodies(spark, MORE, empty, "not xml <", None, "", RSS)).collect()}
    assert (rows["s:0"].entries, rows["s:0"].failures, rows["s:0"].failure_rate) == (5, 4, 0.8)
    assert rows["s:0"].samples == ["no title: https://x.com/e", "no link: a", "no link: b"]
    assert (rows["s:1"].entries, rows["s:1"].failures, rows["s:1"].failure_rate, rows["s:1"].samples) == (0, 0, 0.0, [])
    for k in "234":
        assert (rows[f"s:{k}"].entries, rows[f"s:{k}"].failures, rows[f"s:{k}"].samples) == (0, 1, ["no XML"]), k
    assert (rows["s:5"].entries, rows["s:5"].failures) == (3, 1)


def test_land_and_load(spark, tmp_path):
    root, store = str(tmp_path / "raw"), Snapshots(spark, str(tmp_path / "warehouse"))
    L.land(frame(spark, [record(k) for k in "123"]), root)
    assert L.load(spark, root, store)["rows_added"] == 3
    L.land(frame(spark, [record(k, fetched="2026-07-30T08:00:00+00:00") for k in "345"]), root)
    got = L.load(spark, root, store)
    assert (got["rows_read"], got["rows_added"]) == (3, 2)
    assert L.load(spark, root, store) == {"files_loaded": 0, "rows_read": 0, "rows_added": 0}
    assert L.load(spark, root, store, force=True)["rows_added"] == 0
    assert {r.article_key for r in L.existing_keys(spark, root, "s", "2026-07-30", 0).collect()} == set("345")
    known = L.existing_keys(spark, root, "s", "2026-07-30", 3)
    L.land(frame(spark, [record("1"), record("1", source="other")]), root, known)
    assert L.landed(spark, root).where("source = 'other'").count() == 1 and L.landed(spark, root).count() == 7


def test_stream(spark, tmp_path):
    root, table = str(tmp_path / "raw"), Snapshots(spark, str(tmp_path / "warehouse"))
    L.land(frame(spark, [record("1"), record("2"), record("2", source="other")]), root)
    ingest.run_available(spark, root, table, str(tmp_path / "cp"))
    ingest.run_available(spark, root, table, str(tmp_path / "cp"))
    L.land(frame(spark, [record("2"), record("3")]), root)
    ingest.run_available(spark, root, table, str(tmp_path / "cp"))
    assert sorted(r.article_key for r in table.read("articles").collect()) == ["1", "2", "3"]


def test_fetch(tmp_path):
    class Reply:
        headers = {"ETag": "e1"}

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return b"body"

    store, slept, now = L.StateStore(str(tmp_path / "s.json")), [], [0.0]
    run = lambda opener: L.fetch("http://x/", "f", store, opener, lambda: now[0], slept.append)

    def fails(code, after=None):
        head = email.message.Message()
        if after:
            head["Retry-After"] = after

        def opener(_):
            raise urllib.error.HTTPError("http://x/", code, "", head, None)

        return opener

    assert run(lambda r: Reply()) == ("ok", b"body") and store.get("f").etag == "e1"
    assert run(fails(304)) == ("not_modified", None)
    assert run(fails(503, "7"))[0] == "failed" and slept == [7, 7, 7]
    slept.clear()
    assert run(fails(403))[0] == "failed" and not slept
    assert run(fails(404))[0] == "failed" and run(lambda r: Reply())[0] == "skipped_breaker"
    now[0] = 3601
    assert run(lambda r: Reply())[0] == "ok" and store.get("f").failures == 0
    store.save()
    assert L.StateStore(str(tmp_path / "s.json")).get("f").etag == "e1"
    (tmp_path / "s.json").write_text("{broken")
    assert L.StateStore(str(tmp_path / "s.json")).feeds == {}
    assert L.backoff(1, 10, None) == 60 and L.backoff(1, 1, "x") == 2
