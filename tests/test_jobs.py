import datetime as dt
import json
import threading
import urllib.error
import urllib.request

import pytest

from tidemark.__main__ import main
from tidemark.operators import training
from tidemark.operators.models import Majority, TfIdfMargins
from tidemark.plans.store import Registry
from tidemark.serving import Service, server
from tidemark.sources import cycle

ITEM = "<item><title>{t}</title><link>https://x.com/{k}</link><pubDate>Wed, 29 Jul 2026 14:00:00 +0700</pubDate></item>"


def rss(*keys):
    return f"<rss><channel>{''.join(ITEM.format(t=f'Judul {k} hari ini', k=k) for k in keys)}</channel></rss>".encode()


def test_cycle(spark, tmp_path):
    feeds = [cycle.Feed("a", "x", "k", "u1"), cycle.Feed("a", "y", "k", "u2"), cycle.Feed("b", "x", "k", "u3"), cycle.Feed("c", "x", "k", "u4")]
    answers = {"u1": ("ok", rss("1", "2", "2")), "u2": ("ok", rss("2", "3")), "u3": ("failed", None), "u4": ("not_modified", None)}
    pauses = []
    go = lambda: cycle.run_cycle(spark, feeds, str(tmp_path / "raw"), str(tmp_path / "s.json"), 1.0, frozenset({"c"}), poll=lambda url, *_: answers[url], sleep=pauses.append, now=lambda: 1785312000.0)
    first, second = go(), go()
    assert first.landed == {"a": 3} and second.landed == {} and pauses == [1.0] * 6
    assert first.by_status == {"ok": 2, "failed": 1, "not_modified": 1} and first.lost == {"b"} and first.stale == {"c"} and not first.healthy
    assert "b:x" in first.summary() and first.by_source["a"] == {"feeds": 2, "ok": 2, "failed": 0, "landed": 3}
    assert first.samples == {}
    answers["u1"] = ("ok", b"<rss><channel>" + b"<item><title>left</title></item>" * 4 + b"</channel></rss>")
    third = go()
    assert third.samples == {"a:x": ["no link: left"] * 3} and third.failures["no link"] == ["a:x"] and "a:x: no link: left" in third.summary()
    with pytest.raises(KeyError):
        cycle.feeds_for(feeds, "zzz")


@pytest.fixture(scope="module")
def fct(spark):
    topics = {"sport": "bola gol pemain wasit liga stadion", "money": "rupiah bank saham bunga pajak kurs"}
    rows, t = [], dt.datetime(2026, 7, 30)
    for k in range(600):
        label = ("sport", "money", "sport")[k % 3]
        words = topics[label].split()
        title = " ".join(words[(k + j * j) % 6] for j in range(5)) + f" nomor{k * 7919 % 1000:03d} kode{k * 104729 % 9973} seri{k * 31337 % 7919}"
        rows.append((f"k{k:03d}", t - dt.timedelta(hours=k), "s", label, title, None))
    return spark.createDataFrame(rows, "article_key string, published_at timestamp_ntz, source string, kanal string, title string, summary string")


def test_training_and_serving(spark, fct, tmp_path):
    registry = Registry(str(tmp_path))
    service = Service(spark, registry, ttl=0)
    ask = json.dumps({"articles": [{"title": "gol pemain bola"}, {"title": "bank saham", "summary": "rupiah"}]}).encode()
    assert service.answer("POST", "/predict", ask)[0] == 503 and service.health()["status"] == "no_champion"
    run = training.train_and_promote(fct, registry, resamples=50, candidates=[Majority(), TfIdfMargins(rounds=5, features=500)])
    assert run.winner == "tfidf_linear" and run.verdict == "PROMOTE" and run.scores["tfidf_linear"]["macro_f1"] > 0.9, run.summary()
    assert registry.resolve() == run.artifact and "macro-F1" in run.summary()
    again = training.train_and_promote(fct, registry, resamples=50, candidates=[Majority()])
    assert again.verdict == "REJECT" and registry.resolve() == run.artifact and len(registry.decisions(refused=True)) == 1
    front = server(service, port=0)
    threading.Thread(target=front.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{front.server_address[1]}"
        with urllib.request.urlopen(urllib.request.Request(f"{base}/predict", ask)) as r:
            got = json.load(r)
        assert [p["kanal"] for p in got["predictions"]] == ["sport", "money"] and got["model_id"] == run.artifact
        with urllib.request.urlopen(f"{base}/health") as r:
            assert json.load(r)["status"] == "ok"
        for bad in (b"{}", b"no", json.dumps({"articles": [{"title": ""}]}).encode(), json.dumps({"articles": [{"title": "x"}] * 65}).encode()):
            with pytest.raises(urllib.error.HTTPError, match="422"):
                urllib.request.urlopen(urllib.request.Request(f"{base}/predict", bad))
    finally:
        front.shutdown()
        front.server_close()


def test_unusable(fct, tmp_path):
    registry = Registry(str(tmp_path))
    assert training.train_and_promote(fct.limit(30), registry).verdict == "UNUSABLE" and not registry.decisions()
    with pytest.raises(ValueError):
        training.train_and_promote(fct.limit(0), registry)


def test_command_line(tmp_path, capsys):
    data = ["--data", str(tmp_path)]
    assert main([*data, "champion"]) == 1 and main([*data, "rollback"]) == 1 and main([*data, "decisions"]) == 0
    assert main([*data, "publish", "--repo", "r"]) == 4
    (tmp_path / "export").mkdir()
    for n in ("articles.parquet", "stats", "README.md"):
        (tmp_path / "export" / n).write_text("x")
    assert main([*data, "publish", "--repo", "r", "--dry-run"]) == 0
    feeds = tmp_path / "f.json"
    feeds.write_text(json.dumps([{"source": "a", "channel": "x", "kanal": "k", "url": "u"}]))
    assert main([*data, "status", "--feeds", str(feeds)]) == 0 and main([*data, "ingest", "--feeds", str(feeds), "--source", "zz"]) == 2
    assert "articles: 0" in capsys.readouterr().out


def test_load_transform_status(spark, tmp_path, capsys):
    from test_sources import frame, record

    from tidemark.sources import landing

    data = ["--data", str(tmp_path)]
    feeds = tmp_path / "f.json"
    feeds.write_text(json.dumps([{"source": "s", "channel": "c", "kanal": "k", "url": "u"}]))
    landing.land(frame(spark, [record("1", raw_link="https://x/c/1"), record("2", title_fingerprint="g", fetched_at="2026-07-30T08:00:00+00:00")]), str(tmp_path / "raw"))
    assert main([*data, "load"]) == 0 and main([*data, "load"]) == 0 and main([*data, "transform"]) == 0 and main([*data, "transform"]) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [x.get("rows_added") for x in said[:2]] == [2, 0] and said[2] == {"days": ["2026-07-29", "2026-07-30"], "articles": 2} and said[3]["days"] == []
    assert main([*data, "status", "--feeds", str(feeds)]) == 0
    out = capsys.readouterr().out
    assert "articles: 2" in out and "s: 1 feeds, 2 loaded, URLs tell the label of" in out
    assert main([*data, "export"]) == 0 and json.loads((tmp_path / "export" / "README.md").exists() and capsys.readouterr().out.splitlines()[-1])["articles"] == 2


def test_settings_from_the_environment(monkeypatch, tmp_path, capsys):
    monkeypatch.setenv("TIDEMARK_DATA", str(tmp_path))
    assert main(["champion"]) == 1 and main(["decisions", "--json"]) == 0
    monkeypatch.setenv("TIDEMARK_RETRIES", "many")
    assert main(["champion"]) == 2 and "retries" in capsys.readouterr().err
