import datetime as dt
import random

from tidemark.sources import landing as L
from tidemark.streaming import polling as P

T0 = dt.datetime(2026, 7, 30)


def run(spark, tmp_path, batches, **limits):
    """Each batch is a file and a micro-batch of its own."""
    P.prepare(spark)
    raw = tmp_path / "polls"
    for k, rows in enumerate(batches):
        spark.createDataFrame([(*r, None) for r in rows], P.POLLS).coalesce(1).write.mode("append").json(str(raw / f"b{k:03d}"))
    polls = spark.readStream.schema(P.POLLS).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).json(str(raw))
    out = []
    q = P.decisions(polls, **limits).writeStream.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    return out


def test_is_the_driver_version(spark, tmp_path):
    rng = random.Random(1)
    polls = [(f"s:{rng.randrange(3)}", T0 + dt.timedelta(minutes=7 * k), rng.choice(["ok", "failed", "failed", "failed", "not_modified"]), f"e{k}") for k in range(120)]
    polls = [(f, at, s, e if s == "ok" else None) for f, at, s, e in polls]
    got = run(spark, tmp_path, [polls[k : k + 30] for k in range(0, 120, 30)])
    decided = sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for r in got if r[2] not in ("breaker_closed", "forgotten"))
    want = P.plain(polls)
    assert sorted(want, key=lambda r: (r[0], r[1])) == sorted(decided, key=lambda r: (r[0], r[1]))
    assert any(r[2] == "skipped_breaker" for r in want)


def test_is_the_fetcher(spark, tmp_path):
    """The decisions are those of the fetcher with its state in a file, on one list of events."""
    polls = [("f", T0 + dt.timedelta(seconds=s), status, None) for s, status in ((0, "failed"), (10, "failed"), (20, "ok"), (30, "failed"), (40, "failed"), (50, "failed"), (60, "ok"), (3649, "ok"), (3650, "failed"), (3660, "ok"))]
    store, now = L.StateStore(str(tmp_path / "s.json")), [0.0]

    def opener(_):
        raise OSError

    class Reply:
        headers = {}

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return b""

    want = []
    for feed, at, status, _ in polls:
        now[0] = (at - T0).total_seconds()
        got, _ = L.fetch("http://x/", feed, store, opener if status == "failed" else lambda r: Reply(), lambda: now[0], lambda s: None)
        want.append((at, got, store.get(feed).failures))
    assert [(r[1], r[2], r[3]) for r in sorted(run(spark, tmp_path, [polls[:4], polls[4:7], polls[7:]]), key=lambda r: (r[1], r[2])) if r[2] != "breaker_closed"] == want


def test_breaker_closes_by_itself_and_state_goes(spark, tmp_path):
    polls = [[("f", T0 + dt.timedelta(seconds=k), "failed", None) for k in range(3)], [("g", T0 + dt.timedelta(hours=6), "ok", "e")], [("g", T0 + dt.timedelta(days=9), "ok", "e")], [("g", T0 + dt.timedelta(days=9, hours=2), "ok", "e2")]]
    got = run(spark, tmp_path, polls, forget=86400)
    assert ("f", T0 + dt.timedelta(seconds=3602), "breaker_closed") in [r[:3] for r in got]
    assert ("f", "forgotten") in [(r[0], r[2]) for r in got] and [r[5] for r in got if r[0] == "g" and r[2] == "ok"] == ["e", "e", "e2"]
