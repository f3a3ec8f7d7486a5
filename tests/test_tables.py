import threading

import pytest
from pyspark.sql import functions as F

from test_sources import frame, record
from tidemark.sources import landing as L
from tidemark.sources.tables import Busy, Conflict, Snapshots


@pytest.fixture
def store(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "w"))


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def held(store, name="t", version=None):
    return sorted(map(tuple, store.read(name, version=version).collect()))


def test_versions(spark, store):
    assert store.version() == 0
    with pytest.raises(KeyError):
        store.read("t")
    with store.writer() as t:
        assert t.append("t", rows(spark, (1, "a"), (2, "b")), most=F.max("k")) == {"rows": 2, "most": 2}
        assert t.append("t", rows(spark)) == {"rows": 0}
    with store.writer() as t:
        t.append("t", rows(spark, (3, "c")))
        t.replace("u", rows(spark, (9, "z")))
        assert store.read("t").count() == 2 and t.read("t").count() == 3
    assert store.version() == 2 and held(store) == [(1, "a"), (2, "b"), (3, "c")] and held(store, version=1) == [(1, "a"), (2, "b")]
    with store.writer():
        pass
    assert store.version() == 2


def test_merge_rewrites_what_it_must(spark, store):
    for pairs in ([(1, "a"), (2, "b")], [(3, "c"), (4, "d")], [(5, "e")]):
        with store.writer() as t:
            t.append("t", rows(spark, *pairs))
    before = store.manifest()["tables"]["t"]["folders"]
    with store.writer() as t:
        assert t.merge("t", rows(spark, (3, "C"), (6, "f"), (None, "n")), "k") == {"rows": 3}
    after = store.manifest()["tables"]["t"]["folders"]
    assert set(before) - set(after) == {before[1]} and len(after) == 4
    assert sorted(map(tuple, store.read("t").where("k IS NOT NULL").collect())) == [(1, "a"), (2, "b"), (3, "C"), (4, "d"), (5, "e"), (6, "f")]
    assert store.read("t").where("k IS NULL").count() == 1


def test_a_failed_writer_leaves_nothing(spark, store):
    with store.writer() as t:
        t.append("t", rows(spark, (1, "a")))
    with pytest.raises(RuntimeError, match="crash"), store.writer() as t:
        t.append("t", rows(spark, (2, "b")))
        raise RuntimeError("crash")
    assert held(store) == [(1, "a")] and store.version() == 1 and len(store.files.names(f"{store.root}/t")) == 1


def test_one_writer(spark, store):
    with store.writer() as t:
        with pytest.raises(Busy), store.writer():
            pass
        late = Snapshots(spark, store.root, lease=-1)  # takes the claim of a writer that seems to be dead
        with late.writer() as u:
            u.append("t", rows(spark, (2, "late")))
        t.append("t", rows(spark, (1, "first")))
        with pytest.raises(Conflict):
            t.commit()
        t.cancel()
    assert held(store) == [(2, "late")]


def test_readers_see_whole_versions(spark, store):
    with store.writer() as t:
        t.append("t", rows(spark, (0, "x"), (0, "y")))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(store.read("t").count())

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 4):
        with store.writer() as t:
            t.replace("t", rows(spark, *[(k, "x"), (k, "y")] * (k + 1)))
    stop.set()
    reader.join()
    assert set(seen) <= {2, 4, 6, 8} and held(store) == sorted([(3, "x"), (3, "y")] * 4)


def test_days_and_expiry(spark, store):
    day = lambda *p: spark.createDataFrame(p, "d string, v int").select(F.to_date("d").alias("d"), "v")
    with store.writer() as t:
        t.overwrite_days("m", day(("2026-01-01", 1), ("2026-01-02", 2), (None, 0)), "d", [])
    with store.writer() as t:
        t.overwrite_days("m", day(("2026-01-02", 3), ("2026-01-03", 4)), "d", ["2026-01-02", "2026-01-03"])
    got = sorted((str(r.d), r.v) for r in store.read("m").collect())
    assert got == [("2026-01-01", 1), ("2026-01-02", 3), ("2026-01-03", 4), ("None", 0)]
    with store.writer() as t:
        t.replace("m", day(("2026-01-09", 9)))
    assert store.expire(keep=1) == 2 and [r.v for r in store.read("m").collect()] == [9] and store.versions() == [3]


def test_load_is_one_transaction(spark, tmp_path, store, monkeypatch):
    """A crash after the log and before the table: neither shows, and the next load adds everything once."""
    root = str(tmp_path / "raw")
    L.land(frame(spark, [record(k) for k in "123"]), root)
    real = L.new_rows

    def crash(*a):
        raise RuntimeError("crash")

    monkeypatch.setattr(L, "new_rows", crash)
    with pytest.raises(RuntimeError):
        L.load(spark, root, store)
    assert store.version() == 0
    monkeypatch.setattr(L, "new_rows", real)
    first = L.load(spark, root, store)
    assert (first["rows_read"], first["rows_added"]) == (3, 3)
    log = {r["file_path"]: r["loaded_at"] for r in store.read("load_log").collect()}
    again = L.load(spark, root, store, force=True)
    assert (again["files_loaded"], again["rows_read"], again["rows_added"]) == (first["files_loaded"], 3, 0)
    renewed = {r["file_path"]: r["loaded_at"] for r in store.read("load_log").collect()}
    assert renewed.keys() == log.keys() and all(renewed[k] > log[k] for k in log) and store.read("load_log").count() == len(log)
