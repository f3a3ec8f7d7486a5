import pytest

from tidemark.operators import articles as A
from tidemark.operators import contracts as K
from tidemark.sources import fixture, landing
from tidemark.sources.cycle import Feed
from tidemark.sources.tables import Snapshots

FEEDS = [Feed(s, c, k, "u") for s, c, k in (("a", "news", "politik"), ("a", "sport", "olahraga"), ("b", "money", "ekonomi-bisnis"))]


def test_fixture_goes_through_the_pipeline(spark, tmp_path):
    root, store = str(tmp_path / "raw"), Snapshots(spark, str(tmp_path / "w"))
    assert fixture.build(spark, root, FEEDS, days=2, articles=26) == 156
    assert sorted(map(str, fixture.records(spark, FEEDS, 2, 26).collect())) == sorted(map(str, landing.landed(spark, root).drop("_corrupt_record", "_ingest_file").collect()))
    assert landing.load(spark, root, store)["rows_added"] == 156
    staged = A.staging(store.read("articles"))
    got = staged.selectExpr("count(distinct article_key) keys", "count_if(missing_published_at) undated", "count_if(is_evergreen) old", "count_if(url_leaks_label) leaks", "count(distinct title_fingerprint) stories").first()
    assert (got["keys"], got["undated"]) == (156, 18) and got["old"] > 0 and 0 < got["leaks"] < 156 and got["stories"] < 156
    assert K.future_publication(staged).count() > 0


def test_no_feeds(spark):
    with pytest.raises(ValueError):
        fixture.records(spark, [])
