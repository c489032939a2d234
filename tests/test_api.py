import os

import pytest

from rateflow import api
from tests.conftest import FIXTURES

DELTA_SCHEMA = "user_id long, item_id long, old_rating double, rating double, ts long"


@pytest.fixture(scope="module")
def loaded(spark):
    items = api.load_items(spark, os.path.join(FIXTURES, "items_small.txt"))
    ratings = api.load_ratings(spark, os.path.join(FIXTURES, "ratings_small.txt"))
    return items, ratings


def test_analytics_facade(loaded):
    items, ratings = loaded
    an = api.Analytics(ratings, items)
    assert an.items_rated_per_year().count() == 23
    r = an.least_most_tag().collect()[0]
    assert (r.least_tag, r.least_years, r.most_tag, r.most_years) == ("Animation", 3, "Adventure", 23)
    top = {x.year: x.title for x in an.top_item_per_year().collect()}
    assert top[2010] == "Avatar (2009)"
    assert api.Analytics.items_with_all_tags(items, ["IMAX"]).count() == 4
    an.unpersist()


def test_averages_facade_updates(spark, loaded):
    items, ratings = loaded
    av = api.Averages(spark, ratings, items)
    d1 = spark.createDataFrame([(7, 1, 4.5, 4.0, 1106635948)], DELTA_SCHEMA)
    d2 = spark.createDataFrame([(7, 1, 4.0, 0.0, 1106635949)], DELTA_SCHEMA)
    av.update(d1)
    av.update(d2)
    toy = [r.avg for r in av.result().collect() if r.item_id == 1][0]
    assert toy == pytest.approx(3.815217, abs=1e-6)
    assert av.keyword_average(["AFakeGenre"]).collect()[0].keyword_avg == -1.0


def test_recommender_facade(spark, loaded):
    items, ratings = loaded
    idx = api.LSHIndex(items)
    assert idx.bucket_sizes().count() == 3
    rec = api.Recommender(spark, idx, ratings, als_params={"blocks": 4})
    req = rec.requests([(16, ["Action", "Adventure", "Sci-Fi"]), (148, ["Action", "Adventure", "Sci-Fi"])])
    got = {}
    for r in rec.recommend_baseline(req, 3).orderBy("query_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.item_id)
    assert got == {16: [1210, 122886, 166528], 148: [1196, 260, 1210]}
    als = {}
    for r in rec.recommend_collaborative(req, 3).orderBy("query_id", "rank").collect():
        als.setdefault(r.user_id, []).append(r.item_id)
    assert als == {16: [1210, 72998, 166528], 148: [166528, 1210, 1196]}
    pairs = spark.createDataFrame([(1, 260)], "user_id long, item_id long")
    assert abs(rec.predict_baseline(pairs).collect()[0].prediction - 4.799) < 0.01
    assert abs(rec.predict_collaborative(pairs).collect()[0].prediction - 4.808) < 0.05


def _folders(spark):
    import os
    from rateflow.session import checkpoint_dir
    return {f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith("rateflow-")}


def test_closing_leaves_no_tables(spark, items, ratings):
    from rateflow.api import Averages, LSHIndex, Recommender
    before = _folders(spark)
    index = LSHIndex(items)
    with Recommender(spark, index, ratings, als_params={"max_iter": 2}) as rec:
        req = rec.requests([(16, ["Action", "Adventure", "Sci-Fi"])])
        assert len(rec.recommend_baseline(req, 3).collect()) == 3 and len(rec.recommend_collaborative(req, 3).collect()) == 3
        assert len(rec.predict_collaborative(spark.createDataFrame([(16, 260)], "user_id long, item_id long")).collect()) == 1
        assert _folders(spark) != before
    averages = Averages(spark, ratings, items, keyword_index=True)
    averages.update(ratings.limit(5))
    assert averages.keyword_averages(spark.createDataFrame([("q", ["Action"])], "query_id string, keywords array<string>")).count() == 1
    averages.close()
    index.unpersist()
    assert _folders(spark) == before


def test_scopes_own_what_is_stored_in_them(spark):
    from rateflow.session import ScratchScope, materialize, path_exists
    with ScratchScope(spark) as outer:
        a = materialize(spark.range(3), "a")
        with ScratchScope(spark) as inner:
            b = materialize(spark.range(4), "b")
    assert (a.count(), b.count(), len(outer.paths), len(inner.paths)) == (3, 4, 1, 1)
    kept, gone = outer.paths[0], inner.paths[0]
    inner.release()
    assert path_exists(spark, kept) and not path_exists(spark, gone) and a.count() == 3
    outer.release()
    assert not path_exists(spark, kept)
