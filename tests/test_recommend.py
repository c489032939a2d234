import math

import pandas as pd  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from rateflow.operators import baseline as B
from rateflow.operators import lsh as L
from rateflow.operators import recommend as R

REQ_SCHEMA = "query_id long, user_id long, tags array<string>"
SW = ["Action", "Adventure", "Sci-Fi"]


@pytest.fixture(scope="module")
def model(ratings):
    return B.fit_baseline(ratings)


@pytest.fixture(scope="module")
def index(items):
    return L.lsh_index(items).cache()


def _pairs(spark, pairs):
    return spark.createDataFrame(pairs, "user_id long, item_id long")


def test_baseline_goldens(spark, model):
    got = {(r.user_id, r.item_id): r.prediction
           for r in B.baseline_predict(model, _pairs(spark, [(1, 260), (607, 2628)])).collect()}
    assert abs(got[(1, 260)] - 4.799) < 0.01
    assert abs(got[(607, 2628)] - 2.609) < 0.01


def test_baseline_cold_rows(spark, model):
    dev = {r.item_id: r.item_dev for r in model.item_dev.collect()}
    avg = {r.user_id: r.user_avg for r in model.user_avg.collect()}
    got = {(r.user_id, r.item_id): r.prediction
           for r in B.baseline_predict(model, _pairs(spark, [(999999, 260), (1, 424242), (999999, 424242)])).collect()}
    d = dev[260]
    # unknown user: average 0.0, so scale is 5 above and |dev| below
    assert got[(999999, 260)] == pytest.approx(5 * d if d > 0 else -d)
    assert got[(1, 424242)] == pytest.approx(avg[1])   # unknown item -> user average
    assert got[(999999, 424242)] == 0.0


def test_zero_scale_gives_minus_infinity(spark):
    # user average exactly 1.0 with a rating below it: scale(r, avg) = avg - 1 = 0
    ratings = spark.createDataFrame([(1, 1, None, 0.5, 0), (1, 2, None, 1.5, 0)],
                                    "user_id long, item_id long, old_rating double, rating double, ts long")
    nd = {r.item_id: r.ndev for r in B.normalized_deviations(ratings).collect()}
    assert nd[1] == float("-inf")
    assert nd[2] == pytest.approx(0.5 / 4.0)


def test_recommend_baseline_goldens(spark, index, ratings, model):
    req = spark.createDataFrame([(1, 16, SW), (2, 148, SW)], REQ_SCHEMA)
    out = R.recommend_baseline(index, req, ratings, model, 3).orderBy("query_id", "rank").collect()
    by_q = {}
    for r in out:
        by_q.setdefault(r.user_id, []).append((r.item_id, r.prediction))
    exp16 = [(1210, 4.019230854017198), (122886, 3.7669563134995636), (166528, 3.7511313860645648)]
    exp148 = [(1196, 4.0481849058529304), (260, 3.9781594058495773), (1210, 3.8884616345528236)]
    for got, exp in ((by_q[16], exp16), (by_q[148], exp148)):
        assert [g[0] for g in got] == [e[0] for e in exp]
        for g, e in zip(got, exp):
            assert abs(g[1] - e[1]) < 1e-6


def test_recommend_edge_cases(spark, index, ratings, model):
    req = spark.createDataFrame([
        (1, 999999, SW),          # unknown user: whole bucket is unseen
        (2, 16, ["cowboy"]),      # tags that match no bucket
        (3, 16, SW),              # K larger than the candidates
    ], REQ_SCHEMA)
    out = R.recommend_baseline(index, req, ratings, model, 50).collect()
    per_q = {}
    for r in out:
        per_q.setdefault(r.query_id, []).append(r)
    assert len(per_q[1]) == 10
    assert 2 not in per_q
    seen16 = {r.item_id for r in ratings.where("user_id = 16").collect()}
    assert len(per_q[3]) == 10 - len(seen16 & {260, 1196, 1210, 2628, 5378, 33493, 72998, 122886, 166528, 179819})
    assert sorted(r.rank for r in per_q[3]) == list(range(1, len(per_q[3]) + 1))


def test_recommend_matches_brute_force(spark, index, ratings, model, items):
    """All 224 users at once against a pandas brute force of the same semantics."""
    users = ratings.select("user_id").distinct()
    tags_cycle = [SW, ["Adventure", "Fantasy"], ["Adventure", "Animation", "Children", "Comedy", "Fantasy"]]
    u = [r.user_id for r in users.collect()]
    req_rows = [(i, uid, tags_cycle[i % 3]) for i, uid in enumerate(sorted(u))]
    req = spark.createDataFrame(req_rows, REQ_SCHEMA)
    got = {(r.query_id, r.rank): (r.item_id, r.prediction)
           for r in R.recommend_baseline(index, req, ratings, model, 3).collect()}

    rp = ratings.toPandas()
    ua = rp.groupby("user_id").rating.mean()
    rp["ua"] = rp.user_id.map(ua)

    def scale(x, r):
        return 5 - r if x > r else (r - 1 if x < r else 1.0)

    rp["nd"] = [(x - a) / scale(x, a) for x, a in zip(rp.rating, rp.ua)]
    dev = rp.groupby("item_id").nd.mean()
    idx = index.toPandas()
    seen = set(zip(rp.user_id, rp.item_id))
    expected = {}
    for qid, uid, tags in req_rows:
        sig = idx[idx.tags.apply(lambda t: sorted(t) == sorted(tags))][["sig_0", "sig_1"]].iloc[0]
        bucket = idx[(idx.sig_0 == sig.sig_0) & (idx.sig_1 == sig.sig_1)].item_id
        scored = []
        for it in bucket:
            if (uid, it) in seen:
                continue
            r = ua.get(uid, 0.0)
            d = dev.get(it)
            p = r if d is None or (isinstance(d, float) and math.isnan(d)) else r + d * scale(r + d, r)
            scored.append((-round(p, 6), it, round(p, 6)))
        for rank, (_, it, p) in enumerate(sorted(scored)[:3], start=1):
            expected[(qid, rank)] = (it, p)
    assert got.keys() == expected.keys()
    for k in expected:
        assert got[k][0] == expected[k][0]
        assert got[k][1] == pytest.approx(expected[k][1], abs=1e-9)


def test_rated_items_and_unseen(spark, index, ratings):
    users = spark.createDataFrame([(1,), (999999,)], "user_id long")
    got = sorted(r.item_id for r in R.rated_items(ratings, users).collect())
    assert got == sorted(r.item_id for r in ratings.where("user_id = 1").collect())
    req = spark.createDataFrame([(1, 1, SW)], REQ_SCHEMA)
    cands = {r.item_id for r in R.unseen_candidates(index, req, ratings).collect()}
    assert cands == {260, 1196, 1210, 2628, 5378, 33493, 72998, 122886, 166528, 179819} - set(got)


def test_top_k_plan_limits_before_shuffle(spark, index, ratings, model):
    req = spark.createDataFrame([(1, 16, SW)], REQ_SCHEMA)
    plan = R.recommend_baseline(index, req, ratings, model, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_all_five_user_ties_break_by_item_id(spark):
    """A user whose average is 5.0: every positive deviation scales by 5 - 5 = 0, so all
    such items predict exactly 5.0 and the item id decides the order."""
    rows = [(1, i, None, 5.0, 0) for i in (1, 2)]               # user 1 rates everything 5
    rows += [(2, 3, None, 5.0, 0), (2, 1, None, 1.0, 0)]        # item 3 above user 2's mean
    rows += [(3, 4, None, 4.0, 0), (3, 1, None, 2.0, 0)]        # item 4 above user 3's mean
    rows += [(4, 5, None, 1.0, 0), (4, 2, None, 3.0, 0)]        # item 5 below user 4's mean
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, old_rating double, rating double, ts long")
    items = spark.createDataFrame([(i, f"t{i}", ["g"]) for i in range(1, 6)],
                                  "item_id long, title string, tags array<string>")
    model = B.fit_baseline(ratings)
    req = spark.createDataFrame([(1, 1, ["g"])], REQ_SCHEMA)
    out = R.recommend_baseline(L.lsh_index(items), req, ratings, model, 3).orderBy("rank").collect()
    assert [(r.item_id, r.prediction) for r in out][:2] == [(3, 5.0), (4, 5.0)]
    assert out[2].item_id == 5 and out[2].prediction < 5.0


@pytest.mark.parametrize("head_size", [1, 3, 64])
@pytest.mark.parametrize("k", [1, 4])
def test_pruned_equals_full_on_fixture(spark, index, ratings, model, head_size, k):
    users = sorted(r.user_id for r in ratings.select("user_id").distinct().collect())
    tag_lists = [SW, ["Adventure", "Fantasy"], ["Adventure", "Animation", "Children", "Comedy", "Fantasy"],
                 ["cowboy"]]
    rows = [(i, u, tag_lists[i % 4]) for i, u in enumerate(users + [999998, 999999])]
    req = spark.createDataFrame(rows, REQ_SCHEMA)
    full = sorted(tuple(r) for r in R.recommend_baseline(index, req, ratings, model, k, strategy="full").collect())
    pruned = sorted(tuple(r) for r in R.recommend_baseline(index, req, ratings, model, k, strategy="pruned",
                                                           head_size=head_size).collect())
    assert pruned == full


_RATING = st.sampled_from([0.5, 1.0, 1.5, 3.0, 5.0])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 9), _RATING), min_size=1, max_size=40),
       st.integers(1, 4), st.integers(1, 4))
def test_pruned_equals_full_random(spark, rows, k, head_size):
    """Few users, few items and coarse ratings: many ties, averages at 1.0 and 5.0,
    zero scales and infinite deviations."""
    seen_pairs = {}
    for u, i, r in rows:
        seen_pairs[(u, i)] = r
    data = [(u, i, None, r, 0) for (u, i), r in seen_pairs.items()]
    rt = spark.createDataFrame(data, "user_id long, item_id long, old_rating double, rating double, ts long")
    its = spark.createDataFrame([(i, f"t{i}", ["g"] if i % 3 else ["h"]) for i in range(1, 10)],
                                "item_id long, title string, tags array<string>")
    idx = L.lsh_index(its)
    m = B.fit_baseline(rt)
    req = spark.createDataFrame([(u, u, ["g"]) for u in range(1, 8)] + [(100 + u, u, ["h"]) for u in range(1, 8)],
                                REQ_SCHEMA)
    full = sorted(map(tuple, R.recommend_baseline(idx, req, rt, m, k, strategy="full").collect()), key=repr)
    pruned = sorted(map(tuple, R.recommend_baseline(idx, req, rt, m, k, strategy="pruned",
                                                    head_size=head_size).collect()), key=repr)
    assert list(map(repr, pruned)) == list(map(repr, full))  # NaN equals itself here


@pytest.mark.parametrize("head", [1, 4, 64])
def test_classes_answer_requests_without_an_order(spark, head):
    """Unknown users and averages outside [1, 5]: the same rows as the full path, ties and NaN included."""
    import random
    r = random.Random(head)
    items = spark.createDataFrame([(i, f"t{i}", ["a"] if i % 3 else ["b"]) for i in range(120)], "item_id long, title string, tags array<string>")
    ratings = spark.createDataFrame(
        [(u, r.randrange(110), None, r.choice([0.5, 0.5, 1.0] if u < 8 else [1.0, 3.0, 4.5, 5.0]), 0) for u in range(20) for _ in range(6)],
        "user_id long, item_id long, old_rating double, rating double, ts long")
    model, idx = B.fit_baseline(ratings), L.lsh_index(items)
    # Users that the model doesn't know, but who have rated nearly everything meanwhile.
    seen = ratings.unionByName(spark.createDataFrame([(900, i, None, 3.0, 0) for i in range(117)], ratings.schema))
    req = spark.createDataFrame([(q, u, [t]) for q, (u, t) in enumerate((u, t) for u in [*range(20), 900, 901, 902] for t in "abc")], REQ_SCHEMA)
    full = sorted(map(repr, R.recommend_baseline(idx, req, seen, model, 5, strategy="full").collect()))
    assert sorted(map(repr, R.recommend_baseline(idx, req, seen, model, 5, head_size=head).collect())) == full


def test_cold_requests_cost_classes_not_requests(spark, index, ratings, model):
    """1,000 requests of unknown users with the same tags rank their bucket once."""
    from rateflow.operators.lsh import with_signature
    req = spark.createDataFrame([(q, 10_000 + q, SW) for q in range(1000)], REQ_SCHEMA)
    classes = with_signature(req, "tags").select("sig_0", "sig_1", F.lit(0.0).alias("r")).distinct()
    assert R.class_heads(index, model, classes, 64, R.DEFAULT_SEEDS, 6).count() == 10
    got = R.recommend_baseline(index, req, ratings, model, 3).groupBy("query_id").agg(F.collect_list("item_id").alias("i")).collect()
    assert len(got) == 1000 and len({tuple(sorted(r.i)) for r in got}) == 1


def test_pruned_path_reads_the_index_and_the_ratings_of_those_who_ask_once(spark, items, ratings, index, model, monkeypatch):
    """Hashed signatures and rated pairs are stored, the latter of the requests' users alone."""
    stored = {}
    plain = R.materialize

    def kept(df, name):
        assert name not in stored
        stored[name] = plain(df, name)
        return stored[name]
    req = spark.createDataFrame([(1, 1, ["Action"]), (2, 4, ["Comedy"]), (3, None, ["Drama"]), (4, -7, ["Drama"])], REQ_SCHEMA)
    full = sorted(map(repr, R.recommend_baseline(index, req, ratings, model, 5, strategy="full").collect()))
    monkeypatch.setattr(R, "materialize", kept)
    assert sorted(map(repr, R.recommend_baseline(index, req, ratings, model, 5).collect())) == full
    assert stored["baseline-index"].columns == ["sig_0", "sig_1", "item_id"]
    pairs = {(r.user_id, r.item_id) for r in stored["rated-pairs"].collect()}
    assert pairs == {(r.user_id, r.item_id) for r in ratings.where(F.col("user_id").isin(1, 4)).collect()}


def test_index_is_spread_before_tags_are_hashed(spark, tmp_path):
    """A small file is one scan task, hashing its tags must not be."""
    spark.range(60_000).selectExpr("id as item_id", "concat('t', id) as title", "array(concat('a', id), 'b') as tags").coalesce(1).write.parquet(f"{tmp_path}/items")
    stored = spark.read.parquet(f"{tmp_path}/items")
    assert stored.rdd.getNumPartitions() == 1
    plan = L.lsh_index(stored)._jdf.queryExecution().executedPlan().toString()
    hashed, spread = plan.index("sig_0"), plan.index("hashpartitioning(item_id")
    assert hashed < spread  # the plan's top comes first
