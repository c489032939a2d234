import pytest

from rateflow.operators import als as ALS
from rateflow.operators import lsh as L
from rateflow.operators import recommend as R

SW = ["Action", "Adventure", "Sci-Fi"]


@pytest.fixture(scope="module")
def als_model(ratings):
    # the original's blocking (4 + 4), which the published goldens come from
    return ALS.fit_als(ratings, blocks=ALS.ALS_BLOCKS)


def test_als_predictions(spark, als_model):
    pairs = spark.createDataFrame([(1, 260), (607, 2628), (999999, 260)], "user_id long, item_id long")
    got = {(r.user_id, r.item_id): r.prediction for r in ALS.als_predict(als_model, pairs).collect()}
    assert abs(got[(1, 260)] - 4.808) < 0.05
    assert abs(got[(607, 2628)] - 2.756) < 0.05
    assert got[(999999, 260)] != got[(999999, 260)]  # NaN for an unknown user


def test_als_recommend_order(spark, items, ratings, als_model):
    req = spark.createDataFrame([(1, 16, SW), (2, 148, SW)], "query_id long, user_id long, tags array<string>")
    out = R.recommend_als(L.lsh_index(items), req, ratings, als_model, 3).orderBy("query_id", "rank").collect()
    by_u = {}
    for r in out:
        by_u.setdefault(r.user_id, []).append(r.item_id)
    assert by_u[16] == [1210, 72998, 166528]
    assert by_u[148] == [166528, 1210, 1196]


def test_blocks_are_a_fixed_parameter(spark, ratings):
    import inspect
    assert inspect.signature(ALS.fit_als).parameters["blocks"].default == ALS.ALS_BLOCKS
    pairs = ratings.select("user_id", "item_id").distinct()
    few = ALS.als_predict(ALS.fit_als(ratings.coalesce(1), max_iter=3), pairs)
    many = ALS.als_predict(ALS.fit_als(ratings.repartition(6, "user_id"), max_iter=3), pairs)
    a = {(r.user_id, r.item_id): r.prediction for r in few.collect()}
    b = {(r.user_id, r.item_id): r.prediction for r in many.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-3 for k in a)


def test_blocks_grow_with_the_ratings(spark, ratings, monkeypatch):
    assert [ALS.block_count(n) for n in (0, 600_000, 4_000_000, 36_000_000, 216_000_000)] == [4, 4, 4, 12, 30]
    monkeypatch.setattr(ALS, "BLOCKS_GROW_FROM", ratings.count() // 4)
    model = ALS.fit_als(ratings, max_iter=5, dense_ids=True)
    assert model.model.userFactors.rdd.getNumPartitions() == ALS.block_count(ratings.count()) > ALS.ALS_BLOCKS
    f = ALS.factors(model)
    assert max(r.residual for r in ALS.normal_residuals(f, ratings).collect()) < 1e-3


def test_dense_ids_lift_the_int_limit(spark, ratings):
    from pyspark.sql import functions as F
    far = 10 ** 12
    large = ratings.withColumn("user_id", F.col("user_id") + far).withColumn("item_id", F.col("item_id") + far)
    numbers = ALS.id_numbers(large, "user_id")
    n = large.select("user_id").distinct().count()
    assert sorted(r.user_id_number for r in numbers.collect()) == list(range(n))
    model = ALS.fit_als(large, max_iter=3, dense_ids=True)
    pairs = spark.createDataFrame([(far + 1, far + 260), (far + 999999, far + 260)], "user_id long, item_id long")
    got = {r.user_id: r for r in ALS.als_predict(model, pairs).collect()}
    assert got[far + 1].item_id == far + 260 and 0 < got[far + 1].prediction < 6
    assert got[far + 999999].prediction != got[far + 999999].prediction


def _plain_als_residuals(f, ratings):
    """Normal equations of every user with numpy."""
    import numpy as np
    v = {r.item_id: np.array(r.v, float) for r in f.items.collect()}
    u = {r.user_id: np.array(r.u, float) for r in f.users.collect()}
    a, b, n = {}, {}, {}
    for r in ratings.collect():
        if r.item_id in v:
            a[r.user_id] = a.get(r.user_id, 0) + np.outer(v[r.item_id], v[r.item_id])
            b[r.user_id] = b.get(r.user_id, 0) + r.rating * v[r.item_id]
            n[r.user_id] = n.get(r.user_id, 0) + 1
    solved = {x: np.linalg.solve(a[x] + ALS.ALS_REG * n[x] * np.eye(f.rank), b[x]) for x in n}
    return u, solved, n


def test_users_solve_their_normal_equations(spark, ratings, als_model):
    import numpy as np
    f = ALS.factors(als_model)
    u, solved, n = _plain_als_residuals(f, ratings)
    assert set(u) == set(solved)
    assert max(np.abs(u[x] - solved[x]).max() for x in u) < 1e-3
    got = {r.user_id: r for r in ALS.normal_residuals(f, ratings).collect()}
    assert {x: r.n_ratings for x, r in got.items()} == n and max(r.residual for r in got.values()) < 1e-3
    # Factors that don't belong to the ratings are told apart.
    from pyspark.sql import functions as F
    wrong = ALS.normal_residuals(f, ratings.withColumn("rating", 5.5 - F.col("rating"))).collect()
    assert min(r.residual for r in wrong) > 1e-3


def test_fold_in_solves_the_same_system(spark, ratings, als_model):
    import numpy as np
    f = ALS.factors(als_model)
    new = spark.createDataFrame([(-1, 260, None, 5.0, 1), (-1, 1210, None, 1.0, 1), (-1, 424242, None, 3.0, 1), (-2, 424242, None, 3.0, 1), (-3, 260, None, 2.0, 1), (-3, 260, None, 4.0, 2)],
                                "user_id long, item_id long, old_rating double, rating double, ts long")
    every = ratings.unionByName(new)
    _, solved, n = _plain_als_residuals(f, every)
    got = {r.user_id: r for r in ALS.fold_in(f, every).collect()}
    assert set(got) == set(solved) and -2 not in got
    assert all(got[x].n_ratings == n[x] and np.abs(np.array(got[x].u) - solved[x]).max() < 1e-4 for x in got)
    assert ALS.fold_in(f, new.limit(0)).collect() == []
    folded = ALS.Factors(ALS.fold_in(f, new).select("user_id", "u"), f.items, f.rank)
    assert max(r.residual for r in ALS.normal_residuals(folded, new).collect()) < 1e-4


@pytest.mark.parametrize("head, slice_items", [(1, 1_000_000), (3, 4), (64, 1_000_000)])
def test_pruned_recommendations_equal_the_full_ones(spark, monkeypatch, head, slice_items):
    """Random factors with ties, items and users that the model doesn't know, negative scores,
    several rated items and a K of their own."""
    import random
    monkeypatch.setattr(R, "SLICE_ITEMS", slice_items)
    r = random.Random(head)
    vectors = [[r.choice([-1.0, 0.0, 0.5, 2.0]) + (1.0 if j == 0 else 0.0) for j in range(3)] for _ in range(12)]
    items = spark.createDataFrame([(i, r.choice(vectors) if r.random() < 0.9 else None) for i in range(200)], "item_id long, v array<float>")
    users = spark.createDataFrame([(u, [r.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for u in range(25)], "user_id long, u array<float>")
    f = ALS.Factors(users, items.where("v is not null"), 3)
    index = L.lsh_index(items.selectExpr("item_id", "'t' as title", "array(if(item_id < 150, 'big', 'small')) as tags"))
    ratings = spark.createDataFrame([(r.randrange(30), r.randrange(200), 3.0) for _ in range(900)] + [(40, i, 1.0) for i in range(198)], "user_id long, item_id long, rating double")
    requests = spark.createDataFrame([(q, r.choice([*range(30), 40]), [r.choice(["big", "small", "none"])], r.randint(1, 7)) for q in range(120)],
                                     "query_id long, user_id long, tags array<string>, k int")
    for asked in (requests, requests.drop("k")):
        full = sorted(map(repr, R.recommend_als(index, asked, ratings, f, 7, strategy="full").collect()))
        assert full and sorted(map(repr, R.recommend_als(index, asked, ratings, f, 7, head_size=head, strategy="pruned").collect())) == full


def test_blocks_leave_out_most_of_a_large_bucket(spark, monkeypatch):
    """Factors near one direction: what is scored doesn't grow with the bucket."""
    import random
    scored = []
    plain = R._als_scored

    def counted(candidates, seen, rank):
        scored.append(candidates.count())
        return plain(candidates, seen, rank)
    monkeypatch.setattr(R, "_als_scored", counted)
    users = spark.createDataFrame([(u, [1.0 + u / 20, 0.05 * (u % 3 - 1), 0.02]) for u in range(20)], "user_id long, u array<float>")
    requests = spark.createDataFrame([(u, u, ["t"]) for u in range(20)], "query_id long, user_id long, tags array<string>")
    ratings = spark.createDataFrame([(u, i, 1.0) for u in range(20) for i in range(u)], "user_id long, item_id long, rating double")
    for n in (500, 5000):
        r = random.Random(n)
        items = [(i, [2.0 + i / n, r.uniform(-0.1, 0.1), r.uniform(-0.1, 0.1)]) for i in range(n)]
        f = ALS.Factors(users, spark.createDataFrame(items, "item_id long, v array<float>"), 3)
        assert R._beside_mean(f) < R.PRUNED_BESIDE
        index = L.lsh_index(spark.range(n).selectExpr("id as item_id", "'t' as title", "array('t') as tags"))
        full = sorted(map(repr, R.recommend_als(index, requests, ratings, f, 3, strategy="full").collect()))
        scored.clear()
        assert sorted(map(repr, R.recommend_als(index, requests, ratings, f, 3).collect())) == full
        assert sum(scored) <= 20 * 64 * 12  # of 20 * n
    # Factors in all directions: the bounds tell nothing apart.
    spread = ALS.Factors(users, spark.createDataFrame([(i, [float(j == i % 3) for j in range(3)]) for i in range(30)], "item_id long, v array<float>"), 3)
    assert R._beside_mean(spread) > R.PRUNED_BESIDE


@pytest.mark.parametrize("part_items, group_requests", [(1_000_000, 1_000_000), (7, 5)])
def test_blocked_recommendations_equal_the_full_ones(spark, monkeypatch, part_items, group_requests):
    """Ties, scores next to each other, null and repeated ids, items and users that the model
    doesn't know, users who rated nearly all, lists without tags and a K of their own."""
    import random
    monkeypatch.setattr(L, "PART_ITEMS", part_items)
    monkeypatch.setattr(R, "GROUP_REQUESTS", group_requests)
    r = random.Random(part_items)
    vectors = [[r.choice([-1.0, 0.0, 0.5, 2.0]) + r.choice([0.0, 1e-7]) for _ in range(3)] for _ in range(12)]
    factors = [(i, r.choice(vectors) if i < 90 else [r.gauss(0, 1) for _ in range(3)]) for i in range(180) if r.random() < 0.9]
    users = spark.createDataFrame([(u, [r.choice([-1.0, 0.0, 1.0, 0.3]) for _ in range(3)]) for u in range(25)], "user_id long, u array<float>")
    f = ALS.Factors(users, spark.createDataFrame(factors, "item_id long, v array<float>"), 3)
    listed = [*range(180), None, *range(5), *range(170, 175)]
    index = L.lsh_index(spark.createDataFrame([(i, "t", r.choice([["big"], ["big"], ["big"], ["small"], [], None])) for i in listed], "item_id long, title string, tags array<string>"))
    ratings = spark.createDataFrame([(r.choice([*range(30), None]), r.choice([*range(180), None]), 3.0) for _ in range(900)] + [(u, i, 1.0) for u in (3, 40) for i in range(178)], "user_id long, item_id long, rating double")
    requests = spark.createDataFrame([(q, r.choice([*range(30), 40, None]), r.choice([["big"], ["big"], ["small"], ["none"], [], None]), r.randint(1, 7)) for q in range(120)],
                                     "query_id long, user_id long, tags array<string>, k int")
    for asked in (requests, requests.drop("k")):
        full = sorted(map(repr, R.recommend_als(index, asked, ratings, f, 7, strategy="full").collect()))
        assert full and sorted(map(repr, R.recommend_als(index, asked, ratings, f, 7).collect())) == full
    assert R.recommend_als(index, requests.limit(0), ratings, f, 7).collect() == []


def test_tiles_leave_out_no_candidate():
    """Several products for a request, against sorting all scores."""
    import numpy as np
    rng = np.random.default_rng(1)
    for n, m in ((10, 4), (9000, 40), (30_000, 3)):
        v, u, ids = rng.normal(0.5, 0.3, (n, 10)).astype(np.float32), rng.normal(0.5, 0.3, (m, 10)).astype(np.float32), rng.permutation(n)
        v[n // 2:n // 2 + 50] = v[n // 2]
        norms = np.linalg.norm(v.astype(float), axis=1)
        order = np.argsort(-norms)
        v, norms = v[order], norms[order]
        s = sum(u[:, [j]].astype(float) * v[:, j].astype(float) for j in range(10))
        top = np.argsort(-s, axis=1)[:, :4]
        left = (np.repeat(np.arange(m), 4), top.ravel())
        by = np.argsort(left[1], kind="stable")
        s[left] = -np.inf
        r, p, got = R._tiles(u, v, norms, ids, (left[0][by], left[1][by]), 3, 6)
        assert len(r) <= 4 * m and np.allclose(got, s[r, p], rtol=1e-12)
        for i in range(m):
            best = sorted((-round(s[i, j], 6), ids[j]) for j in range(n) if np.isfinite(s[i, j]))[:3]
            assert sorted((-round(x, 6), y) for x, y in zip(got[r == i], ids[p[r == i]]))[:3] == best


def test_candidates_leave_the_groups_as_rows_of_the_result_only(spark, monkeypatch):
    """What is stored for the requests grows with them, not with the bucket."""
    import random
    stored = []
    plain = R._als_blocked

    def counted(*args):
        out = plain(*args)
        stored.append(out.count())
        return out
    monkeypatch.setattr(R, "_als_blocked", counted)
    monkeypatch.setattr(L, "PART_ITEMS", 1000)
    r = random.Random(5)
    users = spark.createDataFrame([(u, [r.gauss(0, 1) for _ in range(3)]) for u in range(50)], "user_id long, u array<float>")
    f = ALS.Factors(users, spark.createDataFrame([(i, [r.gauss(0, 1) for _ in range(3)]) for i in range(4000)], "item_id long, v array<float>"), 3)
    index = L.lsh_index(spark.range(4000).selectExpr("id as item_id", "'t' as title", "array('t') as tags"))
    requests = spark.createDataFrame([(u, u, ["t"]) for u in range(50)], "query_id long, user_id long, tags array<string>")
    ratings = spark.createDataFrame([(u, i, 1.0) for u in range(50) for i in range(u)], "user_id long, item_id long, rating double")
    got = sorted(map(repr, R.recommend_als(index, requests, ratings, f, 3).collect()))
    assert stored and stored[0] <= 50 * 8 * 4  # of 50 * 4,000
    assert got == sorted(map(repr, R.recommend_als(index, requests, ratings, f, 3, strategy="full").collect()))
