import math
import random

import pytest

from rateflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, cell string"


def _brute(rows, step, k):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in vectors if i % step == 0}:
        s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)[:k]
        out |= {(q, r + 1, i, -n) for r, (n, i) in enumerate(s)}
    return out


@pytest.mark.parametrize("clustered", [True, False])
def test_against_brute_force(spark, monkeypatch, clustered):
    monkeypatch.setattr(topk, "BLOCK", 20)
    monkeypatch.setattr(topk, "FIRST_ROUND", 15)
    rnd = random.Random(3)
    centres = [[rnd.uniform(-1, 1) for _ in range(4)] for _ in range(6)]

    def vector():
        c = rnd.choice(centres) if clustered else [0] * 4
        return [float(int(64 * (x + rnd.uniform(-1, 1) * (0.1 if clustered else 1)))) / 64 for x in c]

    rows = [(i, vector(), 0, "", "", "") for i in range(400)]
    rows += [(i, rows[7][1], 0, "", "", "") for i in range(400, 440)]  # one vector many times: ties
    rows += [(500, None, 0, "", "", ""), (510, [1.0, None, 0.0, 0.0], 0, "", "", ""), (520, [math.nan, 0.0, 0.0, 0.0], 0, "", "", ""),
             (530, [math.inf, 0.0, 0.0, 0.0], 0, "", "", ""), (None, [1.0] * 4, 0, "", "", ""), (540, [0.5, 0.5], 0, "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, "vec_id % 10 = 0", 5).collect()}
    assert got == _brute(rows, 10, 5)


def test_few_and_no_rows(spark):
    one = spark.createDataFrame([(50, [1.0], 0, "", "", "")], SCHEMA)
    assert topk.top_k(one, "vec_id % 50 = 0").collect() == []
    three = spark.createDataFrame([(50, [1.0], 0, "", "", ""), (50, [1.0], 0, "", "", ""), (2, [-1.0], 0, "", "", "")], SCHEMA)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(three, "vec_id % 50 = 0").collect()] == [(50, 1, 2, -65536)]
    assert topk.top_k(spark.createDataFrame([], SCHEMA), "vec_id % 50 = 0").collect() == []


def test_components_beyond_64_bits_are_an_error(spark):
    large = spark.createDataFrame([(50, [1e17, 0.0], 0, "", "", ""), (1, [1e17, 1.0], 0, "", "", "")], SCHEMA)
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(large, "vec_id % 50 = 0").collect()
    fits = spark.createDataFrame([(50, [4e6, -4e6], 0, "", "", ""), (1, [4e6, -4e6], 0, "", "", "")], SCHEMA)
    assert [(r.vec_id, r.score) for r in topk.top_k(fits, "vec_id % 50 = 0").collect()] == [(1, 2 * (256 * 4_000_000) ** 2)]
