import os

import pytest
from pyspark.errors import PySparkException

from rateflow.sources import text as TX
from tests.conftest import FIXTURES


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_load_items_small(items):
    rows = sorted(items.collect(), key=lambda r: str(r.item_id))
    assert len(rows) == 17
    first = [r for r in rows if r.item_id == 1][0]
    assert first.title == "Toy Story (1995)"
    assert first.tags == ["Adventure", "Animation", "Children", "Comedy", "Fantasy"]
    avatar = [r for r in rows if r.item_id == 72998][0]
    assert avatar.tags == ["Action", "Adventure", "Sci-Fi", "IMAX"]


def test_load_ratings_small(ratings):
    assert ratings.count() == 1693
    r = ratings.where("user_id = 1 and item_id = 1").collect()[0]
    assert (r.old_rating, r.rating, r.ts) == (None, 4.0, 964982703)
    assert ratings.select("user_id").distinct().count() == 224
    assert ratings.select("item_id").distinct().count() == 17


def test_java_split_edge_cases(spark, tmp_dir):
    p = os.path.join(tmp_dir, "items.txt")
    _write(p, [
        '1|"A"|"x|y|"',        # trailing separator dropped
        '2|"B"|""',            # empty tag field -> [""]
        '3|"C"|"|||"',         # only separators -> []
        '4|"D, the"|"x||y"',   # inner empty kept, comma in title fine
        '5|"E"|"|x"',          # leading empty kept
    ])
    got = {r.item_id: (r.title, r.tags) for r in TX.read_items_text(spark, p).collect()}
    assert got[1] == ("A", ["x", "y"])
    assert got[2] == ("B", [""])
    assert got[3] == ("C", [])
    assert got[4] == ("D, the", ["x", "", "y"])
    assert got[5] == ("E", ["", "x"])


def test_malformed_line_fails_strict_and_is_diverted_permissive(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ratings.txt")
    _write(p, ["1|2|4.5|100", "x|2|4.0|100", "3|4|5.0"])
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT|INVALID_ARRAY_INDEX"):
        TX.read_ratings_text(spark, p).collect()
    ok = TX.read_ratings_text(spark, p, permissive=True).collect()
    assert [(r.user_id, r.item_id, r.rating, r.ts) for r in ok] == [(1, 2, 4.5, 100)]
    bad = TX.rejected_lines(spark, p, "ratings").collect()
    assert sorted(r.line for r in bad) == ["3|4|5.0", "x|2|4.0|100"]


def test_rejected_items_and_deltas(spark, tmp_dir):
    p = os.path.join(tmp_dir, "items.txt")
    _write(p, ['1|"A"|"x|y"', '2|"B"', 'q|"C"|"z"'])
    assert sorted(r.line for r in TX.rejected_lines(spark, p, "items").collect()) == ['2|"B"', 'q|"C"|"z"']
    assert [r.item_id for r in TX.read_items_text(spark, p, permissive=True).collect()] == [1]
    q = os.path.join(tmp_dir, "deltas.txt")
    _write(q, ["7|1|4.5|4.0|1106635948", "7|1|4.5|?|1106635948"])
    assert [r.line for r in TX.rejected_lines(spark, q, "deltas").collect()] == ["7|1|4.5|?|1106635948"]
    with pytest.raises(ValueError, match="unknown kind"):
        TX.rejected_lines(spark, q, "others")


def test_delta_reader_negative_old_is_null(spark, tmp_dir):
    p = os.path.join(tmp_dir, "d.txt")
    _write(p, ["7|1|4.5|4.0|1106635948", "611|166528|-1|5.0|1493879365"])
    rows = {(r.user_id, r.item_id): r for r in TX.read_deltas_text(spark, p).collect()}
    assert rows[(7, 1)].old_rating == 4.5 and rows[(7, 1)].rating == 4.0
    assert rows[(611, 166528)].old_rating is None


def test_text_round_trip(spark, items, ratings, tmp_dir):
    ip, rp = os.path.join(tmp_dir, "i"), os.path.join(tmp_dir, "r")
    TX.write_items_text(items, ip)
    TX.write_ratings_text(ratings, rp)
    assert sorted(TX.read_items_text(spark, ip).collect()) == sorted(items.collect())
    assert sorted(TX.read_ratings_text(spark, rp).collect()) == sorted(ratings.collect())


def test_fixture_files_exist():
    assert os.path.exists(os.path.join(FIXTURES, "items_small.txt"))


def test_pipe_inside_quoted_title_splits_like_the_original(spark, tmp_dir):
    p = os.path.join(tmp_dir, "items.txt")
    _write(p, ['1|"A|B"|"x"'])
    r = TX.read_items_text(spark, p).collect()[0]
    assert (r.item_id, r.title, r.tags) == (1, "A", ["B", "x"])


@pytest.mark.parametrize("kind, lines", [
    ("items", ['1|"A"|"x|y"', '2|"B"', 'q|"C"|"z"', '3|"D|E"|"w"', ""]),
    ("ratings", ["1|2|3.5|10", "1|2|?|10", "1|2|3.5", "", "x|2|1|1", "7|8|0.5|11"]),
    ("deltas", ["7|1|4.5|4.0|2", "7|1|-1|4.0|2", "7|1|4.5|?|2", "7|1|?|4.0|2"])])
def test_diverted_lines_are_those_of_the_two_readers(spark, tmp_dir, kind, lines):
    path = os.path.join(tmp_dir, kind)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    reader = {"items": TX.read_items_text, "ratings": TX.read_ratings_text, "deltas": TX.read_deltas_text}[kind]
    good, bad = reader(spark, path, True), TX.rejected_lines(spark, path, kind)
    found = TX.divert_lines(spark, path, kind, os.path.join(tmp_dir, "out"))
    assert found.rows.columns == good.columns and sorted(found.rows.collect(), key=repr) == sorted(good.collect(), key=repr)
    assert sorted(found.rejected.collect()) == sorted(bad.collect())
    assert (found.n_lines, found.n_rejected) == (len(lines), found.rejected.count())
    # Each side reads its own folder only.
    for side in (found.rows, found.rejected):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(rejected" in plan and "DataFilters: []" in plan


def test_diverted_lines_of_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    spark.createDataFrame([], "value string").write.text(path)
    found = TX.divert_lines(spark, path, "ratings")
    assert found.rows.collect() == [] and found.rejected.collect() == [] and (found.n_lines, found.n_rejected) == (0, 0)
    with pytest.raises(ValueError, match="unknown kind"):
        TX.divert_lines(spark, path, "others")
