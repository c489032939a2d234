import pytest
import os

from rateflow.operators import incremental as I
from rateflow.operators import stats as S
from rateflow.sources.text import write_deltas_text
from rateflow.streaming.deltas import current_fold, run_delta_stream, stream_apply_deltas

DELTA_SCHEMA = "user_id long, item_id long, old_rating double, rating double, ts long"


def _deltas(spark):
    rows = [(611, 166528, None, 5.0, 1), (7, 1, 4.5, 4.0, 2), (7, 1, 4.0, 0.0, 3),
            (7, 122886, None, 5.0, 4), (7, 122886, 5.0, 4.0, 5), (1, 424242, None, 3.0, 6),
            (9, 260, None, 2.5, 7), (9, 3114, None, 0.5, 8)]
    return spark.createDataFrame(rows, DELTA_SCHEMA)


def test_stream_equals_batch_any_split(spark, ratings, items, tmp_dir):
    state = S.item_stats(ratings, items).cache()
    deltas = _deltas(spark)
    expected = sorted(I.apply_delta(state, deltas).collect())
    for n_files, per_trigger in ((1, None), (4, 1), (8, 3)):
        feed = os.path.join(tmp_dir, f"feed{n_files}")
        deltas.repartition(n_files).write.parquet(feed)
        for mode in ("folds", "stateful"):
            got = stream_apply_deltas(spark, state, feed, out_dir=os.path.join(tmp_dir, f"out{n_files}{mode}"),
                                      max_files_per_trigger=per_trigger, mode=mode)
            assert sorted(got.collect()) == expected, (n_files, mode)


def test_stream_text_feed_and_resume(spark, ratings, items, tmp_dir):
    state = S.item_stats(ratings, items).cache()
    deltas = _deltas(spark)
    feed = os.path.join(tmp_dir, "textfeed")
    os.makedirs(feed)
    out = os.path.join(tmp_dir, "out")
    # a text source reads files in the directory; write batches as sub-files
    src = os.path.join(feed, "src")
    write_deltas_text(deltas.where("ts <= 3"), os.path.join(tmp_dir, "batch1"))
    write_deltas_text(deltas.where("ts > 3"), os.path.join(tmp_dir, "batch2"))
    os.makedirs(src)
    # first batch of files arrives, the stream runs
    for f in os.listdir(os.path.join(tmp_dir, "batch1")):
        if f.startswith("part-"):
            os.link(os.path.join(tmp_dir, "batch1", f), os.path.join(src, "a-" + f))
    run_delta_stream(spark, src, out, fmt="text")
    first = sorted(I.apply_fold(state, current_fold(spark, out)).collect())
    assert first == sorted(I.apply_delta(state, deltas.where("ts <= 3")).collect())
    # more files arrive; the same checkpoint resumes and only reads the new ones
    for f in os.listdir(os.path.join(tmp_dir, "batch2")):
        if f.startswith("part-"):
            os.link(os.path.join(tmp_dir, "batch2", f), os.path.join(src, "b-" + f))
    run_delta_stream(spark, src, out, fmt="text")
    second = sorted(I.apply_fold(state, current_fold(spark, out)).collect())
    assert second == sorted(I.apply_delta(state, deltas).collect())


def test_compaction_keeps_the_fold_and_later_batches(spark, ratings, items, tmp_dir):
    from rateflow.streaming import deltas as D
    state = S.item_stats(ratings, items).cache()
    deltas = _deltas(spark)
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out")
    deltas.where("ts <= 3").repartition(3).write.parquet(feed)
    run_delta_stream(spark, feed, out, max_files_per_trigger=1)
    expected = sorted(current_fold(spark, out).collect())
    D.compact_folds(spark, out)
    assert D._open_batches(spark, out) == [] and sorted(current_fold(spark, out).collect()) == expected
    D.compact_folds(spark, out)  # nothing new: nothing changes
    assert sorted(current_fold(spark, out).collect()) == expected
    deltas.where("ts > 3").write.mode("append").parquet(feed)
    run_delta_stream(spark, feed, out)
    assert sorted(I.apply_fold(state, current_fold(spark, out)).collect()) == sorted(I.apply_delta(state, deltas).collect())


def test_modes_do_not_mix(spark, tmp_dir):
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out")
    _deltas(spark).write.parquet(feed)
    run_delta_stream(spark, feed, out)
    with pytest.raises(ValueError, match="holds results of mode folds"):
        run_delta_stream(spark, feed, out, mode="stateful")


def _compaction_stopped(D, monkeypatch, spark, out, name):
    """compact_folds, stopped when it first calls the named helper."""
    class Stopped(Exception):
        pass

    def stop(*args):
        raise Stopped
    with monkeypatch.context() as patch:
        patch.setattr(D, name, stop)
        with pytest.raises(Stopped):
            D.compact_folds(spark, out)


def test_interrupted_compaction_changes_nothing(spark, tmp_dir, monkeypatch):
    from rateflow.streaming import deltas as D
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out")
    _deltas(spark).repartition(3).write.parquet(feed)
    run_delta_stream(spark, feed, out, max_files_per_trigger=1)
    expected = sorted(current_fold(spark, out).collect())
    _compaction_stopped(D, monkeypatch, spark, out, "summed_folds")  # before its table is written
    assert sorted(current_fold(spark, out).collect()) == expected
    _compaction_stopped(D, monkeypatch, spark, out, "write_text")  # the table is written, but not entered
    assert len(os.listdir(f"{out}/compacted")) == 1 and len(D._open_batches(spark, out)) == 3
    assert sorted(current_fold(spark, out).collect()) == expected
    _compaction_stopped(D, monkeypatch, spark, out, "_remove_superseded")  # entered, but old folders are still there
    assert D._open_batches(spark, out) == [] and sorted(current_fold(spark, out).collect()) == expected
    D.compact_folds(spark, out)  # nothing new: it tidies up
    assert len(os.listdir(f"{out}/compacted")) == 1 and os.listdir(f"{out}/folds") == []
    assert sorted(current_fold(spark, out).collect()) == expected


def test_half_written_batches_are_not_read(spark, tmp_dir):
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out")
    _deltas(spark).coalesce(1).write.parquet(feed)
    run_delta_stream(spark, feed, out)
    expected = sorted(current_fold(spark, out).collect())
    # What an interrupted batch leaves: a folder without an entry in the log.
    spark.read.parquet(f"{out}/folds/batch_id=0").write.parquet(f"{out}/folds/batch_id=1")
    assert sorted(current_fold(spark, out).collect()) == expected


def test_folds_without_rows(spark, tmp_dir):
    from rateflow.streaming import deltas as D
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out")
    _deltas(spark).limit(0).coalesce(1).write.parquet(feed)
    run_delta_stream(spark, feed, out)
    D.compact_folds(spark, out)
    assert current_fold(spark, out).collect() == []
    _deltas(spark).write.mode("append").parquet(feed)
    run_delta_stream(spark, feed, out)
    assert {r.item_id for r in current_fold(spark, out).collect()} == {r.item_id for r in _deltas(spark).collect()}
