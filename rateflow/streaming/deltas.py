"""Structured Streaming maintenance of per-item averages from a feed of deltas.

The feed is a directory of delta files (Parquet or pipe-delimited text) read with the
file source, so every micro-batch covers a set of files recorded in the checkpoint's
offset log. Per item the deltas fold to ``ds`` and ``dn``. Both are sums, so arrival order
and micro-batch boundaries do not matter and no watermark is needed.

Two ways to keep the fold, both exactly once:

* ``mode="folds"`` (default, stateless): each micro-batch folds its own rows (partial
  aggregation, one shuffle) and ``foreachBatch`` writes them to
  ``<out>/folds/batch_id=<n>`` with overwrite. A batch replayed after a failure reads the
  same files and rewrites the same partition. The current fold of an item is the sum
  over all batches. There is no state store, so a batch costs one aggregation of its new
  rows.
* ``mode="stateful"``: a streaming aggregation keeps the running fold in the state store
  (update mode). Each batch writes the cumulative rows of the items it touched, and the
  current fold is the row of each item's latest batch.

A log of small files (``<out>/log``) says what counts: a batch is entered when its fold is
written, a compaction when its table is. Entries appear whole or not at all, and readers go by
them alone, so a fold or a compacted table that an interrupted run has left half-written is never
read. The folds of finished batches are summed into one table (``compact_folds``) when a run has
left more than ``COMPACT_AFTER`` of them; its entry names the table and the last batch in it, and
readers add only the batches after that. Folders that no entry needs any more are removed after
that. An ``out_dir`` keeps to the mode that it was begun with.

The maintained averages are the base state merged with the current fold (a key join).
Checkpoint, state and folds live under the session's shared checkpoint directory unless
``out_dir`` names another shared location.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.operators.incremental import apply_fold, delta_fold
from rateflow.schemas import RATINGS
from rateflow.session import list_names, path_exists, read_text, remove_path, scratch_path, write_text
from rateflow.sources.text import java_split, parse_delta_fields

FOLD_SCHEMA = "item_id bigint, ds double, dn bigint, n_rows bigint"
COMPACT_AFTER = 50


def delta_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "parquet":
        return reader.schema(RATINGS).parquet(source_dir)
    if fmt == "text":
        raw = reader.text(source_dir)
        f = java_split(F.regexp_replace(F.col("value"), '"', ""))
        return parse_delta_fields(raw.select(f.alias("f")), F.col("f"))
    raise ValueError(f"unsupported delta feed format: {fmt}")


def run_delta_stream(spark: SparkSession, source_dir: str, out_dir: str | None = None,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None,
                     mode: str = "folds", timeout_s: float | None = None) -> str:
    """Process everything available in ``source_dir`` (trigger ``availableNow``) and
    return the output directory holding ``folds/`` and ``_checkpoint/``.

    Running it again with the same ``out_dir`` resumes from the checkpoint and only
    processes new files.
    """
    if mode not in ("folds", "stateful"):
        raise ValueError(f"unknown mode: {mode}")
    out = out_dir or scratch_path(spark, "delta-stream")
    other = "stateful" if mode == "folds" else "folds"
    if path_exists(spark, f"{out}/_mode={other}"):
        raise ValueError(f"{out} holds results of mode {other}")
    spark.createDataFrame([], FOLD_SCHEMA).write.mode("overwrite").parquet(f"{out}/_mode={mode}")
    deltas = delta_stream(spark, source_dir, fmt, max_files_per_trigger)

    if mode == "folds":
        def sink(batch: DataFrame, batch_id: int) -> None:
            _store_batch(spark, out, delta_fold(batch), batch_id)
        writer = deltas.writeStream.outputMode("append")
    else:
        def sink(batch: DataFrame, batch_id: int) -> None:
            _store_batch(spark, out, batch, batch_id)
        writer = delta_fold(deltas).writeStream.outputMode("update")

    query = (writer.option("checkpointLocation", f"{out}/_checkpoint")
             .foreachBatch(sink)
             .trigger(availableNow=True)
             .start())
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError("delta stream did not finish in time")
    if mode == "folds":
        batches = _open_batches(spark, out)
        if len(batches) > COMPACT_AFTER:
            compact_folds(spark, out)
    return out


def _store_batch(spark: SparkSession, out_dir: str, fold: DataFrame, batch_id: int) -> None:
    fold.write.mode("overwrite").parquet(f"{out_dir}/folds/batch_id={batch_id}")
    write_text(spark, f"{out_dir}/log/batch-{batch_id:012d}", "")


def _log(spark: SparkSession, out_dir: str) -> tuple[int, list[int]]:
    """The last batch of the last compaction (-1: none), and the batches after it."""
    batches, compactions = [], [-1]
    for name in list_names(spark, f"{out_dir}/log"):
        kind, _, number = name.partition("-")
        if kind in ("batch", "compact"):
            (batches if kind == "batch" else compactions).append(int(number))
    upto = max(compactions)
    return upto, sorted(b for b in batches if b > upto)


def _open_batches(spark: SparkSession, out_dir: str) -> list[int]:
    """Numbers of the batches that are not compacted yet."""
    return _log(spark, out_dir)[1]


def compact_folds(spark: SparkSession, out_dir: str) -> None:
    """Sum the folds of all finished batches (``mode="folds"``) into one table and remove them. Only
    between runs, and not while results of before are still read."""
    _, batches = _log(spark, out_dir)
    if batches:
        name = f"upto-{batches[-1]}-{uuid.uuid4().hex[:12]}"
        summed_folds(spark, out_dir).write.parquet(f"{out_dir}/compacted/{name}")
        write_text(spark, f"{out_dir}/log/compact-{batches[-1]:012d}", name)
    _remove_superseded(spark, out_dir)


def _remove_superseded(spark: SparkSession, out_dir: str) -> None:
    """Delete what the log no longer needs: entries first, so that none names a missing folder."""
    upto, _ = _log(spark, out_dir)
    if upto < 0:
        return
    keep = read_text(spark, f"{out_dir}/log/compact-{upto:012d}")
    for name in list_names(spark, f"{out_dir}/log"):
        kind, _, number = name.partition("-")
        if (kind == "batch" and int(number) <= upto) or (kind == "compact" and int(number) < upto):
            remove_path(spark, f"{out_dir}/log/{name}")
    for name in list_names(spark, f"{out_dir}/folds"):
        if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
            remove_path(spark, f"{out_dir}/folds/{name}")
    for name in list_names(spark, f"{out_dir}/compacted"):
        if name != keep:
            remove_path(spark, f"{out_dir}/compacted/{name}")


def _fold_table(spark: SparkSession, out_dir: str, batches: list[int]) -> DataFrame:
    """The folds of these batches, with their batch_id."""
    if not batches:
        return spark.createDataFrame([], FOLD_SCHEMA + ", batch_id int")
    reader = spark.read.schema(FOLD_SCHEMA + ", batch_id int").option("basePath", f"{out_dir}/folds")
    return reader.parquet(*(f"{out_dir}/folds/batch_id={b}" for b in batches))


def summed_folds(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current fold from per-batch folds (``mode="folds"``): the last compacted table and the
    batches after it, summed."""
    upto, batches = _log(spark, out_dir)
    rows = _fold_table(spark, out_dir, batches).drop("batch_id")
    if upto >= 0:
        name = read_text(spark, f"{out_dir}/log/compact-{upto:012d}")
        rows = rows.unionByName(spark.read.schema(FOLD_SCHEMA).parquet(f"{out_dir}/compacted/{name}"))
    return rows.groupBy("item_id").agg(
        F.sum("ds").alias("ds"), F.sum("dn").alias("dn"), F.sum("n_rows").alias("n_rows"))


def latest_folds(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current fold from cumulative rows (``mode="stateful"``): each item's latest batch."""
    return (_fold_table(spark, out_dir, _log(spark, out_dir)[1]).groupBy("item_id")
            .agg(F.max_by(F.struct("ds", "dn", "n_rows"), F.col("batch_id")).alias("f"))
            .select("item_id", "f.ds", "f.dn", "f.n_rows"))


def current_fold(spark: SparkSession, out_dir: str, mode: str = "folds") -> DataFrame:
    return summed_folds(spark, out_dir) if mode == "folds" else latest_folds(spark, out_dir)


def stream_apply_deltas(spark: SparkSession, state: DataFrame, source_dir: str,
                        out_dir: str | None = None, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None, mode: str = "folds") -> DataFrame:
    """Run the feed to completion and return the maintained averages."""
    out = run_delta_stream(spark, source_dir, out_dir, fmt, max_files_per_trigger, mode)
    return apply_fold(state, current_fold(spark, out, mode))
