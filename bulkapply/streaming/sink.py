"""Streams into targets: the micro-batch is the flush, the checkpoint decides what a restart repeats."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from bulkapply.functions.convert import to_sql_types
from bulkapply.functions.copycsv import encode_lines
from bulkapply.options import SinkOptions, TargetSpec
from bulkapply.retry import with_retry
from bulkapply.sources.copyfiles import write_copy_files
from bulkapply.sources.copyload import FORMAT, CopyLoad
from bulkapply.sources.dml import bind, run_statement

Apply = Callable[[DataFrame, int], None]


def feed_name(checkpoint: str) -> str:
    """A short name of the stream that keeps this checkpoint, for its stage tables."""
    return f"{zlib.crc32(checkpoint.encode()):08x}"


def _triggered(writer: DataStreamWriter, options: SinkOptions, available_now: bool) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    if options.interval is None:
        return writer
    return writer.trigger(processingTime=f"{round(options.interval * 1000)} milliseconds")


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    options: SinkOptions = SinkOptions(),
    available_now: bool = False,
) -> StreamingQuery:
    """Append to a Parquet target. Spark's file sink records each batch's files, so a repeated batch adds nothing."""
    rows = to_sql_types(stream, instants=True)
    if options.parallelism is not None:
        rows = rows.repartition(options.parallelism)
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _triggered(writer.outputMode("append"), options, available_now).start()


def apply_stream(
    stream: DataFrame,
    apply: Apply,
    checkpoint: str,
    options: SinkOptions = SinkOptions(),
    output_mode: str = "append",
    available_now: bool = False,
) -> StreamingQuery:
    """Hand each micro-batch to ``apply(rows, batch_id)``, retried as the options say.

    ``apply`` may see a batch again after a failure and must then leave the target as if it had seen it once.
    """

    def flush(rows: DataFrame, batch_id: int) -> None:
        with_retry(lambda: apply(rows, batch_id), options)

    writer = stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).outputMode(output_mode)
    return _triggered(writer, options, available_now).start()


def statement_stream(
    stream: DataFrame,
    statement: str,
    bindings: Mapping[str, Column],
    checkpoint: str,
    options: SinkOptions = SinkOptions(),
    available_now: bool = False,
) -> StreamingQuery:
    """Run a custom statement on every micro-batch, bound as ``dml.bind`` does.

    ``{batch_id}`` in the statement becomes the batch's number, by which a repeated batch can replace what it wrote.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        run_statement(rows.sparkSession, statement.replace("{batch_id}", str(int(batch_id))), bind(rows, bindings))

    return apply_stream(stream, run, checkpoint, options, "append", available_now)


def copy_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    options: SinkOptions = SinkOptions(bulk=True),
    available_now: bool = False,
) -> StreamingQuery:
    """Load-ready COPY files, one folder per micro-batch; a repeated batch replaces its folder."""

    def write(rows: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        write_copy_files(rows, folder, timestamp_digits=options.timestamp_digits, mode="overwrite")

    return apply_stream(stream, write, checkpoint, options, "append", available_now)


def copy_load_stream(
    stream: DataFrame,
    spec: TargetSpec,
    connect: str,
    checkpoint: str,
    options: SinkOptions = SinkOptions(bulk=True),
    available_now: bool = False,
) -> StreamingQuery:
    """Bulk-append every micro-batch through COPY from the executors; a repeated micro-batch is in the target once.

    The target's database holds a stage per stream and a table of the epochs shown, both named after the target. Showing an epoch
    is retried as the options say, and a query that failed goes on from its checkpoint.
    """
    options.check_target(spec)
    stream.sparkSession.dataSource.register(CopyLoad)
    rows = stream if options.parallelism is None else stream.repartition(options.parallelism)
    named = {
        "connect": connect, "dbtable": spec.table, "columns": ",".join(spec.columns), "batch": feed_name(checkpoint),
        "retries": str(options.max_retries), "retry_interval": str(options.retry_interval),
    }
    writer = encode_lines(rows, spec.columns, options.timestamp_digits).writeStream.format(FORMAT).options(**named)
    return _triggered(writer.option("checkpointLocation", checkpoint).outputMode("append"), options, available_now).start()
