"""Streaming intake of submissions: validation per micro-batch with the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lmtables.operators.submissions import screen_submissions, validate_submissions
from lmtables.session import stage

# Fixed value: seconds between two polls.
POLL_SECONDS = 60


def submission_stream(
    spark: SparkSession, path: str, schema: str, *, max_files: int | None = None
) -> DataFrame:
    """Submissions that arrive as Parquet files in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start(writer: DataStreamWriter, *, once: bool, poll_seconds: int = POLL_SECONDS) -> StreamingQuery:
    """One pass over what is there, or a pass per poll interval.

    State with timers asks for batches without data for ever, so a single pass goes without them: its timers fire with
    the next data, those of a polling stream at the next poll.
    """
    SparkSession.active().conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(not once).lower())
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def validating_sink(
    tables: Callable[[], dict[str, DataFrame]], valid_path: str, reject_path: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that splits a batch into valid and rejected submissions.

    ``tables`` gives events, files, documents, rounds and the allow list as of now; a submission for another round
    or base revision is late and goes to the rejects with its reason. Without ``rounds`` it is only screened: what
    depends on the opening of its round is left to the quorum stream. A repeated batch replaces its own output.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        given = tables()
        judge = validate_submissions if "rounds" in given else screen_submissions
        judged = stage(judge(batch, **given), "judged")
        columns = [c for c in judged.columns if c != "meta"]
        for condition, path in (("reject_reason IS NULL", valid_path), ("reject_reason IS NOT NULL", reject_path)):
            judged.where(condition).select(*columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return sink
