"""Independent reader of the dead-letter table, with its own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType

from spendwatch import schemas
from spendwatch.operators.retry import dead_letter_counts, summed_counts
from spendwatch.sinks.transactional import COMMITS, is_committed, write_batch
from spendwatch.sources.tables import read_batches
from spendwatch.streaming.triggers import AVAILABLE_NOW, Trigger

# Committed batches that one micro-batch takes; bounds the folder names the driver holds.
BATCHES_PER_POLL = 1000


def stream_commits(spark: SparkSession, root: str, batches: int = BATCHES_PER_POLL) -> DataFrame:
    """Batches as they are committed. Markers, not data files: a try that died has none."""
    return spark.readStream.schema(schemas.COMMITS).option("maxFilesPerTrigger", batches).parquet(
        f"{root}/{COMMITS}").select(F.col("batch_id").cast(LongType()), "try_id")


def new_letters(spark: SparkSession, source: str, commits: DataFrame) -> DataFrame:
    """The dead letters of these batches; no other folder of the table is opened."""
    batches = sorted((r.batch_id, r.try_id) for r in commits.select("batch_id", "try_id").distinct().collect())
    return read_batches(spark, source, "dead_letter", schemas.DEAD_LETTER, batches)


def start_monitor(spark: SparkSession, source: str, root: str, checkpoint: str, size: str = "1 hour",
                  trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Partial counts per topic, error and window of the committed dead letters under `source`, into `dead_letter_deltas`
    under `root`, a folder of its own.

    Each micro-batch counts the newly committed batches alone. Its counts are one committed batch, so a replay adds
    nothing; `current_counts` adds the deltas up.
    """
    def emit(commits: DataFrame, batch_id: int) -> None:
        if is_committed(spark, root, batch_id):
            return
        letters = new_letters(spark, source, commits)
        write_batch(spark, root, batch_id, {"dead_letter_deltas": dead_letter_counts(letters, size)})

    return (
        stream_commits(spark, source).writeStream.queryName("dead_letter_monitor").foreachBatch(emit)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def current_counts(deltas: DataFrame, burst: int = 10) -> DataFrame:
    """The counts of each window, topic and error from the deltas of all batches; `burst` marks a systemic failure."""
    return summed_counts(deltas, burst)
