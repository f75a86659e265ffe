"""Landing directory -> day-partitioned generation table, as a stream.

Each landed file is processed once (the checkpoint records it). Every micro-batch goes through
the same keyed merge as the batch job: a late row of an old day is added to that day, a
correction replaces the row it corrects, and a repeated micro-batch changes nothing. There is no
watermark, so no row is too late; files are taken however old they are (the source would skip those
a week older than the newest one), and an older file that arrives later replaces nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattframe.plans.ingest import merge_generation
from wattframe.schemas import GENERATION_FEED
from wattframe.session import RELEASE_SHUFFLES, changed_settings
from wattframe.sources.files import CORRUPT


#: How much older than the newest landed file a file may be.
MAX_FILE_AGE = "36500d"
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
#: State on disk, in bounded memory: the default store holds every record that a stream has seen on the executors' heap.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.trackTotalNumberOfRows": "false",  # else every new record is looked up a second time
}
#: For a run that stops by itself: no store stays open beside its copy in the checkpoint; the next batch fetches it from there.
CLOSE_STATE = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}


def generation_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw generation records of landed JSON-lines files, unreadable ones included."""
    schema = T.StructType([*GENERATION_FEED.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir).withColumn("landed_at", F.col("_metadata.file_modification_time"))


def without_repeats(records: DataFrame, within: str) -> DataFrame:
    """A stream without the records that it has brought already within a time of processing (state store).

    A record's file time is part of what must be equal: the same values in a later file may undo a correction, and
    only the merge can tell. The watermark follows the time of processing, which is never late: however old a file or
    a settlement day is, its records pass. What repeats after ``within`` is met by the merge.

    The state holds the values of a record that have a fixed width, and its texts as 128 bits of hash.
    """
    seen = records.withColumn("_seen_at", F.current_timestamp()).withWatermark("_seen_at", within)
    texts = [c for c, kind in records.dtypes if kind == "string"]
    parts = [x for c in texts for x in (F.col(c), F.col(c).isNull())]  # the hash passes over NULL
    seen = seen.withColumns({f"_texts_{n}": F.xxhash64(F.lit(n), *parts) for n in (1, 2)})
    key = [*[c for c in records.columns if c not in texts], "_texts_1", "_texts_2"]
    return seen.dropDuplicatesWithinWatermark(key).select(*records.columns)


def start_generation_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_path: str,
                            available_now: bool = True, quarantine_path: str | None = None,
                            max_files_per_trigger: int | None = None, repeats_within: str | None = None) -> StreamingQuery:
    """Merge what lands into the table; ``available_now`` processes whatever has landed and stops
    (a scheduled daily run). Records that cannot be used go to ``quarantine_path`` if it is given. With
    ``repeats_within`` repeated records are dropped in front of the merge (:func:`without_repeats`)."""
    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_generation(batch, table_path, quarantine_path)

    records = generation_stream(spark, landing_dir, max_files_per_trigger)
    if repeats_within:
        records = without_repeats(records, repeats_within)
    writer = (records.writeStream.foreachBatch(merge)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    settings = RELEASE_SHUFFLES | (STATE_STORE if repeats_within else {}) | (CLOSE_STATE if repeats_within and available_now else {})
    with changed_settings(spark, settings):  # a stream keeps those it starts with
        return writer.start()
