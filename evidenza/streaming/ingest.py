"""Scraped items arriving as files -> upserted section table.

The item stage of the work handles items one by one as they come.  Here each
micro-batch is appended to an item log, and the section table is the newest
state per url of that log, so no table is rewritten per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from evidenza.operators.ingest import DEFAULT_LANGUAGE, valid_sections

ITEM = T.StructType(
    [
        T.StructField("country_doc_id", T.StringType()),
        T.StructField("section_title", T.StringType()),
        T.StructField("section_url", T.StringType()),
        T.StructField("text_content", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)


def stream_items(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Valid section items from JSON-lines files as they land in ``path``."""
    items = (
        spark.readStream.schema(ITEM).option("maxFilesPerTrigger", files_per_trigger).json(path)
    )
    language = F.coalesce(F.col("language"), F.lit(DEFAULT_LANGUAGE))
    return valid_sections(items).withColumn("language", language)


def append_to_log(items: DataFrame, log: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append every micro-batch under its batch id.

    Writing a batch again after a failure replaces that batch's own folder, so
    each item lands exactly once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    writer = items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current_sections(log: DataFrame) -> DataFrame:
    """Newest state of each section of the item log.

    Spark keeps the best row per url inside each map task before the shuffle,
    so a url with a very long history does not meet in one task.  Merge the
    result into a stored table with ``section_upsert``, which clears the vector
    of every section whose text has changed.
    """
    newest = Window.partitionBy("section_url").orderBy(
        F.col("batch_id").desc(), F.col("scraped_at").desc(), F.xxhash64("text_content")
    )
    return (
        log.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn", "batch_id")
    )
