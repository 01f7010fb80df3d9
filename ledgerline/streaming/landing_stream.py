"""Re-aimed trigger: run the gcp warehouse load for every newly landed batch.

Instead of a scheduler the trigger is a
Structured Streaming query over the ``LANDED`` markers under the landing
root: the file source's checkpoint remembers which batches were processed,
and ``foreachBatch`` runs the (batch) warehouse job once per new stamp, in
stamp order. Only the stamps - one tiny row per landed batch - reach the
driver; the load itself is the usual distributed job.

Replaying the batch that failed is safe: it adds no dimension version and
rewrites the same fact rows. Which batches were loaded is known only from the
checkpoint location, so that must be given and must last between restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.jobs import job_gcp_landed
from ledgerline.plans.tables import Warehouse
from ledgerline.sources.landing import MARKER
from ledgerline.sources.schemas import SOURCE_TABLES


def landed_markers(spark: SparkSession, landing_root: str) -> DataFrame:
    return spark.readStream.format("text").load(f"{landing_root.rstrip('/')}/*/{MARKER}")


def start_landing_stream(spark: SparkSession, wh: Warehouse, landing_root: str,
                         checkpoint_location: str,
                         tables: tuple[str, ...] = SOURCE_TABLES,
                         available_now: bool = True,
                         interval: str = "1 minute") -> StreamingQuery:
    loaded: list[str] = []

    def apply(batch: DataFrame, epoch_id: int) -> None:
        stamps = sorted({r.value.strip() for r in batch.select("value").collect() if r.value})
        for stamp in stamps:
            job_gcp_landed(spark, wh, landing_root, stamp, tables)
            loaded.append(stamp)

    writer = (landed_markers(spark, landing_root).writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint_location).queryName("ledgerline_landing"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=interval)
    q = writer.start()
    q.loaded_stamps = loaded  # for callers and tests
    return q
