"""Incremental synchronisation as a stream.

Every micro-batch is compared with the stored versions of its own keys, and only
real changes are added, beside the buckets they belong to.  A batch reads the
key, hash and update time of its buckets and nothing else.  The changes and the
batch's number become part of the table in one commit, under the id of the
query, which its checkpoint keeps: a batch that runs again changes nothing, and
streams with different checkpoints, runs and compactions stand in each other's
way only where their buckets meet.  A row older than the stored one is skipped,
so the result does not depend on how the input is cut into batches.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketlake.functions import columns as C
from ticketlake.operators.dedup import last_wins
from ticketlake.operators.sync import normalise_reference
from ticketlake.sources.keyed import LEAST_BUCKETS, KeyedTable, bits, bucket_bitmap, bucket_of
from ticketlake.sources.tables import TableStore

UPDATED = "sys_updated_on"


def _fresh(rows: DataFrame, versions: DataFrame | None, key: str) -> DataFrame:
    """Rows that are new, or not older than the stored version and different from it.

    Versions are compared by hash and time alone; one row per key on both sides.
    """
    if versions is None:
        return rows
    known = last_wins(versions, key, ["_commit"]).select(
        F.col(key).alias("_key"), F.col("etl_hash").alias("_hash"), F.col(UPDATED).cast("timestamp_ntz").alias("_updated")
    )
    fresh = F.col("_key").isNull() | (
        ~F.col("etl_hash").eqNullSafe(F.col("_hash"))
        & F.coalesce(F.col(UPDATED).cast("timestamp_ntz") >= F.col("_updated"), F.lit(True))
    )
    # rows without a key match nothing
    return rows.join(known, F.col(key) == F.col("_key"), "left").where(fresh).drop("_key", "_hash", "_updated")


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    writer: str,
    table: KeyedTable,
    entity: str,
    as_of: datetime,
    order: list[str],
) -> None:
    """Add the rows of one micro-batch that are new, or newer and different."""
    key, state = table.key, table.state()
    if state and state.applied.get(writer, -1) >= batch_id:
        return
    buckets = state.buckets if state else LEAST_BUCKETS
    newest = last_wins(batch, key, [UPDATED, *order]).drop(*order)
    rows = normalise_reference(newest, entity, as_of)
    touched = bits(batch.agg(bucket_bitmap(bucket_of(key, buckets))).first()[0])
    table.add_changes(lambda versions: _fresh(rows, versions, key), touched, [key, "etl_hash", UPDATED], writer, batch_id, buckets)


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query whose micro-batch this is; it stays the same for one checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def incremental_stream(
    source: DataFrame,
    store: TableStore,
    table: str,
    entity: str,
    checkpoint: str,
    as_of: datetime | Callable[[], datetime],
    order: list[str] | None = None,
    late_by: str | None = None,
    compact_every: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the sync of a streaming source; by default it stops when the input is used up.

    ``as_of`` is the load time of the rows (a function is asked once per batch).
    ``compact_every`` folds the changes of a bucket into its base when that many
    have piled up there; without it the caller compacts.

    ``late_by`` (such as the overlap of the batch sync, ``1 hour``) drops repeated
    rows before they reach the comparison, with a watermark; rows later than that
    are then dropped too.  By default nothing is dropped: a repeated row has the
    stored hash and is no change.
    """
    if late_by is not None:
        tracked = [c for c in source.columns if c not in (order or [])]
        # A watermark needs a timestamp with time zone; the session runs in UTC.
        marked = source.withColumns({"_hash": C.row_hash(tracked), "_event": F.col(UPDATED).cast("timestamp")})
        marked = marked.withWatermark("_event", late_by)
        # the update time belongs to the key: a value that returns is a change; rows without an id are all kept
        named = marked.where("sys_id is not null").dropDuplicatesWithinWatermark(["sys_id", "_hash", UPDATED])
        source = named.unionByName(marked.where("sys_id is null")).drop("_hash", "_event")

    stored = store.keyed(table)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            now = as_of() if callable(as_of) else as_of
            apply_batch(batch, batch_id, query_id(batch), stored, entity, now, order or [])
        finally:
            batch.unpersist()
        if compact_every:
            stored.compact(compact_every)

    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
