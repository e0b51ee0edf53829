"""Stream operators kept in Spark's state store.

``start_state_store_counts`` is the per-movie count/mean as a streaming
aggregation in update mode: partial aggregation runs before the shuffle,
the state (one row per movie) lives in the configured state store
(RocksDB by default in ``ratecraft.session``) and is checkpointed with the
query, so a restart resumes it.  Each batch's updated rows are upserted
into a keyed table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ratecraft.schemas import EVENT_SCHEMA
from ratecraft.functions import columns as C
from ratecraft.streaming.keyed import LatestTable
from ratecraft.streaming.fanout import parse_messages, split_quarantine


@dataclass
class StateStoreRun:
    query: object
    table: LatestTable


def counts_table(spark: SparkSession, path: str, key: str = "item_id") -> LatestTable:
    """The table that ``start_state_store_counts`` upserts into."""
    return LatestTable(spark, path, [key], [])


def start_state_store_counts(stream: DataFrame, out_path: str, checkpoint: str,
                             key: str = "item_id", available_now: bool = True) -> StateStoreRun:
    good, _ = split_quarantine(parse_messages(stream))
    agg = good.groupBy(key).agg(F.count("rating").alias("rating_count"),
                                F.sum("rating").alias("rating_sum"))
    table = counts_table(stream.sparkSession, out_path, key)

    def upsert(df: DataFrame, batch_id: int) -> None:
        table.write_batch(df.withColumn("rating_avg", F.col("rating_sum") / F.col("rating_count")),
                          batch_id)

    w = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(upsert))
    w = w.trigger(availableNow=True) if available_now else w
    return StateStoreRun(w.start(), table)


# S10 ----------------------------------------------------------------------------------
def read_counts(spark: SparkSession, checkpoint: str, key: str = "item_id") -> DataFrame:
    """(key, rating_count, rating_avg) out of the state of ``start_state_store_counts`` itself.

    The last committed batch of the checkpoint is read, one task a state
    partition; nothing has to be written for it and the stream may go on.  A
    filter on the key gives the point read.
    """
    state = spark.read.format("statestore").load(checkpoint)
    n, total = F.col("value.count"), F.col("value.sum")
    return state.select(F.col(f"key.{key}").alias(key), n.alias("rating_count"),
                        F.when(n > 0, total / n).alias("rating_avg"))


# R3 -----------------------------------------------------------------------------------
RUNNING_SCHEMA = "seq long, rating_count long, rating_avg double"
UNSET = -(1 << 63)  # stands for null where rows are put in order


def _running_rows(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Events of one item in one micro-batch -> its count and mean as of each; the state keeps (n, sum)."""
    n, total = state.get if state.exists else (0, 0.0)
    rows = pd.concat(frames).sort_values(["at", "seq"], kind="stable")
    counts = n + np.arange(1, len(rows) + 1)
    sums = total + rows["rating"].cumsum().to_numpy()
    state.update((int(counts[-1]), float(sums[-1])))
    yield pd.DataFrame({"item_id": [key[0]] * len(rows), "seq": rows["seq"].to_numpy(), "rating_count": counts,
                        "rating_avg": sums / counts})


def running_values(stream: DataFrame, id_type: str = "long") -> DataFrame:
    """(seq, item_id, rating_count, rating_avg) of every rated event, as of that event.

    The state store keeps one (n, sum) an item, so a micro-batch costs its own
    events, however many came before.  Inside a micro-batch events go by time
    and sequence number, nulls first; from one to the next they go by arrival, so
    a late event counts when it comes.  An item's events of one micro-batch are
    one group: the trigger's limit (``maxFilesPerTrigger``,
    ``maxOffsetsPerTrigger``) bounds it.
    """
    good, _ = split_quarantine(parse_messages(stream, id_type))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = good.where(F.col("rating").isNotNull()).select(
        "item_id", F.coalesce(micros, F.lit(UNSET)).alias("at"), F.coalesce("seq", F.lit(UNSET)).alias("seq"), "rating")
    rows = events.groupBy("item_id").applyInPandasWithState(
        _running_rows, f"item_id {id_type}, {RUNNING_SCHEMA}", "n long, total double", "append",
        GroupStateTimeout.NoTimeout)
    return rows.select(F.when(F.col("seq") != UNSET, F.col("seq")).alias("seq"), "item_id", "rating_count", "rating_avg")


def start_running_values(stream: DataFrame, out_path: str, checkpoint: str, *, id_type: str = "long",
                         available_now: bool = True, processing_time: str | None = None):
    """Append ``running_values`` to Parquet files under ``out_path``; the sink's own log makes each batch
    appear once, also after a restart."""
    w = (running_values(stream, id_type).writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def flatten_stream(stream: DataFrame) -> DataFrame:
    """value -> movie fields, rating, user fields (the console consumer's view)."""
    txt = stream.select(C.payload_text("value").alias("json"))
    data = txt.select(C.parse_json("json", EVENT_SCHEMA).alias("value")).select("value.*")
    return data.select("movie.*", "rating", "user.*")
