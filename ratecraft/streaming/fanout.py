"""Rating event streams.

One streaming query reads message payloads, parses them against the
declared record schema, sets aside records whose key parts are missing
(quarantine, decision Q5; a rating that is no number still counts as activity
and as a review) and, inside one ``foreachBatch``, writes

* per-movie partial counts (n, sum, latest title/genres)  -> AdditiveTable
* per-user activity partials (n, latest profile)           -> AdditiveTable
* review rows keyed ``user_movie``                         -> LatestTable

Every output is partitioned by ``batch_id`` and overwritten per batch, and a
commit marker comes last; views show committed batches only, so a failed batch
is not seen and its re-run is idempotent (Q6).  A late event counts when it
comes and never stops the stream.  And two events
of one movie in one batch both count (Q3): the batch is rolled up first
and merged with the stored totals, not read-modify-written per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.functions import columns as C
from ratecraft.schemas import EVENT_SCHEMA
from ratecraft.streaming.keyed import AdditiveTable, LatestTable, _ChangeLog, exists

# The published record plus an optional sequence number (an extra field is
# ignored by readers that do not know it).
MESSAGE_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [T.StructField("seq", T.StringType())])
PAYLOAD_SCHEMA = T.StructType([T.StructField("value", T.BinaryType())])


# S7 / S8 -----------------------------------------------------------------------------
def message_stream(spark: SparkSession, path: str | None = None, *, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None, options: dict[str, str] | None = None
                   ) -> DataFrame:
    """A stream of message payloads (column ``value``).

    ``fmt='kafka'`` passes on the options given (``kafka.bootstrap.servers``,
    ``subscribe``, ...) and no others, so the connector's own defaults hold; it
    needs the Kafka connector on the classpath.  File formats read ``value``
    from files dropped in ``path``, all new files a batch unless
    ``max_files_per_trigger`` says otherwise.
    """
    r = spark.readStream
    if fmt == "kafka":
        return r.format("kafka").options(**(options or {})).load().select("value")
    r = r.schema(PAYLOAD_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


# R1 / P3-P6 --------------------------------------------------------------------------
def parse_messages(df: DataFrame, id_type: str = "long") -> DataFrame:
    """value bytes -> typed, flat event rows (+ the raw text for quarantine).

    Fields are read one by one, so a bad one costs no other.  Ids become
    ``id_type``: "long", where other ids go to quarantine, or "string", where they
    stay as they are.
    """
    txt = df.select(C.payload_text("value").alias("raw"))
    # the text is parsed once, in a step of its own, and not once a field
    p = txt.select("raw", C.salvage_variant("raw").alias("v")).select("raw", C.variant_fields("v", MESSAGE_SCHEMA).alias("d"))
    return p.select(
        "raw",
        F.col("d.movie.movieId").try_cast(id_type).alias("item_id"),
        F.col("d.movie.title").alias("title"),
        F.col("d.movie.genres").alias("genres"),
        F.col("d.rating").try_cast("double").alias("rating"),
        C.epoch_to_timestamp(F.col("d.timestamp"), "seconds").cast("timestamp_ntz").alias("ts"),
        F.col("d.user.userId").try_cast(id_type).alias("user_id"),
        F.col("d.user.age").try_cast("int").alias("age"),
        F.col("d.user.gender").alias("gender"),
        F.col("d.user.occupation").alias("occupation"),
        F.col("d.seq").try_cast("long").alias("seq"))


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a record needs both key parts; without a numeric rating (null) it is still
    an activity of its user and a review, and adds nothing to its item's sums."""
    ok = F.col("item_id").isNotNull() & F.col("user_id").isNotNull()
    return parsed.filter(ok).drop("raw"), parsed.filter(~ok).select("raw")


@dataclass
class RatingTables:
    """The outputs of the rating stream, under one root folder; ids are ``id_type``."""
    spark: SparkSession
    root: str
    id_type: str = "long"

    @property
    def movies(self) -> AdditiveTable:
        return AdditiveTable(self.spark, f"{self.root}/movies", ["item_id"], ["n", "s"],
                             ["title", "genres"], ["ts", "seq"], self.commits_path)

    @property
    def users(self) -> AdditiveTable:
        return AdditiveTable(self.spark, f"{self.root}/users", ["user_id"], ["n"],
                             ["age", "gender", "occupation"], ["ts", "seq"], self.commits_path)

    @property
    def reviews(self) -> LatestTable:
        return LatestTable(self.spark, f"{self.root}/reviews", ["review_id"], ["ts", "seq"], self.commits_path)

    @property
    def commits_path(self) -> str:
        return f"{self.root}/commits"

    def _log(self, name: str) -> _ChangeLog:
        return _ChangeLog(self.spark, f"{self.root}/{name}", [], self.commits_path)

    # views ----------------------------------------------------------------------------
    def item_stats(self) -> DataFrame:
        m = self.movies.current()
        return m.select("item_id", "title", "genres", F.col("n").alias("rating_count"),
                        F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias("rating_avg"))

    def user_stats(self) -> DataFrame:
        u = self.users.current()
        return u.select("user_id", "age", "gender", "occupation", F.col("n").alias("activity_count"))

    def review_table(self) -> DataFrame:
        return self.reviews.current()

    def item_stats_latest_reviews(self) -> DataFrame:
        """Q7 option: count and mean over the current reviews, so a re-review
        replaces the user's earlier rating instead of adding to it."""
        r = self.reviews.current()
        return r.groupBy(F.col("movie.movieId").cast(self.id_type).alias("item_id")).agg(
            F.count("rating").alias("rating_count"), F.avg("rating").alias("rating_avg"))

    def batches(self) -> DataFrame:
        """(batch, n_messages, n_quarantined) of every committed batch."""
        schema = "batch long, n_messages long, n_quarantined long"
        if not exists(self.spark, self.commits_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.commits_path).select("batch", "n_messages", "n_quarantined")

    def quarantined(self) -> DataFrame:
        return self._log("quarantine").rows()


def process_batch(tables: RatingTables, batch: DataFrame, batch_id: int) -> None:
    """The body of ``foreachBatch``: every write replaces this batch's partition,
    the commit marker is written last."""
    parsed = parse_messages(batch, tables.id_type).persist()
    try:
        good, bad = split_quarantine(parsed)
        # the first job over the batch counts its messages, the job that writes the bad records counts those
        read, held = Observation(), Observation()
        _, seen_bad = split_quarantine(parsed.observe(read, F.count(F.lit(1)).alias("n")))
        tables._log("quarantine").write_batch(seen_bad.observe(held, F.count(F.lit(1)).alias("n")), batch_id)

        ordkey = F.struct("ts", "seq")
        movies = good.groupBy("item_id").agg(
            F.count("rating").alias("n"), F.sum("rating").alias("s"),
            F.max_by(F.struct("title", "genres", "ts", "seq"), ordkey).alias("a")
        ).select("item_id", "n", "s", "a.*")
        tables.movies.write_batch(movies, batch_id)

        users = good.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.max_by(F.struct("age", "gender", "occupation", "ts", "seq"), ordkey).alias("a")
        ).select("user_id", "n", "a.*")
        tables.users.write_batch(users, batch_id)

        reviews = good.select(
            C.composite_key("user_id", "item_id").alias("review_id"), "rating", "ts", "seq",
            F.struct(F.col("item_id").cast("string").alias("movieId"), "title", "genres").alias("movie"),
            F.struct(F.col("user_id").cast("string").alias("userId"), "age", "gender",
                     "occupation").alias("user"))
        tables.reviews.write_batch(reviews, batch_id)

        totals = [F.lit(x).cast("long").alias(c) for c, x in (("batch", int(batch_id)), ("n_messages", read.get["n"]),
                                                              ("n_quarantined", held.get["n"]))]
        tables.spark.range(1).select(*totals).coalesce(1).write.mode("overwrite").parquet(f"{tables.commits_path}/batch_id={int(batch_id)}")
    finally:
        parsed.unpersist()


def start_rating_stream(stream: DataFrame, tables: RatingTables, checkpoint: str, *,
                        available_now: bool = True, processing_time: str | None = None,
                        query_name: str | None = None):
    """Start the one query that feeds the keyed outputs (decision Q8); values as of each event come from
    the state store (``stateful.start_running_values``)."""
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: process_batch(tables, df, bid)))
    if query_name:
        w = w.queryName(query_name)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def drain(query) -> None:
    """Wait until an availableNow query has consumed everything."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
