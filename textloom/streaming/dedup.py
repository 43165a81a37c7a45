"""Streaming exact dedup of a delimiter-framed corpus.

Two ways to remember what was seen:

* ``dedup_stream``: ``dropDuplicates``; every hash stays in the executors' state
  store, unless a watermark column lets ``dropDuplicatesWithinWatermark`` evict old
  keys.  For streams with an event time.
* ``SeenTable`` / ``run_dedup``: for a corpus that only grows and has no event time.
  Hashes are a table on shared storage, partitioned by hash, and each micro-batch is
  an anti-join with it, so no state is held in memory between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import EOT, decode_cp1252, trim_chars, universal_newlines
from textloom.sources.artifacts import delete_path, list_names, path_exists


def read_delimited_stream(spark: SparkSession, path: str, delim: str = EOT,
                          repair_bytes: bool = True, max_files_per_trigger: int | None = None
                          ) -> DataFrame:
    """Streaming counterpart of ``read_delimited_docs``."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.text(path, lineSep=delim)
    text = F.col("value")
    if repair_bytes:
        text = decode_cp1252(text.cast("binary"))
    text = trim_chars(universal_newlines(text), " \n")
    return raw.select(text.alias("text"),
                      F.col("_metadata.file_path").alias("src_file")).filter(F.length("text") > 0)


def dedup_stream(stream: DataFrame, text_col: str = "text", key_cols=(),
                 watermark_col: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Drop repeated texts from a stream (first arrival wins)."""
    hashed = stream.withColumn("text_md5", F.md5(F.col(text_col)))
    keys = [*key_cols, "text_md5"]
    if watermark_col:
        return hashed.withWatermark(watermark_col, delay).dropDuplicatesWithinWatermark(keys)
    return hashed.dropDuplicates(keys)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint_path: str,
                      fmt: str = "parquet") -> None:
    """Process everything available now into ``sink_path`` and stop; a restart
    with the same checkpoint resumes where it left off (exactly-once sink)."""
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()


class SeenTable:
    """The hashes that micro-batches have accepted, below ``path``.

    ``batch-<id>`` holds what batch ``id`` accepted; ``base-<id>`` holds all of the
    batches up to ``id`` and replaces them.  Both are partitioned by ``bucket``, a
    function of the hash, and sorted by it.  A batch reads only what earlier batches
    wrote, so running it again after a failure gives the same answer and overwrites
    the same folders."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32, compact_every: int = 16):
        self.spark, self.path, self.buckets, self.compact_every = spark, path.rstrip("/"), buckets, compact_every

    SCHEMA = "hash binary, bucket int"

    def _parts(self, before: int) -> list[str]:
        """The folders that together hold every batch below ``before``."""
        done = [n for n in list_names(self.spark, self.path) if path_exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        number = lambda n: int(n.split("-")[1])
        bases = [n for n in done if n.startswith("base-") and number(n) < before]
        base = max(bases, key=number, default=None)
        least = number(base) + 1 if base else 0
        rest = [n for n in done if n.startswith("batch-") and least <= number(n) < before]
        return ([base] if base else []) + sorted(rest, key=number)

    def hashes(self, before: int = 1 << 62) -> DataFrame:
        """``hash, bucket`` of all texts accepted by batches below ``before``."""
        parts = [f"{self.path}/{n}" for n in self._parts(before)]
        reads = [self.spark.read.schema(self.SCHEMA).parquet(p) for p in parts]
        out = reads[0] if reads else self.spark.createDataFrame([], self.SCHEMA)
        for r in reads[1:]:
            out = out.unionByName(r)
        return out

    def size(self) -> int:
        return self.hashes().count()

    def keyed(self, df: DataFrame, keys: list) -> DataFrame:
        h = F.unhex(F.md5(F.concat_ws("\u0000", *[F.col(k).cast("string") for k in keys])))
        return df.withColumn("_tl_hash", h).withColumn("_tl_bucket", F.pmod(F.xxhash64("_tl_hash"), F.lit(self.buckets)).cast("int"))

    def accept(self, batch: DataFrame, keys: list, batch_id: int) -> DataFrame:
        """The rows of ``batch`` whose key no earlier batch and no other row of this
        one has (of several, any one); call ``remember`` with what was kept.

        Compaction comes first, when all batches that it replaces are committed: a
        batch that is run again finds either what it found before or the base."""
        if batch_id and batch_id % self.compact_every == 0:
            self.compact(batch_id - 1)
        one = self.keyed(batch, keys).dropDuplicates(["_tl_hash"])
        seen = self.hashes(batch_id).select(F.col("hash").alias("_tl_hash"), F.col("bucket").alias("_tl_bucket"))
        return one.join(seen, ["_tl_bucket", "_tl_hash"], "left_anti")

    def remember(self, kept: DataFrame, batch_id: int) -> None:
        self._write(kept.select(F.col("_tl_hash").alias("hash"), F.col("_tl_bucket").alias("bucket")), f"batch-{batch_id}")

    def _write(self, hashes: DataFrame, name: str) -> None:
        (hashes.repartition("bucket").sortWithinPartitions("bucket", "hash")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}"))

    def compact(self, upto: int) -> None:
        """One sorted folder instead of all up to ``upto``; what it replaces goes only
        when it is complete."""
        old = self._parts(upto + 1)
        if len(old) > 1:
            self._write(self.hashes(upto + 1), f"base-{upto}")
            for n in old:
                if n != f"base-{upto}":
                    delete_path(self.spark, f"{self.path}/{n}")


def run_dedup(stream: DataFrame, sink_path: str, state_path: str, checkpoint_path: str,
              text_col: str = "text", key_cols=(), buckets: int = 32, compact_every: int = 16) -> SeenTable:
    """Process everything available now: new texts go to ``sink_path/batch=<id>``.

    A batch that fails is repeated under the same id by Structured Streaming and
    overwrites what it wrote, in the sink and in the table of seen hashes."""
    spark = stream.sparkSession
    table = SeenTable(spark, state_path, buckets, compact_every)
    keys, columns = [*key_cols, text_col], stream.columns

    def each(batch: DataFrame, batch_id: int) -> None:
        table.spark = batch.sparkSession
        out = f"{sink_path.rstrip('/')}/batch={batch_id}"
        table.accept(batch, keys, batch_id).write.mode("overwrite").parquet(out)
        kept = batch.sparkSession.read.parquet(out)  # the hashes are those of the rows that were written
        table.remember(kept, batch_id)

    q = (stream.select(*columns).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    table.spark = spark
    return table


def read_deduped(spark: SparkSession, sink_path: str) -> DataFrame:
    """The texts that ``run_dedup`` has accepted so far."""
    df = spark.read.option("basePath", sink_path).parquet(f"{sink_path.rstrip('/')}/batch=*")
    return df.drop("_tl_hash", "_tl_bucket")
