"""Running word count over new text files in a directory (Structured Streaming).

The same ``word_count`` plan as the batch job, over ``readStream.text``. The
state is one count per distinct word, kept in the state store and checkpointed
with the query's offsets under ``checkpoint``, so a restarted query (or a lost
executor) resumes from the last committed batch without counting a file twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.wordcount import word_count
from quarry.session import remove_path


def word_count_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return word_count(reader.load(directory), "value")


def start_word_count(
    spark: SparkSession,
    directory: str,
    checkpoint: str,
    path: str | None = None,
    sink: str = "files",
    name: str = "word_counts",
    compact_every: int = 50,
) -> StreamingQuery:
    """Start the running count.

    Each micro-batch's changed words (``update`` mode) go through ``foreachBatch``,
    which overwrites one Parquet folder per batch id under ``path``, so a replayed batch rewrites the same
    folder instead of appending twice. After every ``compact_every`` batches the folders become one (see ``compact``).
    ``sink="memory"`` keeps the whole vocabulary in the driver under ``name`` instead: for tests only.
    """
    counts = word_count_stream(spark, directory)
    writer = counts.writeStream.option("checkpointLocation", checkpoint)
    if sink == "memory":
        return writer.outputMode("complete").format("memory").queryName(name).start()
    if path is None:
        raise ValueError("path is required for a file sink")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, batch_id)

    return writer.outputMode("update").foreachBatch(write_batch).start()


def _folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The batch ids of the folders under ``path``: single batches, and compacted ones up to a batch."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(at)]
    return {kind: sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=")) for kind in ("batch", "upto")}


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Write the counts as of batch ``upto`` as one folder, then remove what the compaction before this one had already replaced.

    Folders stay for one compaction longer, so a reader that has listed them can finish. A repeated compaction rewrites its folder.
    """
    before = [n for n in _folders(spark, path)["upto"] if n < upto]
    current_counts(spark, path, upto).write.mode("overwrite").parquet(f"{path}/upto={upto}")
    if before:
        held = _folders(spark, path)
        for kind, last in (("batch", before[-1]), ("upto", before[-1] - 1)):
            for n in held[kind]:
                if n <= last:
                    remove_path(spark, f"{path}/{kind}={n}")


def current_counts(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """(word, occurrences) as of the last batch written by the file sink, or of batch ``upto``.

    A ``batch=N`` folder holds the running totals of the words that changed in batch N, an ``upto=N`` folder those of all
    words as of N. The last compacted folder and the batches after it are read; a word's current total is the
    one from its latest. One aggregate (``max_by``), partial per task.
    """
    held = _folders(spark, path)
    base = [n for n in held["upto"] if upto is None or n < upto][-1:]
    late = [n for n in held["batch"] if n > (base[0] if base else -1) and (upto is None or n <= upto)]
    if not base and not late:
        raise ValueError(f"no counts under {path}")
    parts = [spark.read.parquet(f"{path}/upto={n}").withColumn("batch", F.lit(n)) for n in base]
    if late:
        read = spark.read.option("basePath", path)
        parts.append(read.parquet(*[f"{path}/batch={n}" for n in late]).withColumn("batch", F.col("batch").cast("int")))
    batches = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    return batches.groupBy("word").agg(F.max_by("occurrences", "batch").alias("occurrences"))
