"""Streams of text lines, one integer per line."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket. It cannot be replayed after a failure; prefer Kafka or files."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_lines(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Lines from the values of a Kafka topic (needs Spark's Kafka package on the classpath)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).options(**options).load().select(F.col("value").cast("string"))


def text_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of text files as they land in a folder or below; without a limit a batch takes all new files."""
    stream = spark.readStream.schema("value string").option("recursiveFileLookup", "true")
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.text(path)


def _folder_and_glob(spark: SparkSession, path: str) -> tuple[str, str]:
    """A table that is a folder of files, or one file, as a folder and a pattern of file names."""
    parent, _, name = path.rstrip("/").rpartition("/")
    files = [unquote(f) for f in spark.read.parquet(path).inputFiles()]
    one_file = len(files) == 1 and files[0].endswith(f"/{name}") and not files[0].endswith(f"/{name}/{name}")
    return (parent, name) if one_file else (path, "*")


def column_lines(spark: SparkSession, path: str, column: str, files_per_batch: int | None = None) -> DataFrame:
    """An integer column of a Parquet table, one file or a folder of files, as text lines."""
    folder, glob = _folder_and_glob(spark, path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", glob)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(folder).select(F.col(column).cast("string").alias("value"))


def land(lines: DataFrame, path: str) -> None:
    """Play a producer: add these lines to a folder of text files, as many as there are tasks.

    A stream that takes all new files at each trigger, run once per landing on one checkpoint,
    sees one landing per micro-batch, whatever the number and the times of the files.
    """
    lines.select("value").write.mode("append").text(path)
