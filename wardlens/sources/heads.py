"""First lines of files, read without reading the files.

``file_heads`` is a data source whose partitions are groups of files. A task opens each of its files and reads
blocks until the first line ends, so the bytes read do not grow with the files. Files are opened through
Arrow's file systems (local, S3, GCS, HDFS); where those don't know a path's scheme, one scan of the lines
takes their place.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 1 << 16
FILES_PER_TASK = 64


def _source_class():
    # Made in a function, so that executors get its code by value and need not have this package.
    def first_line(stream, block: int) -> tuple[bytes | None, int]:
        """(first line without its end, bytes read); None of an empty stream. Lines end as in text sources."""
        held, size = b"", 0
        while part := stream.read(block):
            size += len(part)
            ends = [at for at in (part.find(b"\n"), part.find(b"\r")) if at >= 0]
            if ends:
                return held + part[:min(ends)], size
            held += part
        return (held if size else None), size

    class Heads(DataSource):
        @classmethod
        def name(cls) -> str:
            return "file_heads"

        def schema(self) -> str:
            return "file string, header string, bytes_read long"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    class Reader(DataSourceReader):
        def __init__(self, options) -> None:
            self.files = json.loads(options["files"])
            self.block = int(options["block"])
            self.group = int(options["group"])

        def partitions(self):
            return [InputPartition(self.files[k:k + self.group]) for k in range(0, len(self.files), self.group)]

        def read(self, partition):
            from pyarrow import fs

            for file in partition.value:
                system, path = fs.FileSystem.from_uri(file)
                with system.open_input_stream(path, compression="detect", buffer_size=0) as stream:
                    line, size = first_line(stream, self.block)
                if line is not None:
                    yield file, line.decode("utf-8", "replace"), size

    return Heads


def _openable(file: str) -> bool:
    from pyarrow import fs

    try:
        system, path = fs.FileSystem.from_uri(file)
        return system.get_file_info(path).type == fs.FileType.File
    except (OSError, ValueError, NotImplementedError):
        return False


def _scanned_heads(spark: SparkSession, path: str) -> DataFrame:
    """The same by a scan of all lines, reduced to a row per file in the tasks that read it."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        "value", F.monotonically_increasing_id().alias("at"))
    return lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))


def file_heads(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """file, header (and, unless scanned, bytes_read) of all files below ``path`` that aren't empty."""
    files = spark.read.text(path).inputFiles()  # Spark lists them; nothing is read
    if files and not _openable(files[0]):
        return _scanned_heads(spark, path)
    spark.dataSource.register(_source_class())
    return (spark.read.format("file_heads").option("files", json.dumps(list(files)))
            .option("block", str(block)).option("group", str(FILES_PER_TASK)).load())


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> files below ``path`` that start with it, as readers take their paths."""
    groups: dict[str, list[str]] = {}
    for row in sorted(file_heads(spark, path).collect(), key=lambda r: (r.header, r.file)):  # as many rows as files
        groups.setdefault(row.header, []).append(unquote(row.file))
    return groups
