"""Reading and writing of source files and texts."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import base_name
from textloom.session import work_path

ENTRY = "path string, length long, modified long, folder boolean"
ENTRY_ROWS = 10_000
READ_BYTES = 4 << 20


def small_files(spark: SparkSession) -> SparkSession:
    """Session for scans of very many small files: one counts little more than its bytes, so a task takes hundreds of them."""
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.files.openCostInBytes", "64k")
    return session


def _hidden(name: str, folder: bool) -> bool:
    """Names that Spark's file sources pass over."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _entries(uri: str, extension: str):
    """Folders below the root to what lies directly in them: folders, and files of the extension that are not empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = FileSystem.from_uri(uri)
        rows = []
        for folder in itertools.chain.from_iterable(batch.column(0).to_pylist() for batch in batches):
            for found in system.get_file_info(FileSelector("/".join((top.rstrip("/"), folder)) if folder else top)):
                name, is_folder = found.base_name, found.type == FileType.Directory
                wanted = is_folder or (found.type == FileType.File and found.size and name.endswith(extension))
                if wanted and not _hidden(name, is_folder):
                    path = f"{folder}/{name}" if folder else name
                    rows.append((path, found.size, (found.mtime_ns or 0) // 1_000_000, is_folder))
                if len(rows) == ENTRY_ROWS:
                    yield _batch(rows)
                    rows = []
        yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * 4
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["path", "length", "modified", "folder"])


def _root(spark: SparkSession, folder: str, extension: str) -> tuple[str, str] | None:
    """The folder as a URI and as paths of Spark's file sources start, if it is one that Arrow's file systems reach.

    Patterns are left to Spark's file sources, and so are folders of other file systems and those that do not exist.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    uri, start = whole.toUri().toString(), whole.toString().rstrip("/") + "/"
    try:
        system, top = FileSystem.from_uri(uri)
        known = system.get_file_info(top).type == FileType.Directory
    except (ValueError, NotImplementedError, OSError):
        return None
    return None if re.search(r"[][{}*?\\]", folder + extension) or not known else (uri, start)


def _listed(spark: SparkSession, session: SparkSession, uri: str, extension: str, recursive: bool) -> DataFrame | None:
    """``(path, length, modified)`` of files, paths below the folder; tasks list the folders of one depth after the other.

    The driver holds no entry: folders and files are stored, and a folder is listed by one task. Without ``recursive``,
    None where folders of partitions lie in the folder, which Spark's file sources read too.
    """
    tasks, stored = int(spark.conf.get("spark.sql.shuffle.partitions")), []
    folders = session.range(1).select(F.lit("").alias("path"))
    while not stored or (recursive and not folders.isEmpty()):
        stored.append(work_path(spark, "listing"))
        folders.repartition(tasks, "path").mapInArrow(_entries(uri, extension), ENTRY).write.parquet(stored[-1])
        folders = session.read.schema(ENTRY).parquet(stored[-1]).filter("folder").select("path")
    if not recursive and not folders.filter(F.col("path").contains("=")).isEmpty():
        return None
    return session.read.schema(ENTRY).parquet(*stored).filter("NOT folder").drop("folder")


def _spark_files(session: SparkSession, folder: str, extension: str, recursive: bool) -> DataFrame:
    """The files by Spark's own source, whose driver holds the listing."""
    reader = session.read.format("binaryFile").option("pathGlobFilter", f"*{extension}").option("ignoreCorruptFiles", "true")
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)


def discover(spark: SparkSession, folder: str, extension: str, recursive: bool = False) -> DataFrame:
    """Files of one extension directly in a folder, or also below it, case-sensitive; file contents are not read.

    Files of zero bytes hold no document and are not listed, as by Spark's file sources.
    """
    session, root = small_files(spark), _root(spark, folder, extension)
    listing = _listed(spark, session, root[0], extension, recursive) if root else None
    if listing is None:
        listing = _spark_files(session, folder, extension, recursive)
    else:
        listing = listing.select(
            F.concat(F.lit(root[1]), "path").alias("path"), "length", F.timestamp_millis("modified").alias("modificationTime")
        )
    return listing.select("path", base_name(F.col("path")).alias("file_name"), "length", "modificationTime")


def in_folder(path: Column, extension: str, folder: str | None = None) -> Column:
    """The same selection on a stored listing: the extension, and the parent folder when one is given."""
    match = path.endswith(extension)
    return match if folder is None else match & (F.concat(F.lit(folder + "/"), base_name(path)) == path)


def plain_path(path: Column) -> Column:
    """A path as file systems name it; the metadata column of file sources is percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _contents(uri: str, start: str):
    """Paths below the root to paths and contents, in batches of about ``READ_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = FileSystem.from_uri(uri)
        paths, contents, size = [], [], 0
        for path in itertools.chain.from_iterable(batch.column(0).to_pylist() for batch in batches):
            paths.append(start + path)
            contents.append(_content(system, "/".join((top.rstrip("/"), path))))
            size += len(contents[-1] or b"")
            if size >= READ_BYTES or len(paths) == ENTRY_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])
                paths, contents, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])

    return run


def _content(system: FileSystem, path: str) -> bytes | None:
    """Bytes of a file, None where they cannot be read; a file that is gone fails the job, as in Spark's file sources."""
    try:
        with system.open_input_file(path) as file:
            return file.read()
    except FileNotFoundError:
        raise
    except OSError:
        return None


def read_files(spark: SparkSession, folder: str, extension: str, recursive: bool = False) -> DataFrame:
    """Whole files as ``(path, content)``; one file is one document. Files that cannot be read have a null content."""
    session, root = small_files(spark), _root(spark, folder, extension)
    listing = _listed(spark, session, root[0], extension, recursive) if root else None
    if listing is None:
        found = _spark_files(session, folder, extension, recursive).select("path", "content")
        return found.unionByName(unreadable_files(found).withColumn("content", F.lit(None).cast("binary")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listing.select("path").repartition(tasks, "path").mapInArrow(_contents(*root), "path string, content binary")


def unreadable_files(files: DataFrame) -> DataFrame:
    """``path`` of the listed files of Spark's own source that give no content; the contents are read, only paths are compared.

    Without the contents no file is opened, so the paths alone are those of the listing, which is made once for both.
    """
    return files.select("path").join(files.filter(F.length("content") >= 0).select("path"), "path", "left_anti")


def decode_texts(files: DataFrame, content: str = "content") -> DataFrame:
    """Replace bytes with ``text`` (UTF-8, line ends as newline) and ``error`` for invalid files."""
    raw = F.col(content).cast("string")
    text = F.replace(F.replace(raw, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    valid = F.is_valid_utf8(raw)
    return files.select(
        *[c for c in files.columns if c != content],
        F.when(valid, text).alias("text"),
        F.when(~valid, "invalid UTF-8").alias("error"),
    )


def read_texts(spark: SparkSession, folder: str, extension: str = ".txt", recursive: bool = False) -> DataFrame:
    """``(path, text, error)`` of a folder; files that cannot be read or decoded carry ``error`` and no text."""
    found = read_files(spark, folder, extension, recursive)
    read = decode_texts(found.withColumn("unread", F.col("content").isNull()))
    return read.select("path", "text", F.when(F.col("unread"), "unreadable").otherwise(F.col("error")).alias("error"))


def write_documents(documents: DataFrame, path: str, by_split: bool = False, mode: str = "append") -> None:
    """Documents as Parquet, optionally one folder per split."""
    writer = documents.write.mode(mode)
    (writer.partitionBy("split") if by_split else writer).parquet(path)
