"""Text files as a data source of their own: ``spark.read.format("texts")`` and ``df.write.format("texts")``.

Reading plans partitions by bytes: small files share one, a file is never cut;
partitions of a large folder are larger, so that tasks don't grow as its files.
Texts come as valid UTF-8 with single line ends. Writing puts a file a row,
whole or not at all. Files whose name ends in .zst are compressed. Paths are those that pyarrow's file systems open (local or
mounted folders, HDFS, object stores).
"""

from __future__ import annotations

import fnmatch
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .texts import LEAST_TEXT

#: Bytes of files that make up a partition, and bytes of texts that make up a batch.
PARTITION, BATCH = 32 << 20, 8 << 20
#: Partitions beyond which they are made larger instead of more, and the bytes up to which they grow so.
PARTS, GROWN = 256, 256 << 20
#: The ending of compressed files, and how hard they are compressed.
PACKED, LEVEL = ".zst", 19
#: What a file costs beyond its bytes, so that very many small ones are spread.
OPENED = 64 << 10
SCHEMA = "filename string, path string, length bigint, text string"


@dataclass
class Files(InputPartition):
    """The files of one partition, as (path, bytes)."""

    files: list[tuple[str, int]]


def planned(files: list[tuple[str, int]], most: int) -> list[list[tuple[str, int]]]:
    """Files in parts of about ``most`` bytes: the largest first, each to a part that has room for it."""
    parts: list[list[tuple[str, int]]] = []
    room = 0
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if not parts or size + OPENED > room:
            parts.append([])
            room = most
        parts[-1].append((path, size))
        room -= size + OPENED
    return parts


def roomy(files: list[tuple[str, int]], most: int) -> int:
    """Bytes of a partition: ``most``, or more where that would make very many of them. Files are read one by one, whatever a partition holds."""
    return max(most, min(GROWN, sum(size + OPENED for _, size in files) // PARTS))


def decoded(raw: bytes) -> str:
    """Valid UTF-8, with a sign for what isn't, and single line ends."""
    return raw.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")


class TextsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.where = options["path"]
        self.pattern = options.get("pattern", "*.txt")
        self.least = int(options.get("leastBytes", LEAST_TEXT + 1))
        self.most = int(options.get("partitionBytes", PARTITION))
        self.deep = str(options.get("recursive", "false")).lower() == "true"

    def partitions(self) -> list[Files]:
        store, folder = fs.FileSystem.from_uri(self.where)
        found = store.get_file_info(fs.FileSelector(folder, recursive=self.deep))
        files = [(f.path, f.size) for f in found if f.type == fs.FileType.File and f.size >= self.least and fnmatch.fnmatch(f.base_name, self.pattern) and f.base_name[0] not in "._"]
        return [Files(p) for p in planned(files, roomy(files, self.most))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.where)
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            names, paths, sizes, texts = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(paths), pa.array(sizes, pa.int64()), pa.array(texts)], ["filename", "path", "length", "text"])

        for path, length in partition.files if partition else ():
            # A name's ending tells whether the stream is compressed, and is left out of the name.
            packed = path.endswith(PACKED)
            with store.open_input_stream(path, compression="zstd" if packed else None) as f:
                text = decoded(f.read())
            rows.append((posixpath.basename(path).removesuffix(PACKED), path, length, text))
            size += len(text)
            if size >= BATCH:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    files: int


class TextsWriter(DataSourceWriter):
    """Rows of filename and either text or content (binary) as files; of rows with one name the last one written stays."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.level = int(options.get("level", LEVEL))
        self.where, self.body = options["path"], "content" if "content" in schema.names else "text"
        if "filename" not in schema.names or self.body not in schema.names:
            raise ValueError("texts are written from filename and text or content")
        store, folder = fs.FileSystem.from_uri(self.where)
        store.create_dir(folder, recursive=True)
        if overwrite:
            store.delete_dir_contents(folder)

    def write(self, rows: Iterator) -> Written:
        store, folder = fs.FileSystem.from_uri(self.where)
        files, known = 0, set()
        for row in rows:
            name, body = row["filename"], row[self.body]
            to = f"{folder}/{name}"
            if (parent := posixpath.dirname(to)) not in known:
                store.create_dir(parent, recursive=True)
                known.add(parent)
            draft = f"{parent}/.{uuid.uuid4().hex}.draft"
            raw = body.encode() if isinstance(body, str) else bytes(body or b"")
            with store.open_output_stream(draft) as f:
                f.write(pa.Codec("zstd", compression_level=self.level).compress(raw, asbytes=True) if name.endswith(PACKED) else raw)
            # A task that runs again writes the same file again.
            store.move(draft, to)
            files += 1
        return Written(files)

    def commit(self, messages: list) -> None:
        store, folder = fs.FileSystem.from_uri(self.where)
        with store.open_output_stream(f"{folder}/_SUCCESS") as f:
            f.write(b"")

    def abort(self, messages: list) -> None:
        """Files that are there are whole; without ``_SUCCESS`` they may not be all."""


class TextsSource(DataSource):
    """Options: path, pattern (of names), leastBytes, partitionBytes, recursive; level of compression for writing."""

    @classmethod
    def name(cls) -> str:
        return "texts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TextsReader:
        return TextsReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> TextsWriter:
        return TextsWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TextsSource)
