"""A data source that writes text files from the tasks: `df.write.format("citeloom_files").mode("append").save(folder)`.

Rows are (file, text), in the order of partitions and of rows within them. Every task writes the rows of a file that it holds
as a part of that file, in a folder of its own beside the files, and reports the parts and their sizes. The commit puts the
parts of a file together in the order of the partitions: a file of one part is moved, others are copied part after part. A
file takes its old one's place when it is whole. Parts of tasks that failed, or that ran twice, are in no report and go with
the folder; an aborted write leaves nothing behind. No row comes to the driver.

Folders are paths that all machines share, or URIs of file systems that pyarrow knows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from citeloom.operators.labels import numbered

NAME = "citeloom_files"
_COPIED = 8 << 20


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.rstrip("/"))


@dataclass
class Parts(WriterCommitMessage):
    """(file, part, bytes) of a partition, in the order in which the files came."""

    partition: int
    parts: list[tuple[str, str, int]]


class FilesWriter(DataSourceWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.stage = f"_parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Parts:
        files, root = opened(self.folder)
        context = TaskContext.get()
        stage = f"{root}/{self.stage}/{context.partitionId()}-{context.taskAttemptId()}"
        # the folder above is made once, before the tasks: one that an aborted write has deleted isn't made again by a late task
        files.create_dir(stage, recursive=False)
        parts: list[tuple[str, str, int]] = []
        out, size = None, 0
        for row in iterator:
            if not parts or parts[-1][0] != row["file"]:
                if out:
                    out.close()
                parts.append((row["file"], f"{stage}/{len(parts)}", 0))
                out, size = files.open_output_stream(parts[-1][1], compression=None), 0
            data = (row["text"] or "").encode("utf-8", "surrogatepass")
            out.write(data)
            size += len(data)
            parts[-1] = (*parts[-1][:2], size)
        if out:
            out.close()
        return Parts(context.partitionId(), parts)

    def commit(self, messages: list[Parts | None]) -> None:
        files, root = opened(self.folder)
        by_file: dict[str, list[tuple[str, int]]] = {}
        for message in sorted((m for m in messages if m), key=lambda m: m.partition):
            for name, part, size in message.parts:
                by_file.setdefault(name, []).append((part, size))
        for name, parts in by_file.items():
            if "/" in name:
                files.create_dir(f"{root}/{name.rpartition('/')[0]}")
            for part, size in parts:
                if files.get_file_info(part).size != size:
                    raise OSError(f"{part} has not the size that its task reported")
            whole = parts[0][0]
            if len(parts) > 1:
                whole = f"{root}/{self.stage}/whole"
                with files.open_output_stream(whole, compression=None) as out:
                    for part, _ in parts:
                        with files.open_input_stream(part, compression=None) as taken:
                            while data := taken.read(_COPIED):
                                out.write(data)
            files.move(whole, f"{root}/{name}")
        self._cleared()

    def abort(self, messages: list[Parts | None]) -> None:
        self._cleared()

    def _cleared(self) -> None:
        files, root = opened(self.folder)
        for left in range(4, -1, -1):  # tasks that are being stopped may still be closing their parts
            try:
                if files.get_file_info(f"{root}/{self.stage}").type != fs.FileType.NotFound:
                    files.delete_dir(f"{root}/{self.stage}")
                return
            except OSError:
                if not left:
                    raise
                time.sleep(0.2)


class TextFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "file string, text string"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        if overwrite:
            raise ValueError("files of the same name are replaced and others stay: write with mode('append')")
        folder = self.options["path"]
        files, root = opened(folder)
        made = FilesWriter(folder)
        files.create_dir(f"{root}/{made.stage}")
        return made


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(TextFiles)
    return spark


def rendered(df: DataFrame, render: Callable[[dict], str], *keep: str) -> DataFrame:
    """Columns `keep` of df and `text`, which a small function makes of each row, in the tasks."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(dict(zip(names, row, strict=True))) for row in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])

    kinds = dict(df.dtypes)
    return df.mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "text string"]))


def fixed_text(spark: SparkSession, text: str, section: int, file: str) -> DataFrame:
    """One row of a document: what stands before, between or behind its sections."""
    return spark.range(1).select(F.lit(file).alias("file"), F.lit(section).alias("section"), F.lit(0).cast("long").alias("place"), F.lit(text).alias("text"))


def section(df: DataFrame, order: list[Column], render: Callable[[dict], str], number: int, file: str) -> DataFrame:
    """Rows in an order, each rendered with its `place` in it, as a section of a document."""
    made = rendered(numbered(df, order), render, "place")
    return made.select(F.lit(file).alias("file"), F.lit(number).alias("section"), "place", "text")


def write_sections(parts: list[DataFrame], folder: str) -> None:
    """Writes documents of (file, section, place, text), sorted in ranges."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    write_files(rows, folder, "section", "place")


def write_files(rows: DataFrame, folder: str, *order: str) -> None:
    """Writes rows of (file, text), each file in the order of the given columns, by one shuffle."""
    spark = registered(rows.sparkSession)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(width, "file", *order).sortWithinPartitions("file", *order)
    placed.select("file", "text").write.format(NAME).mode("append").save(folder)


def json_text(value) -> str:
    return json.dumps(value, ensure_ascii=False)
