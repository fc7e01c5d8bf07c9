"""Bibliographic services as a data source: `spark.read.format("bibliographic")`.

What is asked for are ids, by a filter that Spark pushes down (`where("id in (...)")`) or by a table of them in the shared
folder, whose files the tasks read. Rows are (id, ord, record, tries): the records of an answer as JSON, in its order, with a
null record for an id that has none, and how many tries the answer took. Options: service, call (a name of services.CALLS, or
lookup for the service's batches), limit, ids (a Parquet folder with a column id), partitions, answers (a folder for answers).
Filters stay with what load() gave, so each question takes a load() of its own.

Tasks share the service's pace: each has its part of it. Answers are kept in a folder that all machines share, so a task that
is run again, or a query that is evaluated again, doesn't ask again. A torn file of an answer is asked for again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from citeloom.operators.graph import scratch

from .textfiles import opened

NAME = "bibliographic"


class Ids(InputPartition):
    """Ids of a task, or the files that hold them."""

    def __init__(self, ids: list[str], files: list[str]) -> None:
        self.ids, self.files = ids, files


def cached(transport, folder: str, prefix: str = ""):
    """A transport that keeps answers as files and asks once for each path and parameters. A torn file is asked for again."""

    def get(path: str, params: dict) -> dict | None:
        files, root = opened(folder)
        where = f"{root}/{prefix}{hashlib.sha1(json.dumps([path, params], sort_keys=True).encode()).hexdigest()}.json"
        if files.get_file_info(where).type == fs.FileType.File:
            try:
                with files.open_input_stream(where) as kept:
                    return json.loads(kept.read())
            except ValueError:
                pass
        found = transport(path, params)
        if found is not None:
            files.create_dir(root)
            fresh = f"{where}.{uuid.uuid4().hex}.new"
            with files.open_output_stream(fresh) as out:
                out.write(json.dumps(found).encode())
            files.move(fresh, where)
        return found

    return get


class Reader(DataSourceReader):
    def __init__(self, options: dict, transport: Callable) -> None:
        self.service, self.call = options.get("service", ""), options.get("call", "lookup")
        self.limit, self.width = int(options.get("limit", 25)), max(1, int(options.get("partitions", 1)))
        self.table, self.answers, self.transport = options.get("ids"), options.get("answers"), transport
        self.ids: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("id",):
                self._only({f.value})
            elif isinstance(f, In) and f.attribute == ("id",):
                self._only(set(f.value))
            else:
                yield f

    def _only(self, ids: set) -> None:
        ids = {i for i in ids if i is not None}
        self.ids = ids if self.ids is None else self.ids & ids

    def partitions(self) -> list[Ids]:
        if self.table is None and self.ids is None:
            raise ValueError("ask for ids: a filter on id, or a table of them in the option ids")
        if self.table is None:
            size = self._size()
            ids = sorted(self.ids)
            groups = [ids[at : at + size] for at in range(0, len(ids), size)]
            return [Ids([i for g in groups[k :: self.width] for i in g], []) for k in range(min(self.width, max(1, len(groups))))]
        files, root = opened(self.table)
        found = sorted(f.path for f in files.get_file_info(fs.FileSelector(root)) if f.path.endswith(".parquet"))
        return [Ids([], found[k :: self.width]) for k in range(min(self.width, max(1, len(found))))]

    def _size(self) -> int:
        from .services import BATCH_SIZES

        return BATCH_SIZES.get(self.service, 1) if self.call == "lookup" else 1

    def read(self, partition: Ids) -> Iterator[tuple]:
        from .services import CALLS, CALLS_A_MINUTE, Pace, fetched, records_in

        get = cached(self.transport(), self.answers) if self.answers else self.transport()
        pace, size = Pace(CALLS_A_MINUTE.get(self.service, 60) / self.width), self._size()

        def paced(path: str, params: dict):
            pace.wait()
            return get(path, params)

        for part in self._batches(partition, size):
            if self.call == "lookup":
                found, tries = fetched(paced, self.service, {"ids": part})
                for i in part:
                    record = (found or {}).get(i)
                    yield i, 0, None if record is None else json.dumps(record), tries
                continue
            path, params, where = CALLS[self.service, self.call]
            for i in part:
                filled = {k: v.format(id=i, limit=self.limit) for k, v in params.items()}
                answer, tries = fetched(paced, path.format(id=i), filled)
                records = records_in(answer, where)[: self.limit]
                yield from ((i, k, json.dumps(r), tries) for k, r in enumerate(records))
                if not records:
                    yield i, 0, None, tries

    def _batches(self, partition: Ids, size: int) -> Iterator[list[str]]:
        held: list[str] = []
        for i in self._ids(partition):
            held.append(i)
            if len(held) == size:
                yield held
                held = []
        if held:
            yield held

    def _ids(self, partition: Ids) -> Iterator[str]:
        yield from partition.ids
        for path in partition.files:
            files, _ = opened(self.table)
            with files.open_input_file(path) as opened_file:
                for batch in pq.ParquetFile(opened_file).iter_batches(columns=["id"]):
                    yield from (i for i in batch.column(0).to_pylist() if i is not None and (self.ids is None or i in self.ids))


def source(transport: Callable, name: str = NAME) -> type[DataSource]:
    """The data source with a transport: transport() is made in a task and answers (path, parameters)."""

    class Bibliographic(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "id string, ord long, record string, tries int"

        def reader(self, schema) -> Reader:
            return Reader(self.options, transport)

    return Bibliographic


def register(spark: SparkSession, transport: Callable, name: str = NAME) -> None:
    """Makes the format known to a session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source(transport, name))


def asked(ids: DataFrame, transport: Callable, **options) -> DataFrame:
    """Rows of the data source for a table of ids, each different one once; answers are kept until the application ends."""
    spark = ids.sparkSession
    place = scratch(spark, "asked")
    ids.where("id is not null").distinct().repartition(int(options.get("partitions", 1))).write.mode("append").parquet(f"{place}/ids")
    register(spark, transport)
    made = spark.read.format(NAME).options(**options, ids=_local(f"{place}/ids"), answers=_local(f"{place}/answers"))
    return made.load()


def _local(path: str) -> str:
    """A path of this machine's file system as pyarrow takes it."""
    return path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:") if path.startswith("file:") else path
