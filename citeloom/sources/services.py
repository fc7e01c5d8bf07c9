"""Bibliographic services as data sources: paced, retried, and given a transport, so tests need no network."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.operators.graph import cut_lineage

from . import bibliographic
from .bibliographic import cached as cached

Transport = Callable[[str, dict], dict | None]


@dataclass
class Pace:
    """A token bucket: at most `per_minute` calls a minute, saved up to half a minute's worth (one call at least)."""

    per_minute: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    tokens: float = field(init=False)
    last: float = field(init=False)

    def __post_init__(self) -> None:
        self.tokens, self.last = self.most, self.clock()

    @property
    def most(self) -> float:
        return max(1.0, self.per_minute / 2)

    def wait(self) -> None:
        now = self.clock()
        self.tokens = min(self.most, self.tokens + (now - self.last) * self.per_minute / 60)
        self.last = now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) * 60 / self.per_minute)
            self.tokens, self.last = 1.0, self.clock()
        self.tokens -= 1


def delay(attempt: int, jitter: Callable[[], float] = random.random) -> float:
    """Seconds before another try: doubling from half a second, 8 at most, spread by half."""
    return min(8.0, 0.5 * 2**attempt) * (0.5 + jitter())


def fetch(transport: Transport, path: str, params: dict, *, tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> dict | None:
    return fetched(transport, path, params, tries=tries, sleep=sleep)[0]


def fetched(transport: Transport, path: str, params: dict, *, tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> tuple[dict | None, int]:
    """The answer and how many tries it took."""
    for attempt in range(tries):
        try:
            return transport(path, params), attempt + 1
        except OSError:
            if attempt + 1 == tries:
                raise
            sleep(delay(attempt))
    return None, 0


def batches(values: list, size: int) -> Iterator[list]:
    for at in range(0, len(values), size):
        yield values[at : at + size]


# How many identifiers a service takes at once, and calls a minute.
BATCH_SIZES = {"semantic_scholar": 500, "openalex": 50, "europe_pmc": 20}
CALLS_A_MINUTE = {"semantic_scholar": 15, "openalex": 60, "crossref": 50}


def looked_up(ids: DataFrame, column: str, service: str, transport: Callable[[], Transport], partitions: int = 1) -> DataFrame:
    """(id, record) for each id, asked for in batches; transport() is made in the task, and the pace is shared among them."""
    got = bibliographic.asked(ids.select(F.col(column).alias("id")), transport, service=service, call="lookup", partitions=partitions)
    return got.select("id", "record")


# Calls of services (path, parameters, and where the records lie).
CALLS = {
    ("semantic_scholar", "search"): ("/paper/search", {"query": "{id}", "limit": "{limit}"}, "data"),
    ("semantic_scholar", "paper"): ("/paper/{id}", {}, ""),
    ("semantic_scholar", "references"): ("/paper/{id}/references", {"limit": "{limit}"}, "data.citedPaper"),
    ("semantic_scholar", "citations"): ("/paper/{id}/citations", {"limit": "{limit}"}, "data.citingPaper"),
    ("openalex", "search"): ("/works", {"search": "{id}", "per-page": "{limit}"}, "results"),
    ("openalex", "paper"): ("/works/{id}", {}, ""),
    ("openalex", "citations"): ("/works", {"filter": "cites:{id}", "per-page": "{limit}"}, "results"),
    ("crossref", "paper"): ("/works/{id}", {}, "message"),
    ("europe_pmc", "title"): ("/search", {"query": 'TITLE:"{id}"', "format": "json", "resultType": "core", "pageSize": "{limit}"}, "resultList.result"),
    ("doi", "paper"): ("/{id}", {}, ""),
}


def records_in(answer, where: str) -> list:
    """The records of an answer, by the names on the way to them; lists on the way are gone through."""
    found = [answer]
    for name in filter(None, where.split(".")):
        found = [r.get(name) for r in found if isinstance(r, dict)]
        found = [x for r in found for x in (r if isinstance(r, list) else [r])]
    return [r for r in found if r]


def called(ids: DataFrame, column: str, service: str, call: str, transport: Callable[[], Transport], *, limit: int = 25, partitions: int = 1) -> DataFrame:
    """(id, ord, record): one call for each id, with its records as JSON in the order of the answer."""
    if (service, call) not in CALLS:
        raise KeyError((service, call))
    got = bibliographic.asked(ids.select(F.col(column).cast("string").alias("id")), transport, service=service, call=call, limit=limit, partitions=partitions)
    return got.where("record is not null").select("id", "ord", "record")


def first_answer(ids: DataFrame, column: str, calls: list[tuple[str, str, Callable[[DataFrame], DataFrame]]], transport: Callable[[], Transport]) -> DataFrame:
    """(id, paper columns, source): the first record of the first service that has one; others are asked for what is left.

    A service's answers are written before they are used, so that each id is asked for once.
    """
    left, found = ids.select(F.col(column).alias("id")).distinct(), None
    for service, call, standardize in calls:
        got = cut_lineage(called(left, "id", service, call, transport, limit=1))
        rows = standardize(got.where("ord = 0")).withColumn("source", F.lit(service))
        found = rows if found is None else found.unionByName(rows)
        left = left.join(rows.select("id"), "id", "left_anti")
    return found


def europe_pmc_query(dois: list[str]) -> str:
    """What asks for some DOIs at once."""
    return " OR ".join(f'DOI:"{d}"' for d in dois)


def europe_pmc_abstracts(records: DataFrame) -> DataFrame:
    """(id, ord, doi, title, abstract) of records of a search; DOIs in lower case."""
    r = records.select("id", "ord", F.from_json("record", "struct<doi:string,title:string,abstractText:string>").alias("r")).where("r is not null")
    return r.select("id", "ord", F.lower("r.doi").alias("doi"), "r.title", text.strip_html(F.col("r.abstractText")).alias("abstract"))


def csl_abstracts(records: DataFrame) -> DataFrame:
    """(id, abstract) of citation records that DOIs resolve to."""
    r = records.select("id", F.get_json_object("record", "$.abstract").alias("abstract"))
    return r.where(text.has_text(F.col("abstract"))).select("id", text.strip_html(F.col("abstract")).alias("abstract"))


def arxiv_page(get: Callable[[str], tuple[int, str]], number: str, address: str | None = None) -> tuple[str, str]:
    """(address, page) of a paper: of the given address, the archive's own page and its mirror, the first that has one."""
    # Where pages are, from what status on an answer is an error, and of how many characters a page has more.
    places = ("https://arxiv.org/html/{}", "https://ar5iv.labs.arxiv.org/html/{}")
    for at in [*filter(None, [address]), *(p.format(number) for p in places)]:
        status, page = get(at)
        if status < 400 and len(page) > 1000:
            return at, page
    raise LookupError(f"no page for {number}")


def standardize_crossref(records: DataFrame, column: str = "record") -> DataFrame:
    """(id, title, year, venue) of works; of titles, containers and dates the first."""
    schema = "struct<title:array<string>,`container-title`:array<string>,issued:struct<`date-parts`:array<array<int>>>>"
    r = records.select("id", F.from_json(column, schema).alias("r")).where("r is not null")
    return r.select("id", F.get("r.title", F.lit(0)).alias("title"), F.get(F.get("r.issued.date-parts", F.lit(0)), F.lit(0)).alias("year"), F.get("r.container-title", F.lit(0)).alias("venue"))


def standardize_s2(records: DataFrame, column: str = "record") -> DataFrame:
    """Paper columns of records with title, year, venue, authors, corpusId and externalIds."""
    schema = "struct<title:string,year:int,venue:string,authors:array<struct<name:string,authorId:string>>,corpusId:string,externalIds:map<string,string>>"
    r = records.select("id", F.from_json(column, schema).alias("r")).where("r is not null")
    doi = F.col("r.externalIds")["DOI"]
    corpus = F.coalesce("r.corpusId", F.col("r.externalIds")["CorpusId"])
    return r.select("id", "r.title", "r.year", "r.venue", F.transform("r.authors", lambda a: a["name"]).alias("authors"), doi.alias("doi"), corpus.alias("corpus_id"), F.lit(None).cast("string").alias("openalex_id"))


def standardize_s2_rows(records: DataFrame) -> DataFrame:
    """(id, ord, title, year, authors, abstract, doi, corpus_id, arxiv) of the records of called(), each on a row."""
    schema = "struct<title:string,year:int,authors:array<struct<name:string>>,abstract:string,corpusId:string,externalIds:map<string,string>>"
    r = records.select("id", "ord", F.from_json("record", schema).alias("r")).where("r is not null")
    ids = F.col("r.externalIds")
    corpus = F.coalesce(ids["CorpusId"], "r.corpusId")
    return r.select("id", "ord", "r.title", "r.year", F.transform("r.authors", lambda a: a["name"]).alias("authors"), "r.abstract", ids["DOI"].alias("doi"), corpus.alias("corpus_id"), ids["ArXiv"].alias("arxiv"))


def standardize_openalex(records: DataFrame, column: str = "record") -> DataFrame:
    """The same columns of works; the venue is the host's, else the primary location's."""
    schema = "struct<id:string,title:string,publication_year:int,doi:string,host_venue:struct<display_name:string>,primary_location:struct<source:struct<display_name:string>>,authorships:array<struct<author:struct<display_name:string>>>>"
    r = records.select("id", F.from_json(column, schema).alias("r")).where("r is not null")
    venue = F.coalesce("r.host_venue.display_name", "r.primary_location.source.display_name")
    authors = F.transform("r.authorships", lambda a: a.author.display_name)
    return r.select("id", "r.title", F.col("r.publication_year").alias("year"), venue.alias("venue"), authors.alias("authors"), "r.doi", F.lit(None).cast("string").alias("corpus_id"), F.col("r.id").alias("openalex_id"))


def first_found(ids: DataFrame, phases: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """(id, value, phase): phases in order of cost, each asked only for what the ones before didn't find, and once."""
    left, found = ids.select("id"), None
    for number, phase in enumerate(phases):
        got = cut_lineage(phase(left).where("value is not null").dropDuplicates(["id"]).select("id", "value", F.lit(number).alias("phase")))
        found = got if found is None else found.unionByName(got)
        left = left.join(got, "id", "left_anti")
    return found
