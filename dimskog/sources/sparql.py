"""A paged SPARQL source: one partition a class, pages by LIMIT and OFFSET, partial data on error.

The transport is a function (query -> list of bindings), given by an importable name, so that tests
and offline sessions need no network.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "wikidata_id string, label_en string, label_sv string, category string"
# Class, category and filter of each partition.
CLASSES = (
    ("Q56061", "Administrative_Entity", "wdt:P17 wd:Q34"),
    ("Q34442", "Street", "wdt:P17 wd:Q34"),
    ("Q16917", "Hospital", "wdt:P17 wd:Q34"),
    ("Q3914", "School", "wdt:P17 wd:Q34"),
    ("Q202444", "Given_Name", "wdt:P407 wd:Q9027"),
    ("Q101352", "Family_Name", "wdt:P407 wd:Q9027"),
)


def page_query(cls: str, where: str, limit: int, offset: int) -> str:
    """The query of one page, in a stable order."""
    return (
        "SELECT DISTINCT ?item ?sv ?en WHERE { "
        f"?item wdt:P31/wdt:P279* wd:{cls} ; {where} . "
        'OPTIONAL { ?item rdfs:label ?sv FILTER(lang(?sv) = "sv") } OPTIONAL { ?item rdfs:label ?en FILTER(lang(?en) = "en") } '
        f"}} ORDER BY ?item LIMIT {limit} OFFSET {offset}"
    )


class _Class(InputPartition):
    def __init__(self, cls: str, category: str, where: str):
        super().__init__(0)
        self.cls, self.category, self.where = cls, category, where


class SparqlReader(DataSourceReader):
    def __init__(self, options: dict):
        self.transport = options["transport"]
        self.limit = int(options.get("limit", "5000"))
        self.pause = float(options.get("pause", "1"))
        self.retries = int(options.get("retries", "2"))

    def partitions(self):
        return [_Class(*c) for c in CLASSES]

    def read(self, partition: _Class) -> Iterator[tuple]:
        module, _, name = self.transport.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        offset, left = 0, self.retries
        while True:
            try:
                page = fetch(page_query(partition.cls, partition.where, self.limit, offset))
            except TimeoutError:
                if left == 0:
                    return
                left -= 1
                time.sleep(self.pause)
                continue
            except Exception:  # what was read so far stands
                return
            left = self.retries
            for row in page:
                yield row.get("item"), row.get("en"), row.get("sv"), partition.category
            if len(page) < self.limit:
                return
            offset += self.limit
            time.sleep(self.pause)


class SparqlSource(DataSource):
    """spark.dataSource.register(SparqlSource); spark.read.format("sparql").option("transport", "module:function")."""

    @classmethod
    def name(cls) -> str:
        return "sparql"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> SparqlReader:
        return SparqlReader(self.options)
