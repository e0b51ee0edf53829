"""A stream over the pages of a laid-down table, whose offset is the page number.

Each trigger reads the next ``pagesPerTrigger`` pages; the checkpoint remembers
the last page, so a stopped stream goes on with the one after it.  The page
index says which files hold a range of pages, and tasks read those ranges, of
``TASK_ROWS`` rows each: how many tasks share a trigger follows from its rows,
not from the files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ratecraft.operators.paging import PageIndex

TASK_ROWS = 25_000


@dataclass
class _Run(InputPartition):
    """Places ``lo`` to ``hi`` (not included) of one part."""
    part: int
    lo: int
    hi: int


class _PageReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType, fences: list, per_page: int, step: int):
        self.path, self.schema, self.fences = path, schema, fences
        self.per_page, self.step = per_page, step
        self.rows = max((start + n for _, start, n in fences), default=0)
        self.last = None  # the offset handed out or resumed from: the next trigger goes on from it

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self, start: dict | None = None, limit=None) -> dict:
        at = (start or {}).get("page", self.last or 0)
        self.last = min(at + self.step, -(-self.rows // self.per_page))
        return {"page": max(self.last, at)}

    def partitions(self, start: dict, end: dict) -> list[_Run]:
        self.last = end["page"]
        lo, hi = (o["page"] * self.per_page for o in (start, end))
        held = [(part, max(lo - first, 0), min(hi - first, n)) for part, first, n in self.fences
                if first < hi and first + n > lo]
        return [_Run(part, at, min(at + TASK_ROWS, end)) for part, begin, end in held
                for at in range(begin, end, TASK_ROWS)]

    def read(self, partition: _Run) -> Iterator:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyarrow.fs import FileSystem

        where = f"{self.path}/rows/_part={partition.part}"
        fs, where = FileSystem.from_uri(where) if ":" in where else (None, where)
        at = pc.field("_at")
        names = self.schema.fieldNames()
        rows = ds.dataset(where, format="parquet", filesystem=fs).scanner(
            columns=names, filter=(at >= partition.lo) & (at < partition.hi), use_threads=False)
        yield from rows.to_batches()

    def commit(self, end: dict) -> None:
        """Nothing to give back: the pages stay where they are."""


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.options["rowSchema"]))

    def streamReader(self, schema: StructType) -> _PageReader:
        return _PageReader(self.options["path"], schema, json.loads(self.options["fences"]),
                           int(self.options["perPage"]), int(self.options["pagesPerTrigger"]))


def page_stream(index: PageIndex, per_page: int = 10, pages_per_trigger: int = 1) -> DataFrame:
    """The rows of ``index`` as a stream, ``pages_per_trigger`` pages a micro-batch, in order.

    The fences, one entry a file, go along with the source.  The index's folder
    must be one that tasks reach by a path or URI that Arrow opens.
    """
    spark = index.spark
    spark.dataSource.register(PageSource)
    fences = [[r["_part"], r["start"], r["n"]] for r in index.fences.orderBy("_part").collect()]
    kept = StructType([f for f in index.rows.schema.fields if f.name not in ("_part", "_at")])
    return spark.readStream.format("pages").options(
        path=index.path, rowSchema=kept.json(), fences=json.dumps(fences), perPage=str(per_page),
        pagesPerTrigger=str(pages_per_trigger)).load()
