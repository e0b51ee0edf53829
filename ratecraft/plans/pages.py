"""The page service: ratings ⋈ items ⋈ users as nested JSON
records, page *n* of a total order, with the page count (T2 + A3 + P2 + K7).

The records lie in order behind a fence index, which gives the page count and
the file or two that hold a page.  A page past the last one (or page 0) yields no rows — the service answers
"not found" from that (decision Q13 validates ``per_page``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.paging import PageIndex
from ratecraft.operators.topk import top_k


def titles(items: DataFrame, limit: int | None = None) -> DataFrame:
    """(item_id, title) of every item, or of the ``limit`` smallest ids where the caller sets one."""
    rows = items.select("item_id", "title")
    return rows if limit is None else top_k(rows, [F.asc_nulls_last("item_id")], limit)


def page_index(rows: DataFrame, order: Sequence[str], record: Column, path: str | None = None) -> PageIndex:
    """The records of the page service, laid down in order once for any number of pages."""
    return PageIndex.build(rows, order, path, columns=[record.alias("_record")])


def page_response(index: PageIndex, page: int, per_page: int = 10) -> DataFrame:
    """(page, total_pages, position, json) for one page of a ``page_index``;
    position is 1-based within the page.  The page count comes from the fences."""
    got = index.page(page, per_page)
    return got.select(F.lit(page).cast("long").alias("page"),
                      F.lit(-(-index.total() // per_page)).cast("long").alias("total_pages"),
                      (F.col("position") - (page - 1) * per_page + 1).alias("position"),
                      F.to_json("_record").alias("json"))
