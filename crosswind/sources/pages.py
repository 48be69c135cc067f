"""Rows of tables found in HTML pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswind.functions.text import table_blocks, table_part, visible_text
from crosswind.operators.lookups import last_wins

# Carriers the page does not list.
EXTRA_CARRIERS = {"VX": "Virgin America", "EV": "ExpressJet Airlines"}


def wiki_tables(html: Column) -> Column:
    return table_blocks(html, "wikitable sortable")


def html_rows(
    pages: DataFrame,
    *,
    html: str = "html",
    page: str = "page_id",
    block: str | Callable[[Column], Column] = wiki_tables,
    row: str = table_part("tr"),
    cell: str = table_part("td"),
    skip_rows: int = 1,
    cells: dict[str, int] | None = None,
) -> DataFrame:
    """One row per table row of every page: page, block_no, row_no and cells.

    ``block`` gives the blocks of a page from its HTML, by default the tables of
    the one class, in which tables inside a cell are part of its text; it may be a
    pattern with one group, as ``row`` and ``cell`` are. ``cells`` maps output
    names to cell numbers counted from 0. The first ``skip_rows`` rows of each
    block are headers; rows without one of the cells are left out.
    """
    cells = cells or {"iata": 2, "icao": 3, "name": 4}
    found = block(F.col(html)) if callable(block) else F.regexp_extract_all(html, F.lit(block), F.lit(1))
    blocks = pages.select(page, F.posexplode(found).alias("block_no", "block"))
    rows = blocks.select(
        page,
        "block_no",
        F.posexplode(F.regexp_extract_all("block", F.lit(row), F.lit(1))).alias("row_no", "row"),
    ).where(F.col("row_no") >= skip_rows)
    found = rows.select(
        page, "block_no", "row_no", F.regexp_extract_all("row", F.lit(cell), F.lit(1)).alias("cell")
    ).where(F.size("cell") > max(cells.values()))
    return found.select(
        page,
        "block_no",
        "row_no",
        *[visible_text(F.get("cell", F.lit(i))).alias(name) for name, i in cells.items()],
    )


def carriers_from_rows(
    rows: DataFrame,
    *,
    key: str = "iata",
    name: str = "name",
    order: tuple[str, ...] = ("page_id", "block_no", "row_no"),
    extra: dict[str, str] = EXTRA_CARRIERS,
) -> DataFrame:
    """Code and carrier: the last row of a code counts, extra entries come last of all."""
    scraped = last_wins(rows.select(key, name, *order), key, list(order))
    listed = scraped.select(F.col(key).alias("Code"), F.col(name).alias("Carrier"))
    added = rows.sparkSession.createDataFrame(list(extra.items()), "Code string, Carrier string")
    return listed.where(~F.col("Code").isin(list(extra))).unionByName(added)
