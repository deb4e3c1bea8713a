"""From workbook cells to ``keywords(tool, batch, pos, keyword)``, and titles from CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X

MIX = "mix of tools"


def cell_keywords(cells: DataFrame) -> DataFrame:
    """The cells of ordinary tabs that are keywords, with their stripped value."""
    value = X.strip(F.col("value"))
    return cells.where(F.col("value").isNotNull() & ~X.is_skipped_tab(F.col("sheet"))).withColumn("keyword", value).where(X.cell_is_keyword(F.col("keyword"))).drop("value")


#: Bits of a position: mixed tab, workbook, tab, row, column. A spreadsheet program's sheet has at most 2**20 rows and 2**14 columns; rows beyond run on into the next tabs' numbers (see ``started``).
BOOK_BITS, SHEET_BITS, ROW_BITS, COL_BITS = 16, 12, 20, 14
TAB = ["path", "sheet_idx"]


def booked(cells: DataFrame) -> DataFrame:
    """``cells`` with path (empty where there is none) and book_idx: the workbook's place by path."""
    if "path" not in cells.columns:
        return cells.withColumn("path", F.lit("")).withColumn("book_idx", F.lit(0).cast("long"))
    if "book_idx" in cells.columns:
        return cells
    books = cells.select("path").distinct()  # a row a workbook
    order = F.row_number().over(W.orderBy("path")).cast("long") - 1
    return cells.join(books.select("path", order.alias("book_idx")), "path")


def merged_tools(tabs: DataFrame) -> DataFrame:
    """``tabs`` (sheet_idx, name..., book_idx if there are several workbooks) with tool: the first tab's spelling among names equal in lower case."""
    at = [c for c in ("book_idx", "sheet_idx") if c in tabs.columns]
    first = W.partitionBy(F.lower("name")).orderBy(*at)
    return tabs.withColumn("tool", F.first_value("name").over(first))


def tab_keywords(cells: DataFrame) -> DataFrame:
    """tool, batch, pos, keyword of ordinary tabs; pos follows workbook, tab, row and column within a tool's batch."""
    found = cell_keywords(booked(cells))
    tabs = found.groupBy("book_idx", *TAB, "sheet").agg(F.max("row_idx").alias("last_row")).withColumn("name", X.tool_name(F.col("sheet")))
    named = merged_tools(tabs).withColumn("batch", F.when(X.is_low_volume(F.col("sheet")), "low_volume").otherwise("standard"))
    return found.join(started(named, ["tool", "batch"]).select(*TAB, "tool", "batch", "start"), TAB).select("tool", "batch", position().alias("pos"), "keyword")


def started(tabs: DataFrame, scope: list[str]) -> DataFrame:
    """``tabs`` (a row a tab of each scope: book_idx, sheet_idx, last_row) with start: the position of its first cell.

    That is the tab's own place by its bits. Where tabs before it in the scope have rows beyond theirs, it is moved on behind them:
    start = max(own place, start of the tab before + its length), so no two cells of a scope share a position.
    """
    order = W.partitionBy(*scope).orderBy("book_idx", "sheet_idx")
    own = F.shiftleft(F.shiftleft(F.col("book_idx").cast("long"), SHEET_BITS) + F.col("sheet_idx").cast("long"), ROW_BITS + COL_BITS)
    length = F.shiftleft(F.col("last_row").cast("long") + 1, COL_BITS)
    placed = tabs.withColumn("_before", F.sum(length).over(order) - length)  # lengths of the scope's tabs before it
    return placed.withColumn("start", F.col("_before") + F.max(own - F.col("_before")).over(order)).drop("_before")


def position(mixed: bool = False) -> Column:
    """One number that sorts like (mixed tab or not, workbook, tab, row, column) within a scope of ``started``. Numbers beyond their bits (for rows: beyond all tabs) are an error, not a collision."""
    pos, fits = F.col("start") + F.shiftleft(F.col("row_idx").cast("long"), COL_BITS) + F.col("col_idx").cast("long"), F.col("row_idx") >= 0
    for name, bits in [("book_idx", BOOK_BITS), ("sheet_idx", SHEET_BITS), ("col_idx", COL_BITS)]:
        fits = fits & (F.col(name) >= 0) & (F.col(name) < 1 << bits)
    top = 1 << BOOK_BITS + SHEET_BITS + ROW_BITS + COL_BITS
    return F.when(fits & (pos < top), pos + F.lit(top * mixed)).otherwise(F.raise_error(F.lit("more workbooks, tabs, rows or columns than a position can hold")).cast("long"))


def mix_keywords(cells: DataFrame) -> DataFrame:
    """tool, batch, pos, keyword of the tab in which each column is a tool.

    Of columns with one name, the last that has keywords counts.
    """
    mine = booked(cells).where((X.lowered(F.col("sheet")) == MIX) & F.col("value").isNotNull()).withColumn("value", X.strip(F.col("value")))
    heads = mine.where("row_idx = 0").select(*TAB, "col_idx", F.col("value").alias("tool")).where("tool <> '' and lower(tool) <> 'none'")
    below = mine.where("row_idx > 0").where(X.looks_like_keyword(F.col("value")) & (F.length("value") >= 3))
    found = below.join(heads, [*TAB, "col_idx"])
    last = found.groupBy("book_idx", *TAB, "tool").agg(F.max("col_idx").alias("col_idx"), F.max("row_idx").alias("last_row"))
    return found.join(started(last, ["tool"]).select(*TAB, "tool", "col_idx", "start"), [*TAB, "tool", "col_idx"]).select("tool", F.lit("standard").alias("batch"), position(mixed=True).alias("pos"), F.col("value").alias("keyword"))


def all_keywords(cells: DataFrame, compat: bool = True) -> DataFrame:
    """Ordinary tabs, then the mixed tab. With ``compat`` the mixed tab is an ordinary tab too."""
    cells = booked(cells)
    tabs = cells if compat else cells.where(X.lowered(F.col("sheet")) != MIX)
    return tab_keywords(tabs).unionByName(mix_keywords(cells))


def selected_tools(keywords: DataFrame, names: str | None) -> DataFrame:
    """Only the tools of a comma-separated list, in any case; all without one."""
    if not names:
        return keywords
    return keywords.where(F.lower("tool").isin(*[n.strip().lower() for n in names.split(",")]))


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """title_pos, title from the ``Name`` column of CSV files; blank and missing ones go.

    Fields may hold line ends, so one file is one task; more files are read side by side.
    """
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    titles = rows.select(F.monotonically_increasing_id().alias("title_pos"), X.strip(F.col("Name")).alias("title"))
    return titles.where("title <> ''")
