"""Sheet exports: CSV files with a title row, a header row and data."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landsync.functions.text import utrim
from landsync.schemas import SHEET_COLUMNS

_SPLIT_ROW = (1 << 33) - 1  # low bits of monotonically_increasing_id: row within a partition


#: Lines looked at for the rows above the data.
TOP_LINES = 65_536
#: A record whose quotes all belong to quoted cells.
_CELL = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
_WELL_FORMED = rf"^{_CELL}(?:,{_CELL})*+$"


def top_rows(spark: SparkSession, path: str, rows: int) -> list[list[str]]:
    """The first ``rows`` rows of a sheet export, cells of many lines included."""
    lines = 64
    while True:
        text = [r[0] for r in spark.read.text(path).limit(lines).collect()]
        found = list(csv.reader(io.StringIO("\n".join(text).removeprefix("\ufeff"), newline="")))
        # The last row seen may go on below; it counts once another one follows.
        if len(found) > rows or len(text) < lines:
            return found[:rows]
        if lines >= TOP_LINES:
            raise ValueError(f"{path}: no end of the first {rows} rows within {lines} lines; is a quote left open?")
        lines *= 8


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of one CSV file as ``seq`` and ``value``, read in many tasks though cells hold line breaks.

    A line is inside a cell if an odd number of quotes stands before it. Quotes are counted line by line in
    every split, and a running total over the splits tells whether one begins inside a cell, and with which
    line the record began that it goes on with. Only records of several lines are gathered. ``seq`` follows
    the file; line breaks in cells become newlines. A quote that is never closed, or that stands inside a cell
    without quotes, fails the job: such a file needs ``multi_line=True``.
    """
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("seq"), F.regexp_replace(
        "value", "^\ufeff", "").alias("value")).withColumns({"quotes": quotes, "split": F.shiftright("seq", 33)})
    in_split = Window.partitionBy("split").orderBy("seq")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    splits = lines.groupBy("split").agg(
        F.sum("quotes").alias("quotes"), *[F.max(F.when(F.col("odd") == k, F.col("seq"))).alias(f"last_{k}") for k in (0, 1)])
    earlier = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    all_splits = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    closed = F.when(F.sum("quotes").over(all_splits) % 2 == 1, F.raise_error(F.lit(f"{path}: a quote is never closed")))
    splits = splits.select("split", F.coalesce(closed, F.sum("quotes").over(earlier), F.lit(0)).alias("begun"), "last_0", "last_1")
    splits = splits.withColumn("begun", F.col("begun") % 2)
    began = F.when(F.col("begun") == 0, F.col("last_0")).otherwise(F.col("last_1"))
    splits = splits.select("split", "begun", F.last(began, True).over(earlier).alias("open"))
    placed = lines.join(splits, "split").withColumn("starts", (F.col("odd") + F.col("begun")) % 2 == 0)
    own = F.last(F.when(F.col("starts"), F.col("seq")), True).over(
        in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("record", F.coalesce(own, F.col("open")))
    alone = F.col("starts") & (F.col("quotes") % 2 == 0)
    gathered = placed.filter(~alone).groupBy("record").agg(F.sort_array(F.collect_list(F.struct("seq", "value"))).alias("of"))
    gathered = gathered.select(F.col("record").alias("seq"), F.array_join(
        F.transform("of", lambda x: x["value"]), "\n").alias("value"), F.lit(True).alias("whole"))

    # Spark may test a row before it filters it, so the test asks for whole records itself.
    def checked(rows: DataFrame) -> DataFrame:
        odd = F.col("whole") & F.contains(value, F.lit('"')) & ~value.rlike(_WELL_FORMED)
        return rows.filter(value != "").select("seq", F.when(odd, F.raise_error(F.concat(
            F.lit(f"{path}: a quote inside a cell without quotes: "), F.substring("value", 1, 80))))
            .otherwise(value).alias("value"))

    return checked(placed.withColumn("whole", alone).filter("whole")).union(checked(gathered))


def read_cells(spark: SparkSession, path: str, width: int, multi_line: bool = True) -> DataFrame:
    """One sheet export as ``seq``, ``first_split`` and the array ``cells``.

    ``multi_line=False`` lets Spark split one large file; cells must then hold no
    line breaks. ``seq`` follows the file order.
    """
    schema = ", ".join(f"c{i} string" for i in range(width))
    raw = (spark.read.schema(schema)
           .option("header", False).option("multiLine", multi_line)
           .option("mode", "PERMISSIVE").option("escape", '"')
           .csv(path))
    cells = F.array(*[F.col(f"c{i}") for i in range(width)])
    return raw.select(
        F.monotonically_increasing_id().alias("seq"),
        (F.col("_metadata.file_block_start") == 0).alias("first_split"),
        cells.alias("cells"))


def record_cells(found: DataFrame, width: int) -> DataFrame:
    """``records`` as ``seq`` and the array ``cells``."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = found.select("seq", F.from_csv("value", F.lit(schema), {"escape": '"', "mode": "PERMISSIVE"}).alias("p"))
    return parsed.select("seq", F.array(*[F.col(f"p.c{i}") for i in range(width)]).alias("cells"))


def header_columns(header: Sequence[str | None],
                   wanted: dict[str, str] | None = None) -> dict[str, int]:
    """Column index per wanted name; names match trimmed and upper-cased, and of a
    repeated header the last counts."""
    wanted = SHEET_COLUMNS if wanted is None else wanted
    names = [(h or "").strip().upper() for h in header]
    return {wanted[n]: i for i, n in enumerate(names) if n in wanted}


def sheet_rows(cells: DataFrame, columns: dict[str, int],
               name: str = "nama_penuh_fasiliti") -> DataFrame:
    """Data rows with named columns: cells trimmed, missing cells empty, blank rows
    and rows without a name dropped. ``cells`` has ``seq`` and ``cells``."""
    out = {key: F.coalesce(utrim(F.get(F.col("cells"), F.lit(i))), F.lit(""))
           for key, i in columns.items()}
    filled = F.exists(F.col("cells"), lambda c: F.length(utrim(F.coalesce(c, F.lit("")))) > 0)
    rows = cells.filter(filled).select("seq", *[v.alias(k) for k, v in out.items()])
    if name not in columns:
        return rows.filter(F.lit(False))
    return rows.filter(F.col(name) != "")


def read_sheet(spark: SparkSession, path: str, skip_rows: int = 2,
               multi_line: bool | None = None) -> DataFrame:
    """One sheet export as raw facility rows with ``seq``, however wide it is.

    Only the first ``skip_rows`` rows visit the driver, to find the columns. Cells may hold line
    breaks and the file is still read in many tasks (see ``records``). ``multi_line=True`` reads
    it in one task by Spark's own reader, ``False`` in many by it, if no cell holds a line break.
    """
    top = top_rows(spark, path, max(skip_rows, 1))
    if len(top) < max(skip_rows, 1):
        return sheet_rows(read_cells(spark, path, 1).filter(F.lit(False)), header_columns([]))
    header = top[max(skip_rows - 1, 0)]
    width = max(len(header), 1)
    if multi_line is None:
        found = records(spark, path)
        above = found.select("seq").orderBy("seq").limit(skip_rows).agg(F.max("seq")).first()[0] if skip_rows else None
        data = record_cells(found if above is None else found.filter(F.col("seq") > above), width)
    else:
        cells = read_cells(spark, path, width, multi_line)
        place = F.col("seq").bitwiseAND(F.lit(_SPLIT_ROW))
        data = cells.filter(~(F.col("first_split") & (place < skip_rows)))
    return sheet_rows(data, header_columns(header))


def read_sheets(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """Several exports as one table; ``sheet`` is the place in ``paths``."""
    parts = [read_sheet(spark, p, **options).withColumn("sheet", F.lit(i))
             for i, p in enumerate(paths)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
