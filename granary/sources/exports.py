"""Quoted text exports, read in ranges.

A cell may hold line breaks, so a file cannot be cut at any of them. But the number of quotes
before a place tells whether it is inside a cell: quotes around a cell come in pairs, and so
do doubled ones. Ranges count their quotes first; sums over the ranges before give the state
in which each begins. Lines that close what they open are records at once. Lines of a longer
record are put together inside their range, and what crosses the border of ranges is put
together for each record that does.

Quotes may stand around a whole cell, or doubled inside one. A file that ends inside a cell
stops the job, and so does a record with other cells than the header.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPTIONS = {"header": True, "escape": '"', "multiLine": True, "mode": "FAILFAST", "columnPruning": False}
_PLACE = ["file", "begin"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file, the begin of their range and their order in it."""
    return (
        spark.read.option("lineSep", "\n").text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("begin"),
            F.monotonically_increasing_id().alias("line"),
            F.col("value"),
            (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        )
    )


def _plain(c: Column) -> Column:
    """A record without what editors put before a file and behind a line; a line break inside
    a cell is a newline."""
    return F.replace(F.regexp_replace(c, "^\ufeff|\r\\z", ""), F.lit("\r\n"), F.lit("\n"))


def _ranges(lines: DataFrame) -> tuple[DataFrame, set[str]]:
    """State in which each range begins, and the first lines of all files.

    One row for each range of a file comes to the driver.
    """
    first = F.min_by("value", "line").alias("first")
    found = lines.groupBy(*_PLACE).agg(F.sum("quotes").alias("quotes"), first).orderBy(*_PLACE).collect()
    states, headers = [], set()
    for file, parts in groupby(found, key=lambda r: r["file"]):
        before = 0
        for r in parts:
            if r["begin"] == 0:
                headers.add(r["first"].lstrip("\ufeff").rstrip("\r"))
            states.append((file, r["begin"], before % 2))
            before += r["quotes"]
    spark = lines.sparkSession
    return spark.createDataFrame(states, "file string, begin long, inside int"), headers


def records(spark: SparkSession, path: str | list[str], same_header: bool = False) -> DataFrame:
    """``(record, is_header)`` for each record of the files, its lines joined again.

    With ``same_header`` all files must have the first line of the first one.
    """
    lines = _lines(spark, path)
    states, headers = _ranges(lines)
    if same_header and len(headers) > 1:
        raise ValueError(f"files with different headers: {sorted(headers)[:3]}")
    in_range = Window.partitionBy(*_PLACE).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    after = F.col("inside") + F.sum("quotes").over(in_range)
    # One row for each range, as many as the files have splits.
    known = (
        lines.join(F.broadcast(states), _PLACE)
        .withColumn("after", after % 2)
        .withColumn("starts", ((F.col("after") + F.col("quotes")) % 2 == 0))
        .withColumn("number", F.count_if("starts").over(in_range))
    )
    alone = F.col("starts") & (F.col("after") == 0)
    whole = known.filter(alone & (F.col("value") != "")).select(*_PLACE, "number", F.col("value").alias("record"))

    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n")
    pieces = known.filter(~alone).groupBy(*_PLACE, "number").agg(joined.alias("text"), F.max_by("after", "line").alias("open"))
    closed = pieces.filter("number > 0 and open = 0").select(*_PLACE, "number", F.col("text").alias("record"))
    # A piece without a start goes on with the last record that its file has left open.
    crossing = pieces.filter("number = 0 or open = 1")
    in_file = Window.partitionBy("file").orderBy("begin", "number").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("number") > 0, F.struct("begin", "number")), ignorenulls=True).over(in_file)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("begin", "number", "text"))), lambda x: x["text"]), "\n")
    stitched = crossing.withColumn("owner", owner).groupBy("file", "owner").agg(text.alias("text"), F.max_by("open", F.struct("begin", "number")).alias("open"))
    ended = F.when(F.col("open") == 0, F.col("text")).otherwise(F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("file"))))
    across = stitched.select("file", "owner.begin", "owner.number", ended.alias("record"))
    return whole.unionByName(closed).unionByName(across).select(
        _plain(F.col("record")).alias("record"), ((F.col("begin") == 0) & (F.col("number") == 1)).alias("is_header")
    )


def read(spark: SparkSession, path: str | list[str], by_name: bool) -> DataFrame:
    """Headered export files with every column as text, read in ranges.

    All files must have as many columns as the first one, and ``by_name`` its header.
    """
    names = spark.read.options(**OPTIONS).csv(path).columns
    # Cells are found by their place, whatever the names are.
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
    found = records(spark, path, by_name).filter(~F.col("is_header") & (F.col("record") != ""))
    cells = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {"escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    parsed = found.select(cells.alias("c"))
    return parsed.select(*[F.col(f"c._{i}").alias(n) for i, n in enumerate(names)])
