"""Sectioned text: many tables in one text, each after a ``[name]`` line.

The line after ``[name]`` is the header, the lines up to the next ``[name]`` are the rows, plainly
separated by commas. Lines are stripped and blank ones skipped; what stands before the first section,
or after an empty ``[]``, belongs to no table. All columns are strings.

A text may be far larger than one task can hold, so no file, section or group of lines is gathered:

1. The lines of all texts are written once, by one scan, to a work table together with their place. Place means the
   text, the file, the split of the file, and the running number inside the split, all known to the scan itself.
   Which text a file belongs to is looked up in a broadcast list of the files.
2. The ``[name]`` lines are located from the narrow columns of that table. Their neighbours are found
   per split first, then across the splits of a range (one row per split), then across ranges (one row per range).
3. Each table is a range of places in the work table. Lines were written in order, so Parquet
   statistics let a table's scan skip the other tables' files and row groups. Nothing is shuffled.

A directory is read as its files one after the other: shorter file names first, then by name, which is
the order of numbered part files.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.functions.conform import conform
from sluiceway.workspace import materialise, work_scope

_BLANKS = "".join(filter(str.isspace, map(chr, range(0x3001))))
_SLASHES = re.compile(r"^(\w+):/+")
# What orders the splits of all texts; with the running number in the split it orders all lines.
_SPLIT = ["source", "name_size", "file", "block"]


def _plain(path: str) -> str:
    """The path without its scheme and host, decoded, and without a slash at its end."""
    parts = urlsplit(path)
    # A local path may hold signs that mean something else in a URI; a file that Spark names is always a URI.
    return (unquote(parts.path) if parts.scheme else path).rstrip("/") or "/"


def _files(texts: DataFrame, paths: list[str]) -> dict[str, int] | None:
    """The number of the text that each file belongs to; None where paths are patterns, relative, or lie within one another.

    The driver has listed the files for the scan anyway.
    """
    numbers = {_plain(path): number for number, path in enumerate(paths)}

    def above(place: str) -> Iterator[str]:
        while "/" in place.lstrip("/"):
            place = place.rsplit("/", 1)[0]
            yield place

    if len(numbers) < len(paths) or any(set("*?[{") & set(p) or numbers.keys() & set(above(p)) for p in numbers):
        return None
    found = {}
    for file in texts.inputFiles():
        place = _plain(file)
        folder = next((p for p in (place, *above(place)) if p in numbers), None)
        if folder is None:
            return None
        found[file] = numbers[folder]
    return found


def _numbered(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of all texts with their text's number, file, block and value: one scan, or else one for each path."""
    place = [F.octet_length("_metadata.file_path").alias("name_size"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    texts = spark.read.text(paths)
    found = _files(texts, paths)
    if found is None:
        return reduce(DataFrame.union, [spark.read.text(path).select(F.lit(n).alias("source"), *place, "value") for n, path in enumerate(paths)])
    # Names of the same file may differ in the number of slashes after the scheme.
    files = spark.createDataFrame([(_SLASHES.sub(r"\1:/", file), n) for file, n in sorted(found.items())], "listed string, source int")
    listed = F.regexp_replace("file", _SLASHES.pattern, "$1:/")
    return texts.select(*place, listed.alias("listed"), "value").join(F.broadcast(files), "listed").select(*_SPLIT, "value")


def _placed_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    # A path that is given again replaces its own earlier tables by the same ones.
    paths = list(reversed(dict.fromkeys(reversed(paths))))
    line = F.btrim("value", F.lit(_BLANKS))
    # Most lines start with a printable character, which saves stripping them just to see that.
    printable = (F.col("value") >= "!") & (F.col("value") < "\x7f")
    marker = F.col("line").startswith("[") & F.col("line").endswith("]")
    # The id holds the partition and the record number inside it, so it is consecutive within a split.
    return (
        _numbered(spark, paths)
        .filter(printable | (line != ""))
        .select(*_SPLIT, F.monotonically_increasing_id().alias("pos"), line.alias("line"))
        .select("*", F.when(marker, F.btrim("line", F.lit("[]"))).alias("section"))
    )


def _sections(lines: DataFrame) -> DataFrame:
    """One row per table name: where its last section that has a header starts and ends."""

    def place(pos: str) -> Column:
        return F.struct(*_SPLIT, F.col(pos).alias("pos"))

    splits = lines.groupBy(*_SPLIT).agg(
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.min(F.when(F.col("section").isNotNull(), F.col("pos"))).alias("marker_pos"),
    )
    next_marker = F.when(F.col("marker_pos").isNotNull(), place("marker_pos"))
    splits = splits.select(*_SPLIT, "last_pos", place("first_pos").alias("line"), next_marker.alias("marker"))
    # Ranges of splits in order, fixed by being written: neighbours within a range, then the first of later ranges.
    ranges = materialise(splits.repartitionByRange(*_SPLIT).withColumn("part", F.spark_partition_id()), "splits")
    back = Window.partitionBy("part").orderBy(*map(F.desc, _SPLIT)).rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.groupBy("part").agg(F.min("line").alias("line"), F.min("marker").alias("marker"))
    # One row for each range, as many as there are shuffle partitions.
    beyond = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    first = first.select("part", F.last("line").over(beyond).alias("far_line"), F.last("marker", ignorenulls=True).over(beyond).alias("far_marker"))
    later_line = F.coalesce(F.last("line").over(back), "far_line")
    later_marker = F.coalesce(F.last("marker", ignorenulls=True).over(back), "far_marker")

    def same_text(neighbour: Column) -> Column:
        return F.when(neighbour["source"] == F.col("source"), neighbour)

    splits = ranges.join(F.broadcast(first), "part").select(
        *_SPLIT, "last_pos", same_text(later_line).alias("later_line"), same_text(later_marker).alias("later_marker")
    )

    in_split = Window.partitionBy(*_SPLIT).orderBy("pos")
    markers = (
        lines.filter(F.col("section").isNotNull())
        .select(*_SPLIT, "pos", "section")
        .withColumn("marker_pos", F.lead("pos").over(in_split))
        .withColumn("line_pos", F.col("pos") + 1)
        .join(splits, _SPLIT)
        .select(
            "section",
            place("pos").alias("start"),
            F.when(F.col("pos") < F.col("last_pos"), place("line_pos"))
            .otherwise(F.col("later_line"))
            .alias("header"),
            F.coalesce(F.when(F.col("marker_pos").isNotNull(), place("marker_pos")), "later_marker").alias("end"),
        )
    )
    has_header = F.col("header").isNotNull() & ~F.col("header").eqNullSafe(F.col("end"))
    return (
        markers.filter((F.col("section") != "") & has_header)
        # Views ignore case, so names that differ in it alone are one table, and the last one in the text wins.
        .groupBy(F.lower("section"))
        .agg(F.max(F.struct("start", "header", "end", "section")).alias("s"))
        .select("s.section", "s.header", "s.end")
    )


def _beyond(place, compare: Callable[[Column, Any], Column]) -> Column:
    """Lines after or before a place of the same text, in terms that Parquet statistics can answer."""
    condition = compare(F.col("pos"), place.pos)
    for name in reversed(_SPLIT[1:]):
        condition = compare(F.col(name), place[name]) | ((F.col(name) == place[name]) & condition)
    return condition


def _table(lines: DataFrame, name: str, columns: list[str], section) -> DataFrame:
    rows = lines.filter((F.col("source") == section.header.source) & _beyond(section.header, operator.gt))
    if section.end is not None:
        rows = rows.filter(_beyond(section.end, operator.lt))
    # A filter, not a column: a reader of few columns, or a count, must still see a ragged row.
    # Commas are counted, which costs far less than splitting the line once more.
    width = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(","), F.lit(""))) + 1
    message = F.format_string(f"%s has {len(columns)} columns but a row has %d fields", F.lit(name), width)
    whole = F.when(width == len(columns), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    fields = rows.filter(whole).select(F.split("line", ",", -1).alias("fields"))
    return fields.select(*[F.col("fields")[i].alias(column) for i, column in enumerate(columns)])


def read_sections(spark: SparkSession, *paths: str) -> dict[str, DataFrame]:
    """Read sectioned texts into one all-string DataFrame per table name.

    A name that occurs again, in whatever case, replaces the earlier table; a section without a header line
    gives none.
    """
    if not paths:
        return {}
    lines = materialise(_placed_lines(spark, list(paths)), "lines")
    # One row per table name, as many as there will be DataFrames.
    with work_scope(spark):
        sections = _sections(lines).collect()
    if not sections:
        return {}
    places = spark.createDataFrame([(s.header.pos,) for s in sections], "pos long")
    ends = [s.header.pos for s in sections]
    near = lines.filter(F.col("pos").between(min(ends), max(ends))).select("pos", "line")
    headers = {row.pos: row.line for row in near.join(F.broadcast(places), "pos").collect()}
    return {
        s.section: _table(lines, s.section, headers[s.header.pos].split(","), s)
        for s in sorted(sections, key=lambda s: s.section)
    }


def load_bundle(
    spark: SparkSession,
    paths: Mapping[str, str],
    types: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Read labelled sectioned texts and register every table as a temp view.

    Later paths replace tables of earlier ones. A path that does not exist raises before anything is
    read. ``types`` maps a table to ``{column: type}`` for :func:`conform`; other columns stay strings.
    """
    tables = read_sections(spark, *paths.values())
    types = {name.lower(): columns for name, columns in (types or {}).items()}
    unknown = sorted(set(types) - {name.lower() for name in tables})
    if unknown:
        raise ValueError(f"types given for tables that were not read: {', '.join(unknown)}")
    for name, table in tables.items():
        tables[name] = conform(table, types.get(name.lower(), {}))
        tables[name].createOrReplaceTempView(name)
    return tables
