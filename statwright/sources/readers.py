"""Readers.  Every scan has an explicit schema; text is read in splits, so a
file may be larger than a task, and line numbers are counted per split."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import FILE_MISSING, missing_to_null, partial_date, profile_family
from ..functions.sizes import broadcast_if_small
from ..functions.storage import written


def _parsed(text: Column, kind: T.DataType) -> Column:
    return text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)


def clean_name(name: str) -> str:
    """Lower case, runs of other characters as one underscore, none at the ends."""
    return re.sub(r"\W+", "_", name).lower().strip("_")


def dashed_name(name: str) -> str:
    return name.strip().replace(" ", "_").replace("-", "_")


def rename_headers(df: DataFrame, rule=clean_name) -> DataFrame:
    """Normal header names; a name that occurs again gets a number."""
    seen: dict[str, int] = {}
    names = []
    for column in df.columns:
        name = rule(column) or "column"
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, missing: Sequence[str] = FILE_MISSING) -> DataFrame:
    """CSV with a header; several texts count as missing, blanks in names
    become underscores, cells that do not parse become NULL."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.option("header", True).schema(texts).csv(path)
    cells = [_parsed(missing_to_null(F.col(f"`{f.name}`"), missing), f.dataType).alias(f.name.replace(" ", "_")) for f in schema.fields]
    return raw.select(*cells)


class DirtyCsv(NamedTuple):
    rows: DataFrame
    malformed: DataFrame
    encoding: str


def read_dirty_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DirtyCsv:
    """UTF-8 if it decodes, else Latin-1; lines that do not fit the schema are
    kept apart."""
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])

    def load(encoding: str) -> DataFrame:
        return (spark.read.schema(wide).option("header", True).option("sep", sep).option("encoding", encoding)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").csv(path))
    encoding = "UTF-8"
    if not spark.read.text(path).filter(~F.is_valid_utf8("value")).isEmpty():
        encoding = "ISO-8859-1"
    raw = load(encoding)
    names = [f.name for f in schema.fields]
    # Spark refuses to scan for the malformed text alone: also ask for the cells, whatever a caller selects later
    touched = F.length(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in names])) >= 0
    return DirtyCsv(raw.filter(F.col("_bad").isNull() & touched).select(*names),
                    raw.filter(F.col("_bad").isNotNull() & touched).select("_bad"), encoding)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, record_per_line: bool = False) -> DataFrame:
    """Files that hold one array of records each.  In general such a file is
    read by one task; with one record per line it is read in splits."""
    if not record_per_line:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    line = F.regexp_replace(F.regexp_replace("value", r"^\s*[\[,]\s*", ""), r"\s*[\],]\s*$", "")
    rows = spark.read.text(path).select(line.alias("value")).filter("value <> ''")
    return rows.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_xml(spark: SparkSession, path: str, schema: T.StructType, row_tag: str) -> DataFrame:
    return spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)


def read_keyed_json(spark: SparkSession, path: str, record: str, key: str = "name", separator: str | None = None) -> DataFrame:
    """Objects {name: {field: ...}}: one row per name.  ``record`` is the type
    of the inner object.  A file is one object, or many with a separator."""
    whole = (spark.read.text(path, wholetext=True) if separator is None
             else spark.read.option("lineSep", separator).text(path))
    entries = F.explode(F.from_json("value", f"map<string,{record}>")).alias(key, "_record")
    return whole.select(entries).select(key, "_record.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (1..), value, without moving a line.  The rows of a split
    carry ids that follow each other, so a line's number is its id less the
    first one of its split, plus the lines in the earlier splits of its file.
    Only one row per split is counted, and joined back."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"), "value")
    splits = raw.groupBy("file", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    start = written(splits.select("file", "_split", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")))
    return raw.join(broadcast_if_small(start), ["file", "_split"]).select("file", (F.col("_id") + F.col("_shift")).alias("line"), "value")


def _numbers(value: Column, n: int) -> list[Column]:
    part = F.split(F.trim(value), r"\s+")
    return [F.get(part, F.lit(i)).try_cast("double") for i in range(n)]


def read_skipping_header(spark: SparkSession, path: str, columns: Sequence[str], header_lines: int = 12) -> DataFrame:
    """Whitespace tables after a fixed number of header lines per file."""
    lines = numbered_lines(spark, path).filter(F.col("line") > header_lines)
    cells = [c.alias(n) for c, n in zip(_numbers(F.col("value"), len(columns)), columns)]
    rows = lines.select("file", "line", *cells)
    return rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def read_parameter_tables(spark: SparkSession, path: str, columns: Sequence[str], header_words: Sequence[str] = ("alpha", "CL"),
                          parameter: str = r"re(\d+)") -> DataFrame:
    """A folder of tables: data start two lines below the line with all header
    words, and have at least as many numbers as columns; the parameter comes
    from the file name, files without one (or without header) are left out."""
    lines = numbered_lines(spark, path)
    has_words = reduce(lambda a, b: a & b, [F.col("value").contains(w) for w in header_words])
    number = F.regexp_extract(F.col("file"), parameter + r"[^/]*(/part-[^/]*)?$", 1).try_cast("long")
    start = written(lines.filter(has_words).groupBy("file").agg(F.min("line").alias("_header")))
    rows = lines.join(broadcast_if_small(start), "file").filter(F.col("line") >= F.col("_header") + 2)
    cells = [c.alias(n) for c, n in zip(_numbers(F.col("value"), len(columns)), columns)]
    rows = rows.filter(F.size(F.split(F.trim("value"), r"\s+")) >= len(columns)).select(number.alias("parameter"), "line", *cells)
    return rows.filter(F.col("parameter") > 0).orderBy("parameter", "line")


class CurveFiles(NamedTuple):
    curves: DataFrame
    points: DataFrame


def read_curve_files(spark: SparkSession, path: str) -> CurveFiles:
    """One curve per file: name from the file, description from its first line,
    then ``x y`` lines; other lines and points beyond 1 in size are skipped."""
    lines = numbered_lines(spark, path).withColumn("name", F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1))
    head = lines.filter("line = 1").select("name", F.trim("value").alias("description"))
    head = head.withColumn("family", profile_family(F.col("name"), F.col("description")))
    x, y = _numbers(F.col("value"), 2)
    rows = lines.filter((F.col("line") > 1) & (F.size(F.split(F.trim("value"), r"\s+")) == 2)).select(
        "name", F.col("line").alias("seq"), x.alias("x"), y.alias("y"))
    return CurveFiles(head, rows.filter((F.abs("x") <= 1) & (F.abs("y") <= 1)))


def read_dated_triples(spark: SparkSession, path: str) -> DataFrame:
    """Lines of exactly (int, int, date); all other lines are skipped."""
    part = F.split("value", ",")
    rows = spark.read.text(path).filter(F.size(part) == 3)
    cell = lambda i: F.trim(F.get(part, F.lit(i)))
    return rows.select(cell(0).try_cast("int").alias("first"), cell(1).try_cast("int").alias("second"), partial_date(cell(2)).alias("date")).dropna()


def point_list(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, seq, x, y from a cell of ``x y`` lines; bad lines are left out."""
    lines = df.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("seq", "value"))
    x, y = _numbers(F.col("value"), 2)
    return lines.select(key, "seq", x.alias("x"), y.alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")


def with_aliases(df: DataFrame, targets: dict[str, Sequence[str]]) -> DataFrame:
    """Each target column is the first non-missing of its possible names."""
    out = []
    for target, names in targets.items():
        present = [F.col(f"`{n}`") for n in names if n in df.columns]
        out.append((F.coalesce(*present) if present else F.lit(None).cast("string")).alias(target))
    return df.select(*out)


def append_sources(sources: Sequence[DataFrame], targets: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Several sources as one table; columns a source lacks are NULL."""
    parts = [with_aliases(df, targets) if targets else df for df in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
