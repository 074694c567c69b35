"""Delimited text tables: header, delimiter, encoding and quoting found out, rows read by Spark.

Every table gets an ``_ord`` column, the position of the row in file order:
``_ord.chunk`` names a bounded run of rows and orders the runs.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from firmscout.operators.joins import ORDER

# Delimiters looked for, the one assumed when none occurs, and the encodings.
DELIMITERS = [";", ",", "\t"]
DEFAULT_DELIMITER = ";"
UTF8, LATIN1 = "UTF-8", "ISO-8859-1"
# Malformed rows allowed by the strict reader.
MAX_BAD_ROWS = 1000

BAD_ROW = "_corrupt_record"
# A quote at the start of a line or behind a delimiter.
OPENING = "(^|[;,|\\t])\""
CHUNK_BITS = 20  # about a million rows per chunk


@dataclass(frozen=True)
class Shape:
    """How to read one group of files: their header line, encoding, and whether fields hold line breaks."""

    header: str
    encoding: str
    multiline: bool


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_ord`` to a frame that comes straight from files."""
    row = F.monotonically_increasing_id()
    chunk = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.shiftright(row, CHUNK_BITS).alias("run"),
    )
    return df.withColumn(ORDER, F.struct(chunk.alias("chunk"), row.alias("row")))


def find_delimiter(line: str, fallback: str = DEFAULT_DELIMITER) -> str:
    """The candidate that splits the header into most fields."""
    widths = {d: len(next(csv.reader([line], delimiter=d))) for d in DELIMITERS}
    best = max(DELIMITERS, key=lambda d: widths[d])
    return best if widths[best] > 1 else fallback


def _lines_by_file(lines: DataFrame) -> DataFrame:
    """Per file its first line with text, and whether any line is not UTF-8 or leaves a quote open.

    A set, always empty, makes this an object hash aggregate: a task reads few files, and no line is sorted by them.
    """
    value = F.col("value")
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
    open_quote = (quotes % 2 == 1) & value.rlike(OPENING)
    return lines.groupBy("file").agg(
        F.min_by("value", F.when(F.col("block") == 0, F.col("place"))).alias("line"),
        F.bool_or(~F.is_valid_utf8(value)).alias("latin"),
        F.bool_or(open_quote).alias("broken"),
        F.collect_set(F.lit(None).cast("int")).alias("unsorted"),
    )


def file_shapes(spark: SparkSession, path: str, whole: bool = True) -> dict[Shape, list[str] | None]:
    """The ways the files of a table must be read, with the files of each; None means all files.

    One pass over the text tells per file its header, whether a line is not valid
    UTF-8 (then the file is Latin-1) and whether a quote that opens a field is
    left open at the end of a line (then a field holds a line break and the file
    cannot be split). A quote elsewhere in a field opens nothing. Files without
    either are read in splits. Empty files are not among them. With ``whole``
    off, only the header is looked for, at the starts of the files.
    """
    value, place = F.col("value"), F.monotonically_increasing_id()
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        value,
        F.when(F.length("value") > 0, place).alias("place"),
    )
    if not whole:
        lines = lines.where("block = 0 AND place IS NOT NULL")
    per_file = _lines_by_file(lines)
    line = F.when(F.is_valid_utf8("line"), F.col("line")).otherwise(F.decode(F.col("line").cast("binary"), LATIN1))
    per_file = per_file.where(F.col("line").isNotNull()).withColumn("line", line)
    kinds = per_file.groupBy("line", "latin", "broken").agg(F.count("*").alias("files"), F.min("file").alias("one")).collect()
    shape = lambda row: Shape(row["line"].removeprefix("\ufeff"), LATIN1 if row["latin"] else UTF8, row["broken"])
    if len({shape(row) for row in kinds}) == 1:
        return {shape(kinds[0]): None}
    # Only where files differ do their names come to the driver, which lists them for the scan anyway.
    shapes: dict[Shape, list[str] | None] = {}
    for row in per_file.collect() if kinds else []:
        shapes.setdefault(shape(row), []).append(row["file"])
    return shapes


def _read(
    spark: SparkSession, files: str | list[str], names: list[str], delimiter: str, shape: Shape, strict: bool
) -> DataFrame:
    fields = [StructField(n, StringType()) for n in names]
    reader = spark.read.schema(StructType(fields + [StructField(BAD_ROW, StringType())] if strict else fields))
    options = {
        "header": True,
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        "multiLine": shape.multiline,
        "encoding": shape.encoding,
        "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    if strict:
        # Parsed whole, whatever is selected: missing fields go unnoticed in pruned rows.
        options |= {"columnNameOfCorruptRecord": BAD_ROW, "columnPruning": False}
    return with_file_order(reader.options(**options).csv(files))


def read_delimited(
    spark: SparkSession,
    path: str,
    *,
    delimiter: str = "auto",
    encoding: str = "auto",
    multiline: bool | None = None,
    strict: bool = False,
    may_be_empty: bool = False,
) -> DataFrame:
    """A table of text columns under its own header names, plus ``_ord``.

    Files with the same header are read together, and each group under its own
    names: columns may come in another order, or be missing, in some files. A
    table of empty files is an error, or has ``_ord`` alone and no rows.

    Short rows end in nulls and surplus fields are ignored; ``strict`` adds
    ``_corrupt_record``, which holds the text of such rows. Of columns whose
    headers are equal but for case, which Spark cannot tell apart, the last one
    is kept. Naming the encoding and whether fields hold
    line breaks saves the pass that finds them out.
    """
    guess = encoding == "auto" or multiline is None
    groups: dict[Shape, list[str] | None] = {}
    for found, files in file_shapes(spark, path, whole=guess).items():
        shape = Shape(
            found.header,
            found.encoding if encoding == "auto" else encoding,
            found.multiline if multiline is None else multiline,
        )
        known = groups.get(shape, [])
        groups[shape] = None if files is None else [*known, *files]
    if not groups:
        if not may_be_empty:
            raise ValueError(f"no header line in {path}")
        return with_file_order(spark.read.text(path)).select(ORDER).where("false")
    parts = []
    for shape, files in groups.items():
        separator = find_delimiter(shape.header) if delimiter == "auto" else delimiter
        header = next(csv.reader([shape.header], delimiter=separator))
        # Positional names: Spark renames headers that are equal but for case.
        names = [f"c{i}" for i in range(len(header))]
        rows = _read(spark, path if files is None else files, names, separator, shape, strict)
        last = {name.lower(): i for i, name in enumerate(header)}
        extra = [BAD_ROW] if strict else []
        parts.append(rows.select(*[F.col(f"c{i}").alias(header[i]) for i in last.values()], *extra, ORDER))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return table


def read_strict(
    spark: SparkSession, path: str, *, max_bad_rows: int = MAX_BAD_ROWS, **options
) -> tuple[DataFrame, DataFrame]:
    """Rows with the right number of fields, and the others; too many others are an error."""
    if max_bad_rows < 0:
        raise ValueError("max_bad_rows must not be negative")
    rows = read_delimited(spark, path, strict=True, **options)
    # Spark refuses to read the corrupt text alone, so the count touches the other columns too.
    others = F.max(F.xxhash64(*[f"`{c}`" for c in rows.columns if c != BAD_ROW]))
    count = rows.agg(F.count(BAD_ROW).alias("bad"), others.alias("others")).head()["bad"]
    if count > max_bad_rows:
        raise RuntimeError(f"more than {max_bad_rows} malformed rows in {path}: {count}")
    return rows.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW), rows.where(F.col(BAD_ROW).isNotNull())
