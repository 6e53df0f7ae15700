"""CSV files with a header, read by the names of their columns.

Every file says by its header which columns it has and in what order: columns of the schema are found by name, in
either case, those a file lacks are NULL, and others are left out. A file without one of the required columns, or with
a name twice, is unknown, and all of its lines are malformed; so is a line with another number of fields than its header.
Malformed lines keep their text and the header of their file. Nothing is lost: every line but headers and blank ones
comes out once.

Lines are read as text, and files may be split over tasks. The header of a file is the first line of its first block. A
table of headers, one row per file, is stored and joined with the lines; Spark broadcasts it below its size threshold,
and otherwise shuffles, splitting large files. As header names are found by splitting at commas, they can't hold one. A quote
inside quotes is doubled, and no line end may be inside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize
from tidemark.sources.files import CORRUPT, LINEAGE, typed, with_lineage

LINE, BLOCK, HEADER = "_line", "_block", "_header"


def _lines(text: DataFrame) -> DataFrame:
    return with_lineage(text).select(
        F.col("value").alias(LINE), *LINEAGE, F.col("_metadata.file_block_start").alias(BLOCK)
    )


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files of a directory, with their lineage."""
    return _lines(spark.read.text(path))


def stream_csv_lines(
    spark: SparkSession, path: str, *, purge: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The lines of new files as a stream, to be parsed in each micro-batch by :func:`parse_by_header`.

    With ``purge`` a file is deleted once a later micro-batch has committed after its own.
    """
    reader = spark.readStream
    if purge:
        reader = reader.option("cleanSource", "delete")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _lines(reader.text(path))


def file_headers(lines: DataFrame, columns: Sequence[str], required: Sequence[str]) -> DataFrame:
    """One row per file: its header, how many columns it names, the place of each wanted one (0 if missing), and
    whether the file is known."""
    # Within a task the lines of a file come in order, and its first block is in one task.
    first = lines.where((F.col(BLOCK) == 0) & (F.trim(LINE) != "")).withColumn("at", F.monotonically_increasing_id())
    heads = first.groupBy("source_file_path").agg(F.min_by(LINE, "at").alias(HEADER))
    bare = F.regexp_replace(F.lower(HEADER), "[\\uFEFF\"]", "")
    heads = heads.withColumn("names", F.transform(F.split(bare, ","), lambda name: F.trim(name)))
    known = F.size(F.array_distinct("names")) == F.size("names")
    for column in required:
        known = known & F.array_contains("names", column.lower())
    places = [F.array_position("names", c.lower()).cast("int") for c in columns]
    return heads.select(
        "source_file_path", HEADER, F.size("names").alias("width"), F.array(*places).alias("places"), known.alias("known")
    )


def _fields(widths: Sequence[int]) -> tuple[list[Column], Column, Column]:
    """Parsed records by width of the header, and from them the fields and the text of a malformed line."""
    parsed, fields, bad = [], F.lit(None).cast("array<string>"), F.lit(None).cast("string")
    for n in widths:
        schema = ", ".join(f"_{i} STRING" for i in range(n)) + f", {CORRUPT} STRING"
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'}
        parsed.append(F.when(F.col("width") == n, F.from_csv(LINE, schema, options)).alias(f"_parsed{n}"))
        record = F.col(f"_parsed{n}")
        fields = F.when(F.col("width") == n, F.array(*[record[f"_{i}"] for i in range(n)])).otherwise(fields)
        bad = F.when(F.col("width") == n, record[CORRUPT]).otherwise(bad)
    return parsed, fields, bad


def parse_by_header(lines: DataFrame, ddl: str, required: Sequence[str] = ()) -> DataFrame:
    """The columns of the schema as texts, the lineage, ``CORRUPT`` with the text of a malformed line and the line and
    header it came from."""
    names = T.StructType.fromDDL(ddl).names
    heads = materialize(file_headers(lines, names, required), "csv-headers")
    # A number for each width that headers have, each a branch of one expression over a single scan.
    widths = sorted(row[0] for row in heads.where("known").select("width").distinct().collect())
    data = lines.where(F.trim(LINE) != "").join(heads, "source_file_path", "left")
    data = data.where(F.coalesce(F.col(LINE) != F.col(HEADER), F.lit(True)))
    parsed, fields, bad = _fields(widths)
    kept = [LINE, HEADER, *LINEAGE, "places", F.coalesce("known", F.lit(False)).alias("known"), "width"]
    # In steps, as each record must be parsed only once and whole.
    data = data.select(*kept, *parsed)
    data = data.select(LINE, HEADER, *LINEAGE, "places", "known", fields.alias("fields"), bad.alias("bad"))
    values = [F.get("fields", F.get("places", F.lit(i)) - 1).alias(c) for i, c in enumerate(names)]
    malformed = F.when(~F.col("known"), F.col(LINE)).otherwise(F.col("bad"))
    return data.select(*values, *LINEAGE, malformed.alias(CORRUPT), LINE, HEADER)


def read_csv(spark: SparkSession, path: str, ddl: str, required: Sequence[str] = ()) -> DataFrame:
    """Batch scan of the well-formed lines, typed; :func:`malformed_csv` has the others."""
    rows = parse_by_header(csv_lines(spark, path), ddl, required)
    return typed(rows.where(F.col(CORRUPT).isNull()), ddl)


def malformed_csv(spark: SparkSession, path: str, ddl: str, required: Sequence[str] = ()) -> DataFrame:
    rows = parse_by_header(csv_lines(spark, path), ddl, required)
    return rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, HEADER, *LINEAGE)
