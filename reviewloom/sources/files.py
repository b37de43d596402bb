"""Directory scans in which each file has its own header.

Heads are read by Spark's own readers, so every scheme and every file name that Spark can read works. A file
that cannot be used is a reject row with a reason and never ends the load of the others.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import materialise

EXTENSIONS = {"csv": "*.csv", "json": "*.json", "parquet": "*.parquet"}

# Footers that the driver reads at a time.
FOOTERS_AT_ONCE = 16


def source_file() -> Column:
    """The file's path as it was named: the metadata column holds it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _literal(path: str) -> str:
    """A path whose name is not taken for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _scan(spark: SparkSession, kind: str):
    return spark.read.option("pathGlobFilter", EXTENSIONS[kind]).option("recursiveFileLookup", "true")


def file_columns(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """(path, columns, types, problem): what the head of every CSV or parquet file says.

    The extension test is case-sensitive. A CSV head is the first line of a file's first block; of a parquet
    file only the footer is read.
    """
    if kind == "parquet":
        return _footers(spark, folder)
    lines = _scan(spark, kind).text(folder).where(F.col("_metadata.file_block_start") == 0)
    numbered = lines.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("line"))
    heads = numbered.groupBy("path").agg(F.min_by("value", "line").cast("binary").alias("head"))

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, head in zip(batch["path"], batch["head"]):
                text = bytes(head or b"").decode("utf-8", "replace").lstrip("\ufeff").rstrip("\r")
                names = next(csv.reader(io.StringIO(text)), [])
                low = [n.lower() for n in names]
                twice = sorted({n for n in names if low.count(n.lower()) > 1})
                problem = f"repeated columns: {', '.join(twice)}" if twice else None
                rows.append((unquote(path), names, ["string"] * len(names), problem))
            yield pd.DataFrame(rows, columns=["path", "columns", "types", "problem"])

    return heads.mapInPandas(parsed, "path string, columns array<string>, types array<string>, problem string")


def _footers(spark: SparkSession, folder: str) -> DataFrame:
    """Schema of each parquet file, footers read some at a time."""
    names = [r.path for r in _scan(spark, "parquet").format("binaryFile").load(folder).select("path").collect()]

    def footer(path: str) -> tuple[str, list[str], list[str], str | None]:
        try:
            fields = spark.read.parquet(_literal(path)).schema.fields
        except Exception as error:  # whatever a broken file raises becomes its reason
            return path, [], [], f"unreadable: {str(error).splitlines()[0][:200]}"
        return path, [f.name for f in fields], [f.dataType.simpleString() for f in fields], None

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as readers:
        rows = list(readers.map(footer, names))
    return spark.createDataFrame(rows, "path string, columns array<string>, types array<string>, problem string")


def read_by_header(
    spark: SparkSession, folder: str, kind: str, wanted: Sequence[str], required: Sequence[str] = (), multiline: bool = False
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of all files that have the required columns, and a table (Source_File, missing, reason) of the others.

    A column is found by name whatever its place. All wanted columns come back as text, NULL where a file
    lacks them, plus ``Source_File``. The first result is None where no file qualifies.
    """
    if kind == "json":
        return _read_json(spark, folder, wanted, required)
    lacking = F.array_except(F.array(*[F.lit(c) for c in required]).cast("array<string>"), F.col("columns"))
    reason = F.coalesce("problem", F.when(F.size("missing") > 0, "missing columns"))
    # stored: one row per file, read for the rejects and again for the layouts
    checked = materialise(file_columns(spark, folder, kind).withColumn("missing", lacking).withColumn("reason", reason), "files")
    rejects = checked.where(F.col("reason").isNotNull()).select(F.col("path").alias("Source_File"), "missing", "reason")
    # files of equal names and types are read together; the driver gets file names only, as it does for any scan
    layouts: dict[tuple, list[str]] = {}
    for row in checked.where(F.col("reason").isNull() & (F.size("columns") > 0)).select("path", "columns", "types").toLocalIterator():
        layouts.setdefault((tuple(row["columns"]), tuple(row["types"])), []).append(row["path"])
    frames = []
    for (columns, _), paths in sorted(layouts.items()):
        frame = _read(spark, kind, columns, [_literal(p) for p in paths], multiline)
        have = set(columns)
        cells = [
            (F.col(f"`{c}`").cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in wanted
        ]
        frames.append(frame.select(*cells, source_file().alias("Source_File")))
    return (reduce(DataFrame.unionByName, frames) if frames else None), rejects


def _read(spark: SparkSession, kind: str, columns: Sequence[str], paths: list[str], multiline: bool) -> DataFrame:
    if kind == "parquet":
        return spark.read.parquet(*paths)
    schema = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in columns)
    reader = spark.read.schema(schema).option("header", "true").option("escape", '"')
    return reader.option("multiLine", str(multiline).lower()).csv(paths)


def missing_in_records(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """(Source_File, missing) of record files, in which a column is missing where no record has it."""
    seen = rows.groupBy("Source_File").agg(F.count(F.lit(1)).alias("rows"), *[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in required])
    lacking = F.array(*[F.when(~F.col(f"`{c}`"), F.lit(c)) for c in required]).cast("array<string>")
    return seen.select("Source_File", F.array_compact(lacking).alias("missing"))


def _read_json(
    spark: SparkSession, folder: str, wanted: Sequence[str], required: Sequence[str]
) -> tuple[DataFrame | None, DataFrame]:
    """JSON lines name their columns record by record."""
    schema = ", ".join(f"`{c}` STRING" for c in wanted)
    rows = _scan(spark, "json").schema(schema).json(folder)
    rows = rows.select(*[F.col(f"`{c}`") for c in wanted], source_file().alias("Source_File"))
    # stored: one row per file, so the records are looked through once
    files = materialise(missing_in_records(rows, required), "files")
    rejects = files.where(F.size("missing") > 0).withColumn("reason", F.lit("missing columns"))
    if files.where(F.size("missing") == 0).isEmpty():
        return None, rejects
    # few files are rejected, so their names meet the rows where those are
    return rows.join(rejects.select("Source_File"), "Source_File", "left_anti").select(rows.columns), rejects
