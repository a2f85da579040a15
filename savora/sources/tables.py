"""Reading and writing the stored tables."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from savora import schemas
from savora.functions import text
from savora.sources import shared


ESCAPED_NULL = "\\N"  # no text looks like it once its backslashes are doubled


def _csv_scan(spark: SparkSession, path: str, escaped_breaks: bool) -> DataFrame:
    options = dict(header=True, multiLine=not escaped_breaks, quote='"', escape='"', encoding="UTF-8", mode="PERMISSIVE")
    return spark.read.options(**options, **({"nullValue": ESCAPED_NULL} if escaped_breaks else {})).csv(path)


def _typed(raw: DataFrame, schema: T.StructType, escaped_breaks: bool, extra: Sequence[str] = ()) -> DataFrame:
    """Columns matched by their header, cast where they can be."""
    def column(field: T.StructField) -> Column:
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        if field.dataType == T.StringType():
            return (text.unescape_breaks(value) if escaped_breaks else value).alias(field.name)
        return value.try_cast(field.dataType).alias(field.name)
    return raw.select(*[column(f) for f in schema.fields], *[c for c in raw.columns if c not in schema.names and c not in extra], *extra)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.SOURCE_SCHEMA, escaped_breaks: bool = False) -> DataFrame:
    """Quoted CSV with a header.  Texts may hold commas, quotes and line breaks.

    The columns are matched by their header, so their order and number may differ
    from the schema; absent ones are NULL.  A file whose fields may hold line breaks
    is read by one task, and an empty text is NULL.  Files written with ``escaped_breaks`` hold no line breaks, so Spark splits them, and tell
    empty texts from NULL.
    """
    return _typed(_csv_scan(spark, path, escaped_breaks), schema, escaped_breaks)  # header only: every column of the scan is a string


def is_csv(path: str) -> bool:
    return path.rstrip("/").endswith(".csv")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV when the path says so, else Parquet."""
    return read_csv(spark, path, schema or schemas.SOURCE_SCHEMA) if is_csv(path) else spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).schema
        return True
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return False
        raise


FILE, POSITION, SOURCE = "_file", "_position", "_source"
FILES_TO_BROADCAST = 50_000


def read_positioned(spark: SparkSession, path: str, schema: T.StructType | None = None, escaped_breaks: bool = False) -> DataFrame:
    """The table with the file of each row and its position in that file, both independent of how files are split.

    Parquet knows the position.  A CSV row is numbered inside the block of the file that a task
    reads; the rows of earlier blocks are added.  Blocks may be cut otherwise the next time, so the scan is stored first.
    """
    if not is_csv(path):
        return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(POSITION))
    scan = _csv_scan(spark, path, escaped_breaks)
    met = scan.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_met"))
    rows = shared.stored(_typed(met, schema or schemas.SOURCE_SCHEMA, escaped_breaks, (FILE, "_block", "_met")), "csv-rows")
    blocks = rows.groupBy(FILE, "_block").agg(F.min("_met").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(FILE, "_block", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(before, [FILE, "_block"]).withColumn(POSITION, F.col("_before") + F.col("_met") - F.col("_first")).drop("_block", "_met", "_first", "_before")


def with_row_order(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack positioned tables and number their rows 0, 1, 2 ... as ``row_idx``: by source, file and position.

    The number follows from the data alone, so a retry, another split or another cluster gives the same one.  Files are
    counted first; their table is broadcast while it is small and joined by file beyond that.
    """
    rows = union_sources([df.withColumn(SOURCE, F.lit(i)) for i, df in enumerate(frames)])
    sizes = rows.groupBy(SOURCE, FILE).agg(F.count("*").alias("_rows"))
    sources = sizes.groupBy(SOURCE).agg(F.sum("_rows").alias("_total"))
    # windows over a handful of sources, and over the files of one of them
    earlier_sources = Window.orderBy(SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    earlier_files = Window.partitionBy(SOURCE).orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sources.select(SOURCE, F.coalesce(F.sum("_total").over(earlier_sources), F.lit(0)).alias("_start"))
    files = shared.stored(sizes.join(starts, SOURCE).select(SOURCE, FILE, (F.col("_start") + F.coalesce(F.sum("_rows").over(earlier_files), F.lit(0))).alias("_start")), "files")
    small = files.count() <= FILES_TO_BROADCAST
    joined = rows.join(F.broadcast(files) if small else files, [SOURCE, FILE])
    return joined.withColumn("row_idx", F.col("_start") + F.col(POSITION)).drop(SOURCE, FILE, POSITION, "_start")


def load_sources(spark: SparkSession, paths: Sequence[str], schema: T.StructType = schemas.SOURCE_SCHEMA) -> DataFrame:
    """Union of the sources that exist and hold rows, numbered as ``row_idx``; none left is an error."""
    frames = []
    for path in paths:
        if exists(spark, path) and not (df := read_positioned(spark, path, schema)).isEmpty():
            frames.append(df)
    if not frames:
        raise FileNotFoundError(f"no source with rows among {list(paths)}")
    return with_row_order(frames)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by column name; a column a source lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_first(spark: SparkSession, paths: Sequence[str], schema: T.StructType = schemas.SOURCE_SCHEMA) -> DataFrame:
    """The first path that exists, else an empty table."""
    for path in paths:
        if exists(spark, path):
            return read_table(spark, path, schema)
    return spark.createDataFrame([], schema)


def _write(df: DataFrame, path: str, csv: bool, mode: str, escaped_breaks: bool) -> None:
    if csv:
        kinds = dict(df.dtypes)
        df = df.withColumns({c: F.to_json(c) for c, kind in kinds.items() if kind.startswith("map")})
        if escaped_breaks:
            df = df.withColumns({c: text.escape_breaks(F.col(c)) for c, kind in df.dtypes if kind == "string"})
        df.write.mode(mode).csv(path, header=True, quote='"', escape='"', encoding="UTF-8", nullValue=ESCAPED_NULL if escaped_breaks else None)
    else:
        df.write.mode(mode).parquet(path)


def append_table(df: DataFrame, path: str, columns: Sequence[str] | None = None, escaped_breaks: bool = False) -> None:
    """Add rows to a stored table, columns in their fixed order; CSV when the path says so."""
    _write(schemas.conform(df, columns) if columns else df, path, is_csv(path), "append", escaped_breaks)


def write_table(df: DataFrame, path: str, columns: Sequence[str] | None = None, escaped_breaks: bool = False) -> int:
    """Write a table in place of what is there, columns in their fixed order, and say how many rows it has; CSV when the path says so.

    Each call writes an attempt of its own beside the table, reads it back and compares the number of rows; only then
    it takes the name.  A call that fails leaves the table as it was.
    """
    spark, attempt = df.sparkSession, shared.beside(path, "attempt")
    out = schemas.conform(df, columns) if columns else df
    seen = Observation()
    try:
        _write(out.observe(seen, F.count(F.lit(1)).alias("rows")), attempt, is_csv(path), "errorifexists", escaped_breaks)
        written = seen.get["rows"]
        found = _csv_scan(spark, attempt, escaped_breaks).count() if is_csv(path) else spark.read.schema(out.schema).parquet(attempt).count()
        if found != written:
            raise OSError(f"{written} rows were written to {path}, {found} can be read")
        shared.publish(spark, attempt, path)
    finally:
        shared.delete(spark, attempt)
    return written


def write_if_valid(df: DataFrame, path: str, required: Sequence[str] = schemas.REQUIRED_COLUMNS,
                   columns: Sequence[str] | None = None) -> bool:
    """Write only a table that has the required columns; says whether it did."""
    if schemas.missing_columns(df, required):
        return False
    write_table(df, path, columns)
    return True


# --- keyed results -----------------------------------------------------------

def upsert(stored: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Stored rows, with the latest new row of a key in place of its old one."""
    columns = [c for c in new.columns]
    latest = new.groupBy(key).agg(F.max_by(F.struct(*columns), version).alias("_row")).select("_row.*")
    kept = stored.join(latest.select(key), key, "left_anti")
    return kept.select(*stored.columns).unionByName(latest, allowMissingColumns=True)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per stored table."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
