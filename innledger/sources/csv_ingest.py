"""Raw CSV extracts to typed tables.

Files are read as text with a fixed column list, never with inferred types, and cast afterwards. A lenient
cast turns a bad value into NULL; a strict cast sets the whole row aside. Both stay visible to Spark as
plain expressions, unlike parser modes, whose result depends on the columns a query asks for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innledger.functions.columns import holds, null_if_token
from innledger.operators.silver import clock
from innledger.values import INCREMENT_PATTERN, LOAD_NULL_TOKENS

# Layouts tried in turn after ISO.
DATE_FORMATS = ("dd-MMM-yyyy", "MM/dd/yyyy")
CLOCK_FORMATS = ("dd-MMM-yyyy HH:mm:ss", "MM/dd/yyyy HH:mm:ss")
#: Column that tells good rows from rejected ones, and the partition they are written to.
OUTCOME = "outcome"
_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}"


def parse_layout(layout: str) -> T.StructType:
    return T.StructType.fromDDL(layout)


def _lines(reader, path: str, layout: str, delimiter: str, multi_line: bool) -> DataFrame:
    """All columns as text by position, from a batch or a stream reader."""
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n in parse_layout(layout).names])
    return (
        reader.schema(text_schema)
        .option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .csv(path)
    )


def _stamped(lines: DataFrame, loaded_at: dt.datetime, null_tokens: Iterable[str], trim: bool) -> DataFrame:
    values = [null_if_token(F.trim(n) if trim else F.col(n), null_tokens).alias(n) for n in lines.columns]
    return lines.select(
        *values, clock(loaded_at).alias("_loaded_at"), F.col("_metadata.file_name").alias("_file_name")
    )


def read_csv_raw(
    spark: SparkSession,
    path: str,
    layout: str,
    loaded_at: dt.datetime,
    null_tokens: Iterable[str] = LOAD_NULL_TOKENS,
    trim: bool = False,
    delimiter: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """All columns as text by position, with the load time and the file each row came from.

    Missing trailing columns become NULL and extra ones are ignored. Quoted line breaks need
    `multi_line`, which gives up splitting of large files.
    """
    return _stamped(_lines(spark.read, path, layout, delimiter, multi_line), loaded_at, null_tokens, trim)


def stream_csv_raw(
    spark: SparkSession,
    path: str,
    layout: str,
    loaded_at: dt.datetime,
    files_per_batch: int | None = None,
    null_tokens: Iterable[str] = LOAD_NULL_TOKENS,
    trim: bool = False,
    delimiter: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """The same rows as a stream of the files that arrive in the folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _stamped(_lines(reader, path, layout, delimiter, multi_line), loaded_at, null_tokens, trim)


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.col(name)
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        iso = F.when(text.rlike(_ISO_DATE), text.try_cast("date"))
        return F.coalesce(iso, *[F.try_to_date(text, f) for f in DATE_FORMATS])
    if isinstance(kind, T.TimestampNTZType):
        iso = F.when(text.rlike(_ISO_DATE), text.try_cast("timestamp_ntz"))
        others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in CLOCK_FORMATS]
        return F.coalesce(iso, *others)
    if isinstance(kind, T.IntegralType):  # a fraction is rounded, not refused
        return text.try_cast("decimal(38,0)").try_cast(kind)
    return text.try_cast(kind)


def cast_lenient(raw: DataFrame, layout: str) -> DataFrame:
    """Typed columns; a value that does not parse becomes NULL and the row stays."""
    schema = parse_layout(layout)
    rest = [c for c in raw.columns if c not in schema.names]
    return raw.select(*[_typed(f.name, f.dataType).alias(f.name) for f in schema], *rest)


def judge(raw: DataFrame, layout: str, strict: Sequence[str] = ()) -> DataFrame:
    """Every row typed, with its `outcome`: `rejected` if a strict column does not parse, else `good`.

    Strict columns default to all columns with a type other than text. Rejected rows keep their text in `_text`
    and name the offending columns in `rejected_columns`.
    """
    schema = parse_layout(layout)
    strict = strict or [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
    rest = [c for c in raw.columns if c not in schema.names]
    typed = F.struct(*[_typed(f.name, f.dataType).alias(f.name) for f in schema])
    cast = raw.select(F.struct(*schema.names).alias("_text"), typed.alias("_typed"), *rest)
    text, value = F.col("_text"), F.col("_typed")
    failed = [F.when(text[n].isNotNull() & value[n].isNull(), F.lit(n)) for n in schema.names if n in strict]
    broken = F.array_join(F.array_compact(F.array(*failed)), ",")
    return cast.withColumn("rejected_columns", broken).select(
        "_typed.*",
        *rest,
        F.when(F.col("rejected_columns") != "", text).alias("_text"),
        "rejected_columns",
        F.when(F.col("rejected_columns") == "", "good").otherwise("rejected").alias(OUTCOME),
    )


def _sides(judged: DataFrame, layout: str) -> tuple[DataFrame, DataFrame]:
    names = parse_layout(layout).names
    rest = [c for c in judged.columns if c not in (*names, "_text", "rejected_columns", OUTCOME)]
    good = judged.where(F.col(OUTCOME) == "good").select(*names, *rest)
    return good, judged.where(F.col(OUTCOME) == "rejected").select("_text.*", *rest, "rejected_columns")


def cast_strict(raw: DataFrame, layout: str, strict: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Typed good rows, and the rows set aside because a strict column does not parse (see `judge`).

    Each frame reads the files for itself; `store_strict` reads them once for both.
    """
    return _sides(judge(raw, layout, strict), layout)


def store_strict(
    raw: DataFrame, layout: str, path: str, strict: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows as `cast_strict` gives them, from one scan of the files.

    Rows are cast once and written by outcome; each side then reads its own partition of the path.
    """
    judged = judge(raw, layout, strict)
    writer = judged.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(OUTCOME).parquet(path)
    return _sides(raw.sparkSession.read.schema(judged.schema).parquet(path), layout)


def append_raw(df: DataFrame, path: str) -> None:
    """A reload appends everything again; the validated layer removes the copies."""
    df.write.mode("append").parquet(path)


def increment_rows(raw: DataFrame, pattern: str = INCREMENT_PATTERN) -> DataFrame:
    """Rows of increment files. The underscore of the pattern matches any one character."""
    return raw.where(F.col("_file_name").like(pattern))


def base_rows(raw: DataFrame, pattern: str = INCREMENT_PATTERN) -> DataFrame:
    """Rows of all other files."""
    return raw.where(~holds(F.col("_file_name").like(pattern)))


def increment_rows_exact(raw: DataFrame, marker: str = "_inc") -> DataFrame:
    """Rows of files whose name holds the marker literally."""
    return raw.where(F.col("_file_name").contains(marker))


def source_manifest(spark: SparkSession, root: str, name_glob: str = "*") -> DataFrame:
    """Files and bytes per entity below a folder, from the file listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    inside = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    entity = F.regexp_replace(F.substring_index(inside, "/", 1), r"\.\w+$", "")
    return files.groupBy(entity.alias("entity")).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("last_modified"),
    )
