"""File scans: CSV (header, optional recursive folder walk) and JSON.

Paths are Hadoop file-system URIs (``s3a://``, ``gs://``, ``hdfs://``,
``file:``), so executors read object storage directly; nothing is first
copied to a machine-local folder.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabsmith.functions import null_tokens


#: The column for records that could not be read, as they stood.
REJECTED = "_rejected"


def _normalise_tokens(df: DataFrame, tokens: Iterable[str] | None) -> DataFrame:
    if tokens is None:
        return df
    tokens = list(tokens)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name != REJECTED]
    return df.withColumns({c: null_tokens(c, tokens) for c in strings}) if strings else df


#: Different header rows that one read may meet; more means that files without
#: a header are read as if they had one.
MAX_HEADERS = 1000


def _configured(spark: SparkSession, settings: dict[str, str]) -> DataFrameReader:
    reader = spark.read
    for key, value in settings.items():
        reader = reader.option(key, value)
    return reader


def _headers(spark: SparkSession, path: str | list[str], settings: dict[str, str]) -> list[tuple[str, ...]]:
    """The different header rows below ``path``, as cell texts. The first line
    that is not blank is taken from every file in the tasks that read it; one
    row per different header reaches the driver."""
    lines = _first_lines(spark, path, settings).select("line").distinct().limit(MAX_HEADERS + 1).collect()
    if len(lines) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different header rows below {path!r}")
    return sorted({_cells(r["line"], settings) for r in lines})


def _first_lines(spark: SparkSession, path: str | list[str], settings: dict[str, str]) -> DataFrame:
    """(file, line): the header row of every file."""
    kept = {k: v for k, v in settings.items() if k in ("recursiveFileLookup", "pathGlobFilter", "encoding", "lineSep", "modifiedBefore", "modifiedAfter")}
    text = _configured(spark, kept).text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("at"))
    lines = lines.filter((F.col("block") == 0) & (F.trim("value") != ""))
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))


def _cells(line: str, settings: dict[str, str]) -> tuple[str, ...]:
    sep, quote = settings.get("sep", settings.get("delimiter", ",")), settings.get("quote", '"')
    return tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff").rstrip("\r")], delimiter=sep, quotechar=quote or None, quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE)))


def _read_by_name(
    spark: SparkSession, path: str | list[str], schema: StructType | None, infer_schema: bool, settings: dict[str, str]
) -> DataFrame:
    """One scan per header row, each over the files that have it, united by name."""
    fold = str if spark.conf.get("spark.sql.caseSensitive", "false") == "true" else str.lower
    wanted = {fold(f.name): f for f in schema.fields} if schema is not None else {}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(_first_lines(spark, path, settings).collect()):  # one path per file, as the scans' own listings have
        by_header.setdefault(_cells(row["line"], settings), []).append(row["file"])
    feeds = []
    for header in by_header:  # the first file's names and order lead
        names = [fold(c) for c in header]
        if len(set(names)) < len(names) or "" in names:
            raise ValueError(f"a header row has a blank or repeated name: {header}")
        kinds = StructType([StructField(wanted[n].name if n in wanted else c, wanted[n].dataType if n in wanted else StringType()) for n, c in zip(names, header, strict=True)])
        if schema is None and infer_schema:
            kinds = _configured(spark, {**settings, "inferSchema": "true"}).csv([unquote(f) for f in by_header[header]]).schema
        if "columnNameOfCorruptRecord" in settings:
            kinds = kinds.add(StructField(settings["columnNameOfCorruptRecord"], StringType()))
        feed = _configured(spark, settings).schema(kinds).csv(path)
        mine = feed.filter(F.col("_metadata.file_path").isin(by_header[header])) if len(by_header) > 1 else feed  # prunes the listing
        if schema is not None:
            there = {fold(c) for c in feed.columns}
            folders = [c for c in feed.columns if c not in kinds.names]
            mine = mine.select(*[F.col(f.name) if n in there else F.lit(None).cast(f.dataType).alias(f.name) for n, f in wanted.items()], *[c for c in folders if fold(c) not in wanted])
        feeds.append(mine)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), feeds)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
    recursive: bool = False,
    glob: str | None = None,
    missing_tokens: Iterable[str] | None = None,
    by_name: bool = True,
    rejects: bool = False,
    **options: str,
) -> DataFrame:
    """CSV folder or files with a header row.

    Give ``schema`` in production: inference costs an extra pass over the data
    and changes types between runs (``007`` becomes 7; one bad date turns a
    date column into text). Without a schema and without ``infer_schema``
    every column is text.

    Columns are matched by their names in each file's header row, so files may
    have them in another order, lack some (null) or, under a ``schema``, have
    others (left out). Spark itself matches by position and would read such a
    file's cells into the wrong columns. The header rows are read in a pass of
    their own over the text; ``by_name=False`` spares it for folders known to
    come from one writer. A header that shares no name with the schema renames
    by position.

    ``recursive`` walks every nested folder (``recursiveFileLookup``); a
    ``**`` glob in the path does not reach all depths. ``glob`` filters file
    names (``pathGlobFilter``, e.g. ``*.csv``). ``missing_tokens`` turns text
    cells such as ``NA`` or ``null`` into nulls before any cast.

    With ``rejects`` a column ``_rejected`` holds the text of every line that has
    too many or too few cells, or one that is not of its type; else it is null.
    """
    settings = {"header": str(header).lower(), **options}
    if rejects:
        if schema is None and not (header and by_name):
            raise ValueError("rejected lines need a schema or header rows")
        settings |= {"columnNameOfCorruptRecord": REJECTED, "mode": "PERMISSIVE"}
    if recursive:
        settings["recursiveFileLookup"] = "true"
    if glob:
        settings["pathGlobFilter"] = glob
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if rejects and schema is not None:
        schema = StructType([*schema.fields, StructField(REJECTED, StringType())])
    headers = _headers(spark, path, settings) if header and by_name else []
    if _by_position(spark, headers, schema, settings):
        reader = _configured(spark, settings)
        if schema is not None:
            reader = reader.schema(schema)
        elif infer_schema:
            reader = reader.option("inferSchema", "true")
        return _normalise_tokens(reader.csv(path), missing_tokens)
    return _normalise_tokens(_read_by_name(spark, path, schema, infer_schema, settings), missing_tokens)


def _by_position(spark: SparkSession, headers: list[tuple[str, ...]], schema: StructType | None, settings: dict[str, str]) -> bool:
    """Whether positions and names agree in all files, or no name is known."""
    if not headers:
        return True
    if schema is None:
        return len(headers) < 2 and "columnNameOfCorruptRecord" not in settings
    fold = str if spark.conf.get("spark.sql.caseSensitive", "false") == "true" else str.lower
    names = [fold(n) for n in schema.names if n != settings.get("columnNameOfCorruptRecord")]
    found = [[fold(c) for c in h] for h in headers]
    return all(h == names[: len(h)] and len(h) == len(names) for h in found) or not any(set(h) & set(names) for h in found)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    multi_line: bool = True,
    rejects: bool = False,
    **options: str,
) -> DataFrame:
    """JSON records. ``multi_line=True`` reads files holding one top-level
    array of records (or pretty-printed objects); ``False`` reads line
    -delimited JSON, which splits across tasks inside a file.

    A record that is no JSON, or has a value that is not of its type, reads as
    nulls. With ``rejects`` its text stands in a column ``_rejected``, null for
    all others; of a damaged multi-line file that is the whole file."""
    settings = {"multiLine": str(multi_line).lower(), **options}
    if rejects:
        settings |= {"columnNameOfCorruptRecord": REJECTED, "mode": "PERMISSIVE"}
    reader = _configured(spark, settings)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields, StructField(REJECTED, StringType())]) if rejects else schema)
    df = reader.json(path)
    if len(df.columns) == 1 and df.columns[0] in ("_corrupt_record", REJECTED):
        raise ValueError(f"no JSON records could be parsed from {path!r} (multi_line={multi_line})")
    return df if not rejects or REJECTED in df.columns else df.withColumn(REJECTED, F.lit(None).cast("string"))


def split_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that were read whole, without the column ``_rejected``, and the
    others with it. Give it a written copy: both are read from it."""
    bad = F.col(REJECTED).isNotNull()
    return df.filter(~bad).drop(REJECTED), df.filter(bad)
