"""Sinks: CSV folder overwrite, schema conformance and table load, preview."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from tabsmith.session import remove_path, scratch_path

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def _qualified(df: DataFrame, path: str) -> tuple[str, str, str]:
    """``(scheme, authority, path)`` of ``path`` qualified against the default
    file system, so ``/x``, ``file:/x`` and ``file:///x`` compare equal."""
    spark = df.sparkSession
    if not hasattr(spark, "_jvm"):  # Spark Connect: only the server knows the default file system
        if not urlsplit(path).scheme:
            raise ValueError(f"give {path} with its scheme, so that it can be compared with the inputs")
        return _split(path)
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return _split(fs.makeQualified(hpath).toString())


def _split(uri: str) -> tuple[str, str, str]:
    parts = urlsplit(uri)
    return parts.scheme, parts.netloc, parts.path.rstrip("/") or "/"


def input_roots(df: DataFrame) -> list[str]:
    """The folders (or files) that the plan's file relations were given, not
    the files in them: a handful for any size of data. Under Spark Connect the
    plan is not at hand and the listed files stand in."""
    if not hasattr(df, "_jdf"):
        return df.inputFiles()
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots: list[str] = []
    for at in range(leaves.size()):
        leaf = leaves.apply(at)
        relation = leaf.relation() if leaf.getClass().getSimpleName() == "LogicalRelation" else None
        if relation is not None and relation.getClass().getSimpleName() == "HadoopFsRelation":
            paths = relation.location().rootPaths()
            roots += [paths.apply(k).toString() for k in range(paths.size())]
    return roots


def refuse_overwriting_inputs(df: DataFrame, path: str) -> None:
    """Raise before writing when the plan reads from ``path``, from a folder
    within it, or from one that holds it.

    A path-based overwrite first deletes the target folder, then runs the
    plan; if the plan reads from that folder the input is lost and the job
    fails half-way. Checked on the driver from the plan (no job, no listing).
    """
    scheme, authority, target = _qualified(df, path)
    for root in input_roots(df):
        other_scheme, other_authority, other = _split(root)
        if (other_scheme, other_authority) == (scheme, authority) and f"{target}/".startswith(f"{other}/") | f"{other}/".startswith(f"{target}/"):
            raise ValueError(f"refusing to overwrite {path}: the DataFrame reads from it ({root})")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, **options: str) -> None:
    """Write a CSV folder (one file per partition), replacing what is there.

    Overwriting a folder the same plan reads from is refused up front (see
    :func:`refuse_overwriting_inputs`); Spark itself would delete the input
    first.
    """
    if mode == "overwrite":
        refuse_overwriting_inputs(df, path)
    writer = df.write.mode(mode).option("header", str(header).lower())
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.csv(path)


def _conform_column(name: str, target, source_type) -> Column:
    c = F.col(name)
    if isinstance(target, _INTEGRAL) and not isinstance(source_type, _INTEGRAL):
        # A plain cast would silently truncate 2.5 to 2; refuse instead. The
        # check is part of the write job itself (no extra pass).
        as_double = c.cast("double")
        c = F.when(
            as_double.isNotNull() & (as_double != F.floor(as_double)),
            F.raise_error(F.concat(F.lit(f"{name} is not whole: "), c.cast("string"))),
        ).otherwise(c)
    return c.cast(target).alias(name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns by name, in its order, cast to its types.

    Columns not in the schema are dropped; a schema column missing from
    ``df`` raises. A fractional value bound for an integer column raises.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the sink schema: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select([_conform_column(f.name, f.dataType, types[f.name]) for f in schema.fields])


def _location(spark: SparkSession, table: str) -> str | None:
    """The folder of a catalog table, if there is such a table yet."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _beside(target: str, name: str) -> str:
    """A path beside ``target`` that readers of its folder pass over."""
    folder, slash, leaf = target.rstrip("/").rpartition("/")
    return f"{folder}{slash}_{leaf}.{name}"


def _file_system(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def _recover(spark: SparkSession, target: str) -> None:
    """Finish what a lost driver left: a table moved aside goes, if the new one
    is in place, and comes back, if it is not."""
    aside, fs = _file_system(spark, _beside(target, "previous"))
    if fs.exists(aside):
        place, _ = _file_system(spark, target)
        if fs.exists(place):
            fs.delete(aside, True)
        elif not fs.rename(aside, place):
            raise OSError(f"{target} could not be brought back from {aside}")


def _publish(spark: SparkSession, staging: str, target: str) -> None:
    """Put a staged folder in the place of ``target``: two renames, between
    which the old table stands beside it, and comes back if the second fails."""
    staged, fs = _file_system(spark, staging)
    place, _ = _file_system(spark, target)
    aside, _ = _file_system(spark, _beside(target, "previous"))
    had = fs.exists(place)
    if had and not fs.rename(place, aside):
        raise OSError(f"{target} could not be moved aside")
    if not fs.rename(staged, place):
        if had:
            fs.rename(aside, place)
        raise OSError(f"{staging} could not be put in the place of {target}")
    if had:
        fs.delete(aside, True)


def load_table(
    df: DataFrame,
    table: str | None = None,
    path: str | None = None,
    schema: StructType | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    empty_message: str = "No data to load",
) -> DataFrame:
    """Replace a table (by name in the catalog, or a path) with ``df``.

    The frame is conformed to ``schema`` first, and computed once, with its rows
    counted on the way; an empty frame raises before the table is touched.
    Returns the conformed frame.

    A table at a ``path`` is written once: beside its place, in the wanted format
    and folders, and then renamed into it, so a failed load leaves the old table
    and a lost driver leaves one that the next load brings back (``_recover``).
    Where the store has renames of folders that is at once; a store that copies
    instead still never shows a half-written table. Loads in another ``mode``, of
    catalog tables or over Spark Connect are staged in the scratch area and
    written from there.
    """
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table or path")
    out = conform(df, schema) if schema is not None else df
    spark = out.sparkSession
    target = path if path is not None else _location(spark, table)
    if target is not None and mode == "overwrite":
        refuse_overwriting_inputs(out, target)
    in_place = path is not None and mode == "overwrite" and hasattr(spark, "_jvm")
    if in_place:
        _recover(spark, path)
    staging = _beside(path, f"staging-{uuid.uuid4().hex[:12]}") if in_place else scratch_path(spark, "load")
    seen = Observation()
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if in_place:
        writer = writer.format(fmt).partitionBy(*(partition_by or []))
    try:
        (writer if in_place else writer.format("parquet")).save(staging)
        if not seen.get["rows"]:
            raise ValueError(empty_message)
        if in_place:
            _publish(spark, staging, path)
            return out
        writer = spark.read.schema(out.schema).parquet(staging).write.mode(mode).format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if table is not None:
            writer.saveAsTable(table)
        else:
            writer.save(path)
    finally:
        remove_path(spark, staging)
    return out


def write_json_arrays(df: DataFrame, path: str, records: int, mode: str = "overwrite") -> None:
    """A folder of JSON files that each hold one array of at most ``records``
    records, as readers of whole documents want them. Null fields are left
    out."""
    if records < 1:
        raise ValueError("records must be >= 1")
    if mode == "overwrite":
        refuse_overwriting_inputs(df, path)
    numbered = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"), F.monotonically_increasing_id().alias("at"))
    arrays = numbered.groupBy(F.expr(f"at div {records}").alias("chunk")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("record")), F.lit("]")).alias("value"))
    arrays.select("value").write.mode(mode).option("maxRecordsPerFile", 1).text(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows (not ordered); a cheap look, not a report."""
    return df.limit(n)


__all__ = ["conform", "load_table", "preview", "refuse_overwriting_inputs", "write_csv", "write_json_arrays"]
