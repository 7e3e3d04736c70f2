"""Source registry: a list of feed specs read into one lazy union.

Each spec becomes one lazy scan tagged with its country; the union is a
single plan, so Spark runs all scans as tasks of one job instead of one
source after another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabsmith.functions import PANDAS_NA_TOKENS
from tabsmith.operators.enrich import tag, union_all
from tabsmith.session import scratch_path
from tabsmith.sources.files import REJECTED, read_csv, read_json, split_rejected
from tabsmith.sources.jdbc import read_jdbc
from tabsmith.sources.xlsx import read_xlsx

DB_KINDS = ("mysql", "postgres", "mssql", "jdbc", "derby")


@dataclass(frozen=True)
class SourceSpec:
    """One feed. ``location`` is a path for files, a JDBC URL for databases.
    ``country`` tags every row; leave it ``None`` for a feed that carries its
    own country column (e.g. a folder partitioned by ``Country=...``)."""

    kind: str
    location: str
    country: str | None = None
    table: str | None = None
    options: Mapping[str, object] = field(default_factory=dict)


def read_source(spark: SparkSession, spec: SourceSpec, tag_column: str = "Country", rejects: bool = False) -> DataFrame:
    """One feed; with ``rejects`` it has the column ``_rejected`` of damaged
    records (always null for spreadsheets and databases)."""
    kind = spec.kind.lower()
    opts = dict(spec.options)
    if rejects and kind in ("csv", "json"):
        opts["rejects"] = True
    if kind == "csv":
        # feeds were read with pandas' defaults: its missing-value tokens are nulls
        opts.setdefault("missing_tokens", PANDAS_NA_TOKENS)
        df = read_csv(spark, spec.location, **opts)
    elif kind == "json":
        df = read_json(spark, spec.location, **opts)
    elif kind == "xlsx":
        opts.setdefault("missing_tokens", PANDAS_NA_TOKENS)
        df = read_xlsx(spark, spec.location, **opts)
    elif kind in DB_KINDS:
        if not spec.table:
            raise ValueError(f"{kind} source needs a table name")
        df = read_jdbc(spark, spec.location, spec.table, kind=kind, **opts)
    else:
        raise ValueError(f"Unsupported source kind: {spec.kind}")
    if rejects and REJECTED not in df.columns:
        df = df.withColumn(REJECTED, F.lit(None).cast("string"))
    return tag(df, tag_column, spec.country) if tag_column and spec.country is not None else df


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns that ``schema`` names, cast to its types; a value that does
    not parse is missing. Other columns stay as they are."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return df.select([F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def unread_cells(df: DataFrame, schema: StructType) -> Column:
    """``name=text; ...`` of a row's cells that are there but not of the type
    that ``schema`` has for them; null where all are."""
    kinds = {f.name: f.dataType for f in schema.fields}
    bad = [
        F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") & F.col(c).try_cast(kinds[c]).isNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string")))
        for c in df.columns
        if c in kinds
    ]
    return F.nullif(F.concat_ws("; ", *bad), F.lit("")) if bad else F.lit(None).cast("string")


def load_sources(
    spark: SparkSession, specs: Sequence[SourceSpec], tag_column: str = "Country", schema: StructType | None = None, rejects: bool = False
) -> DataFrame:
    """Union by column name of every source; a column missing from a feed is null.

    Feeds type the same column differently (CSV and spreadsheet cells are text,
    JSON and databases have numbers). With ``schema`` each feed's columns are
    cast to the common types before the union, so the result does not depend
    on how a union would reconcile them.

    With ``rejects`` no damaged record passes for a row with missing values: the
    column ``_rejected`` holds its text, or the cells that are not of the type in
    ``schema``, and ``_feed`` the location it came from (see :func:`stage_sources`).
    """
    if not specs:
        raise ValueError("no sources given")
    feeds = []
    for spec in specs:
        feed = read_source(spark, spec, tag_column, rejects)
        if rejects and schema is not None:
            feed = feed.withColumn(REJECTED, F.coalesce(REJECTED, unread_cells(feed, schema)))
        if rejects:
            feed = feed.withColumn("_feed", F.lit(spec.location))
        feeds.append(typed(feed, schema) if schema is not None else feed)
    return union_all(feeds)


def stage_sources(
    spark: SparkSession, specs: Sequence[SourceSpec], tag_column: str = "Country", schema: StructType | None = None,
    rejects_path: str | None = None, max_rejects: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The feeds read once into a staging folder: (rows, rejected records).

    Records are counted on the way. Rejected ones are added to the table at
    ``rejects_path``, if given, with their feed and text; more than
    ``max_rejects`` of them raise after that, so a load stops with the damage on
    record. No record is lost: rows and rejected records are all that was read.
    """
    seen = Observation()
    staging = scratch_path(spark, "feeds")
    combined = load_sources(spark, specs, tag_column, schema, rejects=True)
    combined.observe(seen, F.count(F.lit(1)).alias("records"), F.count(REJECTED).alias("rejected")).write.parquet(staging)
    rows, rejected = split_rejected(spark.read.schema(combined.schema).parquet(staging))
    if rejects_path is not None and seen.get["rejected"]:
        rejected.select("_feed", REJECTED).write.mode("append").parquet(rejects_path)
    if max_rejects is not None and seen.get["rejected"] > max_rejects:
        raise ValueError(f"{seen.get['rejected']} of {seen.get['records']} records were rejected, more than {max_rejects}")
    return rows.drop("_feed"), rejected
