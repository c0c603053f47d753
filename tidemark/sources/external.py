"""Tables that live outside the session: other databases, CSV files, columnar files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """The declared columns do not match the external table."""


@dataclass(frozen=True)
class Source:
    """Where tables come from.

    A database source has ``format="jdbc"`` and its URL, driver and credentials in ``options``. A
    file source has a file format, and ``location`` is a path with ``{table}`` in it.
    """

    name: str
    format: str
    location: str = ""
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Split:
    """How to read a database table in parallel: value ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    parts: int


def jdbc_options(source: Source, table: str, schema: T.StructType, split: Split | None) -> dict[str, str]:
    """Reader options of one database table; ``split`` sets the number of parallel queries."""
    options = {
        "fetchsize": "10000",
        **source.options,
        "url": source.location,
        "dbtable": table,
        "customSchema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields),
    }
    if split is not None:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.parts),
        )
    return options


def check_columns(found: T.StructType, declared: T.StructType, table: str) -> None:
    """Every declared column must exist with the declared type."""
    types = {f.name: f.dataType for f in found.fields}
    for column in declared.fields:
        if column.name not in types:
            raise SchemaMismatch(f"{table} has no column {column.name}")
        if types[column.name] != column.dataType:
            raise SchemaMismatch(
                f"{table}.{column.name} is {types[column.name].simpleString()}, "
                f"declared {column.dataType.simpleString()}"
            )


def read_table(
    spark: SparkSession, source: Source, table: str, schema: str | T.StructType, split: Split | None = None
) -> DataFrame:
    """Bind ``table`` of ``source`` with a declared column list, checked when it is bound.

    Filters and column lists of later steps reach the database or the files through Spark's own
    pushdown; only the declared columns are ever read.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if source.format == "jdbc":
        reader = spark.read.format("jdbc").options(**jdbc_options(source, table, declared, split))
        df = reader.load()
    elif source.format == "csv":
        return read_csv(spark, source.location.format(table=table), declared, dict(source.options))
    else:
        df = spark.read.format(source.format).options(**source.options).load(source.location.format(table=table))
    check_columns(df.schema, declared, f"{source.name}.{table}")
    return df.select(*declared.names)


def write_table(df: DataFrame, source: Source, table: str, mode: str = "append") -> None:
    """Write rows to an external table, one connection or file per partition."""
    if source.format == "jdbc":
        options = {**source.options, "url": source.location, "dbtable": table}
        df.write.format("jdbc").options(**options).mode(mode).save()
    else:
        df.write.format(source.format).options(**source.options).mode(mode).save(
            source.location.format(table=table)
        )


def source_schema(spark: SparkSession, source: Source, table: str) -> T.StructType:
    """The columns and types that the source itself has for a table."""
    reader = spark.read.format(source.format).options(**source.options)
    if source.format == "jdbc":
        return reader.options(url=source.location, dbtable=table).load().schema
    if source.format == "csv":
        reader = reader.options(header="true", inferSchema="true")
    return reader.load(source.location.format(table=table)).schema


def import_tables(
    spark: SparkSession, source: Source, schemas: Mapping[str, str] | None, only: Iterable[str], into: str
) -> dict[str, DataFrame]:
    """Bind the named tables of a source as temp views ``<into>__<table>``.

    Columns and types are the source's own, unless ``schemas`` declares them; a declared list is checked against the source.
    """
    wanted = list(only)
    missing = [t for t in wanted if schemas is not None and t not in schemas]
    if missing:
        raise SchemaMismatch(f"{source.name} declares no table {missing[0]}")
    imported = {}
    for table in wanted:
        declared = source_schema(spark, source, table) if schemas is None else schemas[table]
        df = read_table(spark, source, table, declared)
        df.createOrReplaceTempView(f"{into}__{table}")
        imported[table] = df
    return imported


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, options: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV with a header line. The header must name the declared columns; a bad value is an error."""
    settings = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST", **(options or {})}
    return spark.read.schema(schema).options(**settings).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", "true").csv(path)
