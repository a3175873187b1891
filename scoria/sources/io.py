"""Sources and sinks (inventory 2.1, S1-S12).

Reads go through ``spark.read`` / ``spark.table`` so Catalyst can push
filters and prune columns into the scan.  A partitioned write replaces
either the partitions present in the new data (a re-run of one period) or
the whole table (a copy of a source), as the caller says; neither changes
a setting of the session.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = [
    "read_table", "read_tables", "jdbc_options", "read_jdbc", "write_partitioned",
    "write_table", "read_csv", "write_csv", "read_list", "read_json_dict",
    "in_list", "transfer", "TABLES",
]

# Driver-provided tables (one parquet file each).
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, name: str, root: str | None = None,
               columns: Sequence[str] | None = None, refresh: bool = False) -> DataFrame:
    """Catalog table by name, or ``<root>/<name>.parquet``.

    ``refresh`` invalidates cached file listings first (``refresh table``).
    """
    if root is None:
        if refresh:
            spark.catalog.refreshTable(name)
        df = spark.table(name)
    else:
        path = f"{root.rstrip('/')}/{name}.parquet"
        if refresh:
            spark.catalog.refreshByPath(path)
        df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_tables(spark: SparkSession, root: str, names: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    return {n: read_table(spark, n, root) for n in names}


def jdbc_options(url: str, table: str | None = None, columns: Sequence[str] | None = None,
                 query: str | None = None, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetchsize: int = 10000,
                 **extra) -> dict[str, str]:
    """Option map for a parallel RDBMS read.

    Either ``table`` (+ optional column list, rendered as a pushed-down
    SELECT) or a full ``query`` (e.g. a join run in the database).  A
    partition column with bounds splits the read into ``num_partitions``
    range queries so no single task pulls the whole table.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if query is None:
        cols = ", ".join(columns) if columns else "*"
        query = f"SELECT {cols} FROM {table}"
    if partition_column:
        # partitionColumn needs dbtable, so the query becomes a derived table
        opts["dbtable"] = f"({query}) q"
        if None in (lower, upper, num_partitions):
            raise ValueError("partition_column needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    else:
        opts["query"] = query
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()


def write_partitioned(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None,
                      mode: str = "overwrite", fmt: str = "parquet", table: str | None = None,
                      replace: str = "partitions") -> None:
    """Partitioned sink; ``append`` adds, ``overwrite`` replaces.

    ``replace="partitions"`` (U2) touches only partition values present in
    ``df``; ``replace="table"`` (S8) leaves nothing of the old table.  Rows
    are rebalanced by the partition columns: adaptive execution joins small
    partition values and splits a hot one by its measured size, so one big
    day becomes as many tasks and files as its bytes ask for.
    """
    if replace not in ("partitions", "table"):
        raise ValueError("replace must be 'partitions' or 'table'")
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if by:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    w = df.write.mode(mode).format(fmt).option(
        "partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    if by:
        w = w.partitionBy(*by)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Unpartitioned replace."""
    df.write.mode(mode).format(fmt).save(path)


def read_csv(spark: SparkSession, path: str, schema=None, sep: str = ",") -> DataFrame:
    """CSV with header; explicit schema when given (no inference pass)."""
    r = spark.read.option("header", True).option("sep", sep)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV export with header.  ``single_file`` funnels through one task —
    only for small, bounded outputs such as reports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def read_list(spark: SparkSession, path: str, column: str = "value") -> DataFrame | None:
    """One value per line; a missing file means "no filter" (None)."""
    try:
        df = spark.read.text(path)
        df.schema  # forces path resolution
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return df.select(F.trim("value").alias(column)).where(F.col(column) != "").distinct()


def read_json_dict(spark: SparkSession, path: str, key: str = "code", value: str = "name") -> DataFrame:
    """JSON object ``{code: name}`` as a two-column table of strings.

    Keys may hold any character and values may differ in type; a nested value is given as its JSON
    text.  A file is one object, read whole by one task; something else gives no rows."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return raw.select(F.explode("m").alias(key, value))


def in_list(df: DataFrame, column: str, values: DataFrame | Sequence | None,
            value_col: str = "value") -> DataFrame:
    """Keep rows whose column is in a list.

    A list of literals becomes ``isin`` (a hash set); a list held in a table becomes a
    left-semi join (Catalyst broadcasts it when its estimated size is under
    the broadcast threshold, else shuffles — no unchecked broadcast).
    ``None`` means no filter.
    """
    if values is None:
        return df
    if isinstance(values, DataFrame):
        lst = values.select(F.col(value_col).alias("__v")).distinct()
        return df.join(lst, df[column] == lst["__v"], "left_semi")
    return df.where(F.col(column).isin(list(values)))


def transfer(spark: SparkSession, source: Mapping | DataFrame, path: str,
             partition_by: str | Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Copy a source (JDBC option map or DataFrame) into a table folder; ``overwrite`` replaces the table."""
    df = source if isinstance(source, DataFrame) else spark.read.format("jdbc").options(**source).load()
    write_partitioned(df, path, partition_by, mode, replace="table")


def dumps(obj) -> str:
    return json.dumps(obj, ensure_ascii=False, sort_keys=True)
