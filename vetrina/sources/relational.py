"""Tables of a relational database: read in ranges of a column by many connections at once, and written in batches.

Filters and the choice of columns go to the database with each range's query; Spark pushes further ones that
follow. The ranges' number comes from the table's size, up to the connections that the database may be
asked for. The connection's secrets are options of the caller and are never shown.
"""

from __future__ import annotations

import datetime
import decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a range, connections at once, and rows of a round trip.
RANGE_ROWS, CONNECTIONS, FETCH = 1_000_000, 32, 10_000


def quoted(name: str) -> str:
    """A column's name in the database's SQL."""
    return '"' + name.replace('"', '""') + '"'


def read(spark: SparkSession, url: str, table: str, by: str | None = None, columns: list[str] | None = None, where: str | None = None,
         range_rows: int = RANGE_ROWS, connections: int = CONNECTIONS, **options: str) -> DataFrame:
    """The rows of a table that where (SQL of the database) leaves; by is a numeric, date or time column, indexed at best.

    Without by, or where the table has few rows, one connection reads all. Rows whose by is null are in the first range.
    """
    source = spark.read.format("jdbc").options(url=url, fetchsize=str(FETCH), **options)
    inner = f"(select {', '.join(map(quoted, columns)) if columns else '*'} from {table}{f' where {where}' if where else ''}) t"
    if by is None:
        return source.option("dbtable", inner).load()
    sizes = f"(select min({quoted(by)}) as low, max({quoted(by)}) as high, count(*) as n from {table}{f' where {where}' if where else ''}) s"
    first = source.option("dbtable", sizes).load().toDF("low", "high", "n").first()  # one row, counted by the database
    parts = min(connections, -(-first["n"] // range_rows))
    if parts < 2 or first["low"] is None:
        return source.option("dbtable", inner).load()
    return source.options(dbtable=inner, partitionColumn=by, lowerBound=_bound(first["low"]), upperBound=_bound(first["high"]), numPartitions=str(parts)).load()


def _bound(value: object) -> str:
    """A bound as Spark reads it: Spark splits whole numbers, dates and times, and outer ranges are open."""
    if isinstance(value, (float, decimal.Decimal)):
        return str(int(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def write(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = CONNECTIONS, **options: str) -> None:
    """Writes rows in batches by so many connections at most; overwriting keeps the table's definition, and each task's rows are one transaction."""
    df.coalesce(connections).write.format("jdbc").options(url=url, dbtable=table, batchsize=str(FETCH), truncate="true", **options).mode(mode).save()


def upsert_from_stage(spark: SparkSession, df: DataFrame, url: str, table: str, key: list[str], update: bool = False, connections: int = CONNECTIONS, **options: str) -> None:
    """Merges rows into a table by its key in one statement of the database: absent keys are inserted, present ones kept or updated.

    Rows are written to a staging table first, so a lost task or a rerun leaves the target as it was or as it should be. One row a
    key is taken, the least by its columns.
    """
    stage, rest = f"{table}_stage", [c for c in df.columns if c not in key]
    one = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("x")).select(*key, "x.*") if rest else df.distinct()
    write(one, url, stage, "overwrite", connections, **options)
    on = " and ".join(f"t.{quoted(c)} = s.{quoted(c)}" for c in key)
    merge = (f"merge into {table} t using {stage} s on {on}"
             + (f" when matched then update set {', '.join(f'{quoted(c)} = s.{quoted(c)}' for c in rest)}" if update and rest else "")
             + f" when not matched then insert ({', '.join(map(quoted, df.columns))}) values ({', '.join(f's.{quoted(c)}' for c in df.columns)})")
    execute(spark, url, [merge, f"drop table {stage}"], **options)


def execute(spark: SparkSession, url: str, statements: list[str], **options: str) -> None:
    """Runs statements on the driver in one transaction."""
    jvm, properties = spark._jvm, spark._jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, v)
    if "driver" in options:
        spark._jvm.org.apache.spark.util.Utils.classForName(options["driver"], True, False)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        for s in statements:
            statement = connection.createStatement()
            statement.execute(s)
            statement.close()
        connection.commit()
    finally:
        connection.rollback()
        connection.close()
