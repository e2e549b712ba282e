"""The reference database and the episode history over JDBC: reads in parts, and an upsert that may be made again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.sources.reference import jdbc

EPISODES = "topic VARCHAR(255) NOT NULL, since BIGINT NOT NULL, recovered BIGINT, duration BIGINT, PRIMARY KEY (topic, since)"


def in_parts(spark: SparkSession, url: str, table: str, column: str, parts: int, **options: str) -> DataFrame:
    """A table in `parts` ranges of a numeric column, each a query of its own; the database itself tells the ends of the ranges."""
    ends = jdbc(spark, url, f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) ends", **options).first()
    low, high = ends if ends and ends[0] is not None else (0, 0)
    return jdbc(spark, url, table, partitionColumn=column, lowerBound=str(low), upperBound=str(high + 1), numPartitions=str(parts), **options)


def run(spark: SparkSession, url: str, *statements: str) -> list[int]:
    """SQL statements in one transaction, from the driver; the rows that each has changed. None of them holds if one fails."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        changed = [statement.executeUpdate(s) for s in statements]
        connection.commit()
        return changed
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def record_episodes(turns: DataFrame, url: str, table: str = "episodes", **options: str) -> None:
    """monitor.recorded() in the database: upsert turns (topic, since, recovered, duration) into `table`.

    Executors write the turns to a table beside it, then one transaction ends the episodes that are known
    and open, and adds those that aren't known. An end that is known stays, and a topic has one open
    episode at most, so a micro-batch that comes again changes nothing.
    """
    staged = f"{table}_staged"
    rows = turns.groupBy("topic", "since").agg(F.min("recovered").alias("recovered"), F.min("duration").alias("duration"))
    rows.write.format("jdbc").options(url=url, dbtable=staged, createTableColumnTypes="topic VARCHAR(255)", **options).mode("overwrite").save()
    of = '"topic", "since", "recovered", "duration"'  # Spark quotes the columns of a table that it makes
    newest = f'SELECT max(n."since") FROM {staged} n WHERE n."topic" = s."topic" AND n."recovered" IS NULL'
    run(
        turns.sparkSession, url,
        f"""UPDATE {table} SET recovered = (SELECT s."recovered" FROM {staged} s WHERE s."topic" = {table}.topic AND s."since" = {table}.since), duration = (SELECT s."duration" FROM {staged} s WHERE s."topic" = {table}.topic AND s."since" = {table}.since)
            WHERE recovered IS NULL AND EXISTS (SELECT 1 FROM {staged} s WHERE s."topic" = {table}.topic AND s."since" = {table}.since AND s."recovered" IS NOT NULL)""",
        f"""INSERT INTO {table} (topic, since, recovered, duration) SELECT {of} FROM {staged} s
            WHERE NOT EXISTS (SELECT 1 FROM {table} e WHERE e.topic = s."topic" AND e.since = s."since")
            AND (s."recovered" IS NOT NULL OR (s."since" = ({newest}) AND NOT EXISTS (SELECT 1 FROM {table} e WHERE e.topic = s."topic" AND e.recovered IS NULL)))""",
    )
