"""Reference tables and the episode history in a database: Derby in memory stands in for one."""

import uuid

import pytest
from pyspark.sql import functions as F

from quaybook.operators import monitor
from quaybook.sources import database, reference

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
TURNS = "topic string, since long, recovered long, duration long"


@pytest.fixture(scope="module")
def url(spark):
    spark._jvm.java.lang.Class.forName(DRIVER["driver"])
    found = f"jdbc:derby:memory:q{uuid.uuid4().hex};create=true"
    database.run(spark, found, "CREATE TABLE exchange_markets (id INT, exchange_id INT, market VARCHAR(20), market_id INT, status VARCHAR(20), price_amount_rebase INT, volume_amount_rebase INT)", f"CREATE TABLE episodes ({database.EPISODES})")
    for i in range(40):
        database.run(spark, found, f"INSERT INTO exchange_markets VALUES ({i}, {i % 4}, 'M{i}', {i % 10}, 'subscribe', {'NULL' if i == 7 else -1}, 2)")
    return found


def test_filters_and_columns_reach_the_database(spark, url):
    rows = reference.jdbc(spark, url, "exchange_markets", **DRIVER).where("EXCHANGE_ID = 3 AND ID > 20").select("MARKET")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(EXCHANGE_ID,3)" in plan
    assert "GreaterThan(ID,20)" in plan
    assert "ReadSchema: struct<MARKET:string>" in plan
    assert sorted(r.MARKET for r in rows.collect()) == ["M23", "M27", "M31", "M35", "M39"]


def test_reads_in_parts(spark, url):
    rows = database.in_parts(spark, url, "exchange_markets", "ID", 4, **DRIVER)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4
    assert sum(sizes) == 40
    lower = rows.toDF(*(c.lower() for c in rows.columns))
    assert reference.pair_lookup(lower).count() == 40
    database.run(spark, url, "CREATE TABLE nothing (ID INT)")
    assert database.in_parts(spark, url, "nothing", "ID", 4, **DRIVER).isEmpty()


def test_statements_hold_together(spark, url):
    with pytest.raises(Exception, match="(?i)syntax"):
        database.run(spark, url, "INSERT INTO episodes VALUES ('half', 1, NULL, NULL)", "NOT SQL")
    assert reference.jdbc(spark, url, "episodes", **DRIVER).where("TOPIC = 'half'").isEmpty()


def test_replayed_episodes(spark, url):
    """Three runs, each recorded twice: what is stored is what recorded() gives, with one open episode a topic."""
    runs = [[("a", 1, None, None), ("b", 2, 5, 3)], [("a", 1, 9, 8), ("a", 12, None, None), ("b", 2, 7, 5)], [("a", 12, 20, 8), ("c", 4, None, None), ("c", 6, None, None)]]
    want = spark.createDataFrame([], TURNS)
    for turns in runs:
        df = spark.createDataFrame(turns, TURNS)
        for _ in range(2):
            database.record_episodes(df, url, **DRIVER)
        want = monitor.recorded(want, df)
    got = sorted(map(tuple, reference.jdbc(spark, url, "episodes", **DRIVER).collect()), key=lambda r: r[:2])
    assert got == [("a", 1, 9, 8), ("a", 12, 20, 8), ("b", 2, 5, 3), ("c", 6, None, None)]
    assert [r for r in sorted(map(tuple, want.collect()), key=lambda r: r[:2]) if r[:2] != ("c", 4)] == got
    assert max(r.n for r in reference.jdbc(spark, url, "episodes", **DRIVER).where("RECOVERED IS NULL").groupBy("TOPIC").agg(F.count("*").alias("n")).collect()) == 1
    database.record_episodes(spark.createDataFrame([], TURNS), url, **DRIVER)
    assert reference.jdbc(spark, url, "episodes", **DRIVER).count() == 4
