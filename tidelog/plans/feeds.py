"""Change feeds derived from the test tables, in Spark and as common table expressions of SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = 1_000_000_000


class Tables:
    """The parquet tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- feeds

    def feed(self) -> DataFrame:
        """Two mutations of each order: clocks that rise, fall or tie, versions, deletes."""
        pk, k = F.col("pk"), F.col("k")
        o = self("orders").select(F.col("o_orderkey").alias("pk"), "o_orderstatus", "o_totalprice", "o_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
        return o.select(
            F.lit("orders").alias("tbl"),
            F.concat(F.lit("["), pk.cast("string"), F.lit("]")).alias("key"),
            "pk",
            (pk * 2 + k).alias("seq"),
            (F.lit(BASE) + (pk % 97) * 1000 + k * (pk % 3 - 1)).alias("nanos"),
            ((pk + k) % 2).cast("int").alias("logical"),
            (pk % 10 + k * (pk % 4)).alias("ver"),
            F.when(k == 1, F.concat(F.lit("n"), "o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("status"),
            (F.col("o_totalprice") + k).alias("price"),
            (F.lit(BASE) + (pk % 50) * 60).alias("ts"),
            ((pk % 11 == 0) & (k == 1)).alias("is_delete"),
        )

    def target(self) -> DataFrame:
        """Rows that exist already: two thirds of the orders, in older versions."""
        pk = F.col("o_orderkey")
        return self("orders").where(pk % 3 != 0).select(pk.alias("pk"), (pk % 7).alias("ver"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), (F.lit(BASE) + (pk % 40) * 60).alias("ts"))

    def staged(self) -> DataFrame:
        """Half of the feed, staged."""
        return self.feed().where("seq % 4 < 2").select("tbl", "key", "nanos", "logical", "seq", "ver", "status")

    def applied(self) -> DataFrame:
        return self.staged().where("ver % 3 = 0").select("tbl", "key", "nanos", "logical").distinct()

    def checkpoints(self) -> DataFrame:
        """Checkpoints of five partitions of three groups, from the customers."""
        c = F.col("c_custkey")
        return self("customer").select(
            F.concat(F.lit("g"), (c % 3).cast("string")).alias("grp"),
            F.concat(F.lit("p"), (F.floor(c / 3) % 5).cast("string")).alias("part"),
            (c * 10).alias("nanos"),
            (c % 2).cast("int").alias("logical"),
            ((c < 60) & (c % 17 != 0) | (c % 29 == 0)).alias("applied"),
        )

    def messages(self) -> DataFrame:
        """A message queue of three partitions: every seventh message is a resolved one."""
        e = F.col("event_id")
        clock = F.concat((F.lit(BASE) + F.floor(e / 3) * 10).cast("string"), F.lit(".0000000000"))
        value = F.when(F.floor(e / 3) % 7 == 6, F.concat(F.lit('{"resolved":"'), clock, F.lit('"}'))).when(e % 5 == 0, F.concat(F.lit('{"before":{"id":'), e.cast("string"), F.lit('},"updated":"'), clock, F.lit('"}'))).otherwise(F.concat(F.lit('{"after":{"id":'), e.cast("string"), F.lit(',"type":"'), "event_type", F.lit('"},"updated":"'), clock, F.lit('"}')))
        return self("events").select(F.lit("events").alias("topic"), (e % 3).cast("int").alias("part"), F.floor(e / 3).cast("long").alias("offset"), F.concat(F.lit("["), e.cast("string"), F.lit("]")).alias("key"), value.alias("value"))


#: The same in SQL for DuckDB. Names of expressions match the columns above.
CTES = {
    "feed": f"""feed AS (SELECT 'orders' AS tbl, '[' || o_orderkey || ']' AS key, o_orderkey AS pk, o_orderkey * 2 + k AS seq,
        {BASE} + (o_orderkey % 97) * 1000 + k * (o_orderkey % 3 - 1) AS nanos, CAST((o_orderkey + k) % 2 AS INTEGER) AS logical,
        o_orderkey % 10 + k * (o_orderkey % 4) AS ver, CASE WHEN k = 1 THEN 'n' || o_orderstatus ELSE o_orderstatus END AS status,
        o_totalprice + k AS price, {BASE} + (o_orderkey % 50) * 60 AS ts, o_orderkey % 11 = 0 AND k = 1 AS is_delete
        FROM orders, (VALUES (0), (1)) AS twice(k))""",
    "latest": "latest AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY tbl, key ORDER BY nanos DESC, logical DESC, seq DESC) = 1)",
    "target": f"target AS (SELECT o_orderkey AS pk, o_orderkey % 7 AS ver, o_orderstatus AS status, o_totalprice AS price, {BASE} + (o_orderkey % 40) * 60 AS ts FROM orders WHERE o_orderkey % 3 <> 0)",
    "staged": "staged AS (SELECT tbl, key, nanos, logical, seq, ver, status FROM feed WHERE seq % 4 < 2)",
    "applied": "applied AS (SELECT DISTINCT tbl, key, nanos, logical FROM staged WHERE ver % 3 = 0)",
    "checkpoints": "checkpoints AS (SELECT 'g' || (c_custkey % 3) AS grp, 'p' || (c_custkey // 3 % 5) AS part, c_custkey * 10 AS nanos, CAST(c_custkey % 2 AS INTEGER) AS logical, (c_custkey < 60 AND c_custkey % 17 <> 0) OR c_custkey % 29 = 0 AS applied FROM customer)",
    "messages": f"""messages AS (SELECT CAST(event_id % 3 AS INTEGER) AS part, event_id // 3 AS "offset", event_id, event_type, event_id // 3 % 7 = 6 AS is_resolved,
        event_id % 5 = 0 AS is_delete, {BASE} + event_id // 3 * 10 AS nanos FROM events)""",
}


def sql(body: str, *names: str) -> str:
    """body after the named common table expressions."""
    return ("WITH " + ",\n".join(CTES[n] for n in names) + "\n" if names else "") + body


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None, *names: str):
    """Registers a function of Tables under its name, with SQL for the same rows."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if oracle:
            ORACLES[f.__name__] = sql(oracle, *names)
        return f

    return register
