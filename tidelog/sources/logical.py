"""Decoded database logs: write-ahead-log events and binlog row events, landed as JSON.

Live wire protocols are out of scope; what they deliver, decoded, is a table of events in log order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.mapping import UNCHANGED


def wal_mutations(events: DataFrame, saved_lsn: int = 0) -> DataFrame:
    """Mutations of (lsn, xid, kind, tbl, key, data) events between begin and commit of each transaction.

    Transactions at or below the saved position are replays and go; a truncate is an error; a transaction that never
    commits isn't final. Rows without a key have their place in the log as one. All rows of a transaction have its commit's position as their clock.
    """
    commits = events.where("kind = 'commit'").select("xid", F.col("lsn").alias("commit_lsn"))
    bad = F.when(F.col("kind") == "truncate", F.raise_error(F.concat(F.lit("truncate of "), F.col("tbl"))).cast("string")).otherwise(F.col("kind"))
    rows = events.withColumn("kind", bad).where("kind IN ('insert', 'update', 'delete')").join(commits, "xid").where(F.col("commit_lsn") > saved_lsn)
    return rows.select("tbl", F.coalesce("key", F.concat(F.lit('["'), F.col("commit_lsn").cast("string"), F.lit("-"), F.col("lsn").cast("string"), F.lit('"]'))).alias("key"), F.when(F.col("kind") != "delete", F.col("data")).alias("data"), F.col("commit_lsn").alias("nanos"), F.lit(0).alias("logical"), F.col("lsn").alias("seq"), (F.col("kind") == "delete").alias("is_delete"))


def mark_unchanged(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that the source left out, being large and unchanged, get the mark that the sink fills."""
    return df.withColumns({c: F.when(F.array_contains("unchanged", c), F.lit(UNCHANGED)).otherwise(F.col(c)) for c in columns})


def binlog_mutations(events: DataFrame) -> DataFrame:
    """Mutations of (seq, kind, tbl, has_key, rows) events; rows of an update alternate before and after, of which the second counts. Tables without a key take inserts only."""
    checked = F.when(F.col("has_key") | (F.col("kind") == "insert"), F.col("rows")).otherwise(F.raise_error(F.concat(F.lit("no key: "), F.col("tbl"))).cast("array<string>"))
    rows = events.where("kind IN ('insert', 'update', 'delete')").select("seq", "kind", "tbl", F.posexplode(checked).alias("pos", "data"))
    return rows.where("kind <> 'update' OR pos % 2 = 1")


def gtid_intervals(sets: DataFrame, column: str = "gtid") -> DataFrame:
    """(server, low, high) of each interval of a text such as `server:1-5:7,server2:3`."""
    parts = F.explode(F.split(F.col(column), ","))
    rows = sets.select("*", parts.alias("__set")).select("*", F.split("__set", ":").alias("__bits"))
    rows = rows.select("*", F.trim(F.col("__bits")[0]).alias("server"), F.explode(F.slice("__bits", 2, 2**31 - 1)).alias("__span"))
    ends = F.split("__span", "-")
    return rows.select(*[c for c in sets.columns], "server", ends[0].cast("long").alias("low"), F.element_at(ends, -1).cast("long").alias("high"))


def _spans(gtid: Column, flavor: str) -> Column:
    """A set's spans (server, low, high), those of a server in order and as few as they can be."""
    sets = F.filter(F.split(F.regexp_replace(gtid, r"\s", ""), ","), lambda p: p != "")
    span = lambda server, low, high: F.struct(server.alias("server"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    if flavor == "mariadb":  # domain-server-number: all up to the number
        spans = F.transform(sets, lambda p: span(F.regexp_extract(p, "^(.*)-", 1), F.lit(0), F.regexp_extract(p, "([0-9]+)$", 1)))
    else:  # server:low-high:low-high
        ends = lambda server, s: span(F.lower(server), F.element_at(F.split(s, "-"), 1), F.element_at(F.split(s, "-"), -1))
        spans = F.flatten(F.transform(sets, lambda p: F.transform(F.slice(F.split(p, ":"), F.lit(2), F.size(F.split(p, ":"))), lambda s: ends(F.split(p, ":")[0], s))))

    def join(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(span(last["server"], last["low"], F.greatest(last["high"], s["high"]))))
        return F.when((F.size(done) > 0) & (last["server"] == s["server"]) & (s["low"] <= last["high"] + 1), longer).otherwise(F.concat(done, F.array(s)))

    empty = F.array().cast("array<struct<server:string,low:bigint,high:bigint>>")
    return F.aggregate(F.array_sort(F.coalesce(spans, empty)), empty, join)


def _holds(outer: Column, inner: Column) -> Column:
    return F.forall(inner, lambda s: F.exists(outer, lambda o: (o["server"] == s["server"]) & (o["low"] <= s["low"]) & (o["high"] >= s["high"])))


def gtid_less(a: Column, b: Column, flavor: str = "mysql") -> Column:
    """Whether a set of transaction ids is a true part of another: a partial order, so neither of two may be less. Null counts as empty."""
    one, other = _spans(a, flavor), _spans(b, flavor)
    return _holds(other, one) & ~_holds(one, other)


def consistent_points(progress: DataFrame) -> DataFrame:
    """(marker): markers with no value of another queue below them still pending; progress is (queue, value, pending, marker)."""
    low = progress.where("pending").groupBy("queue").agg(F.min("value").alias("low"))
    floor = low.agg(F.min("low").alias("floor"))
    return progress.where("marker").join(F.broadcast(floor)).where(F.col("floor").isNull() | (F.col("value") < F.col("floor"))).select("queue", "value")  # floor is one row


def last_of_transaction(rows: DataFrame) -> DataFrame:
    """Mutations with the place they have in their transaction, and whether they end it."""
    w = Window.partitionBy("nanos", "logical").orderBy("seq")
    return rows.withColumn("place", F.row_number().over(w)).withColumn("ends", F.lead("seq").over(w).isNull())
