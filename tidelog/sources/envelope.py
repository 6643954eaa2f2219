"""Decoding text into mutations: (tbl, key, data, before, nanos, logical, is_delete).

JSON sides stay JSON text; keys are JSON arrays in normal form. Digits of numbers survive, since sides are variants.
What can't be read is an error, never a delete or nothing; `topic_errors` and `webhook_errors` list it beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import hlc

BULK = "after variant, before variant, key variant, updated string, topic string, resolved string"
FIELDS = ["after", "before", "key", "updated", "topic", "resolved"]
OUT = ["tbl", "key", "data", "before", "nanos", "logical", "is_delete"]


def _json(side: Column) -> Column:
    return F.when(side.isNotNull() & ~F.is_variant_null(side), F.to_json(side))


def _clock(text: str) -> Column:
    """The clock in a column; none is an error."""
    none = F.raise_error(F.concat(F.lit("no clock: "), F.coalesce(F.col("value").cast("string"), F.lit("null"))))
    return F.coalesce(hlc.parse(F.col(text)), none.cast("struct<nanos:bigint,logical:int>"))


def _mutations(df: DataFrame, tbl: Column, key: Column) -> DataFrame:
    """Rows with a parsed envelope e; phantom deletes (neither side, no key) go; a line without a clock is an error."""
    clock = _clock("e.updated")
    out = df.select(tbl.alias("tbl"), key.alias("key"), _json(F.col("e.after")).alias("data"), _json(F.col("e.before")).alias("before"), clock.alias("c"))
    out = out.where("data IS NOT NULL OR before IS NOT NULL OR key IS NOT NULL")
    return out.select("tbl", "key", "data", "before", F.col("c.nanos").alias("nanos"), F.col("c.logical").alias("logical"), F.col("data").isNull().alias("is_delete"))


def _parsed(lines: DataFrame) -> DataFrame:
    """Lines with their envelope e; a line that is no JSON object is an error."""
    return lines.where(F.trim("value") != "").withColumn("e", F.from_json("value", BULK, {"mode": "FAILFAST"}))


def bulk_lines(lines: DataFrame, tbl: Column) -> DataFrame:
    """Lines (value) of `{"after", "before", "key", "updated"}`; resolved lines and blank ones don't appear."""
    rows = _parsed(lines).where("e.resolved IS NULL")
    return _mutations(rows, tbl, _json(F.col("e.key")))


def query_lines(lines: DataFrame, tbl: Column, keys: list[str]) -> DataFrame:
    """Lines without a key: it comes from the after side, else from the before side, by the table's key columns.

    Neither side is a phantom delete; a side without one of the columns is an error.
    """
    rows = _parsed(lines).where("e.resolved IS NULL").withColumn("side", F.coalesce(_json(F.col("e.after")), _json(F.col("e.before")))).where("side IS NOT NULL")
    values = F.from_json("side", "map<string,variant>")
    bare = F.when(F.col("e.after").isNull() & F.col("e.before").isNull(), F.raise_error(F.lit("no envelope")).cast("string"))
    parts = [F.coalesce(bare, F.to_json(values[k]), F.raise_error(F.lit(f"no key column {k}")).cast("string")) for k in keys]
    return _mutations(rows, tbl, F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")))


def resolved_lines(lines: DataFrame) -> DataFrame:
    """(nanos, logical) of `{"resolved": "n.l"}` lines."""
    rows = _parsed(lines).where("e.resolved IS NOT NULL").select(F.when(F.col("e.resolved").isNotNull(), _clock("e.resolved")).alias("c"))
    return rows.select("c.nanos", "c.logical")


def _body(text: str) -> Column:
    return F.from_json(text, "map<string,variant>")


def _body_error() -> Column:
    """What is wrong with a body (value), null if nothing: it is no object, has other fields, a length that differs, or lines of that kind."""
    line = lambda m: F.size(F.array_except(F.map_keys(m), F.array(*map(F.lit, FIELDS)))) > 0
    payload = F.coalesce("b.payload", F.array().cast("array<map<string,variant>>"))
    clock = lambda m: F.try_variant_get(m["updated"], "$", "string")
    return (
        F.when(F.trim("value") == "", F.lit(None))  # filters may come after this
        .when(F.col("m").isNull(), "malformed")
        .when(F.size(F.array_except(F.map_keys("m"), F.array(F.lit("payload"), F.lit("length"), F.lit("resolved")))) > 0, "unknown field")
        .when(F.map_contains_key("m", F.lit("resolved")), F.when(hlc.parse(F.col("b.resolved")).isNull(), "no clock"))
        .when(F.size(payload) != F.coalesce("b.length", F.lit(0)), "length differs from payload")
        .when(F.exists(payload, lambda m: m.isNull()), "malformed line")
        .when(F.exists(payload, line), "unknown field in a line")
        .when(F.exists(payload, lambda m: hlc.parse(clock(m)).isNull()), "no clock in a line")
    )


def _bodies(bodies: DataFrame) -> DataFrame:
    parsed = bodies.where(F.trim("value") != "").withColumn("m", _body("value"))
    return parsed.withColumn("b", F.from_json("value", "payload array<map<string,variant>>, length int, resolved string")).withColumn("error", _body_error())


def webhook_errors(bodies: DataFrame) -> DataFrame:
    """Bodies that can't be taken, and why. An empty body is nothing to do, not an error."""
    return _bodies(bodies).where("error IS NOT NULL").drop("m", "b")


def _good(bodies: DataFrame) -> DataFrame:
    """Bodies with b; a bad one is an error."""
    rows = _bodies(bodies)
    checked = F.when(F.col("error").isNull(), F.col("b")).otherwise(F.raise_error(F.concat("error", F.lit(": "), "value")).cast(rows.schema["b"].dataType))
    return rows.select("value", checked.alias("b"))


def _payload_lines(bodies: DataFrame) -> DataFrame:
    """(e): the lines of bodies."""
    text = lambda m, k: F.try_variant_get(m[k], "$", "string").alias(k)
    rows = _good(bodies).where("b.resolved IS NULL").select("value", F.explode("b.payload").alias("m"))
    m = F.col("m")
    return rows.select("value", F.struct(*(m[k].alias(k) if k in ("after", "before", "key") else text(m, k) for k in FIELDS)).alias("e"))


def webhook_bodies(bodies: DataFrame) -> DataFrame:
    """Bodies (value) of `{"payload": [line with topic, ...], "length": n}`; the topic's last part is the table. A body that webhook_errors() lists is an error; `{"resolved"}` bodies are webhook_resolved()'s."""
    return _mutations(_payload_lines(bodies), F.element_at(F.split("e.topic", r"\."), -1), _json(F.col("e.key")))


def webhook_resolved(bodies: DataFrame) -> DataFrame:
    """(nanos, logical) of `{"resolved": "n.l"}` bodies."""
    return _good(bodies).where("b.resolved IS NOT NULL").select(hlc.parse(F.col("b.resolved")).alias("c")).select("c.nanos", "c.logical")


def query_webhook_bodies(bodies: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """The same for feeds of queries, whose lines carry no key: it comes from the sides, by the key columns of the topic's table. Phantom deletes go, other topics are an error."""
    rows = _payload_lines(bodies).withColumn("tbl", F.element_at(F.split("e.topic", r"\."), -1)).withColumn("value", F.to_json("e"))
    known = F.when(F.col("tbl").isin(*keys), F.col("tbl")).otherwise(F.raise_error(F.concat(F.lit("unknown topic: "), F.coalesce("e.topic", F.lit("null")))).cast("string"))
    rows = rows.withColumn("tbl", known)
    out = None
    for name, columns in keys.items():
        one = query_lines(rows.where(F.col("tbl") == name), F.lit(name), columns)
        out = one if out is None else out.unionByName(one)
    return out


def _messages(messages: DataFrame) -> DataFrame:
    rows = messages.withColumn("value", F.col("value").cast("string"))
    clock = hlc.parse(F.coalesce("e.resolved", "e.updated"))
    is_object = F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT")
    wrong = F.when(~F.coalesce(is_object, F.lit(False)) | F.col("e").isNull(), "malformed").when(clock.isNull(), "no clock")
    return rows.withColumn("e", F.from_json("value", BULK)).withColumn("error", wrong)


def topic_errors(messages: DataFrame) -> DataFrame:
    """(part, offset, error) of messages that are no JSON object or have no clock."""
    return _messages(messages).where("error IS NOT NULL").select("part", "offset", "error")


def topic_messages(messages: DataFrame) -> DataFrame:
    """Messages (topic, part, offset, key, value) of a message queue: mutations with the message's key, and its place. A message that topic_errors() lists is an error."""
    rows = _messages(messages)
    place = F.concat(F.lit(" at "), F.col("part").cast("string"), F.lit("/"), F.col("offset").cast("string"))
    checked = F.when(F.col("error").isNull(), F.col("e")).otherwise(F.raise_error(F.concat("error", place)).cast(rows.schema["e"].dataType))
    rows = rows.withColumn("e", checked).where("e.resolved IS NULL")
    out = rows.select("part", "offset", F.col("topic").alias("tbl"), F.col("key").cast("string").alias("key"), _json(F.col("e.after")).alias("data"), _json(F.col("e.before")).alias("before"), hlc.parse(F.col("e.updated")).alias("c"))
    return out.select("part", "offset", "tbl", "key", "data", "before", F.col("c.nanos").alias("nanos"), F.col("c.logical").alias("logical"), F.col("data").isNull().alias("is_delete"))


def topic_resolved(messages: DataFrame) -> DataFrame:
    """(part, offset, nanos, logical) of resolved messages."""
    rows = messages.select("part", "offset", F.from_json(F.col("value").cast("string"), "resolved string")["resolved"].alias("value")).where("value IS NOT NULL")
    return rows.select("part", "offset", F.when(F.col("value").isNotNull(), _clock("value")).alias("c")).select("part", "offset", "c.nanos", "c.logical")


def seek(messages: DataFrame, low: tuple[int, int]) -> DataFrame:
    """(part, offset) from which a partition must be read again: its last resolved message before the clock, its first message if there is none."""
    resolved = topic_resolved(messages).where(hlc.less(hlc.pair(), hlc.literal(*low)))
    best = resolved.groupBy("part").agg(F.max_by("offset", F.struct("nanos", "logical", "offset")).alias("found"))
    first = messages.groupBy("part").agg(F.min("offset").alias("first"))
    return first.join(best, "part", "left").select("part", F.coalesce("found", "first").alias("offset"))


def kafka_stream(spark: SparkSession, servers: str, topics: str, options: dict[str, str] | None = None) -> DataFrame:
    """A stream of messages as topic_messages() takes them. Needs Spark's connector for the queue on the class path; options go through to it."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select("topic", F.col("partition").alias("part"), "offset", "key", "value")


def landing(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """Lines (value, path) of files that land in a folder."""
    reader = spark.readStream if stream else spark.read
    return reader.format("text").load(folder).select("value", F.col("_metadata.file_path").alias("path"))
