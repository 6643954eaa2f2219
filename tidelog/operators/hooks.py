"""User hooks: dispatch, map, deletes, keys, merge and apply.

Hooks are functions on columns wherever they can be: dispatch gives an array of (tbl, doc), map gives a document or null.
Python functions on rows are wrapped by `row_hook` and travel in Arrow batches.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import target as sink
from tidelog.plans.catalog import Catalog, Table
from tidelog.plans.config import SourceConfig


#: What marks a number's text until its quotes are taken off.
_NUMBER = uuid.uuid4().hex
_NUMBER_TOKEN = re.compile(f'"{_NUMBER}([^"]*)"')


def route_all(df: DataFrame, tbl: str) -> DataFrame:
    return df.withColumn("tbl", F.lit(tbl))


def dispatch(df: DataFrame, hook: Callable[[Column, Column], Column]) -> DataFrame:
    """Each mutation once for every (tbl, doc) that the hook gives for its data and its meta; null documents go."""
    meta = F.struct("tbl", "nanos", "logical")
    out = df.withColumn("__to", F.explode(hook(F.col("data"), meta)))
    return out.withColumn("tbl", F.col("__to.tbl")).withColumn("data", F.col("__to.doc")).where("data IS NOT NULL").drop("__to")


def rekey(df: DataFrame, table: Table) -> DataFrame:
    """Keys made anew from the documents, as JSON arrays; a document without a key is an error."""
    def value(k):
        found = F.get_json_object("data", f"$.{k}")
        return F.coalesce(found, F.raise_error(F.lit(f"{table.name}: no {k}")).cast("string"))

    parts = F.array(*(value(c.name) for c in table.columns if c.primary))
    quoted = lambda text: F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2)
    numeric = [c.type.lower() in ("int", "long", "bigint", "short", "smallint") for c in table.columns if c.primary]
    shown = F.concat(F.lit("["), F.concat_ws(",", *(parts[i] if n else quoted(parts[i]) for i, n in enumerate(numeric))), F.lit("]"))
    return df.withColumn("key", shown)


def map_documents(df: DataFrame, hook: Callable[[Column, Column], Column]) -> DataFrame:
    """Documents replaced by what the hook gives; where it gives null the mutation goes."""
    return df.withColumn("data", hook(F.col("data"), F.struct("tbl", "nanos", "logical"))).where("data IS NOT NULL")


def map_keys(df: DataFrame, hook: Callable[[Column], Column], arity: int) -> DataFrame:
    """Deletes with the hook's key; null drops the delete, a key of another length is an error."""
    out = df.withColumn("key", hook(F.col("key"))).where("key IS NOT NULL")
    return out.withColumn("key", F.when(F.json_array_length("key") == arity, F.col("key")).otherwise(F.raise_error(F.concat(F.lit("key has another length: "), F.col("key"))).cast("string")))


def route_deletes(df: DataFrame, to: str | Callable[[Column], Column]) -> DataFrame:
    """Deletes sent to a table, or wherever a function of the key says; null drops them."""
    place = F.lit(to) if isinstance(to, str) else to(F.col("key"))
    return df.withColumn("tbl", place).where("tbl IS NOT NULL").withColumn("data", F.lit(None).cast("string"))


def row_hook(f: Callable[[dict], dict | None]) -> Callable[[Column, Column], Column]:
    """A Python function on documents as a hook; whole numbers are int, others Decimal, so none loses digits."""

    def run(data: pd.Series) -> pd.Series:
        def one(text):
            doc = f(json.loads(text, parse_float=Decimal)) if text is not None else None
            if doc is None:
                return None
            made = json.dumps(doc, default=lambda d: f"{_NUMBER}{d}" if isinstance(d, Decimal) else str(d), separators=(",", ":"))
            return _NUMBER_TOKEN.sub(r"\1", made)

        return data.map(one)

    udf = F.pandas_udf(run, "string")
    return lambda data, meta: udf(data)


@dataclass
class ApplyContext:
    """What an apply hook works with instead of the default sink."""

    spark: SparkSession
    table: Table
    target: DataFrame

    @property
    def columns(self) -> list[str]:
        return [c.name for c in self.table.columns]

    def apply(self, rows: DataFrame) -> DataFrame:
        return sink.apply(self.target, rows, self.table.keys)

    def sql(self, query: str, **views: DataFrame) -> DataFrame:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return self.spark.sql(query)


def pipeline(df: DataFrame, source: SourceConfig, catalog: Catalog) -> DataFrame:
    """A source's mutations (tbl, key, data, is_delete, ...) through its hooks: dispatch or target, then each table's map and key."""
    writes, deletes = df.where("NOT is_delete"), df.where("is_delete")
    if source.target:
        writes, deletes = route_all(writes, source.target), route_all(deletes, source.target)
    if source.dispatch:
        writes = dispatch(writes, source.dispatch)
    if source.deletes_to:
        deletes = route_deletes(deletes, source.deletes_to)
    for name, hook in source.map.items():
        mine = rekey(map_documents(writes.where(F.col("tbl") == name), hook), catalog.tables[name])
        writes = writes.where(F.col("tbl") != name).unionByName(mine.select(*writes.columns))
    for name, hook in source.delete_key.items():
        gone = map_keys(deletes.where(F.col("tbl") == name), hook, len(catalog.tables[name].keys))
        deletes = deletes.where(F.col("tbl") != name).unionByName(gone)
    return writes.unionByName(deletes.select(*writes.columns))
