"""From payloads to typed target columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.plans.catalog import Table
from tidelog.plans.config import TableConfig

#: Stands for a large column that the source didn't change.
UNCHANGED = "__unchanged_toast__"


def payload(data: Column) -> Column:
    """A JSON object as a map from lower-case names to variants, which keep types and digits; null if it is none. Of names that differ in case alone the last counts."""
    m = F.from_json(data, "map<string,variant>")
    names = F.array_distinct(F.transform(F.map_keys(m), F.lower))
    last = F.transform(names, lambda k: F.element_at(F.filter(F.map_entries(m), lambda e: F.lower(e["key"]) == k), -1)["value"])
    return F.when(F.size(names) < F.size(m), F.map_from_arrays(names, last)).otherwise(F.transform_keys(m, lambda k, _: F.lower(k)))


def _wanted(table: Table, config: TableConfig) -> list:
    hidden = {c.lower() for c in config.ignore}
    return [c for c in table.columns if not c.generated and c.name.lower() not in hidden and c.name != config.extras]


def _source(name: str, config: TableConfig) -> str:
    return config.rename.get(name, name).lower()


def map_columns(df: DataFrame, table: Table, config: TableConfig = TableConfig(), data: str = "data", lenient: bool = False) -> DataFrame:
    """df with the table's columns instead of the payload.

    A property that is absent takes the column's default, one that is null stays null, and one that the column's type can't
    hold is an error. Ignored and generated columns
    don't appear. Unknown properties go to the extras column as sorted JSON, or are reported in `unexpected`, a
    sorted array; keys that are absent or null and have no default are reported in `missing`, all of them if the payload is no JSON object.
    A lenient mapping makes values null that a type can't hold, and reports their columns in `unfit`. Replacement expressions fail as they do.
    """
    config.check(table)
    rest = [c for c in df.columns if c != data]
    df = df.withColumn("__m", payload(F.col(data)))
    columns = _wanted(table, config)
    known = [_source(c.name, config) for c in columns] + [c.lower() for c in config.ignore] + [c.name.lower() for c in table.columns if c.generated]
    out: list[Column] = []
    unfit: list[Column] = []
    for c in columns:
        name = _source(c.name, config)
        read = f"{'try_' if lenient else ''}variant_get(__m[{_quoted(name)}], '$', '{_readable(c.type)}')"
        value = F.expr(config.exprs.get(c.name, "$0").replace("$0", read))
        value = value.try_cast(c.type) if lenient else value.cast(c.type)
        if lenient and c.name not in config.exprs:
            given = F.map_contains_key("__m", F.lit(name)) & ~F.coalesce(F.is_variant_null(F.col("__m")[name]), F.lit(False))
            unfit.append(F.when(given & value.isNull(), F.lit(c.name)))
        if c.default is not None:
            value = F.when(F.map_contains_key("__m", F.lit(name)), value).otherwise(F.expr(c.default).cast(c.type))
        out.append(value.alias(c.name))
    names = F.array(*(F.lit(k) for k in known))
    extra = F.map_filter("__m", lambda k, _: ~F.array_contains(names, k))
    if config.extras:
        out.append(_sorted_json(extra).alias(config.extras))
        unexpected = F.array().cast("array<string>")
    else:
        unexpected = F.coalesce(F.array_sort(F.map_keys(extra)), F.array().cast("array<string>"))
    keys = [_source(c.name, config) for c in columns if c.primary and c.default is None] or ["payload"]
    lacks = lambda k: F.col("__m").isNull() | (F.lit(keys != ["payload"]) & (~F.map_contains_key("__m", k) | F.coalesce(F.is_variant_null(F.col("__m")[k]), F.lit(False))))
    missing = F.filter(F.array(*(F.lit(k) for k in keys)), lacks)
    reports = [unexpected.alias("unexpected"), missing.alias("missing")]
    if lenient:
        reports.append(F.array_compact(F.array(*unfit, F.lit(None).cast("string"))).alias("unfit"))
    return df.select(*rest, *out, *reports)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _readable(kind: str) -> str:
    """The type to read from a variant; the rest are read as text and cast."""
    return kind if kind.split("(")[0].lower() in ("int", "long", "bigint", "short", "smallint", "double", "float", "boolean", "string", "decimal") else "string"


def _sorted_json(m: Column) -> Column:
    """JSON of a variant map, by key; null for an empty one."""
    one = lambda k: F.to_json(F.create_map(k, m[k]))
    parts = F.transform(F.array_sort(F.map_keys(m)), lambda k: one(k).substr(F.lit(2), F.length(one(k)) - 2))
    return F.when(F.size(m) > 0, F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")))


def violation() -> Column:
    """What is wrong with a mapped row, null if nothing."""
    missing = F.when(F.size("missing") > 0, F.concat(F.lit("missing keys: "), F.array_join("missing", ", ")))
    return missing.when(F.size("unexpected") > 0, F.concat(F.lit("unexpected columns: "), F.array_join("unexpected", ", ")))


def violations(mapped: DataFrame) -> DataFrame:
    """Rows with unexpected properties or missing keys, and what is wrong."""
    return mapped.withColumn("violation", violation()).where("violation IS NOT NULL")


def valid(mapped: DataFrame) -> DataFrame:
    return mapped.where((F.size("missing") == 0) & (F.size("unexpected") == 0)).drop("unexpected", "missing")


def refused(df: DataFrame, table: Table, config: TableConfig = TableConfig()) -> DataFrame:
    """(tbl, key, nanos, logical, reason) of mutations that the table can't take: payloads that violate it, values that don't fit, keys of another length."""
    place = ["tbl", "key", "nanos", "logical"]
    mapped = map_columns(df.where("NOT is_delete").select(*(F.col(c).alias(f"__{c}") for c in place), "data"), table, config, lenient=True)
    unfit = F.when(F.size("unfit") > 0, F.concat(F.lit("values that don't fit: "), F.array_join("unfit", ", ")))
    writes = mapped.select(*(F.col(f"__{c}").alias(c) for c in place), F.coalesce(violation(), unfit).alias("reason"))
    keys = [c for c in table.columns if c.primary]
    parts = F.from_json("key", "array<string>")
    fits = [F.try_element_at(parts, F.lit(i + 1)).try_cast(c.type).isNotNull() for i, c in enumerate(keys) if c.name not in config.exprs]
    fit = F.coalesce(F.size(parts) == len(keys), F.lit(False))
    reason = F.when(~fit, "a delete's key has another length").when(~F.forall(F.array(F.lit(True), *fits), lambda x: x), "a delete's key doesn't fit")
    deletes = df.where("is_delete").select(*place, reason.alias("reason"))
    return writes.unionByName(deletes).where("reason IS NOT NULL")


def delete_keys(df: DataFrame, table: Table, config: TableConfig = TableConfig(), key: str = "key") -> DataFrame:
    """Typed keys of deletes from their JSON arrays; replacement expressions apply; `arity` tells whether the array fits."""
    values = F.from_json(F.col(key), "array<string>")
    out = []
    for i, c in enumerate(c for c in table.columns if c.primary):
        text = f"try_element_at(from_json({key}, 'array<string>'), {i + 1})"
        value = F.expr(config.exprs[c.name].replace("$0", f"CAST({text} AS {c.type})")) if c.name in config.exprs else F.expr(text)
        out.append(value.cast(c.type).alias(c.name))
    return df.select(*[c for c in df.columns if c != key], *out, (F.size(values) == len(out)).alias("arity"))


def fill_unchanged(rows: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with the target's value wherever a column holds the unchanged mark; null where the target has no such row."""
    now = target.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    out = rows.join(now, keys, "left")
    for c in columns:
        out = out.withColumn(c, F.when(F.col(c) == UNCHANGED, F.col(f"__{c}")).otherwise(F.col(c)))
    return out.select(*rows.columns)
