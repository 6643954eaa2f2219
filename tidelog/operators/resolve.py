"""Compare-and-set, deadlines, three-way merge, and what becomes of conflicts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def greater(new: list[Column], old: list[Column]) -> Column:
    """Whether one tuple is greater than another by SQL's rules: undecided, so not true, at a null.

    Spelled out, since engines differ on nulls inside compared rows.
    """
    parts = []
    for i, (a, b) in enumerate(zip(new, old)):
        same = [x == y for x, y in zip(new[:i], old[:i])]
        parts.append(reduce(lambda p, q: p & q, [*same, a > b]))
    return F.coalesce(reduce(lambda p, q: p | q, parts), F.lit(False))


def in_time(rows: DataFrame, deadlines: dict[str, str], as_of: Column) -> DataFrame:
    """Rows younger than every deadline; nulls are too late."""
    for column, age in deadlines.items():
        rows = rows.where(F.col(column) > as_of - F.expr(f"INTERVAL {age}"))
    return rows


def _current(target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return target.select(*keys, *(F.col(c).alias(f"__now_{c}") for c in columns), F.lit(True).alias("__exists"))


@dataclass
class Decision:
    """What a conditional upsert applies, and what it refuses together with the target's row."""

    applied: DataFrame
    conflicts: DataFrame


def decide(target: DataFrame, rows: DataFrame, keys: list[str], cas: list[str] = (), deadlines: dict[str, str] | None = None, as_of: Column | None = None) -> Decision:
    """Conditional upsert of deduplicated rows.

    Applied are rows in time that have no target row or a greater tuple of cas columns. Every
    other row that has a target row is a conflict, including those dropped by a deadline; the target's columns
    are prefixed with `target_`.
    """
    others = [c for c in target.columns if c not in keys]
    joined = rows.join(_current(target, keys, others), keys, "left")
    ok = _timely(deadlines, as_of, F.col)
    if cas:
        ok = ok & (F.col("__exists").isNull() | greater([F.col(c) for c in cas], [F.col(f"__now_{c}") for c in cas]))
    judged = joined.withColumn("__ok", ok)
    applied = judged.where("__ok").select(*rows.columns)
    conflicts = judged.where(~F.col("__ok") & F.col("__exists")).select(*rows.columns, *(F.col(f"__now_{c}").alias(f"target_{c}") for c in others))
    return Decision(applied, conflicts)


def _timely(deadlines: dict[str, str] | None, as_of: Column | None, value: Callable[[str], Column]) -> Column:
    ok = F.lit(True)
    for column, age in (deadlines or {}).items():
        ok = ok & F.coalesce(value(column) > as_of - F.expr(f"INTERVAL {age}"), F.lit(False))
    return ok


def apply_once(target: DataFrame, rows: DataFrame, keys: list[str], cas: list[str] = (), deadlines: dict[str, str] | None = None, as_of: Column | None = None, is_delete: str | None = None) -> Decision:
    """Deduplicated mutations applied in one pass over the target; applied is its new state, conflicts are as decide() gives them.

    Updates and deletes meet the target in one left join, which needs no shuffle of the target where the rows are few
    enough to be broadcast (adaptive execution checks their size); new rows need the target's keys alone. Deletes hold
    whatever the conditions say.
    """
    others = [c for c in target.columns if c not in keys]
    gone = F.col(is_delete) if is_delete else F.lit(False)
    new = rows.select(*keys, F.struct(*others).alias("__new"), gone.alias("__gone"))
    joined = target.join(new, keys, "left")
    wins = _timely(deadlines, as_of, lambda c: F.col(f"__new.{c}"))
    if cas:
        wins = wins & greater([F.col(f"__new.{c}") for c in cas], [F.col(c) for c in cas])
    met = F.col("__new").isNotNull()
    judged = joined.withColumn("__wins", met & wins)
    kept = judged.where(~F.coalesce("__gone", F.lit(False))).select(*keys, *(F.when(F.col("__wins"), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in others))
    fresh = rows.where(~gone & _timely(deadlines, as_of, F.col)).join(target.select(*keys), keys, "left_anti")
    conflicts = judged.where(met & ~F.col("__gone") & ~F.col("__wins")).select(*keys, *(F.col(f"__new.{c}").alias(c) for c in others), *(F.col(c).alias(f"target_{c}") for c in others))
    return Decision(kept.unionByName(fresh.select(*keys, *others)).select(*target.columns), conflicts)


def conditional_upsert(target: DataFrame, rows: DataFrame, keys: list[str], cas: list[str] = (), deadlines: dict[str, str] | None = None, as_of: Column | None = None) -> DataFrame:
    return apply_once(target, rows, keys, cas, deadlines, as_of).applied


# ---------------------------------------------------------------- three-way merge


def merge_column(before: Column, proposed: Column, current: Column, has_before: Column) -> tuple[Column, Column]:
    """Merged value of one column, and whether it could not be merged.

    Unchanged or already equal: the target's value stays. Target as before: the proposed value. Otherwise both sides
    changed it; the target's value stands meanwhile.
    """
    keep = (has_before & before.eqNullSafe(proposed)) | current.eqNullSafe(proposed)
    take = has_before & before.eqNullSafe(current)
    return F.when(keep, current).when(take, proposed).otherwise(current), ~keep & ~take


def merge_rows(conflicts: DataFrame, columns: list[str], before: str = "before_", current: str = "target_", has_before: str = "has_before") -> DataFrame:
    """Conflicts with merged columns, and `unmerged`, the names of those that could not be."""
    has = F.col(has_before)
    merged, open_ = {}, []
    for c in columns:
        value, stuck = merge_column(F.col(before + c), F.col(c), F.col(current + c), has)
        merged[c] = value
        open_.append(F.when(stuck, F.lit(c)))
    return conflicts.withColumns({f"merged_{c}": v for c, v in merged.items()} | {"unmerged": F.array_compact(F.array(*open_))})


def merge_maps(before: Column, proposed: Column, current: Column) -> tuple[Column, Column]:
    """The same for properties without a column, maps from name to JSON text: merged map and names that could not be merged.

    A property that the proposal lacks, and the target has as before, goes.
    """
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    b, p, t = (F.coalesce(m, empty) for m in (before, proposed, current))
    names = F.array_distinct(F.concat(F.map_keys(b), F.map_keys(p), F.map_keys(t)))

    def verdict(k: Column) -> Column:
        # unset and set to null differ: the map's presence decides
        same = lambda x, y: (F.map_contains_key(x, k) == F.map_contains_key(y, k)) & x[k].eqNullSafe(y[k])
        keep = same(b, p) | same(t, p)
        take = ~F.map_contains_key(t, k) | same(b, t)
        side = F.when(keep, "t").when(take, "p").otherwise("x")
        chosen = F.when(side == "p", p[k]).otherwise(t[k])
        there = F.when(side == "p", F.map_contains_key(p, k)).otherwise(F.map_contains_key(t, k))
        return F.struct(k.alias("name"), chosen.alias("value"), there.alias("there"), (side == "x").alias("stuck"))

    judged = F.transform(F.array_sort(names), verdict)
    kept = F.filter(judged, lambda v: v["there"])
    stuck = F.transform(F.filter(judged, lambda v: v["stuck"]), lambda v: v["name"])
    return F.map_from_entries(F.transform(kept, lambda v: F.struct(v["name"], v["value"]))), stuck


def route(merged: DataFrame, columns: list[str], fallback: str | Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Merged conflicts with a `resolution`: `apply`, or for rows with unmerged columns the fallback (`drop`, `dlq`, or a column); without one they are an error."""
    stuck = F.size("unmerged") > 0
    if fallback is None:
        other = F.raise_error(F.concat(F.lit("unmerged columns: "), F.array_join("unmerged", ", "))).cast("string")
    else:
        other = fallback(merged) if callable(fallback) else F.lit(fallback)
    return merged.withColumn("resolution", F.when(stuck, other).otherwise(F.lit("apply")))


def fixups(routed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rows that resolutions apply, to be upserted without condition."""
    return routed.where(F.col("resolution") == "apply").select(*keys, *(F.col(f"merged_{c}").alias(c) for c in columns))


def dead_letters(routed: DataFrame, name: str, after: Column, before: Column) -> DataFrame:
    """Rows for the dead-letter table: absent sides are JSON null."""
    null = F.lit("null")
    return routed.where(F.col("resolution") == "dlq").select(F.lit(name).alias("dlq_name"), F.col("nanos").alias("source_nanos"), F.col("logical").alias("source_logical"), F.coalesce(after, null).alias("data_after"), F.coalesce(before, null).alias("data_before"))
