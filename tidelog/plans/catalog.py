"""Target tables: columns, keys, references, and the order in which references allow writes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    primary: bool = False
    generated: bool = False
    default: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]

    @staticmethod
    def of(name: str, columns: str, keys: tuple[str, ...], defaults: dict[str, str] | None = None, generated: tuple[str, ...] = ()) -> Table:
        """columns is a DDL list; a table without keys gets a `rowid`."""
        made = []
        for part in re.split(r",(?![^()<>]*[)>])", columns):  # not inside a type
            column, kind = part.strip().split(" ", 1)
            made.append(Column(column, kind, column in keys, column in generated, (defaults or {}).get(column)))
        if not keys:
            made.insert(0, Column("rowid", "string", True, default="uuid()"))
        return Table(name, tuple(sorted(made, key=lambda c: not c.primary)))  # keys first

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.primary]

    def column(self, name: str) -> Column | None:
        """Names match in any case."""
        return next((c for c in self.columns if c.name.lower() == name.lower()), None)


@dataclass
class Catalog:
    tables: dict[str, Table] = field(default_factory=dict)
    #: (child, parent)
    references: list[tuple[str, str]] = field(default_factory=list)

    def levels(self) -> list[list[str]]:
        """Tables by depth, parents first, names in order; ValueError if references form a cycle of two or more."""
        parents = {t: {p for c, p in self.references if c == t and p != t} for t in self.tables}
        out: list[list[str]] = []
        placed: set[str] = set()
        while len(placed) < len(parents):
            ready = sorted(t for t, p in parents.items() if t not in placed and p <= placed)
            if not ready:
                raise ValueError("cycle of references: " + ", ".join(sorted(set(parents) - placed)))
            out.append(ready)
            placed |= set(ready)
        return out

    @staticmethod
    def described(info: DataFrame, references: list[tuple[str, str]] = ()) -> Catalog:
        """From rows (tbl, column_name, kind, ordinal, is_key, is_generated, default) of an information schema, one for each constraint on a column."""
        tables: dict[str, list[Column]] = {}
        for r in columns_once(info).orderBy("tbl", "ordinal").collect():  # names of columns
            tables.setdefault(r.tbl, []).append(Column(r.column_name, r.kind, r.is_key, r.is_generated, r.default))
        return Catalog({t: Table(t, tuple(sorted(c, key=lambda c: not c.primary))) for t, c in tables.items()}, list(references))

    @staticmethod
    def discovered(spark: SparkSession, keys: dict[str, tuple[str, ...]], references: list[tuple[str, str]] = ()) -> Catalog:
        """Of the session's tables and views that have declared keys."""
        tables = {}
        for name, own in keys.items():
            columns = spark.table(name).dtypes
            tables[name] = Table(name, tuple(sorted((Column(c, t, c in own) for c, t in columns), key=lambda c: not c.primary)))
        return Catalog(tables, list(references))


def columns_once(info: DataFrame) -> DataFrame:
    """Each column once, at its first place; it is a key if one of its constraints says so."""
    first = lambda c: F.min_by(c, "ordinal").alias(c)
    return info.groupBy("tbl", "column_name").agg(
        F.min("ordinal").alias("ordinal"), first("kind"), F.bool_or("is_key").alias("is_key"), F.bool_or("is_generated").alias("is_generated"), first("default")
    )


def depths(spark: SparkSession, tables: DataFrame, references: DataFrame) -> DataFrame:
    """(tbl, depth) of tables (tbl) under references (child, parent); -1 for members and descendants of a cycle.

    A table's depth is that of its deepest parent plus one; a reference to itself doesn't count. A path longer than the
    number of tables shows a cycle.
    """
    tables.createOrReplaceTempView("__tables")
    references.where("child <> parent").distinct().createOrReplaceTempView("__references")
    return spark.sql("""
        WITH RECURSIVE bound AS (SELECT count(*) AS n FROM __tables),
        walk AS (
            SELECT tbl, 0 AS depth FROM __tables WHERE tbl NOT IN (SELECT child FROM __references)
            UNION ALL
            SELECT r.child, w.depth + 1 FROM walk w JOIN __references r ON r.parent = w.tbl JOIN bound b ON w.depth < b.n
        )
        SELECT t.tbl, CAST(CASE WHEN max(w.depth) IS NULL OR max(w.depth) >= max(b.n) THEN -1 ELSE max(w.depth) END AS INT) AS depth
        FROM __tables t CROSS JOIN bound b LEFT JOIN walk w ON w.tbl = t.tbl GROUP BY t.tbl
    """)


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of children whose reference isn't null and has no parent."""
    return children.where(F.col(child_key).isNotNull()).join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")
