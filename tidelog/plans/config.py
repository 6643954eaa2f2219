"""Settings of target tables and sources."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from tidelog.plans.catalog import Table


@dataclass(frozen=True)
class TableConfig:
    """How mutations of one table are mapped, resolved and applied."""

    #: Columns compared, in this order, with those of the existing row; only greater ones are applied.
    cas: tuple[str, ...] = ()
    #: Column to the age from which on a row is too late, as an interval's text.
    deadlines: dict[str, str] = field(default_factory=dict)
    #: Target column to an expression in which $0 is the payload's value.
    exprs: dict[str, str] = field(default_factory=dict)
    #: Column that takes properties without a column, as one JSON text.
    extras: str | None = None
    ignore: tuple[str, ...] = ()
    #: Target column to the payload's name for it.
    rename: dict[str, str] = field(default_factory=dict)
    #: "standard", a column function, or None.
    merge: str | Callable | None = None
    #: Queue of conflicts that the merge leaves.
    dlq: str | None = None
    #: Rows of one statement, for targets that are written by statements. The store takes a batch as a whole, so it only checks the value.
    row_limit: int = 100

    def check(self, table: Table) -> None:
        """ValueError unless all settings name columns of the table and go together."""
        for what, names in (("cas", self.cas), ("deadline", self.deadlines), ("expression", self.exprs), ("rename", self.rename), ("extras", (self.extras,) if self.extras else ())):
            if missing := [n for n in names if table.column(n) is None]:
                raise ValueError(f"{what}: no column {', '.join(missing)} in {table.name}")
        if self.row_limit < 1:
            raise ValueError(f"{table.name}: a statement has a row at least, not {self.row_limit}")
        if self.merge and not (self.cas or self.deadlines):
            raise ValueError(f"{table.name}: a merge needs compare-and-set or a deadline")
        lower = [c.name.lower() for c in table.columns]
        if len(set(lower)) < len(lower):
            raise ValueError(f"{table.name}: columns differ in case alone")
        if keys := [k for k in table.keys if k in self.ignore]:
            raise ValueError(f"{table.name}: key {', '.join(keys)} can't be ignored")


@dataclass(frozen=True)
class SourceConfig:
    """Where a source's mutations go and which hooks see them."""

    target: str | None = None
    dispatch: Callable | None = None
    deletes_to: str | Callable | None = None
    map: dict[str, Callable] = field(default_factory=dict)
    delete_key: dict[str, Callable] = field(default_factory=dict)
