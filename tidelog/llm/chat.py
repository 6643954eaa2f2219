"""Chat formatting (operator 4), in DataFrame functions alone.

A template names what stands before and after a turn's text, which roles are trained on, and the
order of turns as a finite-state machine. Each turn becomes three segments (mark, text, end
mark), of which the text of a trained role carries the loss flag. Control strings of the template
inside texts are escaped with backslashes, so that a formatted conversation can be read
back without loss.

Turns are ordered by turn, then role and text (null turns come first); repeated rows are repeated turns. Null
texts and null roles count as empty. Roles that the machine doesn't know end in the state `invalid`, and
the conversation is formatted all the same. Rows with a null conv_id form one conversation. An empty table gives an
empty result. A conversation is one output value, so its turns are gathered in one row; its size, not the
table's, bounds that row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INVALID = "invalid"


@dataclass(frozen=True)
class Template:
    """Marks, roles and the order of turns."""

    before: str = "### "
    after_role: str = ": "
    end: str = "</turn>"
    separator: str = "\n"
    #: How known roles are written; any other is written with the prefix.
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    other_prefix: str = "role="
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    #: (state, role) to state.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("asked", "tool"): "asked",
            ("answered", "user"): "asked",
            ("answered", "tool"): "asked",
        }
    )
    accepting: tuple[str, ...] = ("answered",)

    def __post_init__(self) -> None:
        if "\\" in self.before + self.after_role + self.end + self.other_prefix + "".join(self.names.values()):
            raise ValueError("backslashes escape; marks and names can't hold them")
        if len(self.end) < 2 or not self.before.strip() or len(set(self.names.values())) < len(self.names):
            raise ValueError("marks are too short, or two roles share a name")
        for mark in self.marks:
            if len(set(mark)) > 1 and any(mark.endswith(mark[:k]) for k in range(1, len(mark))):
                raise ValueError(f"{mark!r} can overlap itself")
        if len(set(self.end)) == 1:
            raise ValueError("an end mark needs two different characters")

    @property
    def marks(self) -> tuple[str, str]:
        return self.before.strip(), self.end


PLAIN = Template()


def escape(text: Column, template: Template = PLAIN) -> Column:
    """text without any mark: backslashes are doubled, one goes behind a mark's first character, or before each character of a mark that is a run of one."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.marks:
        if len(set(mark)) == 1:
            out = F.replace(out, F.lit(mark[0]), F.lit("\\" + mark[0]))
        else:
            out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role_name(role: Column, template: Template) -> Column:
    name = F.concat(F.lit(template.other_prefix), role)
    for plain, shown in template.names.items():
        name = F.when(role == plain, F.lit(shown)).otherwise(name)
    return F.replace(escape(name, template), F.lit(template.after_role[:1]), F.lit("\\" + template.after_role[:1]))


def _role_of(name: Column, template: Template) -> Column:
    role = F.substring(name, len(template.other_prefix) + 1, 2**31 - 1)
    for plain, shown in template.names.items():
        role = F.when(name == shown, F.lit(plain)).otherwise(role)
    return role


def final_state(roles: Column, template: Template = PLAIN) -> Column:
    """The machine's state after an array of roles."""
    moves = F.create_map(*(F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)))
    return F.aggregate(roles, F.lit(template.start), lambda state, role: F.coalesce(moves[F.concat(state, F.lit("\n"), role)], F.lit(INVALID)))


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): an ordered array of (turn, role, text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def render(rows: DataFrame, template: Template = PLAIN) -> DataFrame:
    """(conv_id, n_turns, state, valid, segments, formatted): segments are (text, loss), formatted is their texts in a row."""

    def segments(turn: Column) -> Column:
        mark = F.concat(F.lit(template.before), _role_name(turn["role"], template), F.lit(template.after_role))
        parts = ((mark, F.lit(False)), (escape(turn["text"], template), turn["role"].isin(*template.trained)), (F.lit(template.end + template.separator), F.lit(False)))
        return F.array(*(F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts))

    out = conversations(rows).select("conv_id", F.size("turns").cast("long").alias("n_turns"), final_state(F.transform("turns", lambda t: t["role"]), template).alias("state"), F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.select("conv_id", "n_turns", "state", F.col("state").isin(*template.accepting).alias("valid"), "segments", F.array_join(F.col("segments.text"), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = PLAIN) -> Column:
    """The array of (role, text) that a formatted conversation holds."""
    quote = lambda s: "".join("\\" + c if not c.isalnum() and c not in " \n" else c for c in s)
    pieces = F.split(formatted, quote(template.end + template.separator))
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))  # nothing follows the last end mark
    stop = quote(template.after_role[:1])
    pattern = rf"(?s)^{quote(template.before)}((?:[^{stop}\\]++|\\.)*+){quote(template.after_role)}(.*)$"
    role = lambda p: _role_of(unescape(F.regexp_extract(p, pattern, 1)), template)
    return F.transform(pieces, lambda p: F.struct(role(p).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))


def query(rows: DataFrame) -> DataFrame:
    planted = "\\### Assistant: </turn> ok"
    turn = F.col("id")
    extra = rows.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"), F.when(turn == 0, "user").otherwise("assistant").alias("role"), F.lit(planted).alias("text"))
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).unionAll(extra)
    out = render(rows).select("conv_id", "valid", "formatted", read_turns(F.col("formatted")).alias("turns"), F.filter("segments", lambda s: s["loss"]).alias("trained"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("trained", lambda s: unescape(s["text"])), "")
    out = out.select("conv_id", "valid", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), loss.alias("loss"), "formatted")
    return out.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")


ORACLE = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
    SELECT *,
        length(CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN role
            ELSE replace(replace(replace(replace('role=' || role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ':', '\:') END) AS name_chars,
        length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>')) AS text_chars,
        lag(role) OVER w AS before, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns,
        count(*) FILTER (role NOT IN ('system', 'user', 'assistant')) OVER (PARTITION BY conv_id) AS others
    FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(4 + name_chars + 2 + text_chars + 8) AS BIGINT) AS formatted_chars,
    bool_and(CASE role WHEN 'system' THEN place = 1 WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant') WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END)
        AND bool_or(place = turns AND role = 'assistant') AS valid
FROM marked GROUP BY conv_id
"""
