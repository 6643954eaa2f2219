"""Queries on clocks, staging, checkpoints, sources, hooks and modes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import hlc, values
from tidelog.operators import checkpoint, hooks, mapping, poison, staging
from tidelog.operators.dedup import last_by_key
from tidelog.plans import catalog
from tidelog.plans.catalog import Catalog, Table
from tidelog.plans.config import SourceConfig
from tidelog.plans.feeds import BASE, Tables, query
from tidelog.sources import envelope, logical, objects, workload
from tidelog.streaming import control, modes

LOW, HIGH = BASE + 10_000, BASE + 60_000


# ---------------------------------------------------------------- clocks and values


@query("""SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey * 1000 WHEN 1 THEN o_orderkey WHEN 4 THEN 7 END AS nanos, CAST(CASE o_orderkey % 6 WHEN 0 THEN o_orderkey % 9 WHEN 1 THEN 0 WHEN 4 THEN 2147483647 END AS INTEGER) AS logical,
    CASE o_orderkey % 6 WHEN 0 THEN (o_orderkey * 1000) || '.' || lpad(CAST(o_orderkey % 9 AS VARCHAR), 10, '0') WHEN 1 THEN o_orderkey || '.0000000000' WHEN 4 THEN '7.2147483647' END AS shown FROM orders""")
def hlc_parse_valid(t: Tables) -> DataFrame:
    """Clock texts, among them short ones, signs, missing parts and parts out of range."""
    k = F.col("o_orderkey")
    kind, s = k % 6, k.cast("string")
    text = F.when(kind == 0, hlc.text(k * 1000, (k % 9).cast("int"))).when(kind == 1, F.concat(s, F.lit(".0"))).when(kind == 2, F.concat(s, F.lit(".123"))).when(kind == 3, F.concat(F.lit("."), s)).when(kind == 4, F.lit("7.2147483647")).otherwise(F.concat(F.lit("-"), s, F.lit(".0000000000")))
    out = t("orders").select(k.alias("id"), hlc.parse(text).alias("c"))
    return out.select("id", "c.nanos", "c.logical", hlc.text(F.col("c.nanos"), F.col("c.logical")).alias("shown"))


@query("SELECT seq, CASE WHEN logical > 0 THEN nanos ELSE nanos - 1 END AS before_nanos, CASE WHEN logical > 0 THEN logical - 1 ELSE 2147483647 END AS before_logical, nanos AS after_nanos, logical + 1 AS after_logical FROM feed", "feed")
def hlc_neighbours(t: Tables) -> DataFrame:
    n, l = hlc.pair()
    out = t.feed().select("seq", hlc.before(n, l).alias("b"), hlc.after(n, l).alias("a"))
    return out.select("seq", F.col("b.nanos").alias("before_nanos"), F.col("b.logical").alias("before_logical"), F.col("a.nanos").alias("after_nanos"), F.col("a.logical").alias("after_logical"))


@query(f"SELECT tbl, key, nanos, logical, seq FROM feed WHERE (nanos > {LOW} OR (nanos = {LOW} AND logical >= 1)) AND (nanos < {HIGH} OR (nanos = {HIGH} AND logical < 1))", "feed")
def hlc_range_scan(t: Tables) -> DataFrame:
    return t.feed().where(hlc.Range((LOW, 1), (HIGH, 1)).contains()).select("tbl", "key", "nanos", "logical", "seq")


@query("SELECT p_partkey AS id, CAST(p_partkey * 10 AS VARCHAR) AS a, CASE WHEN p_size % 10 = 0 THEN '0.' || (p_size // 10) WHEN p_size < 10 THEN '0.0' || p_size ELSE '0.' || p_size END AS b, CAST(NULL AS VARCHAR) AS c FROM part")
def exponent_removed(t: Tables) -> DataFrame:
    return t("part").select(F.col("p_partkey").alias("id"), values.plain_decimal(F.concat(F.col("p_partkey").cast("string"), F.lit("E+1"))).alias("a"), values.plain_decimal(F.concat(F.col("p_size").cast("string"), F.lit("e-2"))).alias("b"), values.plain_decimal(F.col("p_name")).alias("c"))


@query("SELECT p_partkey AS id, p_size % 3 = 0 AS same, p_size % 4 <> 1 AS same_scalar FROM part")
def canonical_equal(t: Tables) -> DataFrame:
    """Objects are equal in any order of keys; a number equals its text, a boolean doesn't."""
    size = F.col("p_size").cast("string")
    a = F.concat(F.lit('{"b": [1, null], "a": '), size, F.lit("}"))
    b = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('{"a":'), size, F.lit(',"b":[1,null]}'))).otherwise(F.concat(F.lit('{"a":'), size, F.lit(',"b":[null,1]}')))
    kind = F.col("p_size") % 4
    right = F.when(kind == 1, F.concat(F.lit("0"), size)).otherwise(size)
    scalar = values.same_scalar(size, right, F.lit("number"), F.when(kind == 0, "string").otherwise("number"))
    return t("part").select(F.col("p_partkey").alias("id"), (values.canonical_json(a) == values.canonical_json(b)).alias("same"), scalar.alias("same_scalar"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS name, CAST(p_size AS BIGINT) AS bits FROM part")
def hex_and_bits(t: Tables) -> DataFrame:
    shown = F.concat(F.when(F.col("p_partkey") % 4 == 0, F.lit("x")).otherwise(F.lit("\\x")), F.hex("p_name"))
    return t("part").select(F.col("p_partkey").alias("id"), values.hex_bytes(shown).cast("string").alias("name"), values.bit_number(F.bin("p_size")).alias("bits"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'db_my.schema_' ELSE 'db_public_' END || lower(c_name) AS staging FROM customer")
def identifier_parts(t: Tables) -> DataFrame:
    """Quoted parts may hold dots; names compare in any case."""
    name = F.concat(F.when(F.col("c_custkey") % 2 == 0, F.lit('DB."My.Schema".')).otherwise(F.lit('"Db".PUBLIC.')), F.col("c_name"))
    return t("customer").select(F.col("c_custkey").alias("id"), values.staging_name(name).alias("staging"))


# ---------------------------------------------------------------- staging


@query("SELECT tbl, key, nanos, logical, max(seq) AS seq FROM feed f WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.tbl = f.tbl AND s.key = f.key AND s.nanos = f.nanos AND s.logical = f.logical) GROUP BY ALL", "feed", "staged")
def stage_dedup_insert(t: Tables) -> DataFrame:
    """What staging appends: rows that exist stay as they are."""
    return staging.fresh(t.staged(), t.feed()).select("tbl", "key", "nanos", "logical", "seq")


@query("SELECT f.seq, f.nanos, f.logical FROM feed f WHERE NOT EXISTS (SELECT 1 FROM applied a WHERE a.tbl = f.tbl AND a.key = f.key AND a.nanos = f.nanos AND a.logical = f.logical)", "feed", "staged", "applied")
def stage_filter_applied(t: Tables) -> DataFrame:
    return modes.debounce(t.feed(), t.applied()).select("seq", "nanos", "logical")




@query("SELECT seq FROM feed WHERE (tbl, key) IN (SELECT tbl, key FROM staged ANTI JOIN applied USING (tbl, key, nanos, logical))", "feed", "staged", "applied")
def stage_if_exists_staged(t: Tables) -> DataFrame:
    """Mutations that queue behind something staged of their key."""
    return staging.split_by_pending(t.staged(), t.applied(), t.feed())[0].select("seq")


@query("SELECT seq FROM feed WHERE (tbl, key) NOT IN (SELECT tbl, key FROM staged ANTI JOIN applied USING (tbl, key, nanos, logical))", "feed", "staged", "applied")
def stage_if_exists_pending(t: Tables) -> DataFrame:
    return staging.split_by_pending(t.staged(), t.applied(), t.feed())[1].select("seq")


@query("SELECT tbl, key, nanos, logical, seq FROM staged UNION ALL SELECT tbl, key, nanos, logical, seq FROM feed WHERE seq % 4 >= 2 AND ver > 8", "feed", "staged")
def stage_overwrite(t: Tables) -> DataFrame:
    rows = t.feed().where("seq % 4 >= 2 AND ver > 8")
    return staging.overwrite(t.staged(), rows).select("tbl", "key", "nanos", "logical", "seq")


@query("SELECT tbl, key, nanos, logical FROM applied UNION SELECT tbl, key, nanos, logical FROM staged WHERE ver = 4", "feed", "staged", "applied")
def stage_mark_applied(t: Tables) -> DataFrame:
    return staging.mark(t.applied(), t.staged().where("ver = 4"))


@query(f"SELECT key, nanos, logical, seq FROM staged ANTI JOIN applied USING (tbl, key, nanos, logical) WHERE (nanos > {LOW} OR (nanos = {LOW} AND (logical > 0 OR (logical = 0 AND key > '[3')))) AND nanos < {HIGH} ORDER BY nanos, logical, key LIMIT 100", "feed", "staged", "applied")
def stage_page_keyset(t: Tables) -> DataFrame:
    return staging.page(t.staged(), t.applied(), (LOW, 0, "[3"), (HIGH, 0), 100).select("key", "nanos", "logical", "seq")


@query(f"SELECT count(*) AS n FROM staged ANTI JOIN applied USING (tbl, key, nanos, logical) WHERE nanos < {HIGH}", "feed", "staged", "applied")
def stage_count_unapplied(t: Tables) -> DataFrame:
    return staging.count_unapplied(t.staged(), t.applied(), (HIGH, 0))


@query(f"SELECT key, nanos, logical, seq FROM staged ANTI JOIN (SELECT * FROM applied WHERE nanos < {HIGH} OR (nanos = {HIGH} AND logical <= 0)) USING (tbl, key, nanos, logical)", "feed", "staged", "applied")
def stage_retire(t: Tables) -> DataFrame:
    return staging.retire(t.staged(), t.applied(), (HIGH, 0)).select("key", "nanos", "logical", "seq")


_LOGS = f"""logs AS (SELECT 'customer' AS tbl, '[' || c_custkey || ']' AS key, {BASE} + c_custkey % 50 AS nanos, 0 AS logical FROM customer
    UNION ALL SELECT 'orders', '[' || o_orderkey || ']', {BASE} + o_custkey % 50, CAST(o_orderkey % 2 AS INTEGER) FROM orders
    UNION ALL SELECT 'part', '[' || p_partkey || ']', {BASE} + p_size, 0 FROM part)"""


def _logs(t: Tables) -> DataFrame:
    def log(name: str, pk: str, clock: str, logical: str = "0") -> DataFrame:
        return t(name).selectExpr(f"concat('[', {pk}, ']') AS key", f"CAST({BASE} + {clock} AS BIGINT) AS nanos", f"CAST({logical} AS INT) AS logical")

    return staging.by_time({"customer": log("customer", "c_custkey", "c_custkey % 50"), "orders": log("orders", "o_orderkey", "o_custkey % 50", "o_orderkey % 2"), "part": log("part", "p_partkey", "p_size")})


@query(f"WITH {_LOGS} SELECT nanos, logical, count(DISTINCT tbl) AS n_tables, count(*) AS n_rows FROM logs GROUP BY ALL")
def merge_tables_by_time(t: Tables) -> DataFrame:
    """Source transactions across tables."""
    return staging.transactions(_logs(t))


@query(f"WITH {_LOGS} SELECT tbl, count(*) AS n_rows, min(nanos) AS first_nanos, min_by(logical, nanos * 2 + logical) AS first_logical, max(nanos) AS last_nanos, max_by(logical, nanos * 2 + logical) AS last_logical FROM logs GROUP BY tbl")
def coalesce_by_table(t: Tables) -> DataFrame:
    return staging.by_table(_logs(t))


@query(f"""WITH RECURSIVE {_LOGS}, tx AS (SELECT row_number() OVER (ORDER BY nanos, logical) AS i, nanos, logical, count(DISTINCT tbl) AS n_tables, count(*) AS n_rows FROM logs GROUP BY nanos, logical),
    f AS (SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS waiting, CAST(0 AS BIGINT) AS next, CAST(0 AS BIGINT) AS flush
    UNION ALL SELECT tx.i, CASE WHEN f.waiting + n_rows >= 70 THEN 0 ELSE f.waiting + n_rows END, CASE WHEN f.waiting + n_rows >= 70 THEN f.next + 1 ELSE f.next END, f.next FROM f JOIN tx ON tx.i = f.i + 1)
    SELECT nanos, logical, n_tables, n_rows, flush FROM f JOIN tx USING (i)""")
def copier_flush_groups(t: Tables) -> DataFrame:
    """Whole transactions, flushed as soon as 70 mutations wait."""
    return staging.flush_groups(_logs(t), 70)


@query("SELECT 'orders' AS tbl, key, ver, is_delete FROM latest_in ".replace("latest_in", f"(SELECT * FROM feed f WHERE nanos < {HIGH} AND NOT EXISTS (SELECT 1 FROM applied a WHERE a.key = f.key AND a.nanos = f.nanos AND a.logical = f.logical) QUALIFY row_number() OVER (PARTITION BY tbl, key ORDER BY nanos DESC, logical DESC, seq DESC) = 1)"), "feed", "staged", "applied")
def consistent_sweep(t: Tables) -> DataFrame:
    """Whole source transactions in the window, one mutation for each key."""
    return modes.consistent_batch(t.feed(), t.applied(), hlc.Range((0, 0), (HIGH, 0))).select("tbl", "key", "ver", "is_delete")


_LINES = "lines AS (SELECT 'lineitem' AS tbl, '[' || l_orderkey || ',' || l_linenumber || ']' AS key, CASE WHEN l_orderkey % 13 = 0 THEN -l_orderkey ELSE l_orderkey END AS parent, l_orderkey AS nanos, l_linenumber AS logical FROM lineitem), earlier AS (SELECT tbl, key, nanos - 1 AS nanos, logical FROM lines WHERE nanos % 10 = 0)"


@query(f"WITH {_LINES} SELECT key, nanos, logical, CASE WHEN parent < 0 OR nanos % 10 = 0 THEN 'staged' ELSE 'applied' END AS way FROM lines")
def best_effort_split(t: Tables) -> DataFrame:
    """Lines whose order is unknown, or that have something staged before, are staged; the rest is applied."""
    rows = t("lineitem").selectExpr("'lineitem' AS tbl", "concat('[', l_orderkey, ',', l_linenumber, ']') AS key", "CASE WHEN l_orderkey % 13 = 0 THEN -l_orderkey ELSE l_orderkey END AS parent", "l_orderkey AS nanos", "CAST(l_linenumber AS INT) AS logical")
    staged = rows.where("nanos % 10 = 0").selectExpr("tbl", "key", "nanos - 1 AS nanos", "logical")
    now, later = modes.best_effort_batch(staged, staged.where("false"), rows, t("orders").selectExpr("o_orderkey AS id"))
    return now.select("key", "nanos", "logical", F.lit("applied").alias("way")).unionAll(later.select("key", "nanos", "logical", F.lit("staged").alias("way")))


# ---------------------------------------------------------------- checkpoints

_REFRESH = """SELECT grp, coalesce(low // 2, 0) AS low_nanos, CAST(coalesce(low % 2, 0) AS INTEGER) AS low_logical, high // 2 AS high_nanos, CAST(high % 2 AS INTEGER) AS high_logical FROM (
    SELECT e.grp, e.high, (SELECT max(c) FROM log l WHERE l.grp = e.grp AND l.applied AND c <= e.high AND c < coalesce((SELECT min(c) FROM log g WHERE g.grp = e.grp AND NOT g.applied), 9e18)) AS low
    FROM (SELECT grp, min(last) AS high FROM (SELECT grp, part, max(c) AS last FROM log GROUP BY grp, part) GROUP BY grp) e)"""


@query("SELECT * FROM (WITH log AS (SELECT *, nanos * 2 + logical AS c FROM checkpoints) " + _REFRESH + ")", "checkpoints")
def checkpoint_refresh(t: Tables) -> DataFrame:
    return checkpoint.refresh(t.checkpoints())


@query("SELECT * FROM (WITH log AS (SELECT grp, part, nanos, logical, nanos * 2 + logical AS c, applied OR nanos BETWEEN 100 AND 400 AND nanos <> 250 AS applied FROM checkpoints) " + _REFRESH + ")", "checkpoints")
def checkpoint_gap(t: Tables) -> DataFrame:
    """Ranges committed out of order leave a gap; the window starts before it."""
    log = checkpoint.commit(t.checkpoints(), hlc.Range((100, 0), (250, 0)))
    return checkpoint.refresh(checkpoint.commit(log, hlc.Range((250, 2), (401, 0))))


@query("SELECT * FROM (WITH log AS (SELECT grp, part, nanos, logical, nanos * 2 + logical AS c, true AS applied FROM checkpoints UNION ALL SELECT 'g1', 'new', 1, 1, 3, true) " + _REFRESH + ")", "checkpoints")
def checkpoint_new_partition(t: Tables) -> DataFrame:
    """A partition that was just added holds its group's window at the seed."""
    log = t.checkpoints().withColumn("applied", F.lit(True))
    new = t.spark.createDataFrame([("g1", "new"), ("g1", "p0")], "grp string, part string")
    return checkpoint.refresh(checkpoint.ensure(log, new))


@query("SELECT c.grp, c.part, 400 + c.n AS nanos FROM (SELECT grp, part, count(*) AS n, max(nanos) AS last FROM checkpoints GROUP BY grp, part) c WHERE 400 + c.n < last OR (400 + c.n = last AND 0 < (SELECT max(logical) FROM checkpoints k WHERE k.grp = c.grp AND k.part = c.part AND k.nanos = c.last))", "checkpoints")
def checkpoint_advance_guard(t: Tables) -> DataFrame:
    """Checkpoints that would go backwards."""
    new = t.checkpoints().groupBy("grp", "part").agg((F.count("*") + 400).alias("nanos")).select("grp", "part", "nanos", F.lit(0).alias("logical"))
    return checkpoint.going_backwards(t.checkpoints(), new).select("grp", "part", "nanos")


@query("SELECT DISTINCT grp FROM checkpoints WHERE NOT applied", "checkpoints")
def checkpoint_groups(t: Tables) -> DataFrame:
    return checkpoint.unapplied_groups(t.checkpoints())


@query(f"WITH {_LOGS} SELECT min(nanos) AS nanos, min_by(logical, nanos * 2 + logical) AS logical FROM (SELECT tbl, max(nanos) AS nanos, max_by(logical, nanos * 2 + logical) AS logical FROM logs GROUP BY tbl)")
def common_progress(t: Tables) -> DataFrame:
    log = _logs(t)
    return checkpoint.common_progress(log, log.select("tbl").distinct())


@query(f"WITH {_LOGS} SELECT min(nanos) AS nanos, min(logical) AS logical FROM logs WHERE false HAVING count(*) > 0")
def common_progress_absent(t: Tables) -> DataFrame:
    """A table without progress leaves no common one."""
    log = _logs(t)
    return checkpoint.common_progress(log, log.select("tbl").distinct().unionAll(t.spark.createDataFrame([("none",)], "tbl string")))


# ---------------------------------------------------------------- references

_REFERENCES = [("nation", "region"), ("customer", "nation"), ("supplier", "nation"), ("orders", "customer"), ("lineitem", "orders"), ("lineitem", "part"), ("lineitem", "supplier"), ("part", "part"), ("a", "b"), ("b", "a"), ("c", "a")]
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _depths(t: Tables, tables: list[str]) -> DataFrame:
    names = t.spark.createDataFrame([(n,) for n in tables], "tbl string")
    return catalog.depths(t.spark, names, t.spark.createDataFrame([r for r in _REFERENCES if r[0] in tables], "child string, parent string"))


_VALUES = ", ".join(f"('{c}', '{p}')" for c, p in _REFERENCES if c != p)
_NAMES = ", ".join(f"('{n}')" for n in _TABLES)
_WALK = "WITH RECURSIVE refs(child, parent) AS (VALUES {refs}), names(tbl) AS (VALUES {names}), walk AS (SELECT tbl, 0 AS depth FROM names WHERE tbl NOT IN (SELECT child FROM refs) UNION ALL SELECT child, depth + 1 FROM walk JOIN refs ON parent = tbl WHERE depth < (SELECT count(*) FROM names))"


@query(_WALK.format(refs=_VALUES, names=_NAMES) + " SELECT tbl, max(depth) AS depth FROM walk GROUP BY tbl")
def fk_dependency_order(t: Tables) -> DataFrame:
    return _depths(t, _TABLES)


@query("SELECT * FROM (VALUES ('a', -1), ('b', -1), ('c', -1), ('nation', 1), ('region', 0)) AS v(tbl, depth)")
def fk_cycle_detect(t: Tables) -> DataFrame:
    """Members and descendants of a cycle have no depth."""
    return _depths(t, ["region", "nation", "a", "b", "c"])


@query("SELECT l_orderkey AS parent, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0) GROUP BY l_orderkey")
def fk_orphan_children(t: Tables) -> DataFrame:
    lines = t("lineitem").select(F.col("l_orderkey").alias("parent"))
    return catalog.orphans(lines, t("orders").where("o_orderkey % 9 <> 0"), "parent", "o_orderkey").groupBy("parent").agg(F.count("*").alias("n"))


@query("SELECT column_name, kind, is_key FROM (VALUES ('c_custkey', 'bigint', true), ('c_name', 'string', false), ('c_nationkey', 'int', false), ('c_acctbal', 'double', false), ('c_mktsegment', 'string', false)) AS v(column_name, kind, is_key)")
def catalog_columns(t: Tables) -> DataFrame:
    t("customer").createOrReplaceTempView("__customer")
    found = catalog.Catalog.discovered(t.spark, {"__customer": ("c_custkey",)}).tables["__customer"]
    return t.spark.createDataFrame([(c.name, c.type, c.primary) for c in found.columns], "column_name string, kind string, is_key boolean")


# ---------------------------------------------------------------- hooks

ITEM = Table.of("item", "k long, v string", ("k",))


def _documents(t: Tables) -> DataFrame:
    docs = t("orders").selectExpr("'source' AS tbl", "concat('[', o_orderkey, ']') AS key", "CASE WHEN o_orderkey % 11 <> 0 THEN to_json(named_struct('k', o_orderkey, 'v', o_orderstatus)) END AS data", f"CAST({BASE} + o_orderkey AS BIGINT) AS nanos", "0 AS logical")
    return docs.withColumn("is_delete", F.col("data").isNull())


@query("SELECT 'all' AS tbl, o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 11 <> 0 UNION ALL SELECT 'open', o_orderkey, lower(o_orderstatus) FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderstatus = 'O'")
def dispatch_fanout(t: Tables) -> DataFrame:
    """One document to one or two tables."""
    value = F.get_json_object("data", "$.v")
    low = F.when(value == "O", F.to_json(F.struct(F.get_json_object("data", "$.k").cast("long").alias("k"), F.lower(value).alias("v"))))
    hook = lambda doc, meta: F.array(F.struct(F.lit("all").alias("tbl"), doc.alias("doc")), F.struct(F.lit("open").alias("tbl"), low.alias("doc")))
    out = hooks.rekey(hooks.dispatch(_documents(t).where("NOT is_delete"), hook), ITEM)
    return out.select("tbl", F.get_json_object("key", "$[0]").cast("long").alias("k"), F.get_json_object("data", "$.v").alias("v"))


@query("SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS tbl, '[' || o_orderkey || ']' AS key, true AS is_delete FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 3 <> 0")
def deletes_to(t: Tables) -> DataFrame:
    k = F.get_json_object("key", "$[0]").cast("long")
    gone = _documents(t).where("is_delete")
    return hooks.route_deletes(gone, lambda _: F.when(k % 3 == 0, F.lit(None)).when(k % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))).select("tbl", "key", "is_delete")


@query("SELECT '[' || (o_orderkey + 1000000) || ']' AS key FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 4 <> 0")
def delete_key_rewrite(t: Tables) -> DataFrame:
    k = F.get_json_object("key", "$[0]").cast("long")
    hook = lambda _: F.when(k % 4 != 0, F.concat(F.lit("["), (k + 1000000).cast("string"), F.lit("]")))
    return hooks.map_keys(_documents(t).where("is_delete"), hook, 1).select("key")


@query("SELECT o_orderkey AS k, 'was ' || o_orderstatus AS v FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderstatus <> 'P'")
def map_filter(t: Tables) -> DataFrame:
    """A map hook changes documents and drops some."""
    value = F.get_json_object("data", "$.v")
    hook = lambda doc, meta: F.when(value != "P", F.to_json(F.struct(F.get_json_object(doc, "$.k").cast("long").alias("k"), F.concat(F.lit("was "), value).alias("v"))))
    out = hooks.map_documents(_documents(t).where("NOT is_delete"), hook)
    return out.select(F.get_json_object("data", "$.k").cast("long").alias("k"), F.get_json_object("data", "$.v").alias("v"))


@query("SELECT o_orderkey + 9007199254740993 AS k, o_orderstatus || '!' AS v FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderstatus <> 'P'")
def python_row_hook(t: Tables) -> DataFrame:
    """A Python function on documents; whole numbers keep their digits."""

    def hook(doc: dict) -> dict | None:
        return None if doc["v"] == "P" else {"k": doc["k"] + 2**53 + 1, "v": doc["v"] + "!"}

    out = hooks.map_documents(_documents(t).where("NOT is_delete"), hooks.row_hook(hook))
    return out.select(F.get_json_object("data", "$.k").cast("long").alias("k"), F.get_json_object("data", "$.v").alias("v"))


@query("SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 11 <> 0")
def active_active_loop_filter(t: Tables) -> DataFrame:
    """Documents that this side wrote itself don't come back."""
    mine = F.col("nanos") % 2 == (BASE + 1) % 2
    out = hooks.map_documents(_documents(t).where("NOT is_delete"), lambda doc, meta: F.when(~mine, doc))
    return out.select(F.get_json_object("data", "$.k").cast("long").alias("k"), F.get_json_object("data", "$.v").alias("v"))


@query("SELECT o_orderstatus AS v, count(*) AS n FROM orders WHERE o_orderkey % 11 <> 0 GROUP BY ALL")
def apply_hook_sql(t: Tables) -> DataFrame:
    """An apply hook runs SQL of its own on a batch instead of the default sink."""
    context = hooks.ApplyContext(t.spark, ITEM, t.spark.createDataFrame([], "k long, v string"))
    rows = _documents(t).where("NOT is_delete").select(F.get_json_object("data", "$.v").alias("v"))
    return context.sql("SELECT v, count(*) AS n FROM batch GROUP BY v", batch=rows)


@query("SELECT 'item' AS tbl, '[' || o_orderkey || ']' AS key, lower(o_orderstatus) AS v, false AS is_delete FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderstatus <> 'P' UNION ALL SELECT 'item', '[' || (-o_orderkey) || ']', NULL, true FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 2 = 0")
def hook_pipeline(t: Tables) -> DataFrame:
    """A source's hooks in order: target, deletes, then the table's map and key."""
    value, k = F.get_json_object("data", "$.v"), F.get_json_object("key", "$[0]").cast("long")
    config = SourceConfig(
        target="item",
        deletes_to="item",
        map={"item": lambda doc, meta: F.when(value != "P", F.to_json(F.struct(F.get_json_object(doc, "$.k").cast("long").alias("k"), F.lower(value).alias("v"))))},
        delete_key={"item": lambda key: F.when(k % 2 == 0, F.concat(F.lit("["), (-k).cast("string"), F.lit("]")))},
    )
    out = hooks.pipeline(_documents(t), config, Catalog({"item": ITEM}))
    return out.select("tbl", "key", F.get_json_object("data", "$.v").alias("v"), "is_delete")


# ---------------------------------------------------------------- sources


def _line(t: Tables, keyed: bool) -> DataFrame:
    key = ',"key":[\', o_orderkey, \']' if keyed else ""
    clock = f"{BASE}' || '.0000000000"
    after = f"concat('{{\"after\":{{\"id\":', o_orderkey, ',\"v\":\"', o_orderstatus, '\"}}{key},\"updated\":\"{clock}\"}}')"
    gone = f"concat('{{\"after\":null,\"before\":{{\"id\":', o_orderkey, '}}{key},\"updated\":\"{clock}\"}}')"
    phantom = f"'{{\"after\":null,\"before\":null,\"updated\":\"{clock}\"}}'"
    return t("orders").selectExpr(f"CASE o_orderkey % 5 WHEN 0 THEN {gone} WHEN 1 THEN {phantom} WHEN 2 THEN '  ' WHEN 3 THEN '{{\"resolved\":\"77.0000000001\"}}' ELSE {after} END AS value")


@query(f"""SELECT 'orders' AS tbl, '[' || o_orderkey || ']' AS key, CASE WHEN o_orderkey % 5 = 4 THEN '{{"id":' || o_orderkey || ',"v":"' || o_orderstatus || '"}}' END AS data, o_orderkey % 5 = 0 AS is_delete, CAST({BASE} AS BIGINT) AS nanos, 0 AS logical FROM orders WHERE o_orderkey % 5 IN (0, 4)""")
def envelope_bulk(t: Tables) -> DataFrame:
    """Bulk lines: writes, deletes, phantom deletes, blank and resolved lines."""
    return envelope.bulk_lines(_line(t, True), F.lit("orders")).select("tbl", "key", "data", "is_delete", "nanos", "logical")


@query("""SELECT '[' || o_orderkey || ']' AS key, o_orderkey % 5 = 0 AS is_delete FROM orders WHERE o_orderkey % 5 IN (0, 4)""")
def envelope_query(t: Tables) -> DataFrame:
    """Lines without keys: they come from the sides."""
    return envelope.query_lines(_line(t, False), F.lit("orders"), ["id"]).select("key", "is_delete")


@query("SELECT CAST(77 AS BIGINT) AS nanos, 1 AS logical, count(*) AS n FROM orders WHERE o_orderkey % 5 = 3")
def envelope_resolved(t: Tables) -> DataFrame:
    return envelope.resolved_lines(_line(t, True)).groupBy("nanos", "logical").agg(F.count("*").alias("n"))


@query(f"""SELECT 'item' AS tbl, '[' || l_orderkey || ',' || l_linenumber || ']' AS key, CAST({BASE} + l_linenumber AS BIGINT) AS nanos FROM lineitem WHERE l_orderkey % 4 <> 0""")
def webhook_payload(t: Tables) -> DataFrame:
    """Bodies with several lines each, and resolved ones."""
    one = F.concat(F.lit('{"after":{"n":1},"key":['), F.col("l_orderkey").cast("string"), F.lit(","), F.col("l_linenumber").cast("string"), F.lit(f'],"topic":"db.sch.item","updated":"'), (F.col("l_linenumber") + BASE).cast("string"), F.lit('.0000000000"}'))
    bodies = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(one).alias("lines"))
    full = F.concat(F.lit('{"payload":['), F.array_join("lines", ","), F.lit('],"length":'), F.size("lines").cast("string"), F.lit("}"))
    value = F.when(F.col("l_orderkey") % 4 == 0, F.lit('{"resolved":"5.0000000000"}')).otherwise(full)
    return envelope.webhook_bodies(bodies.select(value.alias("value"))).select("tbl", "key", "nanos")


@query("SELECT 'item' AS tbl, '[' || l_orderkey || ',\"' || l_returnflag || '\"]' AS key, l_linenumber % 3 = 0 AS is_delete FROM lineitem WHERE l_linenumber % 4 <> 0")
def webhook_query_payload(t: Tables) -> DataFrame:
    """Bodies of query feeds: keys come from the sides; phantom deletes go."""
    side = F.concat(F.lit('{"id":'), F.col("l_orderkey").cast("string"), F.lit(',"flag":"'), F.col("l_returnflag"), F.lit('"}'))
    n = F.col("l_linenumber")
    body = F.when(n % 4 == 0, F.lit('"after":null,"before":null')).when(n % 3 == 0, F.concat(F.lit('"after":null,"before":'), side)).otherwise(F.concat(F.lit('"after":'), side))
    one = F.concat(F.lit("{"), body, F.lit(',"topic":"db.sch.item","updated":"5.0000000000"}'))
    bodies = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(one).alias("lines"))
    value = F.concat(F.lit('{"payload":['), F.array_join("lines", ","), F.lit('],"length":'), F.size("lines").cast("string"), F.lit("}"))
    return envelope.query_webhook_bodies(bodies.select(value.alias("value")), {"item": ["id", "flag"], "other": ["k"]}).select("tbl", "key", "is_delete")


@query("""SELECT part, "offset", CASE WHEN "offset" % 10 = 4 THEN 'no clock' ELSE 'malformed' END AS error FROM messages WHERE "offset" % 10 IN (3, 4, 5)""", "messages")
def kafka_bad_messages(t: Tables) -> DataFrame:
    """Messages that can't be taken, and why; reading them as mutations is an error."""
    at = F.col("offset") % 10
    bad = F.when(at == 3, "{garbage").when(at == 4, '{"after":{"id":1}}').when(at == 5, "[1]").otherwise(F.col("value"))
    return envelope.topic_errors(t.messages().withColumn("value", bad))


@query("""SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN 'malformed' WHEN 1 THEN 'unknown field' WHEN 2 THEN 'no clock' WHEN 3 THEN 'length differs from payload' WHEN 4 THEN 'unknown field in a line' WHEN 5 THEN 'no clock in a line' END AS error FROM orders WHERE o_orderkey % 8 < 6""")
def webhook_bad_bodies(t: Tables) -> DataFrame:
    """Bodies that can't be taken, and why; of eight kinds the last two are good."""
    line = '{"after":{"n":1},"key":[1],"topic":"a.b.t"%s}'
    body = '{"payload":[%s],"length":%d}'
    good = line % ',"updated":"5.0000000000"'
    kinds = ["{garbage", '{"payloads":[]}', '{"resolved":"abc"}', body % (good, 2), body % (line % ',"updated":"5.0000000000","x":1', 1), body % (line % ',"updated":"x"', 1), body % (good, 1), '{"resolved":"5.0000000000"}']
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return envelope.webhook_errors(t("orders").select(F.col("o_orderkey").alias("id"), kind.alias("value"))).select("id", "error")


@query('SELECT part, max("offset") AS "offset" FROM messages WHERE is_resolved AND nanos < 1000000500 GROUP BY part', "messages")
def kafka_seek_resolved(t: Tables) -> DataFrame:
    return envelope.seek(t.messages(), (BASE + 500, 0))


@query(f"""SELECT part, "offset", '[' || event_id || ']' AS key, is_delete, nanos FROM messages WHERE NOT is_resolved AND nanos >= {BASE + 200} AND nanos < {BASE + 2000}""", "messages")
def kafka_time_range(t: Tables) -> DataFrame:
    rows = envelope.topic_messages(t.messages()).where(hlc.Range((BASE + 200, 0), (BASE + 2000, 0)).contains())
    return rows.select("part", "offset", "key", "is_delete", "nanos")




def _objects(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    stem = F.concat(F.lit("2024-01-"), F.lpad((k % 3 + 1).cast("string"), 2, "0"), F.lit("/"), (k % 50 + 20240101000000).cast("string"), F.lpad(k.cast("string"), 9, "0"), F.lit("0000000000"))
    return t("orders").select(F.when(k % 10 == 0, F.concat(stem, F.lit(".RESOLVED"))).when(k % 10 == 1, F.concat(stem, F.lit("-odd.txt"))).otherwise(F.concat(stem, F.lit("-0877fe-1-2-00000000-my_table-a2.ndjson"))).alias("path"))


_PATHS = """paths AS (SELECT stem || CASE WHEN k % 10 = 0 THEN '.RESOLVED' WHEN k % 10 = 1 THEN '-odd.txt' ELSE '-0877fe-1-2-00000000-my_table-a2.ndjson' END AS path FROM (
    SELECT o_orderkey AS k, '2024-01-' || lpad(CAST(o_orderkey % 3 + 1 AS VARCHAR), 2, '0') || '/' || (o_orderkey % 50 + 20240101000000) || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '0000000000' AS stem FROM orders))"""


@query(f"""WITH {_PATHS}, marks AS (SELECT path, regexp_extract(path, '([0-9]{{33}})[.]RESOLVED$', 1) AS digits, split_part(path, '/', 1) AS folder FROM paths)
    SELECT path, 'my_table' AS tbl, marker, CAST(epoch(strptime(marker[1:14], '%Y%m%d%H%M%S')) AS BIGINT) * 1000000000 + CAST(marker[15:23] AS BIGINT) AS nanos, CAST(marker[24:33] AS INTEGER) AS logical FROM (
    SELECT *, min(CASE WHEN digits <> '' THEN digits END) OVER (PARTITION BY folder ORDER BY path ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS marker FROM marks)
    WHERE path LIKE '%.ndjson' AND marker IS NOT NULL""")
def objstore_resolved_ranges(t: Tables) -> DataFrame:
    """Data files with the marker that makes them final."""
    return objects.ranges(_objects(t))


@query(f"WITH {_PATHS} SELECT CASE WHEN path LIKE '%.ndjson' THEN 'my_table' END AS tbl, count(*) AS n FROM paths GROUP BY ALL")
def objstore_table_name(t: Tables) -> DataFrame:
    return _objects(t).select(values.table_of_path(F.col("path")).alias("tbl")).groupBy("tbl").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey AS id, v.kind, CASE WHEN v.kind IS NOT NULL THEN 'db' || (o_orderkey % 7) END AS db, v.tbl,
    CASE WHEN v.kind = 'resolved' THEN '202004042351304139680000000000000' END AS marker FROM orders JOIN (VALUES (0, 'resolved', NULL), (1, 'ndjson', 'REAL-42'), (2, 'webhook', NULL), (3, 'resolved', 'a table'),
    (4, 'ndjson', 'a table'), (5, 'webhook', '2020-04-04'), (6, 'ndjson', 'My.T'), (7, NULL, NULL), (8, NULL, NULL), (9, NULL, NULL)) AS v(k, kind, tbl) ON o_orderkey % 10 = v.k""")
def url_route(t: Tables) -> DataFrame:
    """Paths to schemas and tables, with escapes and empty parts; too long ones and unfinished names lead nowhere."""
    k = F.col("o_orderkey")
    stamp = "/2020-04-04/202004042351304139680000000000000"
    rest = [f"{stamp}.RESOLVED", f"{stamp}-x-1-2-00000000-REAL-42-1.ndjson", "//", f"/a%20table{stamp}.RESOLVED", f"/a+table/{stamp}-x-1-2-00000000-t-1.ndjson", "/2020-04-04"]
    rest += [f'{stamp}-x-1-2-00000000-other."My.T"-1.ndjson', "/a/b/c/d/e/f/g", f"/x/y{stamp}.RESOLVED", f"{stamp}0.RESOLVED"]
    path = F.concat(F.lit("/db"), (k % 7).cast("string"), F.lit("/sch"), F.element_at(F.array(*map(F.lit, rest)), (k % 10 + 1).cast("int")))
    r = objects.route(path).alias("r")
    return t("orders").select(k.alias("id"), r).select("id", "r.kind", "r.db", F.col("r.table").alias("tbl"), "r.marker")


@query("""SELECT c_custkey AS id, c_custkey % 6 IN (1, 2, 4) AS less, c_custkey % 2 = 0 AS maria FROM customer""")
def gtid_order(t: Tables) -> DataFrame:
    """Sets of transaction ids, of which some are true parts of others; touching spans are one."""
    k = F.col("c_custkey")
    n = (k + 5).cast("string")
    pairs = [  # equal, part, part by another server, neither, part across touching spans, more
        ("S:1-{n}", "s:1-3:4-{n}"), ("s:2-4", "s:1-{n}"), ("s:1-{n}", "s:1-{n},t:1"), ("s:1-{n},u:3", "s:1-{n},t:1"), ("s:2-5", "s:1-3:4-{n}"), ("s:1-{n}", ""),
    ]
    text = lambda i: F.element_at(F.array(*(F.replace(F.lit(p[i]), F.lit("{n}"), n) for p in pairs)), (k % 6 + 1).cast("int"))
    maria = logical.gtid_less(F.concat(F.lit("0-1-"), n), F.concat(F.lit("0-1-"), (k + 6 - k % 2).cast("string"), F.lit(", 1-1-7")), "mariadb")
    lower = logical.gtid_less(F.concat(F.lit("0-2-"), n), F.concat(F.lit("0-1-"), n), "mariadb")
    return t("customer").select(k.alias("id"), logical.gtid_less(text(0), text(1)).alias("less"), ((k % 2 == 0) & maria & ~lower).alias("maria"))


@query("SELECT p_partkey AS id, p_size % 5 IN (0, 1, 2) AS same FROM part")
def deep_equal(t: Tables) -> DataFrame:
    """Values inside objects and lists: a number equals its text in any form, a boolean only itself, an order of keys is none."""
    size = F.col("p_size").cast("string")
    ten = F.concat(size, F.lit("0"))
    a = F.concat(F.lit('{"b": [1.50, {"x": '), ten, F.lit(', "y": null}], "a": true}'))
    x = F.element_at(F.array(ten, F.concat(F.lit('"'), ten, F.lit('"')), F.concat(size, F.lit("e+1")), F.concat(F.lit("1"), ten), ten), (F.col("p_size") % 5 + 1).cast("int"))
    flag = F.when(F.col("p_size") % 5 == 4, F.lit('"true"')).otherwise(F.lit("true"))
    b = F.concat(F.lit('{"a":'), flag, F.lit(',"b":["1.5",{"y":null,"x":'), x, F.lit("}]}"))
    return t("part").select(F.col("p_partkey").alias("id"), values.same_value(a, b).alias("same"))


@query("SELECT p_partkey AS id, p_partkey % 5 * 300 + length(p_name) AS n, p_partkey % 5 * 300 + length(p_name) > 1024 AS packed, md5(p_name || repeat('x', CAST(p_partkey % 5 * 300 AS BIGINT))) AS digest FROM part")
def gzip_long_values(t: Tables) -> DataFrame:
    """Long values are stored compressed and come back as they were; short ones are stored as they are."""
    raw = F.concat("p_name", F.repeat(F.lit("x"), (F.col("p_partkey") % 5 * 300).cast("int"))).cast("binary")
    rows = t("part").select(F.col("p_partkey").alias("id"), raw.alias("raw")).select("id", "raw", values.gzip_value("raw").alias("kept"))
    back = rows.withColumn("back", values.gunzip_value("kept"))
    return back.select("id", F.length("raw").cast("long").alias("n"), (F.length("kept") < F.length("raw")).alias("packed"), F.md5("back").alias("digest"))


@query("""SELECT o_orderkey AS id, upper(lpad(to_hex(o_orderkey), 32, '0')) AS raw, CAST(o_orderdate AS DATE) AS day, CAST(epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) + 45296120000 - CASE WHEN o_orderkey % 2 = 0 THEN 7200000000 ELSE 0 END AS at FROM orders""")
def typed_texts(t: Tables) -> DataFrame:
    """UUIDs, times with and without zone, and dates, from their texts."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    digits = F.lpad(F.lower(F.hex(k)), 32, "0")
    dashed = F.concat_ws("-", *(digits.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    raw = F.when(k % 3 == 0, dashed).when(k % 3 == 1, F.concat(F.lit("\\x"), digits)).otherwise(F.concat(F.lit("{"), dashed, F.lit("}")))
    clock = F.concat(day, F.lit("T12:34:56.12"), F.when(k % 2 == 0, "+02:00").otherwise(""))
    at = F.unix_micros(values.typed_text(clock, "TIMESTAMP(6)"))
    return t("orders").select(k.alias("id"), F.hex(values.typed_text(raw, "RAW(16)")).alias("raw"), values.typed_text(day, "DATE").alias("day"), at.alias("at"))


@query("SELECT key FROM feed WHERE seq % 5 <> 0", "feed")
def stub_filter(t: Tables) -> DataFrame:
    """What another writer's staging table emits: everything but its stubs."""
    rows = t.feed().withColumn("data", F.when(F.col("seq") % 10 == 0, F.lit('{"__stub__":true}')).when(F.col("seq") % 5 == 0, F.lit('{"__stub__": true}')).when(F.col("seq") % 7 == 0, F.lit(None)).otherwise(F.lit('{"__stub__":false}')))
    return staging.emitted(rows).select("key")


@query("SELECT 't' || (c_custkey % 40) AS tbl, 'c' || (c_custkey % 120) AS column_name, min(c_custkey) AS ordinal, bool_or(c_custkey % 7 = 0) AS is_key, min_by(c_mktsegment, c_custkey) AS kind FROM customer GROUP BY ALL")
def catalog_columns_once(t: Tables) -> DataFrame:
    """Columns of an information schema that names a column once for each of its constraints."""
    k = F.col("c_custkey")
    info = t("customer").select(F.concat(F.lit("t"), (k % 40).cast("string")).alias("tbl"), F.concat(F.lit("c"), (k % 120).cast("string")).alias("column_name"), F.col("c_mktsegment").alias("kind"), k.alias("ordinal"), (k % 7 == 0).alias("is_key"), F.lit(False).alias("is_generated"), F.lit(None).cast("string").alias("default"))
    return catalog.columns_once(info).select("tbl", "column_name", "ordinal", "is_key", "kind")


@query("""SELECT '[' || o_orderkey || ']' AS key, CASE o_orderkey % 6 WHEN 0 THEN 'values that don''t fit: v' WHEN 1 THEN 'missing keys: k' WHEN 2 THEN 'unexpected columns: z' WHEN 3 THEN 'a delete''s key has another length' END AS reason FROM orders WHERE o_orderkey % 6 < 4""")
def refused_mutations(t: Tables) -> DataFrame:
    """Mutations that a table can't take, each with what is wrong with it."""
    k = F.col("o_orderkey")
    s = k.cast("string")
    bodies = ['{"k":#,"v":"x"}', '{"v":1}', '{"k":#,"v":1,"z":2}', None, '{"k":#,"v":7}', None]
    data = F.element_at(F.array(*(F.replace(F.lit(b), F.lit("#"), s) for b in bodies)), (k % 6 + 1).cast("int"))
    own = F.concat(F.lit("["), s, F.when(k % 6 == 3, F.lit(",1]")).otherwise(F.lit("]")))
    rows = t("orders").select(F.lit("t").alias("tbl"), own.alias("key"), data.alias("data"), k.alias("nanos"), F.lit(0).alias("logical")).withColumn("is_delete", F.col("data").isNull())
    out = mapping.refused(rows, Table.of("t", "k long, v int", ("k",)))
    return out.select(F.concat(F.lit("["), F.regexp_extract("key", "([0-9]+)", 1), F.lit("]")).alias("key"), "reason")


@query("SELECT o_custkey * 100000000 + 99999999 AS nanos, '[' || o_orderkey || ']' AS key, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS data, o_orderkey % 3 = 0 AS is_delete FROM orders WHERE o_custkey % 10 <> 0 AND o_custkey > 20")
def wal_transactions(t: Tables) -> DataFrame:
    """Log events grouped by commit; replays and open transactions go."""
    rows = t("orders").selectExpr("o_custkey * 100000000 + o_orderkey AS lsn", "o_custkey AS xid", "CASE WHEN o_orderkey % 3 = 0 THEN 'delete' WHEN o_orderkey % 3 = 1 THEN 'insert' ELSE 'update' END AS kind", "'orders' AS tbl", "concat('[', o_orderkey, ']') AS key", "o_orderstatus AS data")
    commits = t("orders").where("o_custkey % 10 <> 0").selectExpr("o_custkey * 100000000 + 99999999 AS lsn", "o_custkey AS xid", "'commit' AS kind", "CAST(NULL AS STRING) AS tbl", "CAST(NULL AS STRING) AS key", "CAST(NULL AS STRING) AS data").distinct()
    return logical.wal_mutations(rows.unionAll(commits), saved_lsn=20 * 100000000 + 99999999).select("nanos", "key", "data", "is_delete")


@query("SELECT l_orderkey AS seq, CASE l_orderkey % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS kind, 'after ' || l_linenumber AS data FROM lineitem UNION ALL SELECT l_orderkey, CASE l_orderkey % 3 WHEN 0 THEN 'insert' ELSE 'delete' END, 'before ' || l_linenumber FROM lineitem WHERE l_orderkey % 3 <> 1")
def binlog_rows(t: Tables) -> DataFrame:
    """Of an update's alternating rows only the later of each pair counts."""
    pair = F.struct(F.concat(F.lit("before "), F.col("l_linenumber").cast("string")).alias("b"), F.concat(F.lit("after "), F.col("l_linenumber").cast("string")).alias("a"))
    events = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(pair).alias("p")).select(F.col("l_orderkey").alias("seq"), F.when(F.col("l_orderkey") % 3 == 0, "insert").when(F.col("l_orderkey") % 3 == 1, "update").otherwise("delete").alias("kind"), F.lit("lineitem").alias("tbl"), F.lit(True).alias("has_key"), F.flatten(F.transform("p", lambda p: F.array(p["b"], p["a"]))).alias("rows"))
    return logical.binlog_mutations(events).select("seq", "kind", "data")


@query("SELECT c_custkey AS id, 's' || (c_custkey % 3) AS server, CAST(1 AS BIGINT) AS low, c_custkey AS high FROM customer UNION ALL SELECT c_custkey, 's' || (c_custkey % 3), c_custkey + 5, c_custkey + 5 FROM customer UNION ALL SELECT c_custkey, 'z', 3, 9 FROM customer")
def gtid_sets(t: Tables) -> DataFrame:
    s = F.col("c_custkey").cast("string")
    text = F.concat(F.lit("s"), (F.col("c_custkey") % 3).cast("string"), F.lit(":1-"), s, F.lit(":"), (F.col("c_custkey") + 5).cast("string"), F.lit(", z:3-9"))
    return logical.gtid_intervals(t("customer").select(F.col("c_custkey").alias("id"), text.alias("gtid"))).select("id", "server", "low", "high")


@query("SELECT 'q' || (c_custkey % 3) AS queue, c_custkey AS value FROM customer WHERE c_custkey % 5 = 0 AND c_custkey < (SELECT min(c_custkey) FROM customer WHERE c_custkey % 7 = 0 AND c_custkey > 60)")
def consistent_markers(t: Tables) -> DataFrame:
    rows = t("customer").selectExpr("concat('q', c_custkey % 3) AS queue", "c_custkey AS value", "c_custkey % 7 = 0 AND c_custkey > 60 AS pending", "c_custkey % 5 = 0 AS marker")
    return logical.consistent_points(rows)


@query("SELECT tbl, count(*) AS n, count(DISTINCT id) AS ids, CAST(sum(val) AS BIGINT) AS val FROM (SELECT CASE WHEN s % 5 < 2 THEN 'parent' ELSE 'child' END AS tbl, CASE s % 5 WHEN 0 THEN s // 5 WHEN 1 THEN s // 10 WHEN 2 THEN s // 5 * 2 WHEN 3 THEN s // 5 * 2 + 1 ELSE s // 10 * 2 END AS id, s * 7 % 1000 AS val FROM range(0, 5000) AS r(s)) GROUP BY tbl")
def workload_steps(t: Tables) -> DataFrame:
    return workload.steps(t.spark, 5000).groupBy("tbl").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.sum("val").alias("val"))


@query("SELECT what, CAST(n AS BIGINT) AS n FROM (VALUES ('child orphan', 286), ('parent missing', 143)) AS v(what, n)")
def workload_check(t: Tables) -> DataFrame:
    """The checker finds parents that were lost on the way, and their children."""
    last = last_by_key(workload.steps(t.spark, 5000))
    parents, children = last.where("tbl = 'parent'").select("id", "val"), last.where("tbl = 'child'").select("id", "parent", "val")
    return workload.check(parents.where("id % 7 <> 0"), children, parents, children)


# ---------------------------------------------------------------- modes


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 OR c_custkey * 13 % 4000 <= (c_custkey % 11 * 400) / 4 THEN 'consistent' WHEN c_custkey * 13 % 4000 >= c_custkey % 11 * 400 THEN 'best_effort' WHEN c_custkey % 3 = 0 THEN 'consistent' ELSE 'best_effort' END AS mode FROM customer")
def mode_decision(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    current = F.when(c % 3 == 0, "consistent").when(c % 3 == 1, "best_effort")
    return t("customer").select(c.alias("id"), modes.mode_column(current, c * 13 % 4000, c % 11 * 400).alias("mode"))


@query("""WITH RECURSIVE b AS (SELECT o_custkey AS batch, list(DISTINCT o_orderkey % 400) AS keys FROM orders GROUP BY o_custkey), n AS (SELECT row_number() OVER (ORDER BY batch) AS i, * FROM b),
    f AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS batch, false AS held, [CAST(7 AS BIGINT), 190] AS bad
    UNION ALL SELECT n.i, n.batch, list_has_any(f.bad, n.keys), CASE WHEN list_has_any(f.bad, n.keys) THEN list_distinct(list_concat(f.bad, n.keys)) ELSE f.bad END FROM f JOIN n ON n.i = f.i + 1)
    SELECT batch FROM f WHERE held""")
def poison_contagion(t: Tables) -> DataFrame:
    """Batches held back by two failed keys, directly or through one another, to the end."""
    batches = t("orders").select(F.col("o_custkey").alias("batch"), (F.col("o_orderkey") % 400).alias("key")).distinct()
    return poison.spread(batches, t.spark.createDataFrame([(7, 0), (190, 0)], "key long, since long"))


@query("SELECT 'l' || c_custkey AS name, 'me' AS nonce FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0")
def lease_acquire(t: Tables) -> DataFrame:
    """Leases that nobody else holds: free, over, or held by the same one."""
    name = F.concat(F.lit("l"), F.col("c_custkey").cast("string"))
    held = t("customer").where("c_custkey % 4 = 0").select(name.alias("name"), F.when(F.col("c_custkey") % 3 == 0, 5).otherwise(50).alias("expires"), F.when(F.col("c_custkey") % 5 == 0, "me").otherwise("other").alias("nonce"))
    wanted = t("customer").select(name.alias("name"), F.lit(99).alias("expires"), F.lit("me").alias("nonce"))
    return control.acquire(held, wanted, F.lit(10)).select("name", "nonce")


@query("SELECT count(*) AS n_rows, count(*) FILTER (event_id % 9 = 0) AS n_deletes, min(event_id) AS first_nanos, max(event_id) AS last_nanos FROM events")
def batch_metrics(t: Tables) -> DataFrame:
    """What a batch counts of itself while it is written somewhere."""
    rows = t("events").select(F.col("event_id").alias("nanos"), F.lit(0).alias("logical"), (F.col("event_id") % 9 == 0).alias("is_delete"))
    batch, seen = control.observed(rows, "batch")
    batch.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame([tuple(seen.get[c] for c in ("n_rows", "n_deletes", "first_nanos", "last_nanos"))], "n_rows long, n_deletes long, first_nanos long, last_nanos long")


@query("SELECT user_id, max_by(event_id, (epoch_us(ts), event_id)) AS event_id FROM events GROUP BY user_id")
def memo_latest(t: Tables) -> DataFrame:
    """The last value put under each key."""
    puts = t("events").select(F.lit("memo").alias("tbl"), F.col("user_id").cast("string").alias("key"), "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("nanos"), F.lit(0).alias("logical"), F.col("event_id").alias("seq"))
    return last_by_key(puts).select("user_id", F.col("seq").alias("event_id"))
