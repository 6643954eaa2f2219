"""Queries on applying mutations: dedup, upsert, mapping, compare-and-set, merge, dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators import dedup, mapping, resolve
from tidelog.operators import target as sink
from tidelog.plans.catalog import Table
from tidelog.plans.config import TableConfig
from tidelog.plans.feeds import BASE, Tables, query
from tidelog.streaming import modes

ROW = ["pk", "ver", "status", "price", "ts"]


def _latest(t: Tables) -> DataFrame:
    return dedup.last_by_key(t.feed())


def _writes(t: Tables) -> DataFrame:
    return _latest(t).where("NOT is_delete").select(*ROW)


@query("SELECT tbl, key, nanos, logical, seq, ver, status, is_delete FROM latest", "feed", "latest")
def dedup_by_key(t: Tables) -> DataFrame:
    return _latest(t).select("tbl", "key", "nanos", "logical", "seq", "ver", "status", "is_delete")


@query(f"SELECT tbl, key, CAST({BASE} AS BIGINT) AS nanos, logical, max(seq) AS seq FROM feed GROUP BY ALL", "feed")
def dedup_by_time_key(t: Tables) -> DataFrame:
    return dedup.last_by_time_key(t.feed().withColumn("nanos", F.lit(BASE).cast("long"))).select("tbl", "key", "nanos", "logical", "seq")


@query("""SELECT status, count(*) AS n, CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS price, CAST(sum(ver) AS BIGINT) AS ver FROM (
    SELECT t.ver, t.status, t.price FROM target t WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.pk = t.pk AND NOT is_delete AND l.ver > t.ver) AND NOT EXISTS (SELECT 1 FROM latest l WHERE l.pk = t.pk AND is_delete)
    UNION ALL SELECT l.ver, l.status, l.price FROM latest l LEFT JOIN target t ON t.pk = l.pk WHERE NOT is_delete AND (t.pk IS NULL OR l.ver > t.ver)) GROUP BY status""", "feed", "latest", "target")
def change_feed_by_status(t: Tables) -> DataFrame:
    """The flagship: a feed deduplicated, deletes and compare-and-set writes applied to a target, then summed up."""
    state, _ = modes.apply_batch(t.target(), t.feed(), ["pk"], cas=["ver"])
    return state.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price"), F.sum("ver").cast("long").alias("ver"))


@query("SELECT pk, ver, status, price, ts FROM target WHERE pk NOT IN (SELECT pk FROM latest WHERE NOT is_delete) UNION ALL SELECT pk, ver, status, price, ts FROM latest WHERE NOT is_delete", "feed", "latest", "target")
def apply_upsert(t: Tables) -> DataFrame:
    return sink.upsert(t.target(), _writes(t), ["pk"])


@query("SELECT * FROM target WHERE pk NOT IN (SELECT pk FROM latest WHERE is_delete)", "feed", "latest", "target")
def apply_delete(t: Tables) -> DataFrame:
    return sink.delete(t.target(), _latest(t).where("is_delete"), ["pk"])


@query("SELECT pk, ver, status, price, ts FROM target WHERE pk NOT IN (SELECT pk FROM latest) UNION ALL SELECT pk, ver, status, price, ts FROM latest WHERE NOT is_delete", "feed", "latest", "target")
def apply_upsert_delete_mix(t: Tables) -> DataFrame:
    return sink.apply(t.target(), _latest(t), ["pk"])


@query("SELECT pk FROM target UNION SELECT pk FROM latest WHERE NOT is_delete", "feed", "latest", "target")
def apply_pk_only_ignore(t: Tables) -> DataFrame:
    return sink.upsert(t.target().select("pk"), _writes(t).select("pk"), ["pk"])


@query("SELECT t.pk, coalesce(l.ver, t.ver) AS ver, t.status, t.price, t.ts FROM target t LEFT JOIN latest l ON l.pk = t.pk AND NOT is_delete UNION ALL SELECT pk, ver, NULL, NULL, NULL FROM latest WHERE NOT is_delete AND pk NOT IN (SELECT pk FROM target)", "feed", "latest", "target")
def apply_partial_columns(t: Tables) -> DataFrame:
    """Columns that the payload lacks keep the target's value."""
    return sink.upsert(t.target(), _writes(t).select("pk", "ver"), ["pk"])


@sink.strategy("add_prices")
def _add_prices(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    both = target.join(rows.select(*keys, F.col("price").alias("more")), keys, "left")
    return both.withColumn("price", F.round(F.col("price") + F.coalesce("more", F.lit(0.0)), 2)).select(*target.columns)


@query("SELECT t.pk, t.ver, t.status, round(t.price + coalesce(l.price, 0), 2) AS price, t.ts FROM target t LEFT JOIN latest l ON l.pk = t.pk AND NOT is_delete", "feed", "latest", "target")
def apply_custom_strategy(t: Tables) -> DataFrame:
    return sink.apply_custom(t.target(), _writes(t), ["pk"], "add_prices")


# ---------------------------------------------------------------- mapping

PARTS = Table.of("parts", "id long, name string, size int, brand string, price double, extras string, changed string", ("id",), defaults={"brand": "'none'"}, generated=("changed",))


def _payloads(t: Tables, *parts: str) -> DataFrame:
    """Parts as JSON documents; every third lacks its brand, every fifth has a null one."""
    fields = {
        "id": "concat('\"ID\":', p_partkey)",
        "name": "concat('\"name\":', to_json(named_struct('x', p_name)))",
        "size": "concat('\"size\":', p_size)",
        "brand": "CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN '\"brand\":null' ELSE concat('\"brand\":\"', p_brand, '\"') END",
        "zeta": "concat('\"zeta\":', p_size)",
        "alpha": "CASE WHEN p_partkey % 2 = 0 THEN '\"alpha\":{\"b\":1,\"a\":[true,null]}' END",
        "label": "concat('\"label\":\"', p_type, '\"')",
    }
    body = ", ".join(fields[p] for p in parts)
    return t("part").selectExpr("p_partkey", f"concat('{{', concat_ws(',', {body}), '}}') AS data").selectExpr("p_partkey AS seq", "data")


@query("SELECT p_partkey AS id, p_size AS size, CASE WHEN p_partkey % 3 = 0 THEN 'none' WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS brand FROM part")
def apply_default_fill(t: Tables) -> DataFrame:
    """An absent property takes the default, a null one stays null."""
    out = mapping.valid(mapping.map_columns(_payloads(t, "id", "size", "brand"), PARTS))
    return out.select("id", "size", "brand")


@query("SELECT 2 * p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'none' WHEN p_partkey % 5 <> 0 THEN p_brand || ' world!' END AS brand, 'constant' AS name FROM part")
def apply_expr_columns(t: Tables) -> DataFrame:
    config = TableConfig(exprs={"id": "2 * $0", "brand": "$0 || ' world!'", "name": "'constant'"})
    return mapping.valid(mapping.map_columns(_payloads(t, "id", "size", "brand"), PARTS, config)).select("id", "brand", "name")


@query("SELECT 2 * o_orderkey AS id, o_orderkey % 4 <> 0 AS arity FROM orders")
def delete_key_exprs(t: Tables) -> DataFrame:
    """Replacement expressions apply to the keys of deletes; keys of another length are told apart."""
    keys = t("orders").selectExpr("CASE WHEN o_orderkey % 4 = 0 THEN concat('[', o_orderkey, ',1]') ELSE concat('[', o_orderkey, ']') END AS key")
    return mapping.delete_keys(keys, PARTS, TableConfig(exprs={"id": "2 * $0"}))


@query("SELECT p_partkey AS id, p_size AS size FROM part")
def apply_ignore_columns(t: Tables) -> DataFrame:
    """Ignored properties needn't exist in the target; generated columns take no value."""
    config = TableConfig(ignore=("brand", "zeta", "name", "price"))
    out = mapping.valid(mapping.map_columns(_payloads(t, "id", "size", "brand", "zeta"), PARTS, config))
    return out.select(*[c for c in out.columns if c not in ("seq", "extras")])


@query("SELECT p_partkey AS id, p_type AS name, p_size AS size FROM part")
def apply_rename_columns(t: Tables) -> DataFrame:
    config = TableConfig(rename={"name": "label"})
    return mapping.valid(mapping.map_columns(_payloads(t, "id", "size", "label"), PARTS, config)).select("id", "name", "size")


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN '{"alpha":{"a":[true,null],"b":1},"zeta":' || p_size || '}' ELSE '{"zeta":' || p_size || '}' END AS extras FROM part""")
def apply_extras_json(t: Tables) -> DataFrame:
    """Properties without a column become one JSON text, keys in order."""
    return mapping.valid(mapping.map_columns(_payloads(t, "zeta", "id", "size", "alpha"), PARTS, TableConfig(extras="extras"))).select("id", "extras")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'unexpected columns: alpha, zeta' ELSE 'unexpected columns: zeta' END AS violation FROM part WHERE p_partkey % 7 <> 0 UNION ALL SELECT NULL, 'missing keys: id' FROM part WHERE p_partkey % 7 = 0")
def reject_violations(t: Tables) -> DataFrame:
    bad = _payloads(t, "id", "zeta", "alpha").where("seq % 7 <> 0").unionAll(_payloads(t, "size").where("seq % 7 = 0"))
    return mapping.violations(mapping.map_columns(bad, PARTS)).select("id", "violation")


@query("SELECT CASE p_partkey % 5 WHEN 0 THEN 'missing keys: id' WHEN 1 THEN 'missing keys: id' WHEN 2 THEN 'missing keys: id' ELSE 'ok' END AS state, count(*) AS n, sum(CASE WHEN p_partkey % 5 > 2 THEN p_size END) AS size FROM part GROUP BY 1")
def mapping_null_keys(t: Tables) -> DataFrame:
    """Keys that are null or absent and payloads that are no JSON are violations; of names that differ in case the last counts."""
    size = F.col("p_size").cast("string")
    doc = F.when(F.col("p_partkey") % 5 == 0, F.lit('{"id":null,"size":1}')).when(F.col("p_partkey") % 5 == 1, F.lit('{"size":1}')).when(F.col("p_partkey") % 5 == 2, F.lit("{garbage")).otherwise(F.concat(F.lit('{"size":0,"Id":7,"SIZE":'), size, F.lit("}")))
    mapped = mapping.map_columns(t("part").select(doc.alias("data")), Table.of("p", "id long, size long", ("id",)))
    bad = mapping.violations(mapped).select(F.col("violation").alias("state"), F.lit(None).cast("long").alias("size"))
    return bad.unionAll(mapping.valid(mapped).select(F.lit("ok"), "size")).groupBy("state").agg(F.count("*").alias("n"), F.sum("size").alias("size"))


@query("SELECT count(*) AS n, count(DISTINCT p_partkey) AS n_rowids, sum(p_size) AS size FROM part")
def keyless_table(t: Tables) -> DataFrame:
    """Rows of a table without a key get one each."""
    docs = t("part").select(F.concat(F.lit('{"size":'), F.col("p_size").cast("string"), F.lit("}")).alias("data"))
    rows = mapping.valid(mapping.map_columns(docs, Table.of("p", "size long", ())))
    return rows.agg(F.count("*").alias("n"), F.countDistinct("rowid").alias("n_rowids"), F.sum("size").alias("size"))


@query("SELECT l.pk, CASE WHEN l.pk % 2 = 0 THEN t.status ELSE l.status END AS status FROM latest l LEFT JOIN target t ON t.pk = l.pk WHERE NOT is_delete", "feed", "latest", "target")
def apply_toast(t: Tables) -> DataFrame:
    """A large column that the source left out keeps the target's value; null where there is no row."""
    rows = _writes(t).select("pk", F.when(F.col("pk") % 2 == 0, F.lit(mapping.UNCHANGED)).otherwise(F.col("status")).alias("status"))
    return mapping.fill_unchanged(rows, t.target(), ["pk"], ["status"])


# ---------------------------------------------------------------- compare-and-set, deadlines

AS_OF = f"timestamp_seconds({BASE} + 1800)"
IN_TIME = f"l.ts > {BASE} + 1800 - 600"


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("at", F.timestamp_seconds("ts"))


@query("SELECT t.pk, CASE WHEN l.ver > t.ver THEN l.ver ELSE t.ver END AS ver, CASE WHEN l.ver > t.ver THEN l.status ELSE t.status END AS status, CASE WHEN l.ver > t.ver THEN l.price ELSE t.price END AS price, CASE WHEN l.ver > t.ver THEN l.ts ELSE t.ts END AS ts FROM target t LEFT JOIN latest l ON l.pk = t.pk AND NOT is_delete UNION ALL SELECT pk, ver, status, price, ts FROM latest WHERE NOT is_delete AND pk NOT IN (SELECT pk FROM target)", "feed", "latest", "target")
def cas_upsert(t: Tables) -> DataFrame:
    return resolve.conditional_upsert(t.target(), _writes(t), ["pk"], cas=["ver"])


@query("SELECT l.pk, l.a, l.b FROM (SELECT pk, CASE WHEN pk % 5 = 0 THEN NULL ELSE ver END AS a, CASE WHEN pk % 4 = 0 THEN NULL ELSE pk % 3 END AS b FROM latest WHERE NOT is_delete) l LEFT JOIN (SELECT pk, CASE WHEN pk % 7 = 0 THEN NULL ELSE ver END AS a, CASE WHEN pk % 8 = 0 THEN NULL ELSE 1 END AS b FROM target) t ON t.pk = l.pk WHERE t.pk IS NULL OR l.a > t.a OR (l.a = t.a AND l.b > t.b)", "feed", "latest", "target")
def cas_tuple_nulls(t: Tables) -> DataFrame:
    """Tuples are compared as SQL does: a null decides nothing, so the row loses."""
    rows = _writes(t).selectExpr("pk", "CASE WHEN pk % 5 = 0 THEN NULL ELSE ver END AS a", "CASE WHEN pk % 4 = 0 THEN NULL ELSE pk % 3 END AS b")
    old = t.target().selectExpr("pk", "CASE WHEN pk % 7 = 0 THEN NULL ELSE ver END AS a", "CASE WHEN pk % 8 = 0 THEN NULL ELSE 1L END AS b")
    return resolve.decide(old, rows, ["pk"], cas=["a", "b"]).applied


@query(f"SELECT pk, ver, status, price, ts FROM latest l WHERE NOT is_delete AND {IN_TIME}", "feed", "latest")
def deadline_filter(t: Tables) -> DataFrame:
    return resolve.in_time(_timed(_writes(t)), {"at": "10 minutes"}, F.expr(AS_OF)).drop("at")


@query(f"SELECT t.pk, coalesce(l.ver, t.ver) AS ver, coalesce(l.status, t.status) AS status, coalesce(l.price, t.price) AS price, coalesce(l.ts, t.ts) AS ts FROM target t LEFT JOIN latest l ON l.pk = t.pk AND NOT is_delete AND l.ver > t.ver AND {IN_TIME} UNION ALL SELECT pk, ver, status, price, ts FROM latest l WHERE NOT is_delete AND {IN_TIME} AND pk NOT IN (SELECT pk FROM target)", "feed", "latest", "target")
def cas_deadline_upsert(t: Tables) -> DataFrame:
    return resolve.conditional_upsert(_timed(t.target()), _timed(_writes(t)), ["pk"], ["ver"], {"at": "10 minutes"}, F.expr(AS_OF)).drop("at")


@query(f"SELECT l.pk, l.ver, t.ver AS target_ver, t.status AS target_status FROM latest l JOIN target t ON t.pk = l.pk WHERE NOT is_delete AND NOT (l.ver > t.ver AND {IN_TIME})", "feed", "latest", "target")
def conflicts_returned(t: Tables) -> DataFrame:
    """What compare-and-set or a deadline refused, with the target's row."""
    found = resolve.decide(_timed(t.target()), _timed(_writes(t)), ["pk"], ["ver"], {"at": "10 minutes"}, F.expr(AS_OF)).conflicts
    return found.select("pk", "ver", "target_ver", "target_status")


# ---------------------------------------------------------------- three-way merge

_SIDES = """SELECT o_orderkey AS pk, o_orderkey % 4 <> 3 AS has_before, o_orderkey * 2 AS seq, {base} + o_orderkey AS nanos, 0 AS logical,
    o_orderkey % 10 AS before_a, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 10 ELSE o_orderkey % 10 + 1 END AS a, CASE WHEN o_orderkey % 5 < 3 THEN o_orderkey % 10 ELSE o_orderkey % 10 + o_orderkey % 5 - 2 END AS target_a,
    o_orderstatus AS before_b, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE o_orderstatus END AS b, CASE WHEN o_orderkey % 6 < 4 THEN o_orderstatus ELSE 'own' END AS target_b FROM orders""".format(base=BASE)
_MERGED = f"""sides AS ({_SIDES}), judged AS (SELECT *,
    (has_before AND before_a IS NOT DISTINCT FROM a) OR target_a IS NOT DISTINCT FROM a AS keep_a, has_before AND before_a IS NOT DISTINCT FROM target_a AS take_a,
    (has_before AND before_b IS NOT DISTINCT FROM b) OR target_b IS NOT DISTINCT FROM b AS keep_b, has_before AND before_b IS NOT DISTINCT FROM target_b AS take_b FROM sides),
    merged AS (SELECT *, CASE WHEN keep_a OR NOT take_a THEN target_a ELSE a END AS merged_a, CASE WHEN keep_b OR NOT take_b THEN target_b ELSE b END AS merged_b,
    concat_ws(',', CASE WHEN NOT keep_a AND NOT take_a THEN 'a' END, CASE WHEN NOT keep_b AND NOT take_b THEN 'b' END) AS unmerged FROM judged) """


def _merged(t: Tables) -> DataFrame:
    t("orders").createOrReplaceTempView("__orders")
    sides = t.spark.sql(_SIDES.replace("FROM orders", "FROM __orders"))
    return resolve.merge_rows(sides, ["a", "b"])


@query("WITH " + _MERGED + "SELECT pk, merged_a AS a, merged_b AS b FROM merged WHERE unmerged = ''")
def merge3_standard(t: Tables) -> DataFrame:
    """Columns that one side changed take that side's value."""
    return resolve.fixups(resolve.route(_merged(t), ["a", "b"], "drop"), ["pk"], ["a", "b"])


@query("WITH " + _MERGED + "SELECT pk, unmerged FROM merged WHERE unmerged <> ''")
def merge3_unmerged(t: Tables) -> DataFrame:
    return _merged(t).where(F.size("unmerged") > 0).select("pk", F.array_join("unmerged", ",").alias("unmerged"))


@query("WITH " + _MERGED + """SELECT 'conflicts' AS dlq_name, nanos AS source_nanos, logical AS source_logical, '{"a":' || a || ',"b":"' || b || '"}' AS data_after, CASE WHEN has_before THEN '{"a":' || before_a || ',"b":"' || before_b || '"}' ELSE 'null' END AS data_before FROM merged WHERE unmerged <> ''""")
def merge3_dlq(t: Tables) -> DataFrame:
    """What can't be merged goes to the dead-letter queue that was asked for."""
    routed = resolve.route(_merged(t), ["a", "b"], "dlq")
    before = F.when(F.col("has_before"), F.to_json(F.struct(F.col("before_a").alias("a"), F.col("before_b").alias("b"))))
    return resolve.dead_letters(routed, "conflicts", F.to_json(F.struct("a", "b")), before)


@query("WITH " + _MERGED + "SELECT CASE WHEN unmerged = '' THEN 'apply' ELSE 'drop' END AS resolution, count(*) AS n FROM merged GROUP BY ALL")
def merge3_drop(t: Tables) -> DataFrame:
    return resolve.route(_merged(t), ["a", "b"], "drop").groupBy("resolution").agg(F.count("*").alias("n"))


@query("WITH " + _MERGED + "SELECT CASE WHEN unmerged = '' THEN 'apply' WHEN unmerged = 'a' THEN 'dlq' ELSE 'drop' END AS resolution, count(*) AS n FROM merged GROUP BY ALL")
def merge3_fallback(t: Tables) -> DataFrame:
    """A fallback decides row by row."""
    hook = lambda _: F.when(F.array_join("unmerged", ",") == "a", "dlq").otherwise("drop")
    return resolve.route(_merged(t), ["a", "b"], hook).groupBy("resolution").agg(F.count("*").alias("n"))


@query("SELECT t.pk, CASE WHEN l.ver > t.ver THEN l.ver WHEN l.pk IS NOT NULL THEN t.ver + (l.ver - (l.pk % 10)) ELSE t.ver END AS ver FROM target t LEFT JOIN latest l ON l.pk = t.pk AND NOT is_delete UNION ALL SELECT pk, ver FROM latest WHERE NOT is_delete AND pk NOT IN (SELECT pk FROM target)", "feed", "latest", "target")
def merge_counter_delta(t: Tables) -> DataFrame:
    """A merge of counters adds the change that a refused row describes (before: pk % 10) to the target's value."""
    old, rows = t.target().select("pk", "ver"), _writes(t).select("pk", "ver")
    made = resolve.decide(old, rows, ["pk"], ["ver"])
    state = sink.upsert(old, made.applied, ["pk"])
    fixed = made.conflicts.select("pk", (F.col("target_ver") + F.col("ver") - F.col("pk") % 10).alias("ver"))
    return sink.upsert(state, fixed, ["pk"])




@query("""SELECT o_orderkey AS pk, CASE o_orderkey % 4 WHEN 0 THEN 'x=9,z=5' WHEN 1 THEN 'x=9,y=2,z=5' WHEN 2 THEN 'x=7,z=5' ELSE 'x=9' END AS merged, CASE o_orderkey % 4 WHEN 2 THEN 'x' ELSE '' END AS unmerged FROM orders""")
def merge3_extras(t: Tables) -> DataFrame:
    """Properties without a column merge by name: changed, added, removed and disputed ones."""
    one = lambda *kv: F.create_map(*map(F.lit, kv))
    pk = F.col("o_orderkey") % 4
    before = F.when(pk == 3, one("x", "1", "z", "5")).otherwise(one("x", "1", "y", "2"))
    proposed = F.when(pk == 0, one("x", "9", "z", "5")).when(pk == 1, one("x", "9", "y", "2", "z", "5")).when(pk == 2, one("x", "9", "z", "5")).otherwise(one("x", "9"))
    current = F.when(pk == 2, one("x", "7", "y", "2")).when(pk == 3, one("x", "1", "z", "5")).otherwise(one("x", "1", "y", "2"))
    merged, stuck = resolve.merge_maps(before, proposed, current)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return t("orders").select(F.col("o_orderkey").alias("pk"), merged.alias("m"), F.array_join(stuck, ",").alias("unmerged")).select("pk", shown.alias("merged"), "unmerged")


@query("SELECT 'late' AS dlq_name, nanos AS source_nanos, logical AS source_logical, '{\"pk\":' || pk || ',\"ver\":' || ver || '}' AS data_after, 'null' AS data_before FROM (SELECT l.* FROM latest l JOIN target t ON t.pk = l.pk WHERE NOT is_delete AND NOT l.ver > t.ver)", "feed", "latest", "target")
def dlq_rows(t: Tables) -> DataFrame:
    rows = _latest(t).where("NOT is_delete").select("pk", "ver", "nanos", "logical")
    lost = resolve.decide(t.target().select("pk", "ver"), rows, ["pk"], ["ver"]).conflicts.withColumn("resolution", F.lit("dlq"))
    return resolve.dead_letters(lost, "late", F.to_json(F.struct("pk", "ver")), F.lit(None).cast("string"))


@query("SELECT pk, ver, status, price, ts, false AS is_deleted FROM target WHERE pk NOT IN (SELECT pk FROM latest WHERE is_delete) UNION ALL SELECT pk, ver, status, price, ts, true FROM target WHERE pk IN (SELECT pk FROM latest WHERE is_delete)", "feed", "latest", "target")
def soft_delete(t: Tables) -> DataFrame:
    """Deletes become updates of a flag."""
    old = t.target().withColumn("is_deleted", F.lit(False))
    gone = _latest(t).where("is_delete").select("pk").join(old.select("pk"), "pk", "left_semi").withColumn("is_deleted", F.lit(True))
    return sink.upsert(old, gone, ["pk"])


@query("SELECT pk, difference FROM (SELECT coalesce(t.pk, l.pk) AS pk, CASE WHEN l.pk IS NULL THEN 'missing' WHEN t.pk IS NULL THEN 'extra' WHEN t.ver <> l.ver OR t.status <> l.status THEN 'changed' END AS difference FROM target t FULL JOIN (SELECT * FROM latest WHERE NOT is_delete) l ON l.pk = t.pk) WHERE difference IS NOT NULL", "feed", "latest", "target")
def consistency_diff(t: Tables) -> DataFrame:
    return sink.difference(t.target().select("pk", "ver", "status"), _writes(t).select("pk", "ver", "status"), ["pk"])
