"""Keyed tables, sets, rankings, lists, wide rows, words and reach over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import fanout, maps
from fleetpulse.operators import cells as CE
from fleetpulse.operators import keyed as K
from fleetpulse.operators import lookup as L
from fleetpulse.operators import ranking as RK
from fleetpulse.operators import sets as ST
from fleetpulse.operators import wordcount as WC
from fleetpulse.operators.reach import edges
from fleetpulse.operators.reach import reach as reach_of
from fleetpulse.plans.registry import query
from fleetpulse.session import scratch_path
from fleetpulse.sources import keyed_files as KF
from fleetpulse.sources import sinks, tables
from fleetpulse.sources.adapter import load


def _text(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


# ---- sets: customers by order priority

LOW, HIGH, URGENT = "5-LOW", "2-HIGH", "1-URGENT"
MEMBERSHIP = "WITH m AS (SELECT o_orderpriority AS key, 'C' || o_custkey AS member FROM orders)\n"


def _membership(spark, sf):
    return load(spark, sf, "orders").select(F.col("o_orderpriority").alias("key"), _text("C", "o_custkey").alias("member"))


def _in(key):
    return f"SELECT member FROM m WHERE key = '{key}'"


@query("set_union", MEMBERSHIP + f"{_in(LOW)} UNION {_in(HIGH)} UNION {_in(URGENT)}")
def set_union(spark, sf):
    return ST.union(_membership(spark, sf), LOW, HIGH, URGENT)


@query("set_intersect", MEMBERSHIP + f"{_in(LOW)} INTERSECT {_in(HIGH)} INTERSECT {_in(URGENT)}")
def set_intersect(spark, sf):
    return ST.intersection(_membership(spark, sf), LOW, HIGH, URGENT)


@query("set_diff", MEMBERSHIP + f"{_in(LOW)} EXCEPT {_in(HIGH)} EXCEPT {_in(URGENT)}")
def set_diff(spark, sf):
    return ST.difference(_membership(spark, sf), LOW, HIGH, URGENT)


@query(
    "set_store",
    MEMBERSHIP + f"SELECT DISTINCT key, member FROM m UNION ALL SELECT 'all', member FROM ({_in(LOW)} INTERSECT {_in(HIGH)})",
)
def set_store(spark, sf):
    m = _membership(spark, sf)
    return ST.store(m.distinct(), "all", ST.intersection(m, LOW, HIGH))


@query(
    "set_add",
    MEMBERSHIP + "SELECT key, member FROM m UNION SELECT 'suppliers', 'C' || s_suppkey FROM supplier",
)
def set_add(spark, sf):
    new = load(spark, sf, "supplier").select(F.lit("suppliers").alias("key"), _text("C", "s_suppkey").alias("member"))
    return ST.add(_membership(spark, sf), new)


@query(
    "set_remove",
    MEMBERSHIP + "SELECT * FROM m WHERE NOT (key = '5-LOW' AND member IN (SELECT 'C' || s_suppkey FROM supplier))",
)
def set_remove(spark, sf):
    gone = load(spark, sf, "supplier").select(F.lit(LOW).alias("key"), _text("C", "s_suppkey").alias("member"))
    return ST.remove(_membership(spark, sf), gone)


@query("set_cardinality", MEMBERSHIP + "SELECT key, count(DISTINCT member) AS cardinality FROM m GROUP BY key")
def set_cardinality(spark, sf):
    return ST.cardinality(_membership(spark, sf))


@query(
    "set_is_member",
    MEMBERSHIP
    + """SELECT '5-LOW' AS key, 'C' || c_custkey AS member,
      EXISTS (SELECT 1 FROM m WHERE key = '5-LOW' AND member = 'C' || c_custkey) AS is_member FROM customer""",
)
def set_is_member(spark, sf):
    asked = load(spark, sf, "customer").select(F.lit(LOW).alias("key"), _text("C", "c_custkey").alias("member"))
    return ST.is_member(_membership(spark, sf), asked)


@query("set_members", MEMBERSHIP + f"SELECT DISTINCT member FROM m WHERE key = '{LOW}'")
def set_members(spark, sf):
    return ST.members(_membership(spark, sf), LOW)


@query("set_random_member", MEMBERSHIP + "SELECT key, arg_min(member, md5('7|' || key || '|' || member)) AS member FROM m GROUP BY key")
def set_random_member(spark, sf):
    return ST.random_member(_membership(spark, sf), seed=7)


# ---- scores: orders by status

SCORES = """WITH s AS (SELECT o_orderstatus AS key, 'O' || o_orderkey AS member, o_totalprice AS score FROM orders),
up AS (SELECT key, member, score, row_number() OVER (PARTITION BY key ORDER BY score, member) - 1 AS up,
  row_number() OVER (PARTITION BY key ORDER BY score DESC, member DESC) - 1 AS down, count(*) OVER (PARTITION BY key) AS n FROM s)
"""


def _scores(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("key"), _text("O", "o_orderkey").alias("member"), F.col("o_totalprice").alias("score")
    )


@query("rank_asc", SCORES + "SELECT key, member, score, up AS rank FROM up")
def rank_asc(spark, sf):
    return RK.rank(_scores(spark, sf))


@query("rank_desc", SCORES + "SELECT key, member, score, down AS rank FROM up")
def rank_desc(spark, sf):
    return RK.rank(_scores(spark, sf), descending=True)


@query("top_k", SCORES + "SELECT key, member, score, down AS rank FROM up WHERE down <= 9")
def top_k(spark, sf):
    return RK.top_range(_scores(spark, sf), 0, 9)


@query("bottom_k", SCORES + "SELECT key, member, score, down AS rank FROM up WHERE down BETWEEN n - 5 AND n - 2")
def bottom_k(spark, sf):
    return RK.top_range(_scores(spark, sf), -5, -2)


@query("inner_ranks", SCORES + "SELECT key, member, score, down AS rank FROM up WHERE down BETWEEN 3 AND n - 3")
def inner_ranks(spark, sf):
    return RK.top_range(_scores(spark, sf), 3, -3)


@query("score_range", SCORES + "SELECT * FROM s WHERE score BETWEEN 100000 AND 300000 ORDER BY key, score DESC, member DESC")
def score_range(spark, sf):
    return RK.descending_order(RK.score_range(_scores(spark, sf), 300000.0, 100000.0))


@query(
    "score_count",
    SCORES + """SELECT key, count(*) AS cardinality, count(*) FILTER (WHERE score BETWEEN 100000 AND 300000) AS in_range
      FROM s GROUP BY key""",
)
def score_count(spark, sf):
    return RK.count_in_range(_scores(spark, sf), 100000.0, 300000.0)


@query(
    "score_lookup",
    SCORES + """SELECT a.key, a.member, s.score FROM (SELECT 'F' AS key, 'O' || (l_orderkey * 2) AS member FROM lineitem) a
      LEFT JOIN s USING (key, member)""",
)
def score_lookup(spark, sf):
    asked = load(spark, sf, "lineitem").select(
        F.lit("F").alias("key"), F.concat(F.lit("O"), (F.col("l_orderkey") * 2).cast("string")).alias("member")
    )
    return RK.scores_of(_scores(spark, sf), asked)


@query("remove_by_rank", SCORES + "SELECT key, member, score FROM up WHERE up NOT BETWEEN 0 AND 99")
def remove_by_rank(spark, sf):
    return RK.remove_by_rank(_scores(spark, sf), 0, 99)


@query("remove_by_score", SCORES + "SELECT * FROM s WHERE score NOT BETWEEN 100000 AND 300000")
def remove_by_score(spark, sf):
    return RK.remove_by_score(_scores(spark, sf), 100000.0, 300000.0)


WRITES = """WITH w AS (SELECT o_orderstatus AS key, 'C' || o_custkey AS member, o_totalprice AS score, o_orderkey AS seq FROM orders)
"""


def _writes(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("key"),
        _text("C", "o_custkey").alias("member"),
        F.col("o_totalprice").alias("score"),
        F.col("o_orderkey").alias("seq"),
    )


@query("score_upsert", WRITES + "SELECT key, member, arg_max(score, seq) AS score FROM w GROUP BY key, member")
def score_upsert(spark, sf):
    return RK.upsert_scores(_writes(spark, sf))


@query(
    "score_increment",
    WRITES + """SELECT key, member, round(sum(score), 2) AS score FROM (
      SELECT key, member, arg_max(score, seq) AS score FROM w GROUP BY key, member
      UNION ALL SELECT key, member, -score FROM w) GROUP BY key, member""",
)
def score_increment(spark, sf):
    writes = _writes(spark, sf)
    deltas = writes.select("key", "member", (-F.col("score")).alias("delta"))
    changed = RK.increment_scores(RK.upsert_scores(writes), deltas)
    return changed.withColumn("score", F.round("score", 2))


@query(
    "score_remove",
    WRITES + """SELECT key, member, arg_max(score, seq) AS score FROM w
      WHERE member NOT IN (SELECT 'C' || s_suppkey FROM supplier) OR key <> 'F' GROUP BY key, member""",
)
def score_remove(spark, sf):
    gone = load(spark, sf, "supplier").select(F.lit("F").alias("key"), _text("C", "s_suppkey").alias("member"))
    return RK.remove_members(RK.upsert_scores(_writes(spark, sf)), gone)


# ---- counters, hashes, upserts

EVENTS_K = "WITH e AS (SELECT *, cast(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)\n"


def _events(spark, sf):
    return load(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


@query(
    "counters",
    EVENTS_K + "SELECT 'V' || user_id AS key, event_type AS field, cast(sum(k - 50) AS BIGINT) AS value FROM e GROUP BY 1, 2",
)
def counters(spark, sf):
    deltas = _events(spark, sf).select(
        _text("V", "user_id").alias("key"), F.col("event_type").alias("field"), (F.col("k") - 50).alias("delta")
    )
    return K.count_deltas(deltas, ["key", "field"])


@query(
    "counter_merge",
    EVENTS_K + """SELECT key, cast(sum(v) AS BIGINT) AS value FROM (SELECT 'V' || c_custkey AS key, c_nationkey AS v FROM customer
      UNION ALL SELECT 'V' || user_id, k - 50 FROM e) GROUP BY key""",
)
def counter_merge(spark, sf):
    stored = load(spark, sf, "customer").select(_text("V", "c_custkey").alias("key"), F.col("c_nationkey").alias("value"))
    deltas = _events(spark, sf).select(_text("V", "user_id").alias("key"), (F.col("k") - 50).alias("delta"))
    return K.add_to_counters(stored, deltas, ["key"])


HASHES = """WITH t AS (SELECT 'V' || c_custkey AS key, 'segment' AS field, c_mktsegment AS value FROM customer),
u AS (SELECT 'V' || user_id AS key, CASE WHEN event_type = 'error' THEN 'segment' ELSE event_type END AS field,
  cast(event_id AS VARCHAR) AS value, event_id AS seq FROM events)
"""


def _hash(spark, sf):
    table = load(spark, sf, "customer").select(
        _text("V", "c_custkey").alias("key"), F.lit("segment").alias("field"), F.col("c_mktsegment").alias("value")
    )
    field = F.when(F.col("event_type") == "error", "segment").otherwise(F.col("event_type"))
    updates = load(spark, sf, "events").select(
        _text("V", "user_id").alias("key"),
        field.alias("field"),
        F.col("event_id").cast("string").alias("value"),
        F.col("event_id").alias("seq"),
    )
    return table, updates


@query(
    "hash_upsert",
    HASHES + """SELECT key, field, arg_max(value, seq) AS value FROM (SELECT *, -1 AS seq FROM t UNION ALL SELECT * FROM u)
      GROUP BY key, field""",
)
def hash_upsert(spark, sf):
    return K.merge_hash(*_hash(spark, sf))


@query("hash_delete", HASHES + "SELECT * FROM t WHERE key NOT IN (SELECT key FROM u WHERE field = 'segment')")
def hash_delete(spark, sf):
    return K.delete_fields(*_hash(spark, sf))


@query(
    "hash_fields",
    """SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'nation,segment' ELSE 'nation,segment,tier' END AS names,
      CASE WHEN c_nationkey = 3 THEN 2 ELSE 3 END AS n, c_nationkey <> 3 AS has_tier, 'X' AS segment, c_nationkey AS nation
    FROM customer""",
)
def hash_fields(spark, sf):
    columns = ["nation", "segment"]
    df = load(spark, sf, "customer").select(
        "c_custkey", F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("s")
    )
    stored = maps.struct_to_map(F.col("s"), columns)
    tier = maps.set_if_absent(maps.set_fields(stored, {"segment": F.lit("X")}), "tier", F.lit("1"))
    changed = F.when(F.col("s.nation") == 3, maps.delete_fields(tier, "tier")).otherwise(tier)
    df = df.select("c_custkey", changed.alias("h"))
    back = maps.map_to_struct(F.col("h"), T.StructType().add("nation", T.IntegerType()).add("segment", T.StringType()))
    return df.select(
        "c_custkey",
        F.array_join(F.sort_array(maps.field_names(F.col("h"))), ",").alias("names"),
        maps.field_count(F.col("h")).alias("n"),
        maps.has_field(F.col("h"), "tier").alias("has_tier"),
        back["segment"].alias("segment"),
        back["nation"].alias("nation"),
    )


@query(
    "field_merge",
    """WITH u AS (SELECT user_id AS id, arg_max(CASE WHEN event_type = 'click' THEN event_id END, event_id)
        FILTER (WHERE event_type = 'click') AS clicked, arg_max(value, event_id) AS bal FROM events GROUP BY 1)
      SELECT coalesce(c_custkey, id) AS id, coalesce(u.bal, c_acctbal) AS bal, c_mktsegment AS segment, coalesce(u.clicked, -1) AS clicked
      FROM customer FULL JOIN u ON u.id = c_custkey""",
)
def field_merge(spark, sf):
    table = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment")
    )
    updates = load(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        F.col("value").alias("bal"),
        F.when(F.col("event_type") == "click", F.col("event_id")).alias("clicked"),
        F.col("event_id").alias("seq"),
    )
    return K.merge_fields(table, updates, ["id"]).withColumn("clicked", F.coalesce("clicked", F.lit(-1)))


NEW_ROWS = """WITH t AS (SELECT c_custkey AS key, c_mktsegment AS value FROM customer),
r AS (SELECT o_custkey * 2 AS key, o_orderpriority AS value, o_orderkey AS seq FROM orders)
"""


def _new_rows(spark, sf, shift=0):
    table = load(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"))
    rows = load(spark, sf, "orders").select(
        (F.col("o_custkey") * 2 + shift).alias("key"),
        F.col("o_orderpriority").alias("value"),
        F.col("o_orderkey").alias("seq"),
    )
    return table, rows


@query(
    "insert_if_absent",
    NEW_ROWS + """SELECT * FROM t UNION ALL SELECT key, arg_min(value, seq) FROM r
      WHERE key NOT IN (SELECT key FROM t) GROUP BY key""",
)
def insert_if_absent(spark, sf):
    return K.insert_if_absent(*_new_rows(spark, sf), ["key"])


@query(
    "insert_all_if_absent",
    NEW_ROWS + """, shifted AS (SELECT key + 1000000000 AS key, arg_max(value, seq) AS value FROM r GROUP BY ALL)
      SELECT * FROM t UNION ALL SELECT * FROM shifted
      WHERE (SELECT count(*) FROM shifted WHERE key IN (SELECT key FROM t)) = 0""",
)
def insert_all_if_absent(spark, sf):
    table, rows = _new_rows(spark, sf, 1_000_000_000)
    return K.insert_all_if_absent(table, rows, ["key"])


@query(
    "insert_all_if_absent_taken",
    NEW_ROWS + """, last AS (SELECT key, arg_max(value, seq) AS value FROM r GROUP BY key)
      SELECT * FROM t UNION ALL SELECT * FROM last WHERE (SELECT count(*) FROM last WHERE key IN (SELECT key FROM t)) = 0""",
)
def insert_all_if_absent_taken(spark, sf):
    return K.insert_all_if_absent(*_new_rows(spark, sf), ["key"])


@query(
    "ttl_expire",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE TIMESTAMP '1999-01-01' - o_orderdate < INTERVAL 365 DAY",
)
def ttl_expire(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return K.expire(rows, "o_orderdate", F.lit("1999-01-01 00:00:00").cast("timestamp"), "365 days")


@query(
    "delete_keys",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def delete_keys(spark, sf):
    gone = load(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return K.delete_keys(load(spark, sf, "customer").select("c_custkey", "c_name"), gone, "c_custkey")


@query("key_scan", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%' OR p_name LIKE '_e%g%'")
def key_scan(spark, sf):
    parts = load(spark, sf, "part").select("p_partkey", "p_name")
    return L.keys_like(parts, "p_name", "small*").union(
        L.keys_like(L.keys_like(parts, "p_name", "?e*g*"), "p_name", "[^s]*")
    )


# ---- lookups


@query(
    "lookup_by_key",
    "SELECT o_orderkey, o_custkey * 2 AS c_custkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2",
)
def lookup_by_key(spark, sf):
    asked = load(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("c_custkey"))
    return L.lookup_by_key(asked, load(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")


@query(
    "bulk_fetch",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey * 2 FROM orders)",
)
def bulk_fetch(spark, sf):
    asked = load(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("c_custkey"))
    return L.found_values(asked, load(spark, sf, "customer"), "c_custkey", "c_name")


# ---- lists: a customer's orders in key order

LISTS = """WITH l AS (SELECT 'C' || o_custkey AS key, o_orderkey AS pos, o_orderpriority AS value FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY key) AS size FROM l)
"""


def _lists(spark, sf):
    return load(spark, sf, "orders").select(
        _text("C", "o_custkey").alias("key"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("value")
    )


@query("latest_n", LISTS + "SELECT key, pos, value, i AS index FROM n WHERE i >= size - 3")
def latest_n(spark, sf):
    return K.list_range(_lists(spark, sf), -3, -1)


@query("list_range", LISTS + "SELECT key, pos, value, i AS index FROM n WHERE i BETWEEN 1 AND 4")
def list_range(spark, sf):
    return K.list_range(_lists(spark, sf), 1, 4)


@query("list_trim", LISTS + "SELECT key, pos, value, i AS index FROM n WHERE i BETWEEN 1 AND size - 2")
def list_trim(spark, sf):
    return K.list_range(_lists(spark, sf), 1, -2)


@query("list_index", LISTS + "SELECT key, pos, value, i AS index FROM n WHERE i = size - 1")
def list_index(spark, sf):
    return K.list_index(_lists(spark, sf), -1)


@query("list_length", LISTS + "SELECT key, count(*) AS length FROM l GROUP BY key")
def list_length(spark, sf):
    return K.list_length(_lists(spark, sf))


@query(
    "list_push",
    LISTS + """SELECT * FROM l UNION ALL SELECT 'C' || c_custkey, coalesce(m, 0) - 1, c_mktsegment
      FROM customer LEFT JOIN (SELECT key, min(pos) AS m FROM l GROUP BY key) ON key = 'C' || c_custkey""",
)
def list_push(spark, sf):
    new = load(spark, sf, "customer").select(
        _text("C", "c_custkey").alias("key"), F.col("c_custkey").alias("seq"), F.col("c_mktsegment").alias("value")
    )
    return K.push(_lists(spark, sf), new, left=True)


@query(
    "list_remove_head",
    LISTS + """SELECT l.* FROM l LEFT JOIN (SELECT key, pos, row_number() OVER (PARTITION BY key ORDER BY pos) AS r
      FROM l WHERE value = '5-LOW') d USING (key, pos) WHERE r IS NULL OR r > 2""",
)
def list_remove_head(spark, sf):
    return K.remove_values(_lists(spark, sf), F.lit(LOW), 2)


@query(
    "list_remove_tail",
    LISTS + """SELECT l.* FROM l LEFT JOIN (SELECT key, pos, row_number() OVER (PARTITION BY key ORDER BY pos DESC) AS r
      FROM l WHERE value = '5-LOW') d USING (key, pos) WHERE r IS NULL OR r > 1""",
)
def list_remove_tail(spark, sf):
    return K.remove_values(_lists(spark, sf), F.lit(LOW), -1)


@query("list_remove_all", LISTS + "SELECT * FROM l WHERE value <> '5-LOW'")
def list_remove_all(spark, sf):
    return K.remove_values(_lists(spark, sf), F.lit(LOW), 0)


# ---- wide rows: a vehicle's events by type

CELLS = EVENTS_K + """, c AS (SELECT 'V' || user_id AS row_key, event_type AS family, 'k' || (k % 10) AS qualifier,
  cast(event_id AS VARCHAR) AS value, event_id AS seq FROM e),
m AS (SELECT row_key, family, qualifier, arg_max(value, seq) AS value FROM c GROUP BY ALL)
"""


def _cells(spark, sf):
    return _events(spark, sf).select(
        _text("V", "user_id").alias("row_key"),
        F.col("event_type").alias("family"),
        F.concat(F.lit("k"), (F.col("k") % 10).cast("string")).alias("qualifier"),
        F.col("event_id").cast("string").alias("value"),
        F.col("event_id").alias("seq"),
    )


@query("cell_merge", CELLS + "SELECT * FROM m")
def cell_merge(spark, sf):
    return CE.merge_cells(_cells(spark, sf))


@query(
    "wide_rows",
    CELLS + """SELECT row_key, max(value) FILTER (WHERE qualifier = 'k1') AS k1, max(value) FILTER (WHERE qualifier = 'k2') AS k2
      FROM m WHERE family = 'click' AND qualifier IN ('k1', 'k2') GROUP BY row_key""",
)
def wide_rows(spark, sf):
    return CE.wide_rows(_cells(spark, sf), "click", ["k1", "k2"])


@query(
    "get_cells",
    CELLS + """SELECT 'V' || c_custkey AS row_key, value FROM customer
      LEFT JOIN (SELECT row_key, value FROM m WHERE family = 'view' AND qualifier = 'k3') ON row_key = 'V' || c_custkey""",
)
def get_cells(spark, sf):
    asked = load(spark, sf, "customer").select(_text("V", "c_custkey").alias("row_key"))
    return CE.get_cells(_cells(spark, sf), asked, "view", "k3")


def _entries(hash_map):
    return F.array_join(F.transform(F.map_entries(hash_map), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")


@query(
    "family_map",
    CELLS + """SELECT row_key, string_agg(qualifier || '=' || value, ',' ORDER BY qualifier) AS columns
      FROM m WHERE family = 'click' GROUP BY row_key""",
)
def family_map(spark, sf):
    return CE.family_map(_cells(spark, sf), "click").select("row_key", _entries(F.col("columns")).alias("columns"))


@query(
    "row_map",
    CELLS + """SELECT row_key, string_agg(family || '{' || cs || '}', ';' ORDER BY family) AS families FROM (
      SELECT row_key, family, string_agg(qualifier || '=' || value, ',' ORDER BY qualifier) AS cs FROM m GROUP BY ALL)
      GROUP BY row_key""",
)
def row_map(spark, sf):
    entry = F.transform(
        F.map_entries("families"), lambda f: F.concat(f["key"], F.lit("{"), _entries(f["value"]), F.lit("}"))
    )
    return CE.row_map(_cells(spark, sf)).select("row_key", F.array_join(entry, ";").alias("families"))


@query(
    "cell_deletes",
    CELLS + """SELECT * FROM c WHERE row_key NOT IN (SELECT 'V' || s_suppkey FROM supplier)
      AND NOT (family = 'error' AND row_key IN (SELECT 'V' || (s_suppkey + 100) FROM supplier))""",
)
def cell_deletes(spark, sf):
    supplier = load(spark, sf, "supplier")
    rows = supplier.select(_text("V", "s_suppkey").alias("row_key"))
    families = supplier.select(
        F.concat(F.lit("V"), (F.col("s_suppkey") + 100).cast("string")).alias("row_key"), F.lit("error").alias("family")
    )
    return CE.delete_cells(CE.delete_cells(_cells(spark, sf), rows), families)


@query(
    "cell_deletes_single",
    CELLS + "SELECT * FROM c WHERE NOT (family = 'view' AND qualifier = 'k3' AND row_key IN (SELECT 'V' || s_suppkey FROM supplier))",
)
def cell_deletes_single(spark, sf):
    single = load(spark, sf, "supplier").select(_text("V", "s_suppkey").alias("row_key"), F.lit("view").alias("family"), F.lit("k3").alias("qualifier"))
    return CE.delete_cells(_cells(spark, sf), single)


@query(
    "wide_unpivot",
    """SELECT o_orderkey, 'o_custkey' AS column_name, o_custkey AS column_value FROM orders
      UNION ALL SELECT o_orderkey, 'o_totalprice', cast(trunc(o_totalprice) AS BIGINT) FROM orders""",
)
def wide_unpivot(spark, sf):
    return CE.unpivot_values(load(spark, sf, "orders"), "o_orderkey", ["o_custkey", "o_totalprice"])


@query(
    "wide_to_cells",
    """SELECT 'S' || s_suppkey AS row_key, 's' AS family, q AS qualifier,
      CASE q WHEN 's_name' THEN s_name ELSE cast(s_nationkey AS VARCHAR) END AS value, s_suppkey AS seq
    FROM supplier CROSS JOIN (SELECT unnest(['s_name', 's_nationkey']) AS q)""",
)
def wide_to_cells(spark, sf):
    rows = load(spark, sf, "supplier").withColumn("row", _text("S", "s_suppkey"))
    return CE.cells_of(rows, "row", "s", ["s_name", "s_nationkey"], "s_suppkey")


# ---- generic rows


@query(
    "rows_as_maps",
    """SELECT cast(o_orderkey AS VARCHAR) AS k, o_orderstatus AS s,
      CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS p FROM orders""",
)
def rows_as_maps(spark, sf):
    p = F.when(F.col("o_orderpriority") != LOW, F.col("o_orderpriority")).alias("p")
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), p)
    return tables.rows_as_maps(rows).select(*[F.col("row")[c].alias(c) for c in ("k", "s", "p")])


@query(
    "rows_as_json",
    """SELECT '{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '","p":' ||
      CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}' AS json FROM orders""",
)
def rows_as_json(spark, sf):
    p = F.when(F.col("o_orderpriority") != LOW, F.col("o_orderpriority")).alias("p")
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), p)
    return tables.rows_as_json(rows)


@query(
    "log_sample",
    f"""SELECT * FROM lineitem
      WHERE ('0x' || substr(md5('1|' || l_orderkey || '|' || l_linenumber), 1, 8))::BIGINT < {int(0.004 * 2**32)}""",
)
def log_sample(spark, sf):
    return sinks.log_sample(load(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", seed=1)


# ---- words and reach

WORDS = """WITH words AS (SELECT unnest(CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN []
    ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents),
counts AS (SELECT word, count(*) AS count FROM words GROUP BY word),
asked AS (SELECT conv_id, unnest(CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN []
    ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM conversations)
"""


def _counts(spark, sf):
    texts = load(spark, sf, "documents").select("doc_id", "text")
    return WC.word_count(tables.spread(texts, "doc_id"), "text")


@query("word_count", WORDS + "SELECT * FROM counts")
def word_count(spark, sf):
    return _counts(spark, sf)


@query("split_by_function", WORDS + "SELECT * FROM counts")
def split_by_function(spark, sf):
    """The words split by a table function."""
    texts = tables.spread(load(spark, sf, "documents").select("doc_id", "text"), "doc_id").select("text")
    return fanout.split_words(texts, "text").groupBy("word").agg(F.count("*").alias("count"))


@query("word_lookup", WORDS + "SELECT word, count FROM asked JOIN counts USING (word)")
def word_lookup(spark, sf):
    return WC.count_lookup(load(spark, sf, "conversations"), _counts(spark, sf), "text")


@query(
    "word_sum",
    WORDS + "SELECT conv_id, cast(sum(count) AS BIGINT) AS sum FROM asked JOIN counts USING (word) GROUP BY conv_id",
)
def word_sum(spark, sf):
    return WC.count_total(load(spark, sf, "conversations"), _counts(spark, sf), ["conv_id"], "text")


@query("word_total", WORDS + "SELECT cast(sum(count) AS BIGINT) AS sum FROM asked JOIN counts USING (word)")
def word_total(spark, sf):
    """One sum over all requests."""
    return WC.count_total(load(spark, sf, "conversations"), _counts(spark, sf), text="text")


REACH = """SELECT n_name AS url, count(DISTINCT o_custkey) AS reach FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
      LEFT JOIN lineitem ON l_suppkey = s_suppkey LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY n_name"""


@query("reach_lists", REACH)
def reach_lists(spark, sf):
    """The same from adjacency lists: a list of suppliers, and one of customers for each order."""
    nation, supplier = load(spark, sf, "nation"), load(spark, sf, "supplier")
    tweeters = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", F.array("s_suppkey").alias("people"))
    lines = load(spark, sf, "lineitem").join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    followers = lines.select("l_suppkey", F.when(F.col("o_custkey").isNotNull(), F.array("o_custkey", "o_custkey")).alias("people"))
    return reach_of(nation.select(F.col("n_name").alias("url")), edges(tweeters, "n_name", "people"), edges(followers, "l_suppkey", "people"))


@query(
    "reach",
    """SELECT n_name AS url, count(DISTINCT o_custkey) AS reach FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
      LEFT JOIN lineitem ON l_suppkey = s_suppkey LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY n_name""",
)
def reach(spark, sf):
    """Customers reached by a nation's suppliers."""
    nation, supplier = load(spark, sf, "nation"), load(spark, sf, "supplier")
    tweeters = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("key"), F.col("s_suppkey").alias("member")
    )
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    followers = lines.join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("key"), F.col("o_custkey").alias("member")
    )
    return reach_of(nation.select(F.col("n_name").alias("url")), tweeters, followers)


# ---- tables by key


@query(
    "keyed_upsert_table",
    HASHES + """SELECT key, field, arg_max(value, seq) AS value FROM (SELECT *, -1 AS seq FROM t UNION ALL SELECT * FROM u)
      GROUP BY key, field""",
)
def keyed_upsert_table(spark, sf):
    """The hash table kept in files, changed by three batches of updates, one of which comes twice."""
    path = scratch_path(spark, "keyed")
    table, updates = _hash(spark, sf)
    KF.upsert(table.withColumn("seq", F.lit(-1).cast("bigint")).select("key", "field", "value", "seq"), path, ["key", "field"], "seq", buckets=16)
    for k in (0, 1, 1, 2):
        KF.upsert(updates.filter(F.pmod("seq", F.lit(3)) == k).select("key", "field", "value", F.col("seq").cast("bigint").alias("seq")), path, ["key", "field"], "seq", buckets=16)
    return KF.read(spark, path).drop("seq")


@query(
    "point_reads",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT n_nationkey * 29 + 1 FROM nation)",
)
def point_reads(spark, sf):
    """A few orders by key, out of files that hold a range of keys each."""
    path = scratch_path(spark, "ranged")
    KF.write_ranged(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, "o_orderkey", 16)
    return KF.read_keys(spark, path, "o_orderkey", load(spark, sf, "nation").select((F.col("n_nationkey") * 29 + 1).alias("o_orderkey")))


@query(
    "many_point_reads",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)",
)
def many_point_reads(spark, sf):
    """More keys than are pushed into a scan."""
    path = scratch_path(spark, "ranged")
    KF.write_ranged(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, "o_orderkey", 16)
    asked = load(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return KF.read_keys(spark, path, "o_orderkey", asked)
