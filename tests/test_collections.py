import random

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import cells as CE
from fleetpulse.operators import keyed as K
from fleetpulse.operators import lookup as L
from fleetpulse.operators import ranking as RK
from fleetpulse.operators import sets as ST
from fleetpulse.operators import wordcount as WC
from fleetpulse.operators.reach import edges, reach
from fleetpulse.sources import sinks, tables

# Sample sentences and adjacency lists with known answers.
SENTENCES = [
    "the cow jumped over the moon",
    "the man went to the store and bought some candy",
    "four score and seven years ago",
    "how many apples can you eat",
    "to be or not to be the person",
]
TWEETERS = {
    "foo.com/blog/1": ["sally", "bob", "tim", "george", "nathan"],
    "engineering.twitter.com/blog/5": ["adam", "david", "sally", "nathan"],
    "tech.backtype.com/blog/123": ["tim", "mike", "john"],
}
FOLLOWERS = {
    "sally": ["bob", "tim", "alice", "adam", "jim", "chris", "jai"],
    "bob": ["sally", "nathan", "jim", "mary", "david", "vivian"],
    "tim": ["alex"],
    "nathan": ["sally", "bob", "adam", "harry", "chris", "vivian", "emily", "jordan"],
    "adam": ["david", "carissa"],
    "mike": ["john", "bob"],
    "john": ["alice", "nathan", "jim", "mike", "bob"],
}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- words and reach


def test_word_queries(spark):
    counts = WC.word_count(spark.createDataFrame([(s,) for s in SENTENCES], "sentence string"))
    assert dict(rows(counts))["the"] == 5 and dict(rows(counts))["be"] == 2
    args = spark.createDataFrame([(1, "cat the dog jumped"), (2, "the the")], "id int, args string")
    assert rows(WC.count_lookup(args, counts)) == [("jumped", 1), ("the", 5), ("the", 5), ("the", 5)]
    assert rows(WC.count_total(args, counts, ["id"])) == [(1, 6), (2, 10)]
    assert WC.count_total(args, counts).first()["sum"] == 16


def adjacency(spark, lists):
    return edges(spark.createDataFrame(list(lists.items()), "k string, m array<string>"), "k", "m")


def test_reach(spark):
    urls = spark.createDataFrame([("aaa",), *[(u,) for u in TWEETERS]], "url string")
    followers = adjacency(spark, FOLLOWERS)
    got = dict(rows(reach(urls, adjacency(spark, TWEETERS), followers.union(followers))))
    assert got == {"aaa": 0, "foo.com/blog/1": 16, "engineering.twitter.com/blog/5": 14, "tech.backtype.com/blog/123": 7}


# ---- ranks


def scores(spark, n=600, seed=1):
    rng = random.Random(seed)
    data = [("hot" if rng.random() < 0.8 else f"k{rng.randrange(5)}", f"m{i:04d}", float(rng.randrange(20))) for i in range(n)]
    return data, spark.createDataFrame(data, "key string, member string, score double")


def ranked(data, descending=False):
    out = {}
    for key in {d[0] for d in data}:
        mine = sorted([d for d in data if d[0] == key], key=lambda d: (d[2], d[1]), reverse=descending)
        out.update({(d[0], d[1]): i for i, d in enumerate(mine)})
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_rank(spark, descending, hot_rows):
    data, df = scores(spark)
    got = {(r.key, r.member): r["rank"] for r in RK.rank(df, descending, hot_rows=hot_rows).collect()}
    assert got == ranked(data, descending)


@pytest.mark.parametrize("start,end", [(0, 4), (2, 2), (-3, -1), (-1, -1), (3, -3), (-9, 5), (0, -1), (0, 5000), (5, 2)])
def test_ranges(spark, start, end):
    data, df = scores(spark)
    order = ranked(data, True)
    want = set()
    for key in {d[0] for d in data}:
        members = sorted((k for k in order if k[0] == key), key=order.get)
        n = len(members)
        lo, hi = (start if start >= 0 else n + start), (end if end >= 0 else n + end)
        want |= {(m, i) for i, m in enumerate(members) if lo <= i <= hi}
    got = {((r.key, r.member), r["rank"]) for r in RK.top_range(df, start, end, hot_rows=100).collect()}
    assert got == want
    kept = {(r.key, r.member) for r in RK.remove_by_rank(df, start, end, hot_rows=100).collect()}
    ascending = ranked(data)
    sizes = {k: sum(1 for d in data if d[0] == k) for k in {d[0] for d in data}}

    def doomed(m):
        n = sizes[m[0]]
        lo, hi = (start if start >= 0 else n + start), (end if end >= 0 else n + end)
        return lo <= ascending[m] <= hi

    assert kept == {m for m in ascending if not doomed(m)}


def test_top_is_cut_before_the_shuffle(spark):
    _, df = scores(spark, 50)
    plan = RK.top_range(df, 0, 9)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_score_writes_and_reads(spark):
    writes = spark.createDataFrame([("a", "x", 1.0, 1), ("a", "x", 5.0, 2), ("a", "y", 2.0, 1)], "key string, member string, score double, seq int")
    table = RK.upsert_scores(writes)
    assert rows(table) == [("a", "x", 5.0), ("a", "y", 2.0)]
    deltas = spark.createDataFrame([("a", "x", -1.0), ("b", "n", 3.0)], "key string, member string, delta double")
    assert rows(RK.increment_scores(table, deltas)) == [("a", "x", 4.0), ("a", "y", 2.0), ("b", "n", 3.0)]
    assert rows(RK.remove_members(table, writes.filter("member = 'x'"))) == [("a", "y", 2.0)]
    assert rows(RK.score_range(table, 5.0, 3.0)) == [("a", "x", 5.0)]
    assert rows(RK.count_in_range(table, 2.0, 2.0)) == [("a", 2, 1)]
    asked = spark.createDataFrame([("a", "y"), ("a", "z")], "key string, member string")
    assert sorted(rows(RK.scores_of(table, asked)), key=str) == [("a", "y", 2.0), ("a", "z", None)]
    assert rows(RK.remove_by_score(table, 3.0, 9.0)) == [("a", "y", 2.0)]


# ---- sets


def test_sets(spark):
    data = [("a", "1"), ("a", "2"), ("a", "2"), ("a", "3"), ("b", "2"), ("b", "3"), ("c", "3"), ("c", "4")]
    df = spark.createDataFrame(data, "key string, member string")
    assert rows(ST.union(df, "a", "c")) == [("1",), ("2",), ("3",), ("4",)]
    assert rows(ST.intersection(df, "a", "b", "c")) == [("3",)]
    assert rows(ST.intersection(df, "a", "none")) == []
    assert rows(ST.difference(df, "a", "b", "c")) == [("1",)]
    assert rows(ST.difference(df, "a")) == [("1",), ("2",), ("3",)]
    stored = ST.store(df, "b", ST.union(df, "c"))
    assert rows(stored.filter("key = 'b'")) == [("b", "3"), ("b", "4")]
    new = spark.createDataFrame([("a", "1"), ("d", "9")], "key string, member string")
    assert ST.add(df, new).count() == 8
    assert rows(ST.remove(df, new).filter("key = 'a'")) == [("a", "2"), ("a", "2"), ("a", "3")]
    assert rows(ST.cardinality(df)) == [("a", 3), ("b", 2), ("c", 2)]
    assert rows(ST.is_member(df, new)) == [("a", "1", True), ("d", "9", False)]
    assert rows(ST.members(df, "a")) == [("1",), ("2",), ("3",)]
    drawn = rows(ST.random_member(df, 3))
    assert drawn == rows(ST.random_member(df.repartition(3), 3)) and all((k, m) in data for k, m in drawn)


# ---- keyed tables


def test_counters_and_upserts(spark):
    deltas = spark.createDataFrame([("a", 3), ("a", -5), ("b", 1)], "key string, delta int")
    stored = spark.createDataFrame([("a", 10), ("c", 1)], "key string, value bigint")
    assert rows(K.add_to_counters(stored, deltas, ["key"])) == [("a", 8), ("b", 1), ("c", 1)]

    table = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "key string, n int, t string")
    updates = spark.createDataFrame(
        [("a", 9, None, 1), ("a", None, "z", 2), ("a", 8, None, 0), ("c", None, "new", 1)], "key string, n int, t string, seq int")
    merged = K.merge_fields(table, updates, ["key"])
    assert sorted(rows(merged), key=str) == [("a", 9, "z"), ("b", 2, "y"), ("c", None, "new")]

    long = spark.createDataFrame([("a", "f", "1"), ("a", "g", "2")], "key string, field string, value string")
    change = spark.createDataFrame([("a", "f", "3", 0), ("a", "f", "4", 1)], "key string, field string, value string, seq int")
    assert rows(K.merge_hash(long, change)) == [("a", "f", "4"), ("a", "g", "2")]
    assert rows(K.delete_fields(long, change)) == [("a", "g", "2")]


def test_conditional_inserts(spark):
    table = spark.createDataFrame([("a", "old")], "key string, value string")
    new = spark.createDataFrame([("a", "n", 1), ("b", "late", 5), ("b", "first", 2)], "key string, value string, seq int")
    assert rows(K.insert_if_absent(table, new, ["key"])) == [("a", "old"), ("b", "first")]
    assert rows(K.insert_all_if_absent(table, new, ["key"])) == [("a", "old")]
    assert rows(K.insert_all_if_absent(table, new.filter("key = 'b'"), ["key"])) == [("a", "old"), ("b", "late")]


def test_lists(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate("xyxzx")] + [("b", 7, "x")], "key string, pos bigint, value string")

    def values(out, key="a"):
        return [r.value for r in out.filter(F.col("key") == key).orderBy("pos").collect()]

    assert values(K.list_range(df, 0, -1)) == list("xyxzx")
    assert values(K.list_range(df, 1, -2)) == list("yxz")
    assert values(K.list_range(df, -2, -1)) == list("zx")
    assert values(K.list_index(df, -2)) == ["z"] and values(K.list_index(df, 9)) == []
    assert rows(K.list_length(df)) == [("a", 5), ("b", 1)]
    assert values(K.remove_values(df, F.lit("x"), 2)) == list("yzx")
    assert values(K.remove_values(df, F.lit("x"), -1)) == list("xyxz")
    assert values(K.remove_values(df, F.lit("x"), 0)) == list("yz")
    new = spark.createDataFrame([("a", 10, "p"), ("a", 11, "q"), ("c", 1, "r")], "key string, seq bigint, value string")
    assert values(K.push(df, new)) == list("xyxzxpq") and values(K.push(df, new), "c") == ["r"]
    assert values(K.push(df, new, left=True)) == list("qpxyxzx")


def test_keys_and_lookup(spark):
    df = spark.createDataFrame([("BIG:1", 1), ("BIG:22", None), ("x.y", 3), ("xzy", 4)], "k string, v int")
    find = lambda p: [r.k for r in L.keys_like(df, "k", p).orderBy("k").collect()]
    assert find("BIG:*") == ["BIG:1", "BIG:22"] and find("BIG:?") == ["BIG:1"]
    assert find("x.y") == ["x.y"] and find("x[z]y") == ["xzy"] and find("*") == ["BIG:1", "BIG:22", "x.y", "xzy"]
    asked = spark.createDataFrame([("BIG:1",), ("BIG:1",), ("none",), ("BIG:22",)], "k string")
    assert L.lookup_by_key(asked, df, "k").count() == 4 and L.lookup_by_key(asked, df, "k", False).count() == 3
    assert rows(L.found_values(asked, df, "k", "v")) == [("BIG:1", 1)]
    assert L.drop_missing(df, "v").count() == 3


# ---- wide rows


def test_cells(spark):
    data = [("r", "f", "a", "1", 1), ("r", "f", "a", "2", 2), ("r", "f", "b", "3", 1), ("r", "g", "a", "4", 1), ("s", "f", "a", "5", 1)]
    df = spark.createDataFrame(data, "row_key string, family string, qualifier string, value string, seq int")
    assert rows(CE.merge_cells(df))[0] == ("r", "f", "a", "2") and CE.merge_cells(df).count() == 4
    assert sorted(rows(CE.wide_rows(df, "f", ["a", "b"])), key=str) == [("r", "2", "3"), ("s", "5", None)]
    keys = spark.createDataFrame([("r",), ("none",)], "row_key string")
    assert sorted(rows(CE.get_cells(df, keys, "f", "a")), key=str) == [("none", None), ("r", "2")]
    assert {r.row_key: r.columns for r in CE.family_map(df, "f").collect()} == {"r": {"a": "2", "b": "3"}, "s": {"a": "5"}}
    assert {r.row_key: r.families for r in CE.row_map(df).collect()}["r"] == {"f": {"a": "2", "b": "3"}, "g": {"a": "4"}}
    assert CE.delete_cells(df, keys).count() == 1
    family = spark.createDataFrame([("r", "f")], "row_key string, family string")
    assert CE.delete_cells(df, family).count() == 2
    cell = spark.createDataFrame([("r", "f", "b")], "row_key string, family string, qualifier string")
    assert CE.delete_cells(df, cell).count() == 4
    wide = spark.createDataFrame([("k", "7", "x")], "k string, a string, b string")
    assert rows(CE.unpivot_values(wide, "k", ["a", "b"])) == [("k", "a", 7)]


# ---- sources and sinks


def test_generic_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, t string")
    assert [r.row for r in tables.rows_as_maps(df).orderBy(F.col("row")["id"]).collect()] == [{"id": "1", "t": ""}, {"id": "2", "t": "b"}]
    assert rows(tables.rows_as_json(df)) == [('{"id":1,"t":null}',), ('{"id":2,"t":"b"}',)]
    assert rows(tables.last_row(df, "id")) == [(2, "b")] and tables.last_row(df.limit(0), "id").count() == 0
    rules = spark.createDataFrame([(None, None, None)], "OPTION string, VALUE int, ALARM_LEVEL int")
    assert tuple(tables.with_rule_defaults(rules).first()) == ("=", 0, None)
    assert sinks.log_sample(spark.range(10_000), "id", seed=1).count() < 200


def test_refreshing_table(spark):
    now, loads = [0.0], []
    table = tables.RefreshingTable(lambda s: loads.append(1) or s.range(1), 300, lambda: now[0])
    for moment in (0, 300, 301, 500):
        now[0] = moment
        table(spark)
    assert len(loads) == 2


def test_spread_only_widens(spark):
    assert tables.spread(spark.range(0, 9, 1, 1), "id").rdd.getNumPartitions() == 4
    assert tables.spread(spark.range(0, 90, 1, 7), "id").rdd.getNumPartitions() == 7


def test_file_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert tables.read_table(spark, path=path).count() == 3


def test_rows_of_one_row_group_are_dealt_to_several_tasks(spark, tmp_path):
    """A file of one row group has as many splits as its bytes, but all rows are in one of them."""
    path = str(tmp_path / "one")
    spark.range(0, 100_000, 1, 1).selectExpr("id", "uuid() AS text").write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        source = spark.read.parquet(path)
        sizes = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
        assert source.rdd.getNumPartitions() >= 4 and sizes(source)[1] == 100_000
        tasks, most = sizes(tables.deal(source, "id", rows=10_000))
        assert tasks == 10 and most < 12_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
