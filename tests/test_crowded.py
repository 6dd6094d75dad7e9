"""Queries whose groups outgrow what a window or one key's task takes, against their SQL."""

import duckdb
import pytest

from loomwork.plans import registry

ROWS = 1_010


@pytest.fixture(scope="module")
def crowded(tmp_path_factory):
    """Customers of one house block, more than a window of 999 rows spans and of two labels, and three vectors."""
    at = tmp_path_factory.mktemp("crowded")
    con = duckdb.connect()
    con.sql(f"""copy (select k as c_custkey, 'Customer#' || k as c_name, (k % 3)::int as c_nationkey, 0.5::double as c_acctbal, ['FURNITURE', 'MACHINERY'][(k % 2 + 1)::int] as c_mktsegment
        from (select i * 700 + 2 as k from range({ROWS}) t(i) union all select i * 700 + 345 from range(6) t(i))) to '{at}/customer.parquet'""")
    con.sql(f"copy (select (i * 700 + 2)::bigint as vec_id, [1.0::float, i::float] as embedding from range(3) t(i)) to '{at}/embeddings.parquet'")
    for t in ("customer", "embeddings"):
        con.sql(f"create view {t} as from '{at}/{t}.parquet'")
    return str(at), con


def same_as_sql(spark, crowded, name, tmp_path):
    d, con = crowded
    registry.queries()[name](spark, d).write.parquet(f"{tmp_path}/got")
    cols = ", ".join(f'"{c}"' for (c, *_) in con.sql(f"describe from '{tmp_path}/got/*.parquet'").fetchall())
    con.sql(f"create or replace temp table want as {registry.oracle_sql()[name]}")
    con.sql(f"create or replace temp table got as select {cols} from '{tmp_path}/got/*.parquet'")
    n = con.sql("select (select count(*) from want), (select count(*) from got)").fetchall()[0]
    assert n[0] == n[1] > 0
    assert con.sql(f"select count(*) from (select {cols} from want except all from got)").fetchall() == [(0,)]


@pytest.mark.parametrize("name", ["grid_block_house", "haversine", "match_codes", "rule_crosstab", "combine_blocks_1km", "extra_pairs", "missed_pairs", "blocking_stats", "place_stats", "joined_features"])
def test_crowded_block_equals_sql(spark, crowded, tmp_path, name):
    same_as_sql(spark, crowded, name, tmp_path)


def test_pairs_of_ids_in_several_groups_come_once(spark):
    from loomwork.operators.pairs import pairs_in_groups, stars_in_groups

    rows = [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 4), ("c", 4), ("c", 4), (None, 5), (None, 6), ("d", 7), ("a", None)]
    df = spark.createDataFrame(rows, "k string, id long")
    want = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4)]
    assert sorted(tuple(r) for r in pairs_in_groups(df, ["k"], "id").collect()) == want
    assert sorted(tuple(r) for r in pairs_in_groups(df, ["k"], "id", tile=1).collect()) == want
    assert sorted(set(map(tuple, stars_in_groups(df, ["k"], "id").collect()))) == [(1, 2), (1, 3), (1, 4)]


def test_pairs_without_columns_take_little_room(spark, tmp_path):
    """Every pair is written, in at most half a byte each (1.1 in the order of a join of rows)."""
    from loomwork.operators.pairs import pairs_in_groups

    n = 3_000
    con, out = duckdb.connect(), f"{tmp_path}/out"
    pairs_in_groups(spark.range(2 * n).selectExpr("id", "id % 2 as k"), ["k"], "id").write.parquet(out)
    got = con.sql(f"select count(*), count(distinct ltable_id * {2 * n} + rtable_id), bool_and(ltable_id < rtable_id and (rtable_id - ltable_id) % 2 = 0) from '{out}/*.parquet'").fetchall()[0]
    assert got == (n * (n - 1), n * (n - 1), True)
    assert sum(f.stat().st_size for f in tmp_path.glob("out/*.parquet")) < 0.5 * n * (n - 1)


def test_pairs_of_any_keys_come_once(spark):
    from loomwork.operators.pairs import pairs_in_any_groups

    df = spark.createDataFrame([(1, "x", "p"), (2, "x", "p"), (3, "y", "p"), (4, "y", None), (5, None, None)], "id long, k string, m string")
    assert sorted(tuple(r) for r in pairs_in_any_groups(df, [["k"], ["m"]], "id", ["m"]).select("ltable_id", "rtable_id").collect()) == [(1, 2), (1, 3), (2, 3), (3, 4)]


def test_marked_stats_of_places_with_several_rows(spark):
    """The same figures as by joining, where places repeat."""
    from loomwork.operators import metrics, pairs

    rows = [(i, f"p{i % 9}", f"c{i % 4}", "1", 52.1, 4.1) for i in range(14)] + [(20, "q", "c1", "1", 52.1, 4.1), (21, "r", None, "1", 52.1, 4.1), (22, "s", "c2", None, 52.1, 4.1)]
    view = pairs.mark_solo(spark.createDataFrame(rows, "Id long, placeId string, clusterId string, houseNumber string, latitude double, longitude double"))
    cand = pairs.whole_house_block(view, ["clusterId", "placeId", "solo"]).where("placeId1 <> placeId2")
    gold = pairs.golden_pairs(view, ["solo"])
    assert metrics.marked_place_stats(cand, pairs.is_golden(), gold).collect() == metrics.place_stats(cand, gold).collect()
    assert metrics.marked_blocking_stats(cand, pairs.is_golden(), gold, view).collect() == metrics.blocking_stats(cand, gold, view).collect()


def test_greedy_clusters_by_home_equal_those_by_component(spark):
    from pyspark.sql import functions as F

    from loomwork.operators import clustering
    from loomwork.plans import surface

    scores = surface.scored_pairs(spark, "/root/testdata/sf0.01")
    one, two = (clustering.greedy_clusters(scores, 0.9, 0.95, home) for home in (None, "home"))
    assert one.count() == two.count() == one.join(two, ["id", "cluster"]).count() > 0
    a, b = (clustering.merge_clusters_simple(scores, two, 0.8, 6, home) for home in (None, "home"))
    assert a.count() == a.join(b, ["id", "cluster"]).count()
    rows = scores.join(spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select(F.col("c_custkey").alias("placeId1"), "c_nationkey"), "placeId1")
    assert rows.where(~F.col("home").startswith(F.concat(F.col("c_nationkey").cast("string"), F.lit(":")))).isEmpty()


def test_scored_pairs_join_by_bucket(spark):
    """The join's keys hold the bucket, so a group of one nation and segment isn't compared with all of itself."""
    from loomwork.plans import surface

    plan = surface.scored_pairs(spark, "/root/testdata/sf0.01")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bucket") >= 4


def test_merging_long_chains_in_order():
    from loomwork.operators.clustering import merge_in_order

    n = 20_000
    assert merge_in_order(((i, i + 1) for i in reversed(range(n))), dict.fromkeys(range(n + 1), 1), n + 1) == dict.fromkeys(range(1, n + 1), 0)


@pytest.mark.parametrize("name", ["pair_features", "feature_table", "unanimous_votes", "ensemble_score"])
def test_pairs_are_joined_with_nothing(spark, crowded, name):
    """The attributes come along with the rows: once pairs are made, they meet no exchange."""
    df = registry.queries()[name](spark, crowded[0])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_many1" in plan and plan.index("Union") < plan.index("Join")


def test_crowded_clusters_equal_sql(spark, tmp_path):
    """A house block of more rows than the window of 999 that these queries had: the last row, of another kind, scores 0.95 with each one before."""
    con = duckdb.connect()
    con.sql(f"""copy (select i * 700 + if(i < 1009, 7, 434) as c_custkey, 'Customer#' || i as c_name, 0::int as c_nationkey, 0.5::double as c_acctbal, 'FURNITURE' as c_mktsegment from range(1010) t(i)) to '{tmp_path}/customer.parquet'""")
    con.sql(f"create view customer as from '{tmp_path}/customer.parquet'")
    same_as_sql(spark, (str(tmp_path), con), "clusters_with_singletons", tmp_path)
    assert con.sql('select count(*), count(distinct "clusterId") from got').fetchall() == [(1010, 1)]
    assert [tuple(r) for r in registry.queries()["agglomerative_clusters"](spark, str(tmp_path)).groupBy("cluster").count().collect()] == [(0, 1010)]


@pytest.mark.parametrize("room", [1, 50, 1 << 19])
def test_first_pairs_cluster_as_all_pairs(spark, room):
    import random

    from pyspark.sql import functions as F

    from loomwork.operators import clustering

    r = random.Random(room)
    rows = sorted({(f"p{a}", f"p{b}"): (f"p{a}", f"p{b}", r.randrange(91, 100) / 100) for a, b in ((r.randrange(60), r.randrange(60)) for _ in range(400)) if a != b}.values(), key=lambda x: (-x[2], x[0], x[1]))
    of = clustering.match((i, *x) for i, x in enumerate(rows))
    first = clustering.first_pairs(spark.createDataFrame(rows, "a string, b string, score double").repartition(5), room)
    kept = sorted(map(tuple, first.collect()), key=lambda x: (-x[2], x[0], x[1]))
    assert set(kept) < set(rows) and len(kept) <= 60
    assert {k: rows[v][:2] for k, v in of.items()} == {k: kept[v][:2] for k, v in clustering.match((i, *x) for i, x in enumerate(kept)).items()}
    got = clustering.greedy_clusters(spark.createDataFrame([*rows, ("p1", "p2", float("nan")), (None, "p3", 0.99)], "placeId1 string, placeId2 string, prediction double"), 0.9, 0.9)
    number = {v: i for i, v in enumerate(sorted(set(of.values())))}
    assert {x["id"]: x["cluster"] for x in got.select("id", F.col("cluster").cast("int")).collect()} == {k: number[v] for k, v in of.items()}


def test_block_features_equal_those_of_each_pair(spark):
    """Tile by tile the same rows as pair by pair, vectors and ids in several groups included."""
    from pyspark.sql import functions as F

    from loomwork.operators import features, pairs

    view = registry.place_view(spark, "/root/testdata/sf0.01").where("Id < 700")
    view = view.withColumn("phoneNumbers", F.expr("case when Id % 5 = 0 then null when Id % 5 = 1 then array() when Id % 5 = 2 then array_repeat(phoneNumbers[0], 2) else array(phoneNumbers[0], '12345', null) end"))
    view = view.join(features.hashed_embedding(view, F.col("sourceNames")).where("Id % 4 > 0"), "Id", "left")
    view = features.prepare(view.withColumn("k", F.explode(F.array(F.col("Id") % 40, F.when(F.col("Id") % 3 == 0, F.col("Id") % 10)))))
    one = features.block_features(view, ["k"], "TST", vectors=True)
    both = pairs.pairs_in_groups(view, ["k"], "Id", [*features.ATTRS, *features.MADE, "vector"])
    two = features.carried_features(both, "TST", keep=[features.similarity().alias("similarity")])
    got, want = (df.select(sorted(df.columns)).toPandas().sort_values(["ltable_id", "rtable_id"], ignore_index=True) for df in (one, two))
    assert len(want) > 1_000 and got.equals(want)


def test_scores_in_bulk_equal_those_one_by_one():
    import random

    import pandas as pd

    from loomwork.functions import kernels as K

    r = random.Random(1)
    text = lambda n: "".join(r.choice("0123456789") for _ in range(r.randrange(n)))
    for n in (1, 11, 16, 17, 33, 64, 65, 90):
        a, b = [text(n) for _ in range(9)], [text(r.choice((n, 150))) for _ in range(140)]
        assert K.lcs_lengths(a, b).tolist() == [[K.lcs_length(x, y) for y in b] for x in a]
    a, b = ([r.choice([None, [], [text(12)], [text(12), None, text(70)]]) for _ in range(20)] for _ in range(2))
    codes, values = K.best_phones(a, b)
    assert values[codes].tolist() == [x for p in a for x in K._best_phone(pd.Series([p] * len(b), dtype=object), pd.Series(b, dtype=object))]
