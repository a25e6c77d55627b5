"""Every registered query with SQL gives the same rows as DuckDB, on the smallest tables."""

import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (date, datetime)):
        return v.isoformat()[:10] if not isinstance(v, datetime) else v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cursor = duck.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = sorted(repr([plain(r[c]) for c in order]) for r in df.collect())
    theirs = sorted(repr([plain(r[names.index(c)]) for c in order]) for r in cursor.fetchall())
    assert ours == theirs


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["q01_merge_flatten", "q02_inventory", "q07_grid_asof", "q19_runs", "q48_shards"])
def test_same_on_any_partitioning(spark, name):
    found = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(repr, registry.QUERIES[name](spark, SF).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


@pytest.mark.parametrize("name", ["q04_overlap_join", "q07_grid_asof", "q10_index_map", "q21_presence_filter", "q54_streaming_windows"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_whole_turns_reach_templates_and_split(spark, tmp_path):
    rows = [(1, 0, "user", "a question of more than twenty characters ASSISTANT: in it"), (1, 1, "assistant", "an answer of more than twenty characters")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = registry.QUERIES["q37b_whole_templates"](spark, str(tmp_path)).first()
    assert got.chain == " -> ".join(r[3] for r in rows) and got.chat.endswith(rows[1][3])
    got = registry.QUERIES["q61c_whole_marker_split"](spark, str(tmp_path)).first()
    assert got.prompt == "USER: a question of more than twenty characters" and got.answer == "in it ASSISTANT: " + rows[1][3]


def test_every_window_of_a_vector_has_a_row(spark, tmp_path):
    rows = [(1, 0, [0.0] * 8 + [0.0, 1.0] * 4), (2, 0, [0.0] * 20)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.vec_id, r.win): r.points for r in registry.QUERIES["q24b_window_control_points"](spark, str(tmp_path)).collect()}
    assert got == {(1, 0): 2, (1, 1): 8, (2, 0): 2, (2, 1): 2}
    assert (r := registry.QUERIES["q25b_window_tiers"](spark, str(tmp_path)).first()).p2 == 3 and r.p8 == 1


@pytest.fixture
def small_splits(spark):
    """Scans in splits smaller than a row group, so the first tasks have no rows."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_strict_lines_where_the_first_task_has_no_rows(spark, small_splits):
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert registry.QUERIES["q120b_strict_json_lines"](spark, SF).count() == events.count() > 0


def test_a_capital_is_one_letter(spark):
    from tidemark.operators.streams import replace_words

    rows = [(1, "Abcdefß"), (2, "abcdefß"), (3, "Abcdefg"), (4, "ßbcdefg")]
    synonyms = spark.createDataFrame([("abcdefß", "ßfedcba"), ("abcdefg", "a.foo-bar"), ("ßbcdefg", "gfedcbß")], "word string, synonym string")
    got = replace_words(spark.createDataFrame(rows, "k long, text string"), "k", "text", synonyms, 2.0)
    assert {r.k: r.text for r in got.collect()} == {1: "ẞfedcba", 2: "ßfedcba", 3: "A.foo-bar", 4: "gfedcbß"}


@pytest.mark.parametrize("name", ["q24_control_points", "q24b_window_control_points", "q25_tier_histogram", "q25b_window_tiers"])
def test_hundredths_are_floats_as_in_sql(spark, tmp_path, name):
    odd = [0.014999999664723873, 0.02500000037252903, 0.04500000178813934, 0.054999999701976776, 0.08500000089406967, 0.0949999988079071]
    rows = [(i, i % 2, [odd[(i + j * (i % 5 + 1)) % 6] * (-1) ** (j * (i % 3)) for j in range(16)]) for i in range(60)]
    spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    cursor = con.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    ours = sorted(repr([plain(r[c]) for c in names]) for r in registry.QUERIES[name](spark, str(tmp_path)).collect())
    assert ours == sorted(repr([plain(v) for v in r]) for r in cursor.fetchall())
