"""Specs: faults, clauses, and the same query written as SQL."""

import pytest

from sluiceway.operators import grouped, ordered
from sluiceway.plans import SpecError, check_spec, query_from_spec, stage_from_spec
from sluiceway.sources import from_item

PEOPLE = [(1, "Ada", "N", 10), (2, "Bo", "S", 20), (3, "Cy", "N", 30), (4, "Di", None, 40), (5, "Ada", "S", None)]
VISITS = [(1, 5), (1, 7), (2, 1), (3, 9), (3, 9), (9, 2)]


@pytest.fixture(scope="module", autouse=True)
def views(spark):
    spark.createDataFrame(PEOPLE, "id int, name string, area string, age int").coalesce(1).cache().createOrReplaceTempView("people")
    spark.createDataFrame(VISITS, "person int, hours int").coalesce(1).cache().createOrReplaceTempView("visits")


def run(spark, **spec):
    return [tuple(row) for row in query_from_spec(spark, spec).collect()]


def sql(spark, text):
    return [tuple(row) for row in spark.sql(text).collect()]


BASE = {"select_columns": ["p.id"], "table_name": "people p"}
JOIN = {"join_type": "INNER", "join_table": "visits v", "join_condition": "p.id = v.person"}


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"select_columns": None}, "select_columns must be a non-empty list"),
        ({"select_columns": []}, "select_columns must be a non-empty list"),
        ({"select_columns": ["p.id", " "]}, "select_columns must be a non-empty list of non-empty strings"),
        ({"select_columns": "p.id"}, "select_columns must be a non-empty list"),
        ({"table_name": ""}, "table_name must be a non-empty string"),
        ({"table_name": 3}, "table_name must be a non-empty string"),
        ({"where_conditions": ["p.id > 1"]}, "where_conditions must be a non-empty string"),
        ({"having": " "}, "having must be a non-empty string"),
        ({"group_by": "p.id"}, "group_by must be a non-empty list"),
        ({"order_by": [1]}, "order_by must be a non-empty list of non-empty strings"),
        ({"join_conditions": []}, "join_conditions must be a non-empty list"),
        ({"join_conditions": ["x"]}, r"join_conditions\[0\] must be a mapping"),
        ({"join_conditions": [{**JOIN, "join_type": ""}]}, r"join_conditions\[0\].join_type must be"),
        ({"join_conditions": [{"join_type": "LEFT", "join_condition": "1=1"}]}, r"\.join_table must be"),
        ({"join_conditions": [{"join_type": "LEFT", "join_table": "visits v"}]}, r"\.join_condition must be"),
        ({"join_conditions": [{**JOIN, "join_type": "CROSS"}]}, "takes no join_condition"),
        ({"join_conditions": [{**JOIN, "join_type": "cross join"}]}, "takes no join_condition"),
        ({"unions": {}}, "unions must be a non-empty list"),
        ({"unions": [{"table_name": "visits"}]}, r"unions\[0\].select_columns is required"),
        ({"unions": [{"select_columns": ["x"]}]}, r"unions\[0\].table_name is required"),
        ({"unions": [{**BASE, "group_by": []}]}, r"unions\[0\].group_by must be"),
        ({"unions": [{**BASE, "join_conditions": [{}]}]}, r"unions\[0\].join_conditions\[0\].join_type must be"),
    ],
)
def test_faults(change, message):
    with pytest.raises(SpecError, match=message):
        check_spec({**BASE, **change})


def test_faults_of_the_root():
    with pytest.raises(SpecError, match="must be a mapping"):
        check_spec(["select_columns"])
    with pytest.raises(SpecError, match="select_columns is required; table_name is required"):
        check_spec({})


def test_unknown_keys_and_nested_unions_are_errors(spark):
    assert len(run(spark, **BASE, load_file=True)) == 5
    for spec, message in (
        ({**BASE, "where_condition": "p.id > 1"}, "where_condition is not a known key"),
        ({**BASE, "unions": [{**BASE, "unions": [BASE]}]}, r"unions\[0\].unions is not a known key"),
        ({**BASE, "unions": [{**BASE, "load_type": "append"}]}, r"unions\[0\].load_type is not a known key"),
        ({**BASE, "join_conditions": [{**JOIN, "on": "x"}]}, r"join_conditions\[0\].on is not a known key"),
    ):
        with pytest.raises(SpecError, match=message):
            query_from_spec(spark, spec)


def test_outputs_may_have_any_name(spark):
    df = grouped(from_item(spark, "people"), ["area AS __k0", "COUNT(*) AS __h", "MAX(id) AS __s0"], ["area"], "MIN(age) > 1", ["MIN(age)"])
    assert df.columns == ["__k0", "__h", "__s0"] and df.count() > 0
    spec = {"select_columns": ["area", "COUNT(*) AS __h"], "table_name": "people", "group_by": ["area"], "having": "MAX(age) > 0"}
    assert query_from_spec(spark, spec).columns == ["area", "__h"]


def test_select_repeats_and_computes(spark):
    assert run(spark, select_columns=["id", "id", "age * 2 AS twice", "*"], table_name="people", where_conditions="id = 2") == [
        (2, 2, 40, 2, "Bo", "S", 20)
    ]


def test_select_distinct(spark):
    rows = run(spark, select_columns=["DISTINCT p.name"], table_name="people p", order_by=["name DESC"])
    assert rows == [("Di",), ("Cy",), ("Bo",), ("Ada",)]


def test_from_items(spark):
    for item in ("people p", "people AS p", "(SELECT * FROM people WHERE id > 0) p"):
        assert len(run(spark, select_columns=["p.id"], table_name=item)) == 5
    rows = run(spark, select_columns=["p.id"], table_name="people p, visits v", where_conditions="p.id = v.person")
    assert sorted(rows) == [(1,), (1,), (2,), (3,), (3,)]


def test_two_part_names(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS spec_sales")
    spark.sql("CREATE OR REPLACE TEMP VIEW two_part_source AS SELECT 1 AS id")
    spark.table("two_part_source").write.mode("overwrite").saveAsTable("spec_sales.orders")
    assert run(spark, select_columns=["o.id"], table_name="spec_sales.orders o") == [(1,)]
    spark.sql("DROP DATABASE spec_sales CASCADE")


GROUPED = {
    "table_name": "people p",
    "join_conditions": [JOIN],
    "group_by": ["p.area"],
}


def test_group_having_and_order_over_things_not_selected(spark):
    rows = run(
        spark,
        **GROUPED,
        select_columns=["COUNT(DISTINCT p.id) AS people"],
        having="MAX(v.hours) > 2 AND p.area IS NOT NULL",
        order_by=["MIN(p.age) DESC", "p.area"],
    )
    assert rows == [(2,)]


def test_having_on_an_alias_and_order_by_an_alias(spark):
    spec = {**GROUPED, "select_columns": ["p.area AS zone", "SUM(v.hours) AS hours"]}
    assert run(spark, **spec, having="hours > 0", order_by=["hours ASC"]) == [("S", 1), ("N", 30)]
    assert run(spark, **spec, having="hours > 1") == [("N", 30)]
    assert run(spark, **spec, having="SUM(hours) > 1") == [("N", 30)]
    assert run(spark, **spec, having="hours > 1 AND MAX(v.hours) < 10") == [("N", 30)]


def test_having_and_order_by_that_aggregate_other_things(spark):
    spec = {**GROUPED, "select_columns": ["p.area AS zone"]}
    assert run(spark, **spec, having="MIN(p.age) > 5", order_by=["COUNT(*) DESC", "MAX(p.id)"]) == [("N",), ("S",)]


@pytest.mark.parametrize("by", ["hours * 2 DESC", "MAX(v.hours) DESC", "MIN(p.age)", "1", "upper(p.area)", "zone", "-SUM(v.hours)"])
@pytest.mark.parametrize("having", [None, "hours > 0", "SUM(v.hours) > 0", "MIN(p.id) < 3", "zone > 'A'", "p.area > 'A'"])
def test_having_and_order_by_in_any_combination(spark, by, having):
    spec = {**GROUPED, "select_columns": ["p.area AS zone", "SUM(v.hours) AS hours"], "order_by": [by]}
    assert run(spark, **spec, **({"having": having} if having else {})) == [("N", 30), ("S", 1)]


def test_group_by_number_and_by_alias(spark):
    spec = {"select_columns": ["upper(name) AS who", "COUNT(*) AS n"], "table_name": "people", "order_by": ["who"]}
    expected = [("ADA", 2), ("BO", 1), ("CY", 1), ("DI", 1)]
    assert run(spark, **spec, group_by=["1"]) == expected
    assert run(spark, **spec, group_by=["who"]) == expected
    assert run(spark, **spec, group_by=["upper(name)"]) == expected
    with pytest.raises(ValueError, match="group_by item 3"):
        run(spark, **spec, group_by=["3"])


def test_group_without_aggregates(spark):
    assert sorted(run(spark, select_columns=["hours"], table_name="visits", group_by=["person", "hours"])) == [
        (1,), (2,), (5,), (7,), (9,)
    ]


def test_global_aggregates(spark):
    assert run(spark, select_columns=["COUNT(*) AS n", "AVG(age)"], table_name="people") == [(5, 25.0)]
    assert run(spark, select_columns=["COUNT(*) AS n"], table_name="people", having="MAX(age) > 100") == []


def test_column_that_is_not_grouped_is_an_error(spark):
    with pytest.raises(Exception, match="MISSING_AGGREGATION"):
        run(spark, **GROUPED, select_columns=["p.name"])


def test_order_by(spark):
    def ids(*order_by):
        return [row[0] for row in run(spark, **BASE, order_by=list(order_by))]

    assert ids("p.name ASC", "p.age DESC") == [1, 5, 2, 3, 4]
    assert ids("p.area desc nulls first", "p.id desc") == [4, 5, 2, 3, 1]
    assert ids("age DESC NULLS LAST") == [4, 3, 2, 1, 5]
    assert ids("age % 20", "id desc") == [5, 4, 2, 3, 1]
    assert ids("CASE WHEN p.name = 'Bo' THEN 0 ELSE 1 END ASC", "id") == [2, 1, 3, 4, 5]


def test_order_by_number(spark):
    spec = {"select_columns": ["name", "COUNT(*) AS n"], "table_name": "people", "group_by": ["name"]}
    assert run(spark, **spec, order_by=["2 DESC", "1 DESC"])[:2] == [("Ada", 2), ("Di", 1)]
    assert run(spark, select_columns=["area", "id"], table_name="people", order_by=["2 DESC"])[0] == ("S", 5)
    assert run(spark, **UNION | {"unions": UNION["unions"][:1], "order_by": ["2 DESC"]})[0] == ("Ada", 9)
    with pytest.raises(ValueError, match="order_by item 3"):
        run(spark, **spec, order_by=["3"])


def test_subqueries_windows_and_generators_are_expressions_too(spark):
    inside = "EXISTS (SELECT 1 FROM visits v WHERE v.person = p.id AND v.hours > 5)"
    assert run(spark, **BASE, where_conditions=inside, order_by=["p.id"]) == [(1,), (3,)]
    assert run(spark, **BASE, where_conditions="p.id NOT IN (SELECT person FROM visits)", order_by=["p.id"]) == [(4,), (5,)]
    rows = run(
        spark,
        select_columns=["id", "row_number() OVER (PARTITION BY area ORDER BY id DESC) AS n"],
        table_name="people",
        order_by=["id"],
    )
    assert rows == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 1)]
    assert len(run(spark, select_columns=["explode(array(id, age)) AS v"], table_name="people")) == 10


def test_order_by_prefers_the_selected_name(spark):
    rows = run(spark, select_columns=["-id AS id"], table_name="people", order_by=["id"])
    assert rows == [(-5,), (-4,), (-3,), (-2,), (-1,)]
    rows = run(spark, select_columns=["-id AS id"], table_name="people", group_by=["people.id"], order_by=["id"])
    assert rows == [(-5,), (-4,), (-3,), (-2,), (-1,)]


def test_long_run_of_ties_is_spread_over_tasks(spark):
    df = ordered(spark.range(0, 80000, numPartitions=8).selectExpr("id", "id div 70000 AS k"), ["k DESC"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 80000 and max(sizes) < 30000
    ks = [row.k for row in df.collect()]
    assert ks == sorted(ks, reverse=True)


UNION = {
    "select_columns": ["p.name", "p.id"],
    "table_name": "people p",
    "where_conditions": "p.id < 4",
    "order_by": ["p.name DESC", "p.id ASC"],
    "unions": [
        {"select_columns": ["'Ada' AS x", "person"], "table_name": "visits", "group_by": ["person"], "order_by": ["person DESC"]},
        {
            "select_columns": ["p.area", "p.area"],
            "table_name": "people p",
            "join_conditions": [JOIN, {"join_type": "CROSS", "join_table": "(SELECT 1 AS one) o"}],
            "having": "p.area = \"S\"",
            "group_by": ["p.area"],
        },
    ],
}


def test_union_is_a_sorted_set(spark):
    spec = {**UNION, "unions": UNION["unions"][:1]}
    assert run(spark, **spec) == [("Cy", 3), ("Bo", 2), ("Ada", 1), ("Ada", 2), ("Ada", 3), ("Ada", 9)]


def test_union_of_numbers_and_text_follows_ansi_typing(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run(spark, **UNION)


def test_union_widths_must_match(spark):
    with pytest.raises(Exception, match="NUM_COLUMNS_MISMATCH"):
        run(spark, **{**UNION, "unions": [{"select_columns": ["id"], "table_name": "people"}]})


def test_repeated_columns_survive_a_union(spark):
    branch = {"select_columns": ["z.id", "z.id"], "table_name": "people z"}
    assert run(spark, **branch, unions=[branch], order_by=["z.id DESC"])[0] == (5, 5)


def test_predicate_in_where_next_to_the_join(spark):
    rows = run(
        spark,
        select_columns=["a.id", "c.id"],
        table_name="people a",
        where_conditions="a.id = v.person AND a.id < c.id",
        join_conditions=[
            {"join_type": "INNER", "join_table": "visits v", "join_condition": "a.id = v.person"},
            {"join_type": "INNER", "join_table": "people c", "join_condition": "a.name = c.name"},
            {"join_type": "CROSS", "join_table": "(SELECT 1 AS one) o"},
        ],
        group_by=["a.id", "c.id"],
    )
    assert rows == [(1, 5)]


def test_spec_equals_sql(spark):
    text = """SELECT p.area, SUM(v.hours) AS hours, COUNT(DISTINCT p.id) FROM people p
              LEFT JOIN visits v ON p.id = v.person AND v.hours > 1 WHERE p.age > 5
              GROUP BY p.area HAVING COUNT(*) > 0 ORDER BY hours DESC NULLS LAST, p.area"""
    assert sql(spark, text) == run(
        spark,
        select_columns=["p.area", "SUM(v.hours) AS hours", "COUNT(DISTINCT p.id)"],
        table_name="people p",
        join_conditions=[{**JOIN, "join_type": "left", "join_condition": "p.id = v.person AND v.hours > 1"}],
        where_conditions="p.age > 5",
        group_by=["p.area"],
        having="COUNT(*) > 0",
        order_by=["hours DESC NULLS LAST", "p.area"],
    )


def test_grouped_keeps_no_hidden_columns(spark):
    df = grouped(from_item(spark, "people"), ["COUNT(*) AS n"], ["area"], "MAX(age) > 1", ["MIN(age)"])
    assert df.columns == ["n"]


def test_having_on_a_key_reaches_the_scan(spark, tmp_path):
    spark.table("people").write.parquet(str(tmp_path / "people"))
    df = grouped(spark.read.parquet(str(tmp_path / "people")), ["area", "COUNT(*)"], ["area"], "area = 'N'")
    assert "PushedFilters: [IsNotNull(area), EqualTo(area,N)]" in df._jdf.queryExecution().executedPlan().toString()


def test_stage_from_spec(spark):
    assert stage_from_spec(spark, BASE) is None
    with pytest.raises(SpecError, match="staging_table_name"):
        stage_from_spec(spark, {**BASE, "load_table": True})
    spec = {**BASE, "load_table": True, "staging_table_name": "spec_staged"}
    assert stage_from_spec(spark, spec).rows_loaded == 5
    assert stage_from_spec(spark, spec).created is False
    result = stage_from_spec(spark, {**spec, "load_type": "truncate"})
    assert (result.rows_removed, result.rows_loaded) == (10, 5)
    assert spark.table("spec_staged").columns == ["id", "load_ts"]
    spark.sql("DROP TABLE spec_staged")


def test_stage_from_spec_through_a_connector(spark, tmp_path):
    target = {"format": "parquet", "options": {"path": str(tmp_path / "out")}}
    spec = {**BASE, "load_table": True, "staging_table_name": "files", **target}
    assert stage_from_spec(spark, spec).rows_removed == 0
    result = stage_from_spec(spark, {**spec, "load_type": "overwrite"})
    assert (result.rows_removed, result.rows_loaded) == (None, 5)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    with pytest.raises(ValueError, match="options need a connector format"):
        stage_from_spec(spark, {**BASE, "load_table": True, "staging_table_name": "files", "options": {"path": "x"}})
