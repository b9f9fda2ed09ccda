import pytest
from pyspark.sql import functions as F

from footfall.operators import quality
from footfall.operators.quality import Check, Suite
from footfall.plans.checks import CHECKS


def failing(df):
    return df.first().failing_rows


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "a", None), (1, "a", None), (1, "b", 2), (None, None, 3), (None, "c", -1)]
    return spark.createDataFrame(data, "k INT, t STRING, n INT")


def test_rules(rows, spark):
    assert failing(quality.not_null(rows, "k")) == 2
    assert failing(quality.unique(rows, "k")) == 2  # three copies, two too many
    assert failing(quality.accepted_values(rows, "k", ["2", "3"])) == 3
    assert failing(quality.unique_combination(rows, ["k", "t"])) == 1
    assert failing(quality.unique_combination(rows, ["k", "n"])) == 1  # nulls are equal
    assert failing(quality.assert_expression(rows, "n > 0")) == 3  # null is not true
    parent = spark.createDataFrame([("a",)], "f STRING")
    assert failing(quality.relationships(rows, "t", parent, "f")) == 2
    empty = rows.where("false")
    assert failing(quality.unique(empty, "k")) == 0
    assert failing(quality.relationships(empty, "t", parent, "f")) == 0


@pytest.mark.parametrize(
    "wrong",
    [
        {"kind": "nonsense", "column": "k"},
        {"kind": "not_null"},
        {"kind": "assert_expression", "column": "k", "expression": "true"},
        {"kind": "accepted_values", "column": "k"},
        {"kind": "relationships", "column": "k", "parent": "p"},
        {"kind": "unique_combination", "columns": ("k",)},
        {"kind": "assert_expression", "expression": "  "},
    ],
)
def test_wrong_declarations(wrong):
    with pytest.raises(ValueError):
        Check("m", **wrong)


def test_suite_tells_errors_from_failures(rows):
    checks = [
        Check("m", "not_null", "k"),
        Check("m", "not_null", "absent"),
        Check("m", "assert_expression", expression="t is null or cast(t as int) > 0"),
        Check("m", "unique", "t"),
        Check("other", "not_null", "k"),
        Check("m", "relationships", "k", parent="nowhere", parent_column="k"),
        Check("m", "accepted_values", "t", values=("a", "b", "c")),
    ]
    found = Suite({"m": rows}, checks).run().collect()
    status = {(r.model_name, r.column_name, r.test_name): r.status for r in found}
    assert status == {
        ("m", "k", "not_null"): "fail",
        ("m", "absent", "not_null"): "error",
        ("m", None, "assert_expression"): "error",  # the cast raises while running
        ("m", "t", "unique"): "fail",
        ("other", "k", "not_null"): "error",
        ("m", "k", "relationships"): "error",
        ("m", "t", "accepted_values"): "pass",
    }
    assert all(r.error for r in found if r.status == "error")


def test_select_takes_named_models_only(rows):
    checks = [Check("m", "not_null", "k"), Check("n", "not_null", "k")]
    found = Suite({"m": rows, "n": rows}, checks, select=["n"]).results()
    assert [r.model_name for r in found.collect()] == ["n"]
    assert Suite({}, checks, select=["none"]).results().count() == 0


def test_row_rules_of_a_model_share_a_scan(rows):
    checks = [Check("m", "not_null", c) for c in "ktn"]
    plan = Suite({"m": rows}, checks).results()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_declared_checks():
    assert len(CHECKS) == 101
    assert len({(c.model, c.column, c.kind, c.expression) for c in CHECKS}) == 101
