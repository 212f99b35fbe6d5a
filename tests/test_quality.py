"""Data-quality operators: one seeded violation per check kind."""

import pytest

from pyspark.sql import functions as F

from tickerlake.operators import quality as dq


@pytest.fixture()
def tables(spark):
    child = spark.createDataFrame([(1, "A", 5), (2, "A", -1), (3, None, None), (3, "Z", 7)],
                                  "id int, sym string, qty int")
    parent = spark.createDataFrame([("A",), ("B",)], "sym string")
    return {"child": child, "parent": parent}


def test_each_kind_finds_its_violation(tables):
    c = tables["child"]
    assert dq.not_null(c, "sym").count() == 1
    assert [r.id for r in dq.unique(c, "id").collect()] == [3]
    assert dq.unique_combination(c, ["sym"]).count() == 1
    assert [r.sym for r in dq.relationships(c, "sym", tables["parent"], "sym").collect()] == ["Z"]
    # NULL qty passes; -1 fails
    assert [r.id for r in dq.expression_is_true(c, "qty > 0").collect()] == [2]
    assert dq.expression_is_true(c, "qty > 0", where="sym = 'Z'").count() == 0


def test_report_fuses_row_checks_and_gates(tables):
    checks = [
        dq.Check("sym.not_null", "child", "not_null", column="sym"),
        dq.Check("qty.positive", "child", "expression_is_true", expression="qty > 0", where="qty is not null"),
        dq.Check("id.unique", "child", "unique", column="id"),
        dq.Check("sym.fk", "child", "relationships", column="sym", parent="parent", parent_column="sym"),
        dq.Check("parent.ok", "parent", "not_null", column="sym"),
    ]
    rep = {r.check_name: (r.failures, r.passed) for r in dq.quality_report(checks, tables).collect()}
    assert rep == {"sym.not_null": (1, False), "qty.positive": (1, False), "id.unique": (1, False),
                   "sym.fk": (1, False), "parent.ok": (0, True)}
    with pytest.raises(dq.QualityError):
        dq.assert_quality(dq.quality_report(checks, tables))
    dq.assert_quality(dq.quality_report(checks[-1:], tables))


def test_standard_checks_count():
    assert len(dq.standard_checks()) == 33


def test_relationship_on_unique_key_is_fused_and_counts_rows(spark):
    child = spark.createDataFrame([("A", 1), ("A", 2), ("Z", 3), ("Z", 4), ("Y", 5), (None, 6)],
                                  "sym string, qty int")
    parent = spark.createDataFrame([("A",), ("B",), (None,)], "sym string")
    checks = [
        dq.Check("sym.unique", "child", "unique", column="sym"),
        dq.Check("sym.fk", "child", "relationships", column="sym", parent="parent", parent_column="sym",
                 where="sym is not null"),
        dq.Check("qty.small", "child", "expression_is_true", expression="qty < 5"),
    ]
    tables = {"child": child, "parent": parent}
    rep = {r.check_name: r.failures for r in dq.quality_report(checks, tables).collect()}
    # Z (2 rows) and Y (1 row) have no parent; NULL keys are not checked
    assert rep == {"sym.unique": 2, "sym.fk": 3, "qty.small": 2}
    assert dq.relationships(child, "sym", parent, "sym").count() == 3


def test_hot_orphan_is_split(spark):
    """Rows of a missing key that holds most of the child are dealt to several tasks by AQE; the rows are those of an anti-join."""
    n = 60_000
    i = F.col("id")
    child = spark.range(0, n, numPartitions=8).select(
        "id", F.when(i < n * 9 // 10, "HOT").when(i % 100 == 0, None).otherwise(F.concat(F.lit("K"), i % 500)).alias("key"),
        F.sha2(i.cast("string"), 256).alias("pad"))
    parent = spark.range(250).select(F.concat(F.lit("K"), "id").alias("name"))
    parent = parent.union(parent)  # repeated parents do not repeat rows
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = dq.relationships(child, "key", parent, "name")
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan and out.columns == child.columns
    expected = {x for x in range(n) if x < n * 9 // 10 or (x % 100 and x % 500 >= 250)}
    assert len(rows) == len(expected) and {r.id for r in rows} == expected
    assert dq.relationships(child, "key", parent, "name", where="id >= 59000").count() == len([x for x in expected if x >= 59000])
