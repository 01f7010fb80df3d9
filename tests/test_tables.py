"""K4-K6: dropping, typed empty targets, column defaults."""

import os

import pytest
from pyspark.sql import types as T

from ledgerline.plans.tables import Warehouse, with_defaults


def test_typed_target(spark, tmpdir_path):
    """K4-K6: declared once, lengths enforced by the insert, defaults filled."""
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="de_")
    wh.ensure_schemas("t")
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType()),
                           T.StructField("price", T.DecimalType(10, 2)), T.StructField("active", T.BooleanType()),
                           T.StructField("day", T.DateType())])
    for _ in range(2):  # a second call changes nothing
        wh.create_table("t.typed", schema, ("day",), {"name": 3}, {"active": "true", "price": "1.5"})
    assert spark.table("de_t.typed").schema.simpleString() == schema.simpleString()
    wh.insert(spark.sql("SELECT 1 AS id, 'abc' AS name, DATE'2024-01-01' AS day"), "t.typed")
    assert [(r.id, r.active, str(r.price)) for r in wh.read("t.typed").collect()] == [(1, True, "1.50")]
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        wh.insert(spark.sql("SELECT 1 AS id, 'abcd' AS name"), "t.typed")
    ddl = spark.sql("SHOW CREATE TABLE de_t.typed").first()[0]
    assert "VARCHAR(3)" in ddl and "DEFAULT" in ddl
    wh.replace_table(spark.range(3), "t.snap")
    for name in ("t.typed", "t.snap"):
        wh.drop_table(name)
        assert not wh.exists(name) and not os.path.exists(wh.location(name))


def test_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, False)], "id int, is_active boolean")
    got = with_defaults(df, {"is_active": True, "note": "new"}).orderBy("id").collect()
    assert [(r.is_active, r.note) for r in got] == [(True, "new"), (False, "new")]
