"""S4 table registry and K10 query text."""

import pytest

from ledgerline.plans.sql import markers, run_sql, run_statement, statement
from ledgerline.sources.registry import RegistryError, load_registry, registry_of


def entry(name, role, **fields):
    return {name: {"type": role, "schema_fields": [{"name": n, "type": t} for n, t in fields.items()]}}


def test_registry_keeps_order_roles_and_types(tmp_path):
    import yaml
    path = tmp_path / "warehouse.yaml"
    path.write_text(yaml.safe_dump({"tables": [
        entry("harbours", "dimension", code="INTEGER", depth="FLOAT64", label="STRING"),
        entry("arrivals", "fact", ship="STRING", at="TIMESTAMP", tons="INTEGER")]}))
    found = load_registry(str(path))
    assert list(found) == ["harbours", "arrivals"]
    assert [found[t].role for t in found] == ["dimension", "fact"]
    assert found["harbours"].schema.simpleString() == "struct<code:bigint,depth:double,label:string>"
    assert found["arrivals"].schema.names == ["ship", "at", "tons"]


BROKEN = [{"tables": []}, {}, None, ["tables"], {"tables": [{**entry("a", "fact", x="STRING"), **entry("b", "fact", x="STRING")}]},
          {"tables": [entry("a", "fact", x="STRING"), entry("a", "fact", x="STRING")]}, {"tables": [entry("a", "fact")]},
          {"tables": [entry("a", "lookup", x="STRING")]}, {"tables": [entry("a", "fact", x="GEOGRAPHY")]}, {"tables": ["a"]},
          {"tables": [{"a": {"type": "fact", "schema_fields": [{"type": "STRING"}]}}]},
          {"tables": [{"a": {"type": "fact", "schema_fields": [{"name": "x", "mode": "REPEATED"}]}}]}]


@pytest.mark.parametrize("content", BROKEN)
def test_registry_rejects_what_it_cannot_use(content):
    with pytest.raises(RegistryError):
        registry_of(content)


def test_registry_file_must_exist(tmp_path):
    with pytest.raises(RegistryError):
        load_registry(str(tmp_path / "absent.yaml"))


def test_statements_and_their_markers(spark, tmp_path):
    text = "SELECT ship, ':quoted' AS q -- :note\nFROM IDENTIFIER(:t) WHERE tons::int > :least"
    (tmp_path / "late.sql").write_text(text)
    assert statement("late", tmp_path) == text and markers(text) == {"t", "least"}
    spark.sql("SELECT 'x' AS ship, 3 AS tons").createOrReplaceTempView("late_t")
    assert run_statement(spark, "late", tmp_path, t="late_t", least=2).count() == 1
    for args in ({"t": "late_t"}, {"t": "late_t", "least": 2, "more": 1}):
        with pytest.raises(ValueError, match="marker"):
            run_statement(spark, "late", tmp_path, **args)
    with pytest.raises(FileNotFoundError):
        statement("absent", tmp_path)


def test_named_parameters(spark):
    spark.range(12).selectExpr("id AS tons").createOrReplaceTempView("arrivals_t")
    got = run_sql(spark, "SELECT SUM(tons) AS s FROM IDENTIFIER(:t) WHERE tons % :step = 0", {"t": "arrivals_t", "step": 5})
    assert got.first().s == 15
