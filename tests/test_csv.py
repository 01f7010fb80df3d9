"""CSV scans and batch landing."""

import os

import pytest

from ledgerline.plans.profiles import GCP, PSQL
from ledgerline.sources.csv import (force_all_columns, read_csv_by_name, read_csv_by_position,
                                    read_csv_text)
from ledgerline.sources.landing import batch_view, land_files
from ledgerline.sources.schemas import source_schema
from tests.fixtures import write_files


def test_by_name_quotes_header_blank(spark, tmpdir_path):
    files = write_files(tmpdir_path)
    raw = read_csv_text(spark, files["sales"])
    assert raw.columns[-1] == "updated_at"  # ' updated_at' trimmed
    cust = {r.customer_id: r for r in read_csv_by_name(
        spark, files["customers"], source_schema("customers", PSQL)).collect()}
    assert cust[41].address == "Quay 4, Upper Town" and cust[42].address is None
    prod = {r.product_id: r for r in read_csv_by_name(
        spark, files["products"], source_schema("products", PSQL)).collect()}
    assert prod[905].product_id == 905 and prod[901].category is None
    assert str(prod[900].price) == "1250.00"  # truncated by the cleaning rule
    stores = {r.store_id: r for r in read_csv_by_name(
        spark, files["stores"], source_schema("stores", PSQL)).collect()}
    assert stores[5].location == ""  # empty stays empty, only \N is NULL


def test_short_row_fails_on_full_read(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad.csv")
    with open(p, "w") as fh:
        fh.write("a,b,c\n1,2,3\n4,5\n")
    df = read_csv_text(spark, p)
    with pytest.raises(Exception):
        force_all_columns(df)


def test_by_position_ignores_header_names(spark, tmpdir_path):
    files = write_files(tmpdir_path)
    df = read_csv_by_position(spark, files["sales"], source_schema("sales", GCP))
    rows = {r.sale_id: r for r in df.collect()}
    assert rows[7002].total_amount == 7.5 and rows[7009].store_id == 88
    assert df.schema["sale_id"].dataType.simpleString() == "bigint"


def test_landing_and_batch_view(spark, tmpdir_path):
    files = write_files(os.path.join(tmpdir_path, "in"))
    root = os.path.join(tmpdir_path, "landing")
    land_files(spark, files, root, "20240101030000")
    with pytest.raises(Exception):  # a stamp folder is never overwritten
        land_files(spark, files, root, "20240101030000")
    df = batch_view(spark, root, "20240101030000", "customers",
                    source_schema("customers", GCP), view="v_customers")
    assert spark.sql("SELECT COUNT(*) FROM v_customers").first()[0] == 4
    assert {r.customer_id for r in df.collect()} == {41, 42, 47, 60}


def test_multiline_quoted_field_keeps_empty_vs_null(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "ml.csv")
    with open(p, "w") as fh:
        fh.write('customer_id,name,address,created_at,updated_at\n'
                 '1,"Rosa\nDiaz",,2024-03-04 08:15:00,2024-03-04 08:15:00\n'
                 '2,Ivo,\\N,2024-03-04 08:15:00,2024-03-04 08:15:00\n')
    rows = {r.customer_id: r for r in read_csv_by_name(
        spark, p, source_schema("customers", PSQL), multi_line=True).collect()}
    assert rows[1].name == "Rosa\nDiaz" and rows[1].address == "" and rows[2].address is None
