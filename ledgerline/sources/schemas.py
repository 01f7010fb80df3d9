"""Declared source schemas per profile (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerline.plans.profiles import Profile

_TS = T.TimestampNTZType()


def source_schema(table: str, profile: Profile) -> T.StructType:
    """Source (OLTP / CSV) table schema: psql per its DDL, gcp per its registry."""
    idt = profile.id_type
    store_id = T.ShortType() if profile.name == "psql" else idt
    money = profile.money_type
    cols = {
        "customers": [("customer_id", idt), ("name", T.StringType()),
                      ("address", T.StringType())],
        "products": [("product_id", idt), ("name", T.StringType()),
                     ("category", T.StringType()), ("price", money)],
        "stores": [("store_id", store_id), ("name", T.StringType()),
                   ("location", T.StringType())],
        "sales": [("sale_id", idt), ("customer_id", idt), ("product_id", idt),
                  ("store_id", idt), ("sale_date", _TS), ("quantity", idt),
                  ("total_amount", money)],
    }[table]
    cols += [("created_at", _TS), ("updated_at", _TS)]
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SOURCE_TABLES = ("customers", "products", "stores", "sales")
