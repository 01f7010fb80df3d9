"""Dimension / fact specs and the two warehouse profiles.

A profile bundles every rule on which the two warehouses differ (match key,
change test, close scope, carry-forward, key kind, fact lookup and update
columns). Operators take a profile; nothing else branches on its name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Attr:
    """One descriptive attribute: source column -> dimension column."""

    source: str
    target: str
    kind: str = "text"  # "text" or "money"


@dataclass(frozen=True)
class DimSpec:
    name: str                 # customer / product / store
    source_table: str         # customers / products / stores
    natural_id: str           # customer_id ...
    key_col: str              # customer_key ...
    attrs: tuple[Attr, ...]

    @property
    def attr_cols(self) -> list[str]:
        return [a.target for a in self.attrs]

    def attr(self, target: str) -> Attr:
        return next(a for a in self.attrs if a.target == target)


# The three dimensions and their column names.
CUSTOMER = DimSpec("customer", "customers", "customer_id", "customer_key",
                   (Attr("name", "customer_name"), Attr("address", "customer_address")))
PRODUCT = DimSpec("product", "products", "product_id", "product_key",
                  (Attr("name", "product_name"), Attr("category", "product_category"),
                   Attr("price", "product_price", "money")))
STORE = DimSpec("store", "stores", "store_id", "store_key",
                (Attr("name", "store_name"), Attr("location", "store_location")))
DIMENSIONS = {d.name: d for d in (CUSTOMER, PRODUCT, STORE)}


@dataclass(frozen=True)
class Profile:
    name: str
    source_system: str
    id_type: T.DataType                     # natural ids in staging / dims
    money_type: T.DataType                  # price / amount as read from source
    staged_money_type: T.DataType           # price / amount in staging
    stored_money_type: T.DataType           # price / amount in dim / fact
    dim_key_type: T.DataType                # surrogate key of dims
    match_on_natural: bool                  # False: staged id; True: (natural id, source_system)
    change_rule: str                        # padded | hash | nullsafe
    close_scope: str                        # all_versions | active
    carry_forward: bool                     # NULL text attrs take the old value
    dim_key_kind: str                       # sequence | hash | uuid
    writes_created: bool                    # created_at + created_date in dims
    store_load_date_is_run_ts: bool
    lookup_how: str                         # left | inner
    lookup_on_source_system: bool
    fact_key_kind: str                      # sequence | epoch
    fact_key_type: T.DataType
    fact_updated_at_from_sale_date: bool
    fact_update_cols: tuple[str, ...]
    fact_has_created_date: bool
    dim_partition_by: tuple[str, ...] = ()
    dim_cluster_by: tuple[str, ...] = ()
    fact_partition_by: tuple[str, ...] = ("sale_date_key",)
    fact_cluster_by: tuple[str, ...] = ()
    tracked_by_dim: dict = field(default_factory=dict)
    round_before_compare: bool = False      # compare money in the stored type

    def tracked(self, dim: DimSpec) -> list[str]:
        extra = self.tracked_by_dim.get(dim.name, ())
        return dim.attr_cols + list(extra)

    def match_keys(self, dim: DimSpec) -> list[str]:
        return [dim.natural_id, "source_system"] if self.match_on_natural else ["id"]


# The column policy of each profile's fact merge.
PSQL_FACT_UPDATE = ("customer_key", "product_key", "store_key", "sale_time", "quantity",
                    "total_amount", "updated_at", "dwh_load_date")
GCP_FACT_UPDATE = ("sales_id", "source_system", "customer_key", "product_key", "store_key",
                   "sale_time", "sale_date_key", "quantity", "total_amount", "updated_at",
                   "dwh_load_date")

PSQL = Profile(
    name="psql", source_system="emea",
    id_type=T.IntegerType(), money_type=T.DecimalType(10, 2),
    staged_money_type=T.DecimalType(10, 2), stored_money_type=T.DecimalType(10, 2),
    dim_key_type=T.IntegerType(),
    match_on_natural=False, change_rule="padded", close_scope="all_versions",
    carry_forward=True, dim_key_kind="sequence",
    writes_created=False, store_load_date_is_run_ts=False,
    lookup_how="left", lookup_on_source_system=False,
    fact_key_kind="sequence", fact_key_type=T.LongType(),
    fact_updated_at_from_sale_date=True, fact_update_cols=PSQL_FACT_UPDATE,
    fact_has_created_date=False,
    tracked_by_dim={},
)

GCP = Profile(
    name="gcp", source_system="global",
    id_type=T.LongType(), money_type=T.DoubleType(),
    staged_money_type=T.DecimalType(38, 9), stored_money_type=T.DecimalType(10, 2),
    dim_key_type=T.StringType(),
    match_on_natural=True, change_rule="hash", close_scope="active",
    carry_forward=False, dim_key_kind="hash",
    writes_created=True, store_load_date_is_run_ts=True,
    lookup_how="inner", lookup_on_source_system=True,
    fact_key_kind="epoch", fact_key_type=T.StringType(),
    fact_updated_at_from_sale_date=False, fact_update_cols=GCP_FACT_UPDATE,
    fact_has_created_date=True,
    dim_partition_by=("created_date",), dim_cluster_by=("KEY", "is_active"),
    fact_cluster_by=("sales_key", "customer_key", "product_key", "store_key"),
    # updated_at is tracked for customers and stores, not for products
    tracked_by_dim={"customer": ("updated_at",), "store": ("updated_at",)},
)

PROFILES = {"psql": PSQL, "gcp": GCP}

# Declared VARCHAR lengths of the psql warehouse tables.
PSQL_LENGTHS = {"id": 50, "source_system": 20, "customer_name": 100, "customer_address": 255,
                "product_name": 100, "product_category": 100, "store_name": 100,
                "store_location": 255}


def with_rule(profile: Profile, change_rule: str) -> Profile:
    """Same profile with another change rule (e.g. ``nullsafe``)."""
    from dataclasses import replace
    return replace(profile, change_rule=change_rule)
