"""Warehouse tables as Spark catalog tables.

Two kinds of write, both published by the session catalog:

* whole tables (``replace_table``: K1 full refresh, K2 staging): the rows go to
  the one of two folders that the table does not point at, gates run on what
  was counted while writing, then ``ALTER TABLE ... SET LOCATION`` (or the first
  ``CREATE TABLE``) publishes them. The former rows stay until the next refresh.
* dimensions and the fact (``write_pending`` / ``publish``): the new content of
  the touched partitions is written aside, gated, and published by one dynamic
  partition overwrite; no other partition's files change. The folder is named in
  a table property, together with the last sequence key, before the overwrite
  starts and taken out after it. A run that finds the property first repeats the
  overwrite, which gives the same partitions however often it runs.

Catalog state (locations, properties) lasts as long as the session's catalog;
a cluster uses a persistent one. The partitioned tables lie at a fixed folder,
so a session that starts with an empty catalog declares them again and recovers
their partitions; it then takes the last sequence key from the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.sequence import max_key

PENDING = "ledgerline.pending"
#: Layout column of dimension tables; ``read`` leaves it out.
SLOT = "load_slot"


def column_ddl(schema: T.StructType, lengths: Mapping[str, int] = {}, defaults: Mapping[str, str] = {}) -> str:
    """K5 / K6: column list with NOT NULL, VARCHAR(n) and DEFAULT."""
    cols = []
    for f in schema.fields:
        kind = f"VARCHAR({lengths[f.name]})" if f.name in lengths else f.dataType.simpleString()
        cols.append(f"`{f.name}` {kind}{'' if f.nullable else ' NOT NULL'}"
                    + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else ""))
    return ", ".join(cols)


def in_layout(df: DataFrame, partitions: int, *layout: str | Column) -> DataFrame:
    """Rows ranged and sorted by columns (each name once) and computed positions.

    A position is a column of its own until the rows are sorted: a sort by an
    expression computes it again for both rows of every comparison."""
    placed = {f"_at_{i}": c for i, c in enumerate(layout) if isinstance(c, Column)}
    by = dict.fromkeys(c if isinstance(c, str) else f"_at_{i}" for i, c in enumerate(layout))
    return df.withColumns(placed).repartitionByRange(partitions, *by).sortWithinPartitions(*by).select(*df.columns)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, write_partitions: int | None = None,
                 db_prefix: str = "", dim_slots: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.write_partitions = write_partitions
        self.db_prefix = db_prefix  # several warehouses in one catalog
        self.dim_slots = dim_slots  # default: spark.sql.shuffle.partitions

    def partitions(self) -> int:
        return self.write_partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def q(self, name: str) -> str:
        """Catalog name of ``db.table`` (database prefixed)."""
        return f"{self.db_prefix}{name}" if "." in name else name

    def location(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    # -- K3 / K4 / K5 / K6 / K7 ---------------------------------------------
    def ensure_schemas(self, *names: str) -> None:
        for n in names:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.db_prefix}{n}`")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.q(name))

    def drop_table(self, name: str) -> None:
        """K4: the table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.q(name)}")
        for path in (self.location(name), f"{self.location(name)}__next"):
            self.delete_path(path)

    def create_table(self, name: str, schema: T.StructType, partition_by: tuple[str, ...] = (),
                     lengths: Mapping[str, int] = {}, defaults: Mapping[str, str] = {}) -> None:
        """K5: the typed target if absent; files that lie there already (an empty
        catalog over an old warehouse) become its partitions."""
        if self.exists(name):
            return
        path = self.location(name)
        held = bool(partition_by) and self.path_exists(path)
        part = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        self.spark.sql(f"CREATE TABLE {self.q(name)} ({column_ddl(schema, lengths, defaults)}) USING parquet "
                       f"OPTIONS ('partitionOverwriteMode' 'dynamic') {part} LOCATION '{path}'")
        if held:
            self.spark.sql(f"ALTER TABLE {self.q(name)} RECOVER PARTITIONS")

    def insert(self, df: DataFrame, name: str) -> None:
        """K6: append rows by column name; columns that ``df`` lacks take their default."""
        df.createOrReplaceTempView("ledgerline_insert")
        cols = ", ".join(f"`{c}`" for c in df.columns)
        self.spark.sql(f"INSERT INTO {self.q(name)} ({cols}) SELECT {cols} FROM ledgerline_insert")

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.q(name)).drop(SLOT)

    # -- whole tables: K1 / K2 ------------------------------------------------
    def write_aside(self, df: DataFrame, name: str, metrics: Iterable[Column] = ()) -> tuple[str, dict]:
        """Rows to the folder that the table does not use, and what was counted
        meanwhile (``n_rows`` and ``metrics``)."""
        here = self._location_of(name)
        path = f"{self.location(name)}/{'b' if here and here.endswith('/a') else 'a'}"
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("n_rows"), *metrics).write.mode("overwrite").parquet(path)
        return path, counted.get

    def point_at(self, name: str, path: str, schema: T.StructType) -> None:
        """Publish a folder of ``write_aside``: one catalog update."""
        if self.exists(name) and self.spark.table(self.q(name)).schema.simpleString() == schema.simpleString():
            self.spark.sql(f"ALTER TABLE {self.q(name)} SET LOCATION '{path}'")
            self.spark.sql(f"REFRESH TABLE {self.q(name)}")
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {self.q(name)}")
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self.spark.sql(f"CREATE TABLE {self.q(name)} ({column_ddl(nullable)}) USING parquet LOCATION '{path}'")

    def replace_table(self, df: DataFrame, name: str, metrics: Iterable[Column] = (),
                      gates: Callable[[dict], None] | None = None) -> int:
        """K1 / K2: replace the whole table; returns its row count (A1)."""
        path, counted = self.write_aside(df, name, metrics)
        if gates is not None:
            gates(counted)
        self.point_at(name, path, df.schema)
        return counted["n_rows"]

    def stage_table(self, df: DataFrame, name: str) -> DataFrame:
        """K2: rebuild a staging table and return it as read back."""
        self.replace_table(df, name)
        return self.read(name)

    # -- partitions of dimensions and the fact: D7 ----------------------------
    def write_pending(self, df: DataFrame, name: str, layout: Iterable[str | Column],
                      metrics: Iterable[Column] = ()) -> tuple[DataFrame, dict]:
        """The next content of the touched partitions, ranged and sorted by
        ``layout`` (K8: row groups with tight bounds, a hot partition value in
        many tasks), as read back; and what was counted while writing."""
        path, counted = f"{self.location(name)}__next", Observation()
        (in_layout(df, self.partitions(), *layout)
         .observe(counted, F.count(F.lit(1)).alias("n_rows"), *metrics).write.mode("overwrite").parquet(path))
        return self.spark.read.schema(df.schema).parquet(path), counted.get

    def publish(self, name: str, properties: Mapping[str, str] = {}, emptied: Iterable[str] = ()) -> None:
        """Make the pending rows the content of their partitions; ``emptied``:
        partition specifications that lose all rows. ``properties`` (sequence
        keys) are recorded in the same catalog update as the pending folder."""
        held = dict(properties) | {PENDING: "\n".join([f"{self.location(name)}__next", *emptied])}
        self._set_properties(name, held)
        self.finish_pending(name)

    def finish_pending(self, name: str) -> bool:
        """Carry out (again) a publication that was begun."""
        held = self.exists(name) and self.properties(name).get(PENDING)
        if not held:
            return False
        path, *emptied = held.split("\n")
        target = self.spark.table(self.q(name))
        rows = self.spark.read.schema(target.schema).parquet(path)
        rows.write.insertInto(self.q(name), overwrite=True)
        for spec in emptied:  # a dynamic overwrite keeps partitions that get no row
            col = spec.split(" = ")[0].strip("`")
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in target.schema.fields if f.name != col)
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.q(name)} PARTITION ({spec}) SELECT {nothing} WHERE false")
        self.spark.sql(f"ALTER TABLE {self.q(name)} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
        self.delete_path(path)
        return True

    # -- catalog properties: what backs serial keys ---------------------------
    def properties(self, name: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.q(name)}").collect()}

    def _set_properties(self, name: str, values: Mapping[str, str]) -> None:
        pairs = ", ".join("'{}' = '{}'".format(k, v.replace("'", "\\'")) for k, v in values.items())
        self.spark.sql(f"ALTER TABLE {self.q(name)} SET TBLPROPERTIES ({pairs})")

    def last_key(self, name: str, col: str) -> int:
        """Last value of a sequence key: as recorded, else the table's largest."""
        recorded = self.properties(name).get(f"sequence.{col}")
        return int(recorded) if recorded is not None else max_key(self.read(name), col)

    def slots(self, name: str) -> int:
        """Slots of a dimension: as its partitions were named, else the setting."""
        first = self.spark.sql(f"SHOW PARTITIONS {self.q(name)} PARTITION (is_active = true)").first()
        if first is not None:
            return int(first[0].rsplit("-of-", 1)[1])
        return self.dim_slots or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _location_of(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.q(name)}").collect()
        return next((r["data_type"].rstrip("/") for r in rows if r["col_name"] == "Location"), None)

    # -- files -----------------------------------------------------------------
    def _fs(self, path: str):
        """Hadoop file system and path object for any scheme (file, hdfs, s3a...)."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def path_exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def delete_path(self, path: str) -> None:
        fs, p = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """K6 for frames: column defaults for rows that lack a value."""
    for c, v in defaults.items():
        col = F.col(c) if c in df.columns else F.lit(None)
        df = df.withColumn(c, F.coalesce(col, F.lit(v)))
    return df
