"""Declared-schema registry read from YAML.

The file lists tables under ``tables``; each entry maps one table name to its
``type`` (dimension or fact) and ``schema_fields`` (``name``, ``type``, ``mode``).
``load_registry`` gives a :class:`TableSpec` with a Spark ``StructType`` per
table, in file order. What cannot be a table is an error that names it: a missing or
unreadable file, no tables, an entry with more than one name, a name twice, a
table without fields, an unknown role, field type or mode.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import yaml
from pyspark.sql import types as T

# Registry type names and the Spark type each maps to.
TYPE_MAP = {
    "INTEGER": T.LongType(), "INT64": T.LongType(),
    "FLOAT": T.DoubleType(), "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9), "BIGNUMERIC": T.DecimalType(38, 9),
    "STRING": T.StringType(), "BOOL": T.BooleanType(), "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(),
    "DATE": T.DateType(),
}
ROLES = ("dimension", "fact")
#: Nullable or not, by mode.
MODES = {"NULLABLE": True, "REQUIRED": False}


class RegistryError(RuntimeError):
    pass


@dataclass(frozen=True)
class TableSpec:
    name: str
    role: str
    schema: T.StructType


def _pick(table: dict, value: object, where: str) -> object:
    if value not in table:
        raise RegistryError(f"{where}: {value!r} is none of {', '.join(table)}")
    return table[value]


def _field(table: str, declared: dict) -> T.StructField:
    if not isinstance(declared, dict) or not declared.get("name"):
        raise RegistryError(f"{table}: a field without a name")
    where = f"{table}.{declared['name']}"
    kind = _pick(TYPE_MAP, str(declared.get("type", "STRING")).upper(), where)
    return T.StructField(declared["name"], kind, _pick(MODES, str(declared.get("mode", "NULLABLE")).upper(), where))


def _table(name: str, declared: dict) -> TableSpec:
    if not isinstance(declared, dict) or not declared.get("schema_fields"):
        raise RegistryError(f"{name}: no fields")
    role = _pick(dict.fromkeys(ROLES), declared.get("type"), name) or declared["type"]
    return TableSpec(name, role, T.StructType([_field(name, f) for f in declared["schema_fields"]]))


def registry_of(document: object) -> dict[str, TableSpec]:
    """Table name -> spec of a parsed registry document."""
    listed = document.get("tables") if isinstance(document, dict) else None
    if not listed:
        raise RegistryError("no tables in the registry")
    specs: dict[str, TableSpec] = {}
    for entry in listed:
        if not isinstance(entry, dict) or len(entry) != 1:
            raise RegistryError(f"not one table: {entry!r}")
        for name, declared in entry.items():
            if name in specs:
                raise RegistryError(f"{name}: listed twice")
            specs[name] = _table(name, declared)
    return specs


def load_registry(path: str) -> dict[str, TableSpec]:
    try:
        document = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except (OSError, UnicodeDecodeError, yaml.YAMLError) as exc:
        raise RegistryError(f"registry {path}: {exc}") from exc
    return registry_of(document)
