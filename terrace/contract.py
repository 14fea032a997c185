"""Dataset contracts: ordered columns, types, keys, domains, ranges, partitions.

A contract is plain data (it loads from the same YAML shape a team already
keeps next to its SQL) and compiles to two Spark artefacts:

* a ``StructType`` used for reading text sources, for catalog tables and for
  conforming a result to the declared shape;
* a list of quality rules, compiled to Column predicates in
  :mod:`terrace.operators.quality`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

_DECIMAL = re.compile(r"^decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)$")

# The type names a contract may use.
_SIMPLE_TYPES = {
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def spark_type(type_name: str) -> T.DataType:
    """Spark type for a contract type name such as ``decimal(12,2)``."""
    key = type_name.strip().lower()
    if key in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[key]
    match = _DECIMAL.match(key)
    if match:
        return T.DecimalType(int(match.group(1)), int(match.group(2)))
    raise ValueError(f"Unsupported contract type '{type_name}'.")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    allowed_values: tuple[Any, ...] | None = None
    min_value: Any | None = None
    max_value: Any | None = None

    @property
    def data_type(self) -> T.DataType:
        return spark_type(self.type)

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> "ColumnSpec":
        allowed = raw.get("allowed_values")
        return cls(
            name=str(raw["name"]),
            type=str(raw.get("type", "string")),
            nullable=bool(raw.get("nullable", True)),
            allowed_values=tuple(allowed) if isinstance(allowed, list) else None,
            min_value=raw.get("min_value"),
            max_value=raw.get("max_value"),
        )


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    partition_columns: tuple[str, ...] = ()
    description: str = ""

    @property
    def names(self) -> list[str]:
        return [column.name for column in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.data_type, c.nullable) for c in self.columns])

    def column(self, name: str) -> ColumnSpec:
        for column in self.columns:
            if column.name == name:
                return column
        raise KeyError(name)

    def with_partitions_last(self) -> "Contract":
        """Column order a catalog table shows: data columns, then partitions."""
        data = [c for c in self.columns if c.name not in self.partition_columns]
        parts = [self.column(p) for p in self.partition_columns]
        return Contract(self.name, tuple(data + parts), self.primary_key, self.partition_columns, self.description)

    @classmethod
    def from_dict(cls, name: str, raw: dict[str, Any]) -> "Contract":
        columns = tuple(ColumnSpec.from_dict(c) for c in raw.get("columns", []))
        if not columns:
            raise ValueError(f"Contract '{name}' declares no columns.")
        names = [c.name for c in columns]
        if len(set(names)) != len(names):
            raise ValueError(f"Contract '{name}' declares a column twice.")
        primary_key = tuple(raw.get("primary_key") or ())
        partitions = tuple(raw.get("partition_columns") or ())
        for key in primary_key + partitions:
            if key not in names:
                raise ValueError(f"Contract '{name}' names unknown column '{key}'.")
        return cls(name, columns, primary_key, partitions, str(raw.get("description", "")))


def load_contracts(source: str | Path | dict[str, Any]) -> dict[str, Contract]:
    """Contracts from a YAML file (``datasets:`` mapping) or an already-parsed dict."""
    if isinstance(source, dict):
        raw = source
    else:
        import yaml

        raw = yaml.safe_load(Path(source).read_text(encoding="utf-8"))
    datasets = raw.get("datasets", raw)
    return {name: Contract.from_dict(name, body) for name, body in datasets.items()}
