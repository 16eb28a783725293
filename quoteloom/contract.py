"""Declared table contracts: column names, types, required flags, partitioning.

A contract is the one place a table's shape is written down.  Projection,
renaming, casting, null rules and DDL are all driven by it, always by column
name and never by position.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

from quoteloom.errors import ContractError

# The type names a contract may use.  Names are looked up here and
# never evaluated.
TYPES_BY_NAME = {
    "DateType": T.DateType,
    "DoubleType": T.DoubleType,
    "FloatType": T.FloatType,
    "IntegerType": T.IntegerType,
    "LongType": T.LongType,
    "StringType": T.StringType,
    "TimestampType": T.TimestampType,
}


def quote_name(name: str) -> str:
    """Backtick every part of a possibly dotted table name."""
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


@dataclass(frozen=True)
class Field:
    """One column.  ``source`` is its name in incoming data, if different."""

    name: str
    type: str
    nullable: bool = True
    source: str | None = None

    def __post_init__(self):
        if self.type not in TYPES_BY_NAME:
            allowed = ", ".join(sorted(TYPES_BY_NAME))
            raise ContractError(f"column {self.name!r}: unknown type {self.type!r} (one of {allowed})")

    @property
    def data_type(self) -> T.DataType:
        return TYPES_BY_NAME[self.type]()

    @property
    def source_name(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class Contract:
    """The declared shape of one table."""

    table: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.fields:
            raise ContractError(f"{self.table}: no columns declared")
        names = self.columns
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ContractError(f"{self.table}: columns declared twice: {repeated}")
        unknown = [n for n in (*self.keys, *self.partition_by) if n not in names]
        if unknown:
            raise ContractError(f"{self.table}: keys or partitions not among the columns: {unknown}")

    @classmethod
    def from_spec(cls, table: str, spec: Mapping) -> Contract:
        """Build from a ``{"schema": [...], "partition_by": [...], "keys": [...]}`` mapping.

        ``partition_by`` takes plain names or ``{"field": name}`` entries.
        """
        try:
            fields = tuple(
                Field(f["name"], f["type"], bool(f.get("nullable", True)), f.get("source"))
                for f in spec["schema"]
            )
        except (KeyError, TypeError) as e:
            raise ContractError(f"{table}: a contract needs a schema of name/type entries") from e
        partition_by = tuple(
            p["field"] if isinstance(p, Mapping) else p for p in spec.get("partition_by") or ()
        )
        return cls(table, fields, tuple(spec.get("keys") or ()), partition_by)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if not f.nullable]

    @property
    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type, f.nullable) for f in self.fields])

    def create_table_sql(self, fmt: str | None = None, location: str | None = None) -> str:
        """``CREATE TABLE IF NOT EXISTS`` for this contract.

        Required flags are left out of the DDL on purpose: file tables do not
        enforce them, so :func:`quoteloom.operators.checks.check` does.
        """
        columns = ", ".join(
            f"{quote_name(f.name)} {f.data_type.simpleString()}" for f in self.fields
        )
        sql = f"CREATE TABLE IF NOT EXISTS {quote_name(self.table)} ({columns})"
        if fmt:
            sql += f" USING {fmt}"
        if self.partition_by:
            sql += f" PARTITIONED BY ({', '.join(quote_name(c) for c in self.partition_by)})"
        if location:
            sql += " LOCATION '" + location.replace("'", "\\'") + "'"
        return sql

    def at(self, table: str) -> Contract:
        """The same shape under another table name."""
        return Contract(table, self.fields, self.keys, self.partition_by)

    def partitioned_by(self, *columns: str) -> Contract:
        return Contract(self.table, self.fields, self.keys, columns)


class ContractBook:
    """Contracts by table name.

    Two layouts are read: ``{"tables": {name: spec}}``, and ``{zone: {name: spec}}``
    where no ``tables`` entry is present.
    """

    def __init__(self, contracts: Sequence[Contract]):
        self._by_table = {c.table: c for c in contracts}

    @classmethod
    def from_config(cls, config: Mapping) -> ContractBook:
        if not isinstance(config, Mapping):
            raise ContractError("contracts are read from a mapping")
        zones = [config["tables"]] if "tables" in config else list(config.values())
        if not zones or not all(isinstance(z, Mapping) and z for z in zones):
            raise ContractError("contracts are a 'tables' mapping or a mapping of zones to tables")
        return cls([Contract.from_spec(name, spec) for z in zones for name, spec in z.items()])

    @classmethod
    def from_file(cls, path: str) -> ContractBook:
        """Read a JSON file, or a YAML file where a YAML reader is installed."""
        with open(path, encoding="utf-8") as f:
            if path.endswith((".yaml", ".yml")):
                try:
                    import yaml
                except ImportError as e:
                    raise ContractError("no YAML reader is installed; use a JSON contract file") from e
                return cls.from_config(yaml.safe_load(f))
            return cls.from_config(json.load(f))

    def tables(self) -> list[str]:
        return sorted(self._by_table)

    def get(self, table: str) -> Contract:
        if table not in self._by_table:
            raise ContractError(f"no contract for table {table!r}")
        return self._by_table[table]
