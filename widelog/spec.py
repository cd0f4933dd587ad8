"""Tables of the wide-row model: columns with roles, from schema text or by hand."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from .schema_text import Schema, Statement, parted, tokens
from .schema_text import statement as read_statement
from .types import Decimals, SourceType, UnsupportedType, parse_type, spark_type

PARTITION, CLUSTERING, STATIC, REGULAR = "partition", "clustering", "static", "regular"
# Table properties that stay when schema text is cut down.
KEPT_PROPERTIES = ("bloom_filter_fp_chance", "compression", "default_time_to_live", "min_index_interval", "max_index_interval")
LAST_MODIFIED = "last_modified_timestamp"


@dataclass(frozen=True)
class Column:
    name: str
    type: SourceType
    role: str = REGULAR
    descending: bool = False

    def field(self, position: int, decimals: Decimals | None = None) -> T.StructField:
        """A nullable Spark field that carries the column's role as metadata."""
        about = {
            "position": position,
            "sourceType": str(self.type),
            "isPartitionKey": self.role == PARTITION,
            "isPrimaryKey": self.role in (PARTITION, CLUSTERING),
            "isClusteringKey": self.role == CLUSTERING,
            "isStaticColumn": self.role == STATIC,
            "isValueColumn": self.role == REGULAR,
        }
        return T.StructField(self.name, spark_type(self.type, self.name, decimals), True, about)


@dataclass(frozen=True)
class Replication:
    """strategy: SimpleStrategy (options: replication_factor), NetworkTopologyStrategy (by data centre) or LocalStrategy."""

    strategy: str
    options: dict[str, int] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return sum(self.options.values())

    @classmethod
    def from_options(cls, given: dict[str, str]) -> Replication:
        given = dict(given)
        name = str(given.pop("class")).rsplit(".", 1)[-1]
        if name not in ("SimpleStrategy", "NetworkTopologyStrategy", "LocalStrategy"):
            raise ValueError(f"unknown replication strategy {name}")
        return cls(name, {k: int(v) for k, v in given.items()})


@dataclass(frozen=True)
class TableSpec:
    keyspace: str
    name: str
    columns: tuple[Column, ...]
    indexes: int = 0
    default_ttl: int = 0
    create_statement: str = ""
    decimals: Decimals | None = None

    def __post_init__(self) -> None:
        order = {PARTITION: 0, CLUSTERING: 1, STATIC: 2, REGULAR: 3}
        object.__setattr__(self, "columns", tuple(sorted(self.columns, key=lambda c: order[c.role])))
        if not self.partition_key:
            raise ValueError(f"{self.name} has no partition key")

    def named(self, role: str) -> list[str]:
        return [c.name for c in self.columns if c.role == role]

    @property
    def partition_key(self) -> list[str]:
        return self.named(PARTITION)

    @property
    def clustering_key(self) -> list[str]:
        return self.named(CLUSTERING)

    @property
    def primary_key(self) -> list[str]:
        return self.partition_key + self.clustering_key

    @property
    def statics(self) -> list[str]:
        return self.named(STATIC)

    @property
    def regulars(self) -> list[str]:
        return self.named(REGULAR)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def struct_type(self, features: tuple[str, ...] = ()) -> T.StructType:
        """The read schema; feature columns come last."""
        fields = [c.field(k, self.decimals) for k, c in enumerate(self.columns)]
        return T.StructType([*fields, *(T.StructField(f, T.TimestampType(), True) for f in features)])

    def partition_size_type(self) -> T.StructType:
        keys = [c.field(k, self.decimals) for k, c in enumerate(self.columns) if c.role == PARTITION]
        return T.StructType([*keys, T.StructField("uncompressed", T.LongType()), T.StructField("compressed", T.LongType())])

    @classmethod
    def of(cls, name: str, pk: dict[str, str], ck: dict[str, str] | None = None, regular: dict[str, str] | None = None, static: dict[str, str] | None = None, keyspace: str = "ks", udts: dict[str, SourceType] | None = None) -> TableSpec:
        """From {column: type text} by role."""
        roles = ((PARTITION, pk), (CLUSTERING, ck or {}), (STATIC, static or {}), (REGULAR, regular or {}))
        return cls(keyspace, name, tuple(Column(n, parse_type(t, udts), role) for role, given in roles for n, t in given.items()))

    @classmethod
    def from_ddl(cls, ddl: str, keyspace: str | None = None, table: str | None = None, udts: tuple[str, ...] = (), decimals: Decimals | None = None) -> TableSpec:
        """From a CREATE TABLE statement, or from a whole schema's text with keyspace and table named."""
        if keyspace and table:
            schema = Schema(ddl)
            made, indexes = schema.table(keyspace, table), schema.indexes(keyspace, table)
            known = user_types([*map(one_statement, udts), *schema.types(keyspace)])
        else:
            made, indexes, known = one_statement(ddl), 0, user_types(list(map(one_statement, udts)))
        if made.kind != "table":
            raise ValueError(f"no table is created in {ddl[:80]!r}")
        listed, partition, clustering = made.columns()
        kinds = {c.name: parse_type(c.type, known) for c in listed}
        descending = made.descending
        columns = [Column(n, kinds[n], PARTITION) for n in partition] + [Column(n, kinds[n], CLUSTERING, n in descending) for n in clustering]
        others = sorted((c for c in listed if c.name not in partition and c.name not in clustering), key=lambda c: c.name)
        columns += [Column(c.name, kinds[c.name], STATIC if c.static else REGULAR) for c in others]
        ttl = made.given("default_time_to_live")
        return cls(made.keyspace or keyspace or "", made.name, tuple(columns), indexes, int(ttl[0].text) if ttl else 0, made.text(KEPT_PROPERTIES), decimals)


def one_statement(text: str) -> Statement:
    """The first statement of a text; a user type may come without its first two words."""
    some = next(iter(parted(list(tokens(text)), ";")), [])
    found = read_statement(some) or read_statement([*tokens("CREATE TYPE "), *some])
    if not found:
        raise ValueError(f"cannot read {text[:80]!r}")
    return found


def quoted(name: str, always: bool) -> str:
    """A name for a statement: mixed-case and reserved ones in quotes, if quoting is on."""
    return f'"{name}"' if always and (not re.fullmatch(r"[a-z][a-z0-9_]*", name) or name in RESERVED) else name


# Words that can't be bare identifiers.
RESERVED = frozenset(
    "add allow alter and apply asc authorize batch begin by columnfamily create default delete desc describe drop entries execute from full grant if in index infinity insert into is keyspace limit "
    "materialized mbean mbeans modify nan norecursive not null of on or order primary rename replace revoke schema select set table to token truncate unlogged unset update use using view where with".split()
)


def user_types(statements: list[Statement]) -> dict[str, SourceType]:
    """User types by name, in whatever order their dependencies allow."""
    known: dict[str, SourceType] = {}
    waiting = list(statements)
    while waiting:
        later: list[tuple[Statement, UnsupportedType]] = []
        for s in waiting:
            fields, _, _ = s.columns()
            try:
                known[s.name] = SourceType("udt", s.name, tuple(parse_type(c.type, known) for c in fields), tuple(c.name for c in fields))
            except UnsupportedType as e:  # may name a type that comes later
                later.append((s, e))
        if len(later) == len(waiting):
            raise later[0][1]
        waiting = [s for s, _ in later]
    return known


def parse_udts(statements: list[str]) -> dict[str, SourceType]:
    return user_types(list(map(one_statement, statements)))


def replication(schema: str, keyspace: str) -> Replication:
    return Replication.from_options(Schema(schema).replication(keyspace))


def validate_for_write(spec: TableSpec) -> None:
    from .types import WRITABLE_KEYS

    if spec.indexes:
        raise ValueError("tables with secondary indexes can't be written in bulk")
    for name in spec.partition_key:
        if (t := spec.column(name).type).name not in WRITABLE_KEYS:
            raise UnsupportedType(f"partition key {name}: {t} can't be written")


def with_default_ttl(spec: TableSpec, seconds: int) -> TableSpec:
    return replace(spec, default_ttl=seconds)
