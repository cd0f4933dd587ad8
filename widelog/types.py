"""Types of the wide-row model, parsed from schema text and mapped to Spark's."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Native type names and the Spark types their values read as.
NATIVE: dict[str, T.DataType] = {
    "ascii": T.StringType(),
    "bigint": T.LongType(),
    "blob": T.BinaryType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "decimal": T.DecimalType(38, 19),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "inet": T.BinaryType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "text": T.StringType(),
    "time": T.LongType(),
    "timestamp": T.TimestampType(),
    "timeuuid": T.StringType(),
    "tinyint": T.ByteType(),
    "uuid": T.StringType(),
    "varchar": T.StringType(),
    "varint": T.DecimalType(38, 0),
}
UNSUPPORTED = ("counter", "duration", "empty")
#: Types of partition keys that can be written.
WRITABLE_KEYS = frozenset("ascii bigint blob boolean double int text timestamp timeuuid uuid varchar".split())


class UnsupportedType(ValueError):
    pass


@dataclass(frozen=True)
class SourceType:
    """kind: native, list, set, map, tuple or udt; parts: the types inside, in order."""

    kind: str
    name: str
    parts: tuple[SourceType, ...] = ()
    fields: tuple[str, ...] = ()
    frozen: bool = False

    def __str__(self) -> str:
        inner = self.name if self.kind in ("native", "udt") else f"{self.kind}<{', '.join(map(str, self.parts))}>"
        return f"frozen<{inner}>" if self.frozen else inner

    @property
    def is_collection(self) -> bool:
        return self.kind in ("list", "set", "map")

    @property
    def is_multi_cell(self) -> bool:
        """Whether elements are written and deleted one by one."""
        return not self.frozen and (self.is_collection or self.kind == "udt")


def _arguments(text: str) -> list[str]:
    """Splits at commas outside brackets."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(text[last:i].strip())
            last = i + 1
    return [*out, text[last:].strip()]


def parse_type(text: str, udts: dict[str, SourceType] | None = None) -> SourceType:
    """The type that text names; nested names are looked up in udts."""
    text = text.strip()
    m = re.fullmatch(r"(\w+)\s*<(.*)>", text, re.DOTALL)
    if m:
        outer, inner = m[1].lower(), m[2]
        if outer == "frozen":
            t = parse_type(inner, udts)
            return SourceType(t.kind, t.name, t.parts, t.fields, frozen=True)
        parts = tuple(parse_type(x, udts) for x in _arguments(inner))
        wanted = {"list": 1, "set": 1, "map": 2}.get(outer)
        if outer != "tuple" and wanted is None:
            raise UnsupportedType(f"unknown type {text}")
        if wanted not in (None, len(parts)):
            raise UnsupportedType(f"{text}: {outer} takes {wanted} types")
        return SourceType(outer, outer, parts, frozen=outer == "tuple")
    name = text.strip('"')
    if udts and name in udts:
        return udts[name]
    if name.lower() in NATIVE:
        return SourceType("native", name.lower())
    if name.lower() in UNSUPPORTED:
        raise UnsupportedType(f"{name.lower()} is not supported in schemas")
    raise UnsupportedType(f"unknown type {text}")


@dataclass(frozen=True)
class Decimals:
    """Precision and scale of decimal and varint columns, for all or by column, as the JSON of bigNumberConfig gives them."""

    by_column: dict[str, tuple[int, int]] = field(default_factory=dict)

    @classmethod
    def from_json(cls, text: str | None) -> Decimals:
        given = json.loads(text) if text else {}
        return cls({k: (int(v.get("bigDecimalPrecision", v.get("bigIntegerPrecision", 38))), int(v.get("bigDecimalScale", v.get("bigIntegerScale", 0 if "bigIntegerPrecision" in v else 19)))) for k, v in given.items()})

    def of(self, column: str, name: str) -> T.DecimalType:
        precision, scale = self.by_column.get(column, (38, 19 if name == "decimal" else 0))
        return T.DecimalType(precision, scale)


def spark_type(t: SourceType, column: str = "", decimals: Decimals | None = None) -> T.DataType:
    """What a value of t reads as. Sets read as arrays, tuples as structs of fields "0", "1", ..."""
    inner = [spark_type(p, column, decimals) for p in t.parts]
    if t.kind == "native":
        return (decimals or Decimals()).of(column, t.name) if t.name in ("decimal", "varint") else NATIVE[t.name]
    if t.kind in ("list", "set"):
        return T.ArrayType(inner[0])
    if t.kind == "map":
        return T.MapType(inner[0], inner[1])
    names = t.fields if t.kind == "udt" else tuple(map(str, range(len(inner))))
    return T.StructType([T.StructField(n, x) for n, x in zip(names, inner, strict=True)])
