"""Values on their way into a table, by the column's type. All but the write time let nulls through."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import Decimals, SourceType, spark_type

UUID_FORM = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
DAY_NANOS = 86_400_000_000_000
#: Ticks of 100 ns from the epoch of version-1 ids, 1582-10-15, to 1970.
UUID_EPOCH = 0x01B21DD213814000
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def failed(what: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"not a valid {what}: "), F.coalesce(value.cast("string"), F.lit("null"))))


def checked(ok: Column, value: Column, what: str, shown: Column) -> Column:
    return F.when(shown.isNull(), F.lit(None)).when(ok, value).otherwise(failed(what, shown))


@F.pandas_udf(T.BinaryType())
def inet_bytes(text: pd.Series) -> pd.Series:
    """4 or 16 bytes of an address in text."""
    return text.map(lambda t: None if t is None else ipaddress.ip_address(t.strip().lstrip("/")).packed)


def inet_text(raw: Column) -> Column:
    """An address's usual text."""

    @F.pandas_udf(T.StringType())
    def shown(x: pd.Series) -> pd.Series:
        return x.map(lambda b: None if b is None else str(ipaddress.ip_address(bytes(b))))

    return shown(raw)


def timeuuid_from_millis(millis: Column) -> Column:
    """The least version-1 id of a millisecond, in text."""
    ticks = F.lpad(F.hex(millis * 10_000 + F.lit(UUID_EPOCH)), 16, "0")
    text = F.concat(F.substring(ticks, 9, 8), F.lit("-"), F.substring(ticks, 5, 4), F.lit("-1"), F.substring(ticks, 2, 3), F.lit("-8080-808080808080"))
    return F.lower(text)


def nanos_of_day(value: Column) -> Column:
    """Nanoseconds since midnight of a timestamp; its date is dropped."""
    micros = F.unix_micros(value.cast("timestamp"))
    return F.pmod(micros, F.lit(86_400_000_000)) * 1000


def stored_date(value: Column) -> Column:
    """Days since 1970 shifted into unsigned order, as dates are stored."""
    return F.unix_date(value).cast("long") + F.lit(1 << 31)


def from_stored_date(days: Column) -> Column:
    return F.date_from_unix_date((days - F.lit(1 << 31)).cast("int"))


def write_time(value: Column, kind: T.DataType) -> Column:
    """Microseconds of a write's time; null is an error."""
    micros = F.unix_micros(value.cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else value.cast("long")
    return F.coalesce(micros, failed("write time", value).cast("long"))


def converted(value: Column, kind: T.DataType, to: SourceType, decimals: Decimals | None = None, name: str = "") -> Column:
    """value, of Spark type kind, as a table's column of type to takes it."""
    goal = spark_type(to, name, decimals)
    if to.kind in ("list", "set"):
        if not isinstance(kind, T.ArrayType):
            raise TypeError(f"{to} takes arrays, not {kind.simpleString()}")
        out = F.transform(value, lambda x: converted(x, kind.elementType, to.parts[0], decimals, name))
        return F.array_sort(F.array_distinct(out)) if to.kind == "set" else out
    if to.kind == "map":
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and len(kind.elementType) == 2:
            value, pair = F.map_from_entries(value), kind.elementType
            kind = T.MapType(pair[0].dataType, pair[1].dataType)
        if not isinstance(kind, T.MapType):
            raise TypeError(f"{to} takes maps, not {kind.simpleString()}")
        keyed = F.transform_keys(value, lambda k, _: converted(k, kind.keyType, to.parts[0], decimals, name))
        return F.transform_values(keyed, lambda _, v: converted(v, kind.valueType, to.parts[1], decimals, name))
    if to.kind in ("udt", "tuple"):
        if not isinstance(kind, T.StructType):
            raise TypeError(f"{to} takes structs, not {kind.simpleString()}")
        names = to.fields if to.kind == "udt" else tuple(f.name for f in kind)
        given = {f.name: f.dataType for f in kind}
        fields = []
        for k, (n, part) in enumerate(zip(names, to.parts, strict=True)):
            x = converted(value[n], given[n], part, decimals, name) if n in given else F.lit(None).cast(spark_type(part, name, decimals))
            fields.append(x.alias(n if to.kind == "udt" else str(k)))
        return F.when(value.isNotNull(), F.struct(*fields))
    whole = isinstance(kind, INTEGERS)
    if to.name in ("bigint", "int"):
        if not whole or (to.name == "int" and isinstance(kind, T.LongType)):
            raise TypeError(f"{to} can't take {kind.simpleString()}")
        return value.cast(goal)
    if to.name in ("decimal", "varint"):
        if to.name == "varint" and isinstance(kind, (T.FloatType, T.DoubleType)):
            raise TypeError(f"varint can't take {kind.simpleString()}")
        return value.cast(goal)
    if to.name in ("uuid", "timeuuid"):
        if to.name == "timeuuid" and whole:
            return timeuuid_from_millis(value.cast("long"))
        ok = value.rlike(UUID_FORM) & ((F.substring(value, 15, 1) == "1") if to.name == "timeuuid" else F.lit(True))
        return checked(ok, F.lower(value), to.name, value)
    if to.name == "inet":
        return inet_bytes(value) if isinstance(kind, T.StringType) else value
    if to.name == "timestamp":
        return F.timestamp_millis(value.cast("long")) if whole else value.cast("timestamp")
    if to.name == "date":
        return F.timestamp_millis(value.cast("long")).cast("date") if whole else value.cast("date")
    if to.name == "time":
        if whole:
            return checked((value >= 0) & (value < DAY_NANOS), value.cast("long"), "time of day", value)
        return nanos_of_day(value)
    return value.cast(goal)
