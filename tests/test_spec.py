import pytest
from pyspark.sql import types as T

from widelog.schema_text import Schema, said, tokens
from widelog.spec import Replication, TableSpec, parse_udts, replication, validate_for_write
from widelog.types import Decimals, UnsupportedType, parse_type, spark_type

SCHEMA = r"""
-- rides of a bicycle rental; the next line ends in a written line break
CREATE KEYSPACE IF NOT EXISTS rides WITH replication = {'class': 'NetworkTopologyStrategy', 'north': 2, 'south': '1'} AND durable_writes = true;\n
create keyspace system_rides with replication = {'class': 'SimpleStrategy', 'replication_factor': '1'};
CREATE TYPE rides.trip (leg list<frozen<stop>>, note text);
CREATE TYPE rides.stop (dock int, "At" timestamp);
/* one table with everything; ( in a comment */
CREATE TABLE rides.log (
  bike bigint, "Day" date, seen timestamp, fee decimal static, tags map<text, frozen<list<int>>>, way frozen<trip>,
  PRIMARY KEY ((bike, "Day"), seen)
) WITH CLUSTERING ORDER BY (seen DESC) AND comment = 'a; b AND c = (d' AND default_time_to_live = 60 AND compression = {'class': 'zip', 'size': 4} AND speculative_retry = '99p' AND bloom_filter_fp_chance = 0.05;
CREATE INDEX by_tag ON rides.log (tags);
CREATE CUSTOM INDEX IF NOT EXISTS ON rides.log (fee) USING 'x.Y' WITH OPTIONS = {'a': 'b'};
CREATE TABLE rides.docks (dock int PRIMARY KEY, place varint);
CREATE MATERIALIZED VIEW rides.v AS SELECT dock FROM rides.docks;
"""


def test_statements_of_a_schema():
    s = Schema(SCHEMA)
    assert s.keyspaces() == {"rides"} and s.keyspaces(hidden=("none",)) == {"rides", "system_rides"}
    assert replication(SCHEMA, "rides") == Replication("NetworkTopologyStrategy", {"north": 2, "south": 1})
    assert (s.indexes("rides", "log"), s.indexes("rides", "docks")) == (2, 0)
    assert [t.name for t in s.types("rides")] == ["trip", "stop"]
    cut = s.table("rides", "log").text(("default_time_to_live", "bloom_filter_fp_chance", "compression"))
    assert cut.endswith(") WITH CLUSTERING ORDER BY (seen DESC) AND default_time_to_live = 60 AND compression = {'class': 'zip', 'size': 4} AND bloom_filter_fp_chance = 0.05;")
    assert Schema(cut).table("rides", "log").columns() == s.table("rides", "log").columns()
    for bad in (lambda: s.table("rides", "none"), lambda: s.replication("none"), lambda: TableSpec.from_ddl("DROP TABLE x"), lambda: TableSpec.from_ddl("CREATE TABLE x (a int"), lambda: TableSpec.from_ddl("CREATE TYPE x (a int)")):
        with pytest.raises(ValueError):
            bad()


def test_scanner():
    assert said(list(tokens("a\\nb  /* x */ 'it''s -- no' \"Q\"\"r\"\\ c"))) == "a b 'it''s -- no' \"Q\"\"r\" c"
    assert [t.name for t in tokens('Ab "Ab" "x""y"')] == ["ab", "Ab", 'x"y']
    assert Schema("").statements == [] and Schema(";;").statements == []


def test_table_from_schema():
    spec = TableSpec.from_ddl(SCHEMA, "rides", "log")
    assert (spec.partition_key, spec.clustering_key, spec.statics, spec.regulars) == (["bike", "Day"], ["seen"], ["fee"], ["tags", "way"])
    assert spec.column("seen").descending and spec.default_ttl == 60 and spec.indexes == 2
    f = spec.struct_type(("last_modified_timestamp",))
    assert f.names == ["bike", "Day", "seen", "fee", "tags", "way", "last_modified_timestamp"]
    assert f["seen"].metadata["isClusteringKey"] and f["bike"].metadata["isPrimaryKey"] and f["fee"].metadata["isStaticColumn"] and f["tags"].metadata["isValueColumn"]
    assert f["way"].dataType.simpleString() == "struct<leg:array<struct<dock:int,At:timestamp>>,note:string>"
    assert spec.partition_size_type().names == ["bike", "Day", "uncompressed", "compressed"]
    with pytest.raises(ValueError):
        validate_for_write(spec)
    one = TableSpec.from_ddl(SCHEMA, "rides", "docks")
    assert one.partition_key == ["dock"] and one.regulars == ["place"]
    validate_for_write(one)


def test_quoted_names_keep_their_case():
    spec = TableSpec.from_ddl('CREATE TABLE "Zoo"."Pens" ("Pen" text, PEN int, v int, PRIMARY KEY ("Pen", pen));')
    assert (spec.keyspace, spec.name, spec.names) == ("Zoo", "Pens", ["Pen", "pen", "v"])


@pytest.mark.parametrize("text,want", [("text", "string"), ("bigint", "bigint"), ("varint", "decimal(38,0)"), ("decimal", "decimal(38,19)"), ("time", "bigint"), ("inet", "binary"), ("list<int>", "array<int>"), ("set<frozen<list<uuid>>>", "array<array<string>>"), ("map<text, map<int, date>>", "map<string,map<int,date>>"), ("tuple<int, text>", "struct<0:int,1:string>")])
def test_types(text, want):
    assert spark_type(parse_type(text)).simpleString() == want


def test_unsupported_types_and_udt_order():
    for bad in ("counter", "duration", "nothing", "list<int, int>", "pair<int>"):
        with pytest.raises(UnsupportedType):
            parse_type(bad)
    known = parse_udts(["CREATE TYPE k.a (x frozen<b>)", "CREATE TYPE k.b (y frozen<c>)", "CREATE TYPE k.c (z int)"])
    assert set(known) == {"a", "b", "c"}
    with pytest.raises(UnsupportedType):
        parse_udts(["CREATE TYPE k.a (x missing)"])
    assert parse_type("list<int>").is_multi_cell and not parse_type("frozen<list<int>>").is_multi_cell


def test_decimals_by_column():
    d = Decimals.from_json('{"p": {"bigDecimalPrecision": 10, "bigDecimalScale": 2}, "q": {"bigIntegerPrecision": 20, "bigIntegerScale": 1}}')
    assert (d.of("p", "decimal"), d.of("q", "varint"), d.of("r", "varint")) == (T.DecimalType(10, 2), T.DecimalType(20, 1), T.DecimalType(38, 0))
