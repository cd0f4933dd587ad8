import random

import pytest

from widelog.functions.tokens import key_bytes, murmur3_token, murmur3_tokens, random_token, random_token_of, with_token
from widelog.sources.datasource import python_key_bytes
from widelog.spec import TableSpec

# Tokens of a few keys.
TOKENS = {
    "": 0,
    "61": -8839064797231613815,
    "68656c6c6f": -3758069500696749310,
    "0000000000000001": 6292367497774912474,
    "ff": -4442228696663692417,
    "c3a9": 5461403030378599040,
    bytes(range(16)).hex(): 4920504430128807728,
    bytes(range(0xC8, 0xE9)).hex(): -7339430995465112631,
}


def test_known_tokens():
    for key, token in TOKENS.items():
        assert murmur3_tokens([bytes.fromhex(key)])[0] == token
    assert list(murmur3_tokens([bytes.fromhex(k) for k in TOKENS])) == list(TOKENS.values())


def test_column_and_random_tokens(spark):
    rng = random.Random(1)
    keys = [bytes(rng.choices(range(256), k=rng.randint(0, 40))) for _ in range(200)]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys] + [(None,)], "k binary").select("k", murmur3_token("k").alias("t"), random_token("k").alias("r")).collect()
    assert [r["t"] for r in rows] == [*map(int, murmur3_tokens(keys)), None]
    assert [r["r"] for r in rows] == [*(f"{random_token_of(k):039d}" for k in keys), None]
    assert all(0 <= random_token_of(k) <= 1 << 127 for k in keys)


@pytest.mark.parametrize("kind,values", [("bigint", [0, -1, 1 << 62]), ("int", [0, -7, 2**31 - 1]), ("text", ["", "é", "abc"]), ("boolean", [True, False]), ("double", [0.5, -2.0]), ("uuid", ["123e4567-e89b-12d3-a456-426614174000"])])
def test_key_bytes_by_type(spark, kind, values):
    spec = TableSpec.of("t", {"a": kind})
    df = spark.createDataFrame([(v,) for v in values], spec.struct_type())
    assert [bytes(r["k"]) for r in df.select(key_bytes(spec).alias("k")).collect()] == [python_key_bytes(spec, (v,)) for v in values]


def test_composite_key(spark):
    spec = TableSpec.of("t", {"a": "int", "b": "text"})
    df = with_token(spark.createDataFrame([(1, "xy"), (2, None)], spec.struct_type()), spec)
    want = b"\0\4\0\0\0\1\0\0\2xy\0"
    first, second = df.select(key_bytes(spec).alias("k"), "token").collect()
    assert bytes(first["k"]) == want and first["token"] == murmur3_tokens([want])[0] and second["token"] is None
