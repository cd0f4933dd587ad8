"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output over its share of the input, at a mean output size of
``epochs`` inputs. Each document draws a uniform number from a seeded hash of its id; inverting the distribution function
of a Poisson variable with its source's rate turns that into a count, and the document is written out so many times.
So any subset of the input, run again, yields the same copies. The copies are then dealt to partitions and ordered
by another seeded hash, which is a global shuffle.

Without given targets, a source's weight is its number of rows to the power ``temperature``. Null sources form one source,
null ids draw as the empty id, rows with equal ids draw alike. A source without a target gets rate 0. Documents of
rate 0 or a count of 0 leave. The output has the input's columns, whatever their names, and ``replica``, 1 to the count, which
replaces an input column of that name. An empty input gives an empty output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, partitions

SEED, TEMPERATURE, EPOCHS = "mix-1", 0.5, 1.0
#: Sources up to here go to every task; beyond it rates meet documents in a shuffled join that skew can split.
BROADCAST_SOURCES = 50_000


def uniform(key: Column, seed: str) -> Column:
    """52 hashed bits as a number in [0, 1)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson(rate: Column, u: Column) -> Column:
    """How many of P(X <= 0), P(X <= 1), ... of a Poisson variable are no more than u; its time goes with the rate, as the copies do.

    Terms go on far past where they sum to 1, and carry on as logarithms.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    first = F.exp(-rate)
    start = F.struct((-rate).alias("log"), first.alias("sum"), (first <= u).cast("int").alias("n"))

    def step(s: Column, j: Column) -> Column:
        log = s["log"] + F.ln(rate) - F.ln(j.cast("double"))
        total = s["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), (s["n"] + (total <= u).cast("int")).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["n"])


def rates(docs: DataFrame, by: str, targets: dict[str, float] | None, temperature: float, epochs: float) -> tuple[DataFrame, int]:
    """(__by, __rate) of each source, and how many sources there are."""
    counts = docs.groupBy(F.col(by).alias("__by")).agg(F.count("*").alias("n"))
    if targets is None:
        weighed = counts.withColumn("w", F.pow("n", F.lit(temperature)))
    else:
        given = docs.sparkSession.createDataFrame(list(targets.items()) or [("", 0.0)], "name string, w double")
        weighed = counts.join(given, F.col("__by") == F.col("name"), "left").select("__by", "n", F.coalesce("w", F.lit(0.0)).alias("w"))
    total = weighed.agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.count("*").alias("sources")).first()
    if not total["n"] or not total["w"]:
        return weighed.select("__by", F.lit(0.0).alias("__rate")), total["sources"]
    return weighed.select("__by", (F.col("w") / F.lit(total["w"]) * F.lit(epochs * total["n"]) / F.col("n")).alias("__rate")), total["sources"]


def mixed(docs: DataFrame, key: str = "doc_id", by: str = "source", targets: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    rate, sources = rates(docs, by, targets, temperature, epochs)
    own, r, u, n, spot = (free(docs, c) for c in ("__by", "__rate", "__u", "__n", "__spot"))
    table = rate.filter("__rate > 0").select(F.col("__by").alias(own), F.col("__rate").alias(r))
    if sources <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    drawn = docs.withColumn(u, uniform(F.col(key), seed)).join(table, F.col(by).eqNullSafe(F.col(own))).withColumn(n, poisson(F.col(r), F.col(u)))
    names = [c for c in docs.columns if c.lower() != "replica"]
    copies = drawn.filter(F.col(n) > 0).select(*names, F.explode(F.sequence(F.lit(1), F.col(n))).alias("replica"))
    place = F.xxhash64(F.lit(seed), F.col(key), F.col("replica"))
    return copies.withColumn(spot, place).repartition(partitions(docs.sparkSession), spot).sortWithinPartitions(spot).drop(spot)


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return mixed(read(spark, sf_dir, "documents"))


def sql_over(table: str) -> str:
    """The mix in DuckDB SQL."""
    return f"""
with recursive counts as (select source as s, count(*) as n from {table} group by source),
rates as (select s, pow(n, {TEMPERATURE}) / (select sum(pow(n, {TEMPERATURE})) from counts) * ({EPOCHS} * (select sum(n) from counts)) / n as rate from counts),
cdf(s, rate, j, log, total) as (
  select s, rate, 0, -rate, exp(-rate) from rates
  union all
  select s, rate, j + 1, log + ln(rate) - ln(j + 1.0::double), total + exp(log + ln(rate) - ln(j + 1.0::double)) from cdf where j < ceil(rate + 12 * sqrt(rate) + 20)),
drawn as (select *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint / {float(1 << 52)!r}::double as u from {table}),
counted as (select d.doc_id, d.text, d.lang, d.source, d.n_chars, (select count(*) from cdf c where c.s is not distinct from d.source and c.total <= d.u) as n from drawn d)
select doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::int as replica from counted where n > 0"""


SQL = sql_over("documents")
