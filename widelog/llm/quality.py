"""Document quality by a factorisation machine.

Features are hashed words (damped counts, scaled to unit length), structure statistics cut into bins, and what the
metadata says of the text's length. A pair of features weighs the product of their low-rank vectors; the sum over all
pairs takes linear time as half of (square of sums - sum of squares), component by component. Trained by AdaGrad on
logistic loss over a bounded, documented sample of labelled rows, balanced over both labels.

Every row gets a score in [0, 1]: null and empty texts have no words and score by their structure alone, as do very
long ones by all their words. Repeated ids give repeated rows. With no labelled row of either kind the score is 0.5.
An id whose labels disagree teaches nothing; of several texts with one labelled id, the one of the least digest is learned.
Columns of docs are kept, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, fold, free
from .sample import bounded

HASHED, RANK, BINS = 1 << 14, 8, 10
MARKS = b"*#$%&|~^<>{}[]=_\\@"
UPPER = bytes(range(65, 91))
STATS = ("length", "words", "mean word", "distinct", "upper", "shouts", "marks", "digits", "stops", "lines", "top word", "beyond ASCII", "ends of words", "repeats")
#: Upper ends of the bins of shares.
SHARES = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.55, 0.8])
WIDTH = HASHED + BINS * len(STATS) + 3


def features(text: bytes, n_chars: int | None, cache: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and values of a text's features."""
    words = text.lower().split()
    counts = Counter(words)
    if len(cache) > 400_000:
        cache.clear()
    ids = []
    for w in counts:
        k = cache.get(w)
        if k is None:
            k = cache[w] = zlib.crc32(w) % HASHED
        ids.append(k)
    tf = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    n, m = len(text), len(words)
    per_char, per_word = 1 / max(n, 1), 1 / max(m, 1)
    marks = n - len(text.translate(None, MARKS))
    ascii_only = len(text.translate(None, bytes(range(128, 256))))
    upper = n - len(text.translate(None, UPPER))
    shares = (
        len(counts) * per_word, upper * per_char, text.count(b"!") * per_word, marks * per_word, (n - len(text.translate(None, b"0123456789"))) * per_char,
        (text.count(b".") + text.count(b",")) * per_word, text.count(b"\n") * per_word, max(counts.values(), default=0) * per_word, (n - ascii_only) * per_char,
        sum(w[-1] in MARKS or w[-1] == 33 for w in counts) / max(len(counts), 1),
    )
    bins = [min(int(np.log2(n + 1) / 2), BINS - 1), min(int(np.log2(m + 1) / 1.5), BINS - 1), min(int((n - m) * per_word / 1.5), BINS - 1), *np.searchsorted(SHARES, shares), min(int(2 * np.log2(max(m, 1) / max(len(counts), 1))), BINS - 1)]
    declared = 0 if n_chars is None else 1 if n_chars == len(text.decode("utf-8", "replace")) else 2
    at = [HASHED + BINS * k + b for k, b in enumerate(bins)] + [WIDTH - 3 + declared]
    x = np.ones(len(ids) + len(at))
    if ids:
        x[: len(ids)] = tf / np.sqrt((tf * tf).sum())
    return np.array(ids + at, dtype=np.int64), x


class FactorisationMachine:
    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    @classmethod
    def fitted(cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = 8, rate: float = 0.15, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
        rng = np.random.default_rng(seed)
        w, v = np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, RANK))
        gw, gv, bias, gb = np.full(WIDTH, 1e-2), np.full((WIDTH, RANK), 1e-2), 0.0, 1e-2
        share = {y: max(labels.count(y), 1) for y in (0, 1)}
        weight = {y: len(labels) / (2 * n) for y, n in share.items()}
        for _ in range(epochs if len(set(labels)) == 2 else 0):
            for k in rng.permutation(len(rows)):
                ids, x = rows[k]
                vx = v[ids] * x[:, None]
                total = vx.sum(0)
                raw = bias + w[ids] @ x + 0.5 * (total @ total - (vx * vx).sum())
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[k]) * weight[labels[k]]
                dw, dv = err * x + decay * w[ids], err * x[:, None] * (total - vx) + decay * v[ids]
                np.add.at(gw, ids, dw * dw)
                np.add.at(gv, ids, dv * dv)
                np.add.at(w, ids, -rate * dw / np.sqrt(gw[ids]))
                np.add.at(v, ids, -0.3 * rate * dv / np.sqrt(gv[ids]))
                gb += err * err
                bias -= rate * err / np.sqrt(gb)
        met = np.zeros(WIDTH, dtype=bool)
        for ids, _ in rows:
            met[ids] = True
        v[~met] = 0
        return cls(bias, w.astype(np.float32), v.astype(np.float32))

    def score(self, ids: np.ndarray, x: np.ndarray) -> float:
        vx = self.factors[ids] * x[:, None]
        total = vx.sum(0)
        raw = self.bias + self.linear[ids] @ x + 0.5 * (total @ total - (vx * vx).sum())
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = 2500, max_chars: int = 20_000) -> FactorisationMachine:
    """Fits on up to per_label documents of each label with up to max_chars characters; folds are the caller's."""
    marked = labels.select(F.col("doc_id").alias("k"), F.col(label).alias("y")).filter("k is not null and y in (0, 1)")
    marked = marked.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").drop("most")
    chosen, _ = bounded(marked, "y", "k", per_label, 2)
    chosen = F.broadcast(chosen)  # 2 * per_label rows at most
    meta = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    texts = docs.select(F.col("doc_id").alias("k"), F.col("text").alias("t"), meta.alias("n")).filter("length(t) <= %d" % max_chars)
    one = texts.join(chosen, "k").groupBy("k", "y").agg(F.min(F.struct(F.md5("t").alias("digest"), "t", "n")).alias("x"))
    rows = one.select("y", "x.t", "x.n").orderBy("k").collect()  # as many rows as chosen has
    cache: dict[bytes, int] = {}
    return FactorisationMachine.fitted([features(r["t"].encode(), r["n"], cache) for r in rows], [r["y"] for r in rows])


def scored(docs: DataFrame, model: FactorisationMachine, out: str = "__quality") -> DataFrame:
    """docs with a column out after its own."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    meta = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, cache = shipped.value, {}
        for batch in batches:
            raw, at = bytes_of(batch.column(batch.num_columns - 1))
            whole, declared = raw.tobytes(), batch.column(batch.num_columns - 2).to_pylist()
            found = [machine.score(*features(whole[at[k] : at[k + 1]], declared[k], cache)) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(found, pa.float64())], names=[*batch.schema.names[:-2], out])

    schema = docs.withColumn(out, F.lit(0.0)).schema
    return docs.withColumns({free(docs, "__declared"): meta, free(docs, "__text"): F.col("text")}).mapInArrow(score, schema)


def trained(spark, sf_dir: str) -> FactorisationMachine:
    from .common import read

    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return train(docs, labels.filter(fold("doc_id", 5) != 0))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    out = scored(docs, trained(spark, sf_dir))
    score = F.col("__quality")
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the model does not reject, with all their columns."""
    out = free(docs, "__quality")
    return scored(docs, model, out).filter(F.col(out) >= threshold).select(*docs.columns)
