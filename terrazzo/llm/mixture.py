"""Mixing documents to target token shares by soft domain membership.

Logistic regression on the presence of hashed words, fitted on labelled rows with
the FEATURES buckets that a chi-square test finds most telling, gives every
document a posterior over domains; a temperature from held-out labelled rows keeps
it from being overconfident. The expected tokens of a domain are then the sum over
documents of rate x tokens x posterior. Projected gradient steps on the weighted
squared differences to the targets fit nonnegative rates, from 1 for all: each
step moves a document's rate along its posterior and cuts it at 0.

Posteriors are rounded to 1 / GRID. A rate depends on the posterior alone, so a
gradient is a sum over the grid's points that occur of their documents' tokens:
documents are read once, and summed before they are dealt. The driver holds the
points, at most MOST_POINTS whatever the corpus size, and takes at most STEPS steps;
shares that still miss their targets are told in a warning.
Tokens are words unless a column gives them.

The classifier is fitted on at most about LABELLED labelled rows, chosen by hash of
the id; statistics, posteriors and rates cover all documents. Defined results: null
texts have no tokens and the domains' prior; labels without a document, with null
ids or an unknown domain tell nothing; the first label in order counts where an id
has several; a domain without labelled rows gets no posterior; without any labels
all posteriors are equal; an empty table gives an empty table; columns named in
`keep` pass through, but those with the name of a result.
"""

from __future__ import annotations

import functools
import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 18
LABELLED = 8192
HELD_OUT = 5  # one labelled row in so many
FEATURES = 2048  # of the buckets, those whose presence tells domains apart best
ROUNDS, RIDGE = 200, 2e-3
GRID, MOST_POINTS = 100, 200_000
#: So many steps at most: rates stay near 1, where a fit to the last would take clean documents away for a hundredth of doubt.
STEPS, TOLERANCE = 60, 1e-7
#: Token shares that miss a target by more are told in a warning.
MISSED = 1e-2
MADE = ("n_tokens", "posterior", "rate")
TEMPERATURES = (1.6, 1.3, 1.0, 0.8, 0.6, 0.45, 0.3, 0.2)

#: Domains of the labelled table, and the token shares that a mixture should have.
DOMAIN = "case when toxic = 1 then 'toxic' when quality = 1 then 'clean' when quality = 0 then 'rough' end"
TARGETS = {"clean": 0.97, "rough": 0.03, "toxic": 0.0}


def buckets(text: str | None) -> np.ndarray:
    """Hash buckets of a text's words, in order."""
    words = text.encode().split() if text else []
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Classifier:
    """Multinomial logistic regression on the presence of some buckets."""

    chosen: np.ndarray  # buckets
    weights: np.ndarray  # (features + 1) x domains; the last row is the intercept
    temperature: float = 1.0

    def __post_init__(self):
        self.slot = np.full(BUCKETS, -1, np.int32)
        self.slot[self.chosen] = np.arange(len(self.chosen))

    def present(self, found: np.ndarray) -> np.ndarray:
        slots = self.slot[found]
        return np.unique(slots[slots >= 0])

    def posterior(self, scores: np.ndarray) -> np.ndarray:
        z = self.temperature * scores
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def predict(self, found: np.ndarray) -> np.ndarray:
        return self.posterior(self.weights[self.present(found)].sum(0) + self.weights[-1])


def unpacked(packed: np.ndarray, rows: int = 512) -> Iterator[tuple[slice, np.ndarray]]:
    """Bits of some packed rows at a time, with their places."""
    for at in range(0, len(packed), rows):
        yield slice(at, at + rows), np.unpackbits(packed[at : at + rows], axis=1)


def descend(packed: np.ndarray, truth: np.ndarray, n: int) -> np.ndarray:
    """Weights by gradient descent with momentum on the cross entropy, an intercept last, from rows of packed bits."""
    x = np.ones((len(packed), 8 * packed.shape[1] + 1), np.float32)
    for own, bits in unpacked(packed):
        x[own, :-1] = bits
    y = np.eye(n, dtype=np.float32)[truth]
    w = np.zeros((x.shape[1], n), np.float32)
    w[-1] = np.log(np.maximum(y.mean(0), 1e-6))
    slope, scale = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, ROUNDS + 1):
        z = x @ w
        e = np.exp(z - z.max(1, keepdims=True))
        g = x.T @ (e / e.sum(1, keepdims=True) - y) / len(x)
        g[:-1] += RIDGE * w[:-1]
        slope, scale = 0.9 * slope + 0.1 * g, 0.99 * scale + 0.01 * g * g
        w = w - 0.05 * (slope / (1 - 0.9**k)) / (np.sqrt(scale / (1 - 0.99**k)) + 1e-6)
    return w


@functools.cache
def grid_of(domains: int) -> int:
    """Parts of 1 that posteriors are rounded to: GRID, or fewer where that many points would occur for so many domains."""
    return next(g for g in range(GRID, 0, -1) if math.comb(g + domains - 1, domains - 1) <= MOST_POINTS or g == 1)


def rounded(p: np.ndarray) -> np.ndarray:
    """The grid point next to p that still sums to 1: rests go to the largest fractions."""
    grid = grid_of(len(p))
    scaled = p * grid
    whole = np.floor(scaled + 1e-9).astype(np.int32)
    rest = grid - int(whole.sum())
    if rest > 0:
        whole[np.argsort(-(scaled - whole), kind="stable")[:rest]] += 1
    return whole


def fit(docs: DataFrame, labels: DataFrame, domains: list[str], key: str, text: str) -> Classifier:
    """The classifier from (key, domain) rows of `labels`."""
    spark, n = docs.sparkSession, len(domains)
    known = labels.filter(F.col("domain").isin(domains) & F.col(key).isNotNull()).groupBy(key).agg(F.min("domain").alias("domain"))
    known = known.select(F.col(key).alias("label_id"), F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("int").alias("domain"))
    total = known.count()
    # At most about LABELLED rows of two numbers, whatever the table: a broadcast of bounded size.
    chosen = known.filter(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < int(min(1.0, LABELLED / max(1, total)) * (1 << 30)))
    rows = docs.select(F.col(key).alias("label_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "label_id")
    rows = rows.select(F.pmod(F.xxhash64(F.lit("fold"), "label_id"), F.lit(HELD_OUT)).cast("int").alias("fold"), (F.col("domain") - 1).alias("domain"), "text")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.zeros((n, BUCKETS + 1), np.int64)
            for domain, value in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                own[domain, np.unique(buckets(value.as_py()))] += 1
                own[domain, BUCKETS] += 1  # documents
            domain, bucket = np.nonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(domain.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(own[domain, bucket])], names=["domain", "bucket", "n"])

    # At most domains x (BUCKETS + 1) rows.
    table = rows.filter("fold > 0").mapInArrow(counts, "domain int, bucket int, n long").groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((n, BUCKETS + 1))
    seen[table["domain"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    held, present = seen[:, BUCKETS], seen[:, :BUCKETS]
    if not held.any():
        return Classifier(np.zeros(0, np.int64), np.zeros((1, n)))
    overall = (present.sum(0) + 0.5) / (held.sum() + 1)
    expected = held[:, None] * overall
    apart = ((present - expected) ** 2 / np.maximum(expected * (1 - overall), 1e-9)).max(0)
    out = Classifier(np.sort(np.argsort(-apart, kind="stable")[:FEATURES]), np.zeros((FEATURES + 1, n)))
    sent = spark.sparkContext.broadcast(out)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for x in batch.column(2):
                own = np.zeros(FEATURES, np.uint8)
                own[sent.value.present(buckets(x.as_py()))] = 1
                bits.append(np.packbits(own).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["fold", "domain", "bits"])

    # At most about LABELLED rows of FEATURES bits.
    rows = rows.mapInArrow(features, "fold int, domain int, bits binary").orderBy("bits", "domain", "fold").toArrow()
    bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
    fold, truth = rows["fold"].to_numpy(), rows["domain"].to_numpy()
    out.weights = descend(bits[fold > 0], truth[fold > 0], n).astype(np.float64)
    z = np.concatenate([np.zeros((0, n)), *(own @ out.weights[:-1] + out.weights[-1] for _, own in unpacked(bits[fold == 0]))])
    if len(z):
        loss = {}
        for t in TEMPERATURES:
            out.temperature = t
            loss[t] = -np.log(np.maximum(1e-9, out.posterior(z)[np.arange(len(z)), truth[fold == 0]])).mean()
        out.temperature = min(loss, key=loss.get)
    out.weights[:, held == 0] = 0.0
    out.weights[-1, held == 0] = -1e9
    return out


def posteriors(docs: DataFrame, model: Classifier, domains: list[str], key: str, text: str, tokens: str | None, keep: tuple[str, ...]) -> DataFrame:
    """(rest, tokens, p) of every row; p: GRID-ths by domain. Python sees the text alone, once; what passes through stays in Spark."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = F.struct(*[F.col(c) for c in common.passed((key, *keep), *MADE)]).alias("rest")
    rows = common.spread(docs.select(F.col(text).alias("text"), (F.col(tokens).cast("long") if tokens else F.lit(-1).cast("long")).alias("tokens"), rest))

    @F.arrow_udf("struct<tokens: bigint, p: array<int>>")
    def judged(texts: pa.Array, tokens: pa.Array) -> pa.Array:
        size, p = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(domains)), np.int32)
        for i, (x, given) in enumerate(zip(texts, tokens.to_pylist(), strict=True)):
            found = buckets(x.as_py())
            size[i] = len(found) if given is None or given < 0 else given
            p[i] = rounded(sent.value.predict(found))
        lists = pa.ListArray.from_arrays(np.arange(0, p.size + 1, len(domains), dtype=np.int32), p.ravel())
        return pa.StructArray.from_arrays([pa.array(size), lists], names=["tokens", "p"])

    return rows.select(judged("text", "tokens").alias("own"), "rest").select("own.tokens", "own.p", "rest")


def fit_rates(p: np.ndarray, tokens: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rates of grid points (posteriors p, token sums), and the token shares that they reach.

    Projected gradient steps from 1 for all, STEPS of them or until the shares are the
    targets' within TOLERANCE.
    """
    total = float(tokens.sum())
    if not total:
        return np.ones(len(tokens)), targets
    mass = p * (tokens / total)[:, None]
    weight = 1 / np.maximum(mass.sum(0), 1e-6)
    gram = p.T @ mass
    step = 1 / max(1e-12, float(np.linalg.eigvalsh(np.sqrt(weight)[:, None] * gram * np.sqrt(weight)).max()))
    rates = np.ones(len(tokens))
    for _ in range(STEPS):
        apart = rates @ mass - targets
        if np.abs(apart).max() < TOLERANCE:
            break
        rates = np.maximum(0.0, rates - step * (p @ (weight * apart)))
    return rates, rates @ mass


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], *, key: str = "doc_id", text: str = "text", tokens: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, n_tokens, posterior, rate) of every row; `labels` has the key and a `domain` column."""
    domains = list(targets)
    model = fit(docs, labels, domains, key, text)
    with common.small_batches(docs.sparkSession):
        table = common.stored(posteriors(docs, model, domains, key, text, tokens, keep), "posteriors")
    grid = grid_of(len(domains))
    # At most MOST_POINTS rows, whatever the corpus.
    points = table.groupBy("p").agg(F.sum("tokens").alias("tokens")).orderBy("p").collect()
    wanted = np.array([targets[d] for d in domains], float)
    wanted /= max(1e-12, wanted.sum())
    p = np.array([r["p"] for r in points], float).reshape(len(points), len(domains)) / grid
    found, reached = fit_rates(p, np.array([float(r["tokens"] or 0) for r in points]), wanted)
    if points and np.abs(reached - wanted).max() > MISSED:
        told = ", ".join(f"{d}: {s:.4f} for {w:.4f}" for d, s, w in zip(domains, reached, wanted, strict=True))
        warnings.warn(f"no rates meet the targets; token shares reached ({told})", stacklevel=2)
    rates = table.sparkSession.createDataFrame([(r["p"], float(v)) for r, v in zip(points, found, strict=True)], "p array<int>, rate double")
    out = table.join(F.broadcast(rates), "p")
    return out.select(*[F.col(f"rest.{c}").alias(c) for c in common.passed((key, *keep), *MADE)], F.col("tokens").alias("n_tokens"), F.transform("p", lambda v: v / F.lit(grid_of(len(domains)))).alias("posterior"), "rate")


def repeated(mixed: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Each row as often as its rate says: the whole part, and once more by hash of the id with the rest as chance."""
    chance = F.pmod(F.xxhash64(F.lit("copy"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    copy = "_copy" + "_" * max(map(len, mixed.columns))  # no column has this name
    return mixed.select("*", F.explode(F.array_repeat(F.lit(1), times)).alias(copy)).drop(copy)
