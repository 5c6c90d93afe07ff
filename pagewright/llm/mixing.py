"""Mixing documents to target weights by soft domain membership.

1. A multinomial logistic regression on hashed words is trained on labelled documents (at most
   ``train_rows`` of them, chosen by a hash of their id; the only sample here) and gives every document
   a posterior p over the domains.
2. Every document gets a rate r from 0 to ``most`` so that the expected tokens of domain k, the sum of
   r * tokens * p_k, come near its target in the least-squares sense, the gap of each domain weighted by
   one over the tokens it has, so that rare domains count. The rates follow from projected gradient steps
   on the whole table: a step moves r by p . g with one vector g of as many numbers as there are domains, and
   back into its bounds. Each pass works the rates out from the steps so far, tries several further steps at
   once, g being the gradient scaled by the inverse moments of the rows that can move or by the domains'
   tokens, in several lengths, and returns the totals and moments that each of them gives. The best one is
   taken. Steps end when each domain is at its target or none brings the squares down, or after ``ROUNDS``.
3. r is the expected number of copies: its whole part plus one more for the share of documents given by
   its fraction, decided by a hash of the id.

NULL and empty texts have no words: no tokens, the posterior of an empty text. Labels that are NULL or
have no document are left out; of repeated labels of a document the largest counts, and of labelled rows
with one id the smallest text is trained on. With no labelled document all are in the first domain with
probability 1; with one domain only, in that one. Each row is judged by its own id and text, so repeated rows
are judged alike. An empty table gives an empty result. :func:`mix` keeps all columns of the documents,
whatever their names, and only the text and the id are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import by_value, free_name
from pagewright.sources.storage import stored

TRAIN_ROWS = 10_000
FEATURES = 4096
ROUNDS = 12
KNOWN = 200_000  # words that a task remembers
# lengths of the steps that a pass tries
SCALED_LENGTHS, PLAIN_LENGTHS = (1.0, 0.7, 0.4, 0.15), (3.0, 1.0, 0.4, 0.1)
LEAST = 1e-5  # share of what all steps have brought the squares down that one more has to do
CLOSE = 1e-4  # share of its target by which a domain may miss it
PIECE = 1 << 14  # rows whose rates are worked out at a time
# words are runs of letters, digits, # and $, A-Z lower-cased, on UTF-8 bytes
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 or c in b"#$" else 32 for c in range(256))
_MARKS = re.compile(rb"[!|#*$%&]{1,3}|[A-Z]{4,}")


class Features(dict):
    """Hashed feature of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word) % FEATURES
        return found

    def of(self, text: bytes) -> np.ndarray:
        """The features of a text: its words, its marks, and whether it has a word in capitals."""
        words = set(text.translate(_WORDS).split())
        for mark in set(_MARKS.findall(text)):
            words.add(b"<upper>" if mark.isalpha() else b"<mark>" + mark)
        return np.fromiter({self[w] for w in words}, np.int64)


@dataclass(frozen=True)
class Model:
    """Posteriors of the domains; without weights the first of ``sure`` has probability 1."""

    weights: np.ndarray | None  # features and one constant more, by domain
    sure: np.ndarray

    def posterior(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return self.sure
        score = self.weights[features].sum(axis=0) + self.weights[-1]
        p = np.where(self.sure > 0, np.exp(score - score[self.sure > 0].max()), 0.0)
        return p / p.sum()


def domain_of(quality: Column, toxic: Column) -> Column:
    """Domain of a labelled document."""
    return F.when(toxic == 1, "toxic").when(quality == 0, "low").when(quality == 1, "good")


def train(docs: DataFrame, labels: DataFrame, domains: list[str], text: str = "text", train_rows: int = TRAIN_ROWS) -> Model:
    """The classifier of ``labels`` (doc_id, domain)."""
    known = labels.filter(F.col("domain").isin(*domains)).groupBy("doc_id").agg(F.max("domain").alias("domain"))
    # ids and labels only, at most train_rows of them
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = docs.select("doc_id", text).join(F.broadcast(stored(chosen, "labelled")), "doc_id")
    rows = rows.groupBy("doc_id", "domain").agg(F.min(text).alias("text"))

    def features(text: str | None):
        found = np.sort(Features().of((text or "").encode()))
        return Vectors.sparse(FEATURES, found, np.ones(len(found)))

    vector = F.udf(features, VectorUDT())
    rows = stored(rows.select("domain", vector("text").alias("features")), "training")
    have = {r["domain"] for r in rows.select("domain").distinct().collect()}
    present = [d for d in domains if d in have]
    if len(present) < 2:
        sure = present[0] if present else domains[0]
        return Model(None, np.array([float(d == sure) for d in domains]))
    index = F.array_position(F.lit(present), F.col("domain")) - 1
    fit = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-3, standardization=False)
    model = fit.fit(rows.withColumn("label", index.cast("double")))
    weights = np.zeros((FEATURES + 1, len(domains)))
    at = [domains.index(d) for d in present]
    weights[:-1, at] = model.coefficientMatrix.toArray().T
    weights[-1, at] = model.interceptVector.toArray()
    return Model(weights, np.array([float(d in have) for d in domains]))


def posterior_of(model: Model, text: Column) -> Column:
    """The posteriors of a text."""

    def run(column: pa.Array) -> pa.Array:
        features = Features()
        rows = [model.posterior(features.of((t.as_py() or "").encode())) for t in column]
        ends = np.arange(len(rows) + 1) * len(model.sure)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0), *rows])))

    return F.arrow_udf(run, "array<double>")(text)


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def rate_of(steps: list[list[float]], p: Column, most: float) -> Column:
    """The rate after ``steps``: from 1, each moves by p . g and back into [0, most]."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*map(F.lit, g)) for g in steps])
    dot = lambda g: sum((F.get(p, F.lit(k)) * g[k] for k in range(len(steps[0]))), F.lit(0.0))
    return F.aggregate(moves, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), F.least(F.lit(float(most)), r - dot(g))))


def _trial(tokens: np.ndarray, p: np.ndarray, rate: np.ndarray, most: float, pull: np.ndarray) -> np.ndarray:
    """What a trial sums up: domain totals, and moments of the rows that ``pull`` can move on from ``rate``."""
    weighted = p * tokens[:, None]
    toward = p @ pull
    free = ((rate > 0) | (toward < 0)) & ((rate < most) | (toward > 0))
    return np.concatenate([rate @ weighted, (weighted[free].T @ p[free]).ravel()])


def trials(members: DataFrame, steps: list[np.ndarray], tried: list[np.ndarray], most: float, pull: np.ndarray) -> np.ndarray:
    """One pass over ``members`` (tokens, p): the sums of each of the steps ``tried`` after ``steps``."""
    width = len(pull)
    sums = width + width * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(tried), sums))
        pieces = (b.slice(lo, PIECE) for b in batches for lo in range(0, b.num_rows, PIECE))
        for batch in pieces:
            tokens = batch.column(0).to_numpy().astype(np.float64)
            p = batch.column(1).flatten().to_numpy().reshape(-1, width)
            rate = np.ones(len(tokens))
            for g in steps:
                rate = np.clip(rate - p @ g, 0.0, most)
            for k, g in enumerate(tried):
                total[k] += _trial(tokens, p, np.clip(rate - p @ g, 0.0, most), most, pull)
        yield pa.record_batch([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "x"])

    # as many rows as there are sums, whatever the table
    found = members.select("tokens", "p").mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(len(tried) * sums)
    for row in found:
        out[row["at"]] = row["x"]
    return out.reshape(len(tried), sums)


def _scaled(moments: np.ndarray, gap: np.ndarray, have: np.ndarray) -> np.ndarray:
    """The step that closes the gap if the rows of ``moments`` move freely, by least squares in the weights
    of the objective, so that a domain that cannot move does no harm."""
    root = np.sqrt(np.divide(1.0, have, out=np.zeros(len(gap)), where=have > 0))
    left = root[:, None] * moments.reshape(len(gap), -1)
    ridge = 1e-9 * max(float((left * left).sum()), 1e-300)
    return np.linalg.solve(left.T @ left + ridge * np.eye(len(gap)), left.T @ (root * gap))


def fit_rates(members: DataFrame, domains: list[str], weights: dict[str, float], anchor: str, most: float, rounds: int = ROUNDS) -> list[list[float]]:
    """The steps g. ``members`` has tokens and p. Targets are ``weights`` scaled so that ``anchor`` keeps
    the tokens it has. Each round is one pass over the table."""
    k = len(domains)
    share = np.array([weights[d] for d in domains])
    steps: list[np.ndarray] = []
    # every row at the rate 1 and free to move
    sums = trials(members, [], [np.zeros(k)], np.inf, np.ones(k))[0]
    have = sums[:k]
    if have.sum() <= 0:
        return []
    target = share / share[domains.index(anchor)] * have[domains.index(anchor)]
    scale = np.where(target > 0, target, have)
    weigh, top = np.divide(1.0, have, out=np.zeros(k), where=have > 0), 0.0
    for _ in range(rounds - 1):
        gap = sums[:k] - target
        if (np.abs(gap) <= CLOSE * scale).all():
            break
        pull = weigh * gap
        tried = [x * _scaled(sums[k:], gap, have) for x in SCALED_LENGTHS] + [x * pull for x in PLAIN_LENGTHS]
        found = trials(members, steps, tried, most, pull)
        squares = (weigh * (found[:, :k] - target) ** 2).sum(axis=1)
        best = int(squares.argmin())
        before = (weigh * gap**2).sum()
        top = max(top, before)
        if before - squares[best] <= LEAST * (top - squares[best]):
            break
        steps.append(tried[best])
        sums = found[best]
    return [[float(x) for x in g] for g in steps]


def _copies(rate: Column, key: str) -> Column:
    # 53 bits of the hash as a number from 0 to 1
    chance = F.shiftrightunsigned(F.xxhash64(key, F.lit("copies")), 11) / F.lit(float(1 << 53))
    whole = F.floor(rate)
    return (whole + (chance < rate - whole).cast("int")).cast("long")


def _fitted(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str, most: float, text: str, train_rows: int):
    """The classifier, the members (doc_id, tokens, p) of ``docs``, and the steps."""
    domains = list(weights)
    labelled = labels.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
    model = train(docs, labelled, domains, text, train_rows)
    scored = docs.select("doc_id", token_count(F.col(text)).alias("tokens"), posterior_of(model, F.col(text)).alias("p"))
    members = stored(scored, "members")
    return model, members, fit_rates(members, domains, weights, anchor, most)


def mixed(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str, most: float = 1.0,
    text: str = "text", train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(doc_id, tokens, p, rate, copies) per row of ``docs``. ``labels``: doc_id, quality, toxic."""
    _, members, steps = _fitted(docs, labels, weights, anchor, most, text, train_rows)
    return members.withColumn("rate", rate_of(steps, F.col("p"), most)).withColumn("copies", _copies(F.col("rate"), "doc_id"))


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str, most: float = 1.0, text: str = "text") -> DataFrame:
    """``docs`` with each row as often as its copies say, none included. The rows are scored again where
    they are, which is cheaper than to shuffle their texts to what they were given."""
    model, _, steps = _fitted(docs, labels, weights, anchor, most, text, TRAIN_ROWS)
    p, copies = free_name(docs.columns, "_p"), free_name(docs.columns, "_copies")
    rated = docs.withColumn(p, posterior_of(model, F.col(text)))
    rated = rated.withColumn(copies, _copies(rate_of(steps, F.col(p), most), "doc_id")).drop(p).filter(F.col(copies) > 0)
    if most > 1:
        rated = rated.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return rated.drop(copies)


by_value(__name__)
