"""Mixing to target weights with soft domain membership."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tickerlark.llm.bytetext import text_bytes, word_hashes
from tickerlark.llm.langid import softmax
from tickerlark.llm.scratch import free, rows_at_once, stored

#: Texts that a Python worker is handed at once, a whole number of the blocks that are judged together.
HANDED_ROWS = 1024
#: A hash sample takes a share of so many slots; enough for shares of a few in 10**12 rows.
SLOTS = 1 << 50


@dataclass(frozen=True)
class MixSettings:
    """``per_domain`` labelled documents (in expectation, by a hash of doc_id) train the classifier."""

    per_domain: int = 1000
    features: int = 4096
    epochs: int = 30
    rate: float = 0.05
    pull: float = 1e-3  # weight of the squared distance of rates from 1, by tokens
    steps: int = 60
    tolerance: float = 1e-4  # stop when no domain's share moves more than this
    most_rate: float | None = None  # of a document; None: no upper bound
    at_most: tuple[str, ...] = ()  # domains whose weight is an upper bound: a scarce one thins no other
    seed: int = 3


def bag_of_words(text: np.ndarray | None, features: int) -> tuple[np.ndarray, int]:
    """Square roots of hashed word counts, brought to length 1; and the number of words."""
    words = word_hashes(text) if text is not None else np.zeros(0, np.uint64)
    x = np.sqrt(np.bincount((words % np.uint64(features)).astype(np.int64), minlength=features)).astype(np.float32)
    return x / max(1.0, float(np.sqrt((x * x).sum()))), len(words)


@dataclass
class Domains:
    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        return softmax(x @ self.weights + self.bias)


def train_domains(docs: DataFrame, labelled: DataFrame, s: MixSettings) -> Domains | None:
    """Softmax regression on a bounded hash sample of the documents in ``labelled(doc_id, domain)``.

    Domains are weighted by their share of all labels, so the sample's balance doesn't shift the
    posteriors. Null ids, domains and texts are not learned from; a doc_id with several labels
    counts with the smallest. None if nothing is labelled.
    """
    told = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min(F.col("domain").cast("string")).alias("domain"))
    counts = {r["domain"]: r["n"] for r in told.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(SLOTS * min(1, s.per_domain / n)))])
    chosen = told.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(9)), F.lit(SLOTS)) < share[F.col("domain")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [bag_of_words(t, s.features)[0] for t in text_bytes(batch.column(2))]
            at = [np.flatnonzero(x).astype(np.uint32) for x in bags]
            made = [pa.array([i.tobytes() for i in at], pa.binary()), pa.array([x[i].tobytes() for x, i in zip(bags, at, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["doc_id", "domain", "at", "x"])

    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), "domain", "text").mapInArrow(run, "doc_id string, domain string, at binary, x binary")
    with rows_at_once(docs.sparkSession, HANDED_ROWS):
        sample = sorted((r["domain"], r["doc_id"], bytes(r["at"]), bytes(r["x"])) for r in rows.collect())
    labels = sorted({r[0] for r in sample})
    if not labels:
        return None
    x = np.zeros((len(sample), s.features), np.float32)
    for i, r in enumerate(sample):
        x[i, np.frombuffer(r[2], np.uint32)] = np.frombuffer(r[3], np.float32)
    y = np.array([labels.index(r[0]) for r in sample])
    total = sum(counts[k] for k in labels)
    weight = np.array([counts[k] / total / (y == i).sum() for i, k in enumerate(labels)])[y]
    rng = np.random.default_rng(s.seed)
    w, b = np.zeros((s.features, len(labels)), np.float32), np.zeros(len(labels), np.float32)
    m, v, mb, vb, t = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b), 0
    for _ in range(s.epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            rows_at, t = order[i : i + 256], t + 1
            d = softmax(x[rows_at] @ w + b)
            d[np.arange(len(rows_at)), y[rows_at]] -= 1
            d *= (weight[rows_at] * len(x) / len(rows_at))[:, None]
            g, gb = x[rows_at].T @ d + 1e-5 * w, d.sum(axis=0)
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            w = (w - s.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
            b = (b - s.rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return Domains(labels, w, b)


def domain_posteriors(docs: DataFrame, model: Domains) -> DataFrame:
    """(doc_id, n_tokens, posterior) for each row: words of the whole text, a probability by label."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for i in range(0, len(texts), 512):
                bags = [bag_of_words(t, model.weights.shape[0]) for t in texts[i : i + 512]]
                p = model.posteriors(np.stack([x for x, _ in bags])).astype(float)
                columns = [batch.column(0).slice(i, 512), pa.array([n for _, n in bags], pa.int64()), pa.array(list(p), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "posterior"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, posterior array<double>")


def rates_after(p: np.ndarray, pulls: list[np.ndarray], s: MixSettings) -> tuple[np.ndarray, np.ndarray]:
    """Rates of documents with posteriors ``p`` after the given steps, and the point of the next.

    ``pulls`` has the gap (expected minus target share, by domain) of each step. A document's step
    depends on nothing else, so rates are computed anew from the list and never stored.
    """
    high = np.inf if s.most_rate is None else s.most_rate
    rate = point = np.ones(len(p))
    step = 1 / (1 + s.pull)
    t = 1.0
    for gap in pulls:
        new = np.clip(point - step * (p @ gap + s.pull * (point - 1)), 0, high)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        point = np.clip(new + (before - 1) / t * (new - rate), 0, high)
        rate = new
    return rate, point


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def fit_rates(members: DataFrame, targets: np.ndarray, s: MixSettings) -> list[np.ndarray]:
    """Accelerated projected gradient; one pass over ``members`` and one short vector per step.

    Minimises half the squared gaps between expected and target shares plus ``pull`` times half
    the mean squared distance of rates from 1, over rates >= 0. Shares are of all tokens at rate
    1; in the token-weighted metric the step 1 / (1 + pull) is safe for any data.
    """
    d = len(targets)
    total = members.agg(F.sum("n_tokens")).first()[0] or 0
    pulls: list[np.ndarray] = []
    last = np.ones(d)
    for _ in range(s.steps if total else 0):

        def run(batches: Iterator[pa.RecordBatch], pulls=tuple(pulls)) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, d))
            for batch in batches:
                p = _matrix(batch.column(1), d)
                rate, point = rates_after(p, list(pulls), s)
                n = np.asarray(batch.column(0)).astype(float)
                sums += np.stack([(rate * n) @ p, (point * n) @ p])
            yield pa.RecordBatch.from_arrays([pa.array([i for i in range(d)], pa.int32()), pa.array(sums[0]), pa.array(sums[1])], names=["d", "rate", "point"])

        parts = members.select("n_tokens", "posterior").mapInArrow(run, "d int, rate double, point double")
        rows = sorted(parts.groupBy("d").agg(F.sum("rate").alias("rate"), F.sum("point").alias("point")).collect())
        now = np.array([r["rate"] for r in rows]) / total
        gap = np.array([r["point"] for r in rows]) / total - targets
        if len(pulls) > 2 and max(np.abs(now - last).max(), np.abs(gap - pulls[-1]).max()) < s.tolerance:
            break
        last = now
        pulls.append(gap)
    return pulls


def mixing_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], s: MixSettings | None = None) -> DataFrame:
    """(doc_id, n_tokens, domain, rate, copies) and a posterior ``p_<label>`` per domain, by row.

    ``weights`` gives the domains' target shares of the tokens kept (domains it doesn't name have
    target 0; names never labelled are left out). The kept total is as large as it can be with no
    domain repeated: the domain that is scarcest against its weight keeps its expected tokens.
    Domains in ``at_most`` don't count for that; a scarcer one keeps all it has, below its weight.
    ``rate`` is the expected number of uses of a document; ``copies`` is its whole part plus one
    more with the probability of the rest, by a hash of doc_id and n_tokens. ``domain`` is the
    likeliest. Null and word-less texts have 0 tokens. Without labels or weights every rate is 1.
    Repeated and null doc_id rows are rated row by row; other columns are ignored.
    """
    s = s or MixSettings()
    model = train_domains(docs, labelled, s) or Domains(["all"], np.zeros((1, 1), np.float32), np.zeros(1, np.float32))
    with rows_at_once(docs.sparkSession, HANDED_ROWS):
        members = stored(domain_posteriors(docs, model), "posteriors")
    pulls = fit_rates(members, target_shares(members, model.labels, weights, s.at_most), s)
    return _rated(members, model.labels, pulls, s)


def target_shares(members: DataFrame, labels: list[str], weights: dict[str, float], at_most: tuple[str, ...] = ()) -> np.ndarray:
    """Target tokens by domain, as shares of all tokens at rate 1."""
    own = [F.sum(F.col("n_tokens") * F.element_at("posterior", i + 1)) for i in range(len(labels))]
    sums = members.agg(*own, F.sum("n_tokens")).first()
    have = np.array([x or 0.0 for x in sums[:-1]]) / max(1, sums[-1] or 0)
    want = np.array([weights.get(k, 0.0) for k in labels])
    return targets_for(have, want, np.array([k in at_most for k in labels]))


def targets_for(have: np.ndarray, want: np.ndarray, bounded: np.ndarray) -> np.ndarray:
    """Targets from shares, weights, and whether a weight is an upper bound.

    The other domains are in proportion to their weights and as large as the scarcest of them
    allows; each bounded one has its weight of the kept total, or all its tokens if they are fewer.
    """
    if want.sum() <= 0:
        return have
    want = want / want.sum()
    sizing = ~bounded & (want > 0)
    if not sizing.any():
        sizing = want > 0
    kept = want * (have[sizing] / want[sizing]).min()
    scarce = np.zeros(len(want), bool)
    while (now := ~sizing & ~scarce & (kept > have)).any():
        scarce |= now
        rest = ~sizing & ~scarce
        kept[scarce] = have[scarce]
        kept[rest] = want[rest] * kept[~rest].sum() / (1 - want[rest].sum())
    return kept


def _rated(members: DataFrame, labels: list[str], pulls: list[np.ndarray], s: MixSettings) -> DataFrame:
    d = len(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column(2), d)
            rate, _ = rates_after(p, pulls, s)
            columns = [batch.column(0), batch.column(1), pa.array([labels[i] for i in p.argmax(axis=1)], pa.string()), pa.array(rate), *map(pa.array, p.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "domain", "rate", *[f"p_{k}" for k in labels]])

    schema = "doc_id long, n_tokens long, domain string, rate double, " + ", ".join(f"`p_{k}` double" for k in labels)
    return members.mapInArrow(run, schema).withColumn("copies", copies(F.col("rate"), F.col("doc_id"), F.col("n_tokens")))


def copies(rate, doc_id, n_tokens):
    """A whole number with the mean ``rate``: the same for the same row in every run."""
    chance = F.pmod(F.xxhash64(doc_id, n_tokens, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mixed_documents(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], s: MixSettings | None = None) -> DataFrame:
    """``docs``, all columns, each row as often as its ``copies`` (see :func:`mixing_rates`) says.

    The rate of a row follows from its own text and the fitted steps, so the rows are judged where
    they stand: one more pass over the texts, no join and no shuffle of texts. Null texts count as
    empty ones; repeated and null doc_id rows are judged row by row. Without labelled rows nothing
    can be told and every row stays.
    """
    s = s or MixSettings()
    rate_name, size_name = free(docs, "__rate"), free(docs, "__n_tokens")
    model = train_domains(docs, labelled, s)
    if model is None:
        return docs
    with rows_at_once(docs.sparkSession, HANDED_ROWS):
        members = stored(domain_posteriors(docs, model), "posteriors")
    pulls = fit_rates(members, target_shares(members, model.labels, weights, s.at_most), s)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = text_bytes(batch.column(at))
            for i in range(0, len(texts), 512):
                bags = [bag_of_words(t, model.weights.shape[0]) for t in texts[i : i + 512]]
                rate, _ = rates_after(model.posteriors(np.stack([x for x, _ in bags])).astype(float), pulls, s)
                part = batch.slice(i, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rate), pa.array([n for _, n in bags], pa.int64())], names=[*part.schema.names, rate_name, size_name])

    schema = StructType([*docs.schema.fields, StructField(rate_name, DoubleType()), StructField(size_name, LongType())])
    rated = docs.mapInArrow(run, schema)
    n = copies(F.col(rate_name), F.col("doc_id").cast("long"), F.col(size_name))
    return rated.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), n.cast("int"))).alias(rate_name)).drop(rate_name)
