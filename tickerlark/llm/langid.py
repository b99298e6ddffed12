"""Language identification by a small convolutional network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlark.llm.bytetext import text_bytes

LETTER = regex.compile(r"\p{L}")

#: A hash sample takes a share of so many slots; enough for shares of a few in 10**12 rows.
SLOTS = 1 << 50


@dataclass(frozen=True)
class LangSettings:
    """``per_language`` documents (in expectation, by a hash of doc_id) are the training sample."""

    per_language: int = 400
    window: int = 256  # bytes; the last window of a text is filled with zeros
    windows_per_doc: int = 6  # evenly spread, for training only
    embedding: int = 8
    filters: int = 8  # of each width
    widths: tuple[int, ...] = (2, 3, 4)
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


def windows(text: np.ndarray, size: int) -> np.ndarray:
    """The whole text in rows of ``size`` bytes."""
    n = max(1, -(-len(text) // size))
    out = np.zeros(n * size, np.uint8)
    out[: len(text)] = text
    return out.reshape(n, size)


class ByteCnn:
    """Byte embedding, filters of several widths, max pooling over the window, softmax."""

    def __init__(self, labels: list[str], s: LangSettings):
        rng = np.random.default_rng(s.seed)
        self.labels, self.s = labels, s
        self.w = {"e": rng.normal(0, 0.5, (256, s.embedding)).astype(np.float32)}
        for k in s.widths:
            self.w[f"f{k}"] = rng.normal(0, (k * s.embedding) ** -0.5, (k * s.embedding, s.filters)).astype(np.float32)
            self.w[f"b{k}"] = np.zeros(s.filters, np.float32)
        self.w["out"] = rng.normal(0, 0.3, (s.filters * len(s.widths), len(labels))).astype(np.float32)
        self.w["bias"] = np.zeros(len(labels), np.float32)

    def _step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss of one batch."""
        w, s, n = self.w, self.s, len(x)
        emb = w["e"][x]
        pooled, places = [], []
        for k in s.widths:
            runs = np.lib.stride_tricks.sliding_window_view(emb, k, axis=1).swapaxes(2, 3).reshape(n, -1, k * s.embedding)
            made = runs @ w[f"f{k}"] + w[f"b{k}"]
            at = made.argmax(axis=1)
            best = np.take_along_axis(made, at[:, None], 1)[:, 0]
            pooled.append(np.maximum(best, 0))
            places.append((at, best > 0))
        h = np.concatenate(pooled, axis=1)
        p = softmax(h @ w["out"] + w["bias"])
        d = p.copy()
        d[np.arange(n), y] -= 1
        d /= n
        g = {"out": h.T @ d, "bias": d.sum(axis=0), "e": np.zeros_like(w["e"])}
        dh = np.split(d @ w["out"].T, len(s.widths), axis=1)
        row = np.arange(n)[:, None, None]
        for k, (at, on), part in zip(s.widths, places, dh, strict=True):
            part = part * on
            spots = at[:, :, None] + np.arange(k)  # n, filters, k
            came = emb[row, spots].reshape(n, s.filters, -1)
            g[f"f{k}"] = np.einsum("nf,nfi->if", part, came)
            g[f"b{k}"] = part.sum(axis=0)
            back = (part[:, :, None] * w[f"f{k}"].T[None]).reshape(n, s.filters, k, s.embedding)
            np.add.at(g["e"], x[row, spots], back)
        return g

    def fit(self, x: np.ndarray, y: np.ndarray) -> ByteCnn:
        """Adam over shuffled batches; the same rows in the same order give the same network."""
        rng = np.random.default_rng(self.s.seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        t = 0
        for _ in range(self.s.epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), self.s.batch):
                t += 1
                rows = order[i : i + self.s.batch]
                for k, g in self._step(x[rows], y[rows]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.w[k] = (self.w[k] - self.s.rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
        self.tables = self._pair_tables()
        return self

    def _pair_tables(self) -> dict[int, list[tuple[int, int, np.ndarray]]]:
        """The filters as sums of looked-up rows: for each width (offset, bytes, table)."""
        out = {}
        for k in self.s.widths:
            each = [self.w["e"] @ part for part in np.split(self.w[f"f{k}"], k)]
            steps = []
            for at in range(0, k - 1, 2):
                steps.append((at, 2, (each[at][:, None] + each[at + 1][None]).reshape(65536, -1)))
            if k % 2:
                steps.append((k - 1, 1, each[k - 1]))
            out[k] = steps
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each row of windows, in parts that stay in cache."""
        out = []
        for i in range(0, len(x), 256):
            part = x[i : i + 256]
            pairs = part[:, :-1].astype(np.uint16) * np.uint16(256) + part[:, 1:]
            h = []
            for k, steps in self.tables.items():
                length = part.shape[1] - k + 1
                made = None
                for at, size, table in steps:
                    got = np.take(table, (pairs if size == 2 else part)[:, at : at + length], axis=0)
                    made = got if made is None else np.add(made, got, out=made)
                h.append(np.maximum(made.max(axis=1) + self.w[f"b{k}"], 0))
            out.append(softmax(np.concatenate(h, axis=1) @ self.w["out"] + self.w["bias"]))
        return np.concatenate(out)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(doc_id) -> F.Column:
    """True for the fifth of documents, by crc32 of the id, that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, s: LangSettings | None = None) -> ByteCnn | None:
    """A network from a bounded hash sample of ``docs(doc_id, text, lang)``; None if no row is fit.

    Rows with null doc_id, null text, null lang, or held out are not learned from. Counts of the
    languages come from all rows; the sample of each is ``per_language`` rows in expectation, of
    each ``windows_per_doc`` windows reach the driver.
    """
    s = s or LangSettings()
    fit = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in fit.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(SLOTS * min(1, s.per_language / n)))])
    chosen = fit.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(SLOTS)) < share[F.col("lang")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, found = [], [], []
            for doc, text, lang in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                rows = windows(text, s.window)
                for i in sorted(set(np.linspace(0, len(rows) - 1, s.windows_per_doc).astype(int))):
                    if len(text):
                        ids.append(doc), langs.append(lang), found.append(rows[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["doc_id", "lang", "window"])

    rows = chosen.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang").mapInArrow(cut, "doc_id string, lang string, window binary")
    sample = sorted((r["lang"], r["doc_id"], bytes(r["window"])) for r in rows.collect())
    labels = sorted({r[0] for r in sample})
    if not labels:
        return None
    x = np.stack([np.frombuffer(r[2], np.uint8) for r in sample])
    return ByteCnn(labels, s).fit(x, np.array([labels.index(r[0]) for r in sample]))


def _judge(net: ByteCnn | None, text: pa.StringScalar, raw: np.ndarray | None) -> tuple[str, float]:
    if net is None or raw is None or not LETTER.search(text.as_py()):
        return "und", 0.0
    rows = windows(raw, net.s.window)
    weight = np.full(len(rows), net.s.window, float)
    weight[-1] = len(raw) - net.s.window * (len(rows) - 1)
    p = weight @ net.predict(rows) / weight.sum()
    return net.labels[int(p.argmax())], min(1.0, float(p.max()))


def identify(docs: DataFrame, model: ByteCnn | None) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs(doc_id, text)``.

    The mean of the window probabilities over the whole text, each window weighted by its bytes;
    ``score`` is that of the predicted language. ``und`` and 0 for null texts, texts without a
    letter, and if there is no model. One narrow pass; the network (under 2 MB) is broadcast.
    Repeated and null doc_id rows are judged row by row; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            judged = [_judge(net, x, raw) for x, raw in zip(batch.column(1), text_bytes(batch.column(1)), strict=True)]
            langs, scores = pa.array([x for x, _ in judged], pa.string()), pa.array([x for _, x in judged], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: ByteCnn | None, least: float = 0.3) -> DataFrame:
    """``docs``, all columns, without those whose language is ``und`` or scored below ``least``.

    The judgement is made on the row itself, so nothing is joined or shuffled. Null texts and texts
    without a letter go; repeated and null doc_id rows are judged row by row. Without a model (no
    labelled rows to learn from) nothing can be judged and every row stays.
    """
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            judged = [_judge(net, x, raw) for x, raw in zip(batch.column(at), text_bytes(batch.column(at)), strict=True)]
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in judged], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
