"""Bag-of-words and TF-IDF features as long tables, and their principal components."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.functions import sentiment as st
from tickerlark.operators.decomposition import Svd, principal_components
from tickerlark.operators.similarity import WordCounts, split_join
from tickerlark.params import DEFAULTS, Params
from tickerlark.session import materialise

# Rows whose terms are counted at once, and terms that one task weighs.
_ROWS = 256
_TASK_TERMS = 2_000_000


def _tagged_text(df: DataFrame) -> Column:
    tags = F.array_join("hashtags", " ") if "hashtags" in df.columns else F.lit("")
    return F.concat_ws(" ", F.coalesce("content", F.lit("")), tags)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, term, tf) of rows (id, words), few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            at, terms, counts = array("l"), [], array("q")
            for i, text in enumerate(part.column(1).to_pylist()):
                grams = WordCounts(text.split(" ") if text else []).grams
                at.extend([i] * len(grams))
                terms.extend(grams)
                counts.extend(grams.values())
            ids = part.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.string()), pa.array(counts, pa.int64())], names=[batch.schema.names[0], "term", "tf"])


def _term_counts(df: DataFrame, id_col: str, min_chars: int, params: Params) -> DataFrame:
    stop = list(params.stop_words)
    kept = F.filter(
        st.tokens(_tagged_text(df)), lambda t: (F.length(t) >= min_chars) & ~t.isin(stop)
    )
    rows = materialise(df.select(id_col, F.array_join(kept, " ").alias("_words")))
    counts = rows.mapInArrow(_counted, f"`{id_col}` {dict(rows.dtypes)[id_col]}, term string, tf bigint")
    # Terms of a row are counted inside it; only rows that share an id have to meet.
    if rows.groupBy(id_col).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return counts
    return counts.groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))


def _vocabulary(counts: DataFrame, size: int | None) -> DataFrame:
    """All terms, or the ``size`` most frequent."""
    terms = counts.groupBy("term").agg(F.sum("tf").alias("_total"), F.count("*").alias("df"))
    if size is not None:
        terms = terms.orderBy(F.desc("_total"), "term").limit(size)
    return terms.select("term", "df")


def count_vectors(df: DataFrame, id_col: str = "id", params: Params = DEFAULTS) -> DataFrame:
    """(id, term, count) of all 1- and 2-grams, words of two letters or more; of the most frequent
    ones if ``params.max_features`` is set."""
    counts = _term_counts(df, id_col, 2, params)
    if params.max_features is not None:
        counts = materialise(counts)
        counts = split_join(counts, _vocabulary(counts, params.max_features), "term", "df")
    return counts.select(id_col, "term", F.col("tf").alias("count"))


def tfidf_vectors(df: DataFrame, id_col: str = "id", params: Params = DEFAULTS) -> DataFrame:
    """(id, term, weight): tf * (ln((1 + n) / (1 + df)) + 1), each post scaled to length 1."""
    counts = materialise(_term_counts(df, id_col, 1, params))
    n = df.select(F.count("*").alias("n")).scalar()
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1
    known = split_join(counts, _vocabulary(counts, params.max_features), "term", "df")
    # A number of tasks by rows: bytes of repetitive terms say little of the memory they take.
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-counts.count() // _TASK_TERMS))
    raw = known.select(id_col, "term", (F.col("tf") * idf).alias("raw")).repartition(tasks, id_col)
    # A window over the terms of one post, whose number its own text bounds.
    of_post = Window.partitionBy(id_col)
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(of_post))
    return raw.select(id_col, "term", (F.col("raw") / length).alias("weight"))


def reduce_dimensions(
    weights: DataFrame, ids: DataFrame, id_col: str = "id", k: int = 100, settings: Svd | None = None
) -> DataFrame:
    """(id, components): the principal components of (id, term, weight) rows over the whole vocabulary.

    ``ids`` holds each id once, those without terms too. See :func:`principal_components` for
    the number of components and their signs.
    """
    entries = weights.select(F.col(id_col).alias("row"), F.col("term").alias("column"), F.col("weight").alias("value"))
    scores, _, zero = principal_components(entries, k, ids.count(), settings)
    without = F.array(*[F.lit(float(x)) for x in zero])
    found = ids.select(id_col).join(scores.withColumnRenamed("row", id_col), id_col, "left")
    return found.select(id_col, F.coalesce("components", without).alias("components"))
