"""Similarity of short texts and exact similarity joins.

Similarity is the TF-IDF cosine of two texts whose vocabulary and document frequencies come
from just these two. With two documents the smooth idf is 1 for a shared shingle and
k = 1 + ln 1.5 for any other, so with counts a and b, S the shared shingles, A = sum a^2,
B = sum b^2, Sa and Sb the same over S:

    cos = sum_S a b / ( sqrt(Sa + k^2 (A - Sa)) * sqrt(Sb + k^2 (B - Sb)) )

and a cosine of at least t needs Sa >= theta A and Sb >= theta B with
theta = t^2 k^2 / (1 - t^2 + t^2 k^2). The join below rests on that bound and loses no pair.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlark.params import DEFAULTS
from tickerlark.session import materialise

K2 = (1.0 + math.log(1.5)) ** 2
MARGIN = 1e-9
# How much of a text a pair has to share in the prefixes before it is compared in full. More
# slack means longer prefixes and fewer candidates.
SLACK = 0.03
# A shingle shared by the prefixes of more texts than this is combined with a second one.
CROWDED = 200
# At most this many rows of a lookup table are broadcast, see split_join.
MAX_HOT_KEYS = 20_000
# Characters and number of the texts that each task may hold, see similar_to_held.
HELD_CHARS = 2_000_000
HELD_TEXTS = 10_000


def min_share(threshold: float) -> float:
    t2 = threshold * threshold
    return t2 * K2 / (1.0 - t2 + t2 * K2)


def words(text: Column, stop_words: Sequence[str] = DEFAULTS.stop_words) -> Column:
    """Words of at least two characters of a comparison text, without stop words."""
    return F.filter(
        F.split(text, " "), lambda w: (F.length(w) >= 2) & ~w.isin(list(stop_words))
    )


def one_and_two_grams(tokens: Column) -> Column:
    following = F.slice(tokens, F.lit(2), F.size(tokens))
    pairs = F.zip_with(tokens, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, F.filter(pairs, lambda p: p.isNotNull()))


def shingle_counts(
    df: DataFrame, key: str, text: str, stop_words: Sequence[str] = DEFAULTS.stop_words
) -> DataFrame:
    """(key, shingle, c): how often each 1- and 2-gram occurs in each comparison text."""
    tokenised = df.select(key, words(F.col(text), stop_words).alias("_words"))
    grams = tokenised.select(key, F.explode(one_and_two_grams(F.col("_words"))).alias("shingle"))
    return grams.groupBy(key, "shingle").agg(F.count("*").alias("c"))


def cosine(dot: Column, sa: Column, a: Column, sb: Column, b: Column) -> Column:
    return dot / (F.sqrt(sa + (a - sa) * K2) * F.sqrt(sb + (b - sb) * K2))


class WordCounts:
    """The 1- and 2-grams of a text and the sum of their squared counts."""

    __slots__ = ("grams", "total")

    def __init__(self, words: list[str]):
        self.grams = Counter(words)
        self.grams.update(f"{a} {b}" for a, b in zip(words, words[1:]))
        self.total = sum(c * c for c in self.grams.values())


def alike(x: WordCounts, y: WordCounts) -> float:
    """The value of :func:`cosine`: sums of whole numbers, so the same value."""
    dot = sa = sb = 0
    for gram in x.grams.keys() & y.grams.keys():
        a, b = x.grams[gram], y.grams[gram]
        dot, sa, sb = dot + a * b, sa + a * a, sb + b * b
    if not dot:
        return 0.0
    return dot / (math.sqrt(sa + (x.total - sa) * K2) * math.sqrt(sb + (y.total - sb) * K2))


@F.pandas_udf(T.DoubleType())
def _similarity(first: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([alike(WordCounts(a.split(" ") if a else []), WordCounts(b.split(" ") if b else [])) for a, b in zip(first, other)], dtype="float64")


def pair_similarity(
    pairs: DataFrame, text_a: str = "text_a", text_b: str = "text_b", stop_words: Sequence[str] = DEFAULTS.stop_words,
) -> DataFrame:
    """Add ``similarity`` to given pairs of comparison texts; 0 when they share nothing.

    Both texts are in the row, so nothing is moved.
    """
    own = [F.coalesce(F.array_join(words(F.col(c), stop_words), " "), F.lit("")) for c in (text_a, text_b)]
    return pairs.withColumn("similarity", _similarity(*own))


class HeldTexts:
    """A bounded number of texts by their grams, to be compared with one text after the other."""

    def __init__(self, texts: list[str]):
        counts = [WordCounts(text.split(" ")) for text in texts]
        self.totals = np.array([c.total for c in counts], np.float64)
        self.number = {gram: i for i, gram in enumerate(dict.fromkeys(gram for c in counts for gram in c.grams))}
        gram = np.array([self.number[g] for c in counts for g in c.grams], np.int64)
        order = np.argsort(gram, kind="stable")
        self.texts = np.repeat(np.arange(len(counts)), [len(c.grams) for c in counts])[order]
        self.counts = np.array([n for c in counts for n in c.grams.values()], np.float64)[order]
        self.ends = np.searchsorted(gram[order], np.arange(len(self.number) + 1))

    def alike(self, own: WordCounts) -> np.ndarray:
        """The value of :func:`alike` of ``own`` with each text; 0 where they share nothing."""
        met = [(self.number[gram], c) for gram, c in own.grams.items() if gram in self.number]
        if not met:
            return np.zeros(len(self.totals))
        at, count = np.array(met, np.int64).T
        sizes = self.ends[at + 1] - self.ends[at]
        place = np.repeat(self.ends[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        text, a, b = self.texts[place], self.counts[place], np.repeat(count, sizes)
        dot, sa, sb = (np.bincount(text, x, len(self.totals)) for x in (a * b, a * a, b * b))
        return dot / (np.sqrt(sa + (self.totals - sa) * K2) * np.sqrt(sb + (own.total - sb) * K2))


def similar_to_held(held: DataFrame, rows: DataFrame, threshold: float, stop_words: Sequence[str] = DEFAULTS.stop_words) -> DataFrame:
    """(uid, id, similarity) of the texts of ``held`` (uid, text) and the ``rows`` (id, text) that reach the threshold.

    Each task holds the grams of ``held``, which has to be within ``HELD_CHARS`` and ``HELD_TEXTS``
    and have a word in each text. The rows stay where they are and are compared with all of it.
    """
    shown = F.coalesce(F.array_join(words(F.col("text"), stop_words), " "), F.lit("")).alias("text")
    texts = [(r["uid"], r["text"]) for r in held.select("uid", shown).collect()]
    sent = held.sparkSession.sparkContext.broadcast(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uids, known = pa.array([u for u, _ in sent.value], pa.string()), HeldTexts([t for _, t in sent.value])
        for batch in batches:
            at, text, found = array("q"), array("q"), array("d")
            for i, shown in enumerate(batch.column(1).to_pylist()):
                if shown:
                    value = known.alike(WordCounts(shown.split(" ")))
                    near = np.flatnonzero((value >= threshold) & (value > 0))
                    at.extend([i] * len(near)), text.extend(near.tolist()), found.extend(value[near].tolist())
            columns = [uids.take(pa.array(text, pa.int64())), batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "id", "similarity"])

    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("uid", T.StringType()), T.StructField("id", kind), T.StructField("similarity", T.DoubleType())])
    return rows.select("id", shown).mapInArrow(run, schema)


def split_join(rows: DataFrame, lookup: DataFrame, key: str | list[str], weight: str) -> DataFrame:
    """Inner join with a table of one row per key, safe when few keys hold most rows.

    ``weight`` is the number of rows of the key. A key is hot if it holds more than
    total / MAX_HOT_KEYS rows, so there are fewer than MAX_HOT_KEYS hot keys whatever the data:
    those are broadcast and their rows stay where they are. All other keys are small and are
    joined by a shuffle.
    """
    total = lookup.select(F.sum(weight).alias("t")).scalar()
    bound = F.greatest(F.lit(1000), total / MAX_HOT_KEYS)
    hot = lookup.filter(F.col(weight) > bound)
    cold = lookup.filter(F.col(weight) <= bound)
    crowded = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(*([key] if isinstance(key, str) else key))), key, "left_anti").join(cold, key)
    return crowded.unionByName(others)


@dataclass
class SimilarityIndex:
    """Shingles of a set of distinct texts, ready for joins at any threshold.

    ``shingles`` holds (uid, shingle, c2, n, upto, total, size): the squared count, the number of
    texts with the shingle, the running sum of squares from the most common shingle of the text
    down to this one, and sum and number over the whole text. Shingles of a single text cannot
    be shared and only count in ``total`` and ``size``.
    """

    shingles: DataFrame

    @classmethod
    def build(
        cls, texts: DataFrame, uid: str, text: str, stop_words: Sequence[str] = DEFAULTS.stop_words
    ) -> SimilarityIndex:
        counts = shingle_counts(
            texts.select(F.col(uid).alias("uid"), F.col(text).alias("_text")), "uid", "_text", stop_words
        )
        c = F.col("c").cast("double")
        counts = materialise(counts.select("uid", "shingle", (c * c).alias("c2")))
        frequency = counts.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
        totals = counts.groupBy("uid").agg(
            F.sum("c2").alias("total"), F.count("*").alias("size")
        )
        common_first = (
            Window.partitionBy("uid")
            .orderBy(F.desc("n"), "shingle")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        ranked = (
            split_join(counts, frequency, "shingle", "n")
            .withColumn("upto", F.sum("c2").over(common_first))
            .join(totals, "uid")
        )
        return cls(materialise(ranked))

    def blocks(self, threshold: float, crowded: int = CROWDED) -> DataFrame:
        """(uid, key, second, m, strong, size, share, below, unseen, reach): where texts that can reach the threshold meet.

        Take the shared shingles of a similar pair, rarest first, until they hold more than
        ``SLACK`` of one text. Each of them lies in the rare end ("prefix") of both texts,
        upto >= (theta - SLACK) total: otherwise everything shared would be that text's common
        part and less than SLACK, which is below its minimum share. So the pair meets on all of
        them, and ``candidate_pairs`` asks for their share.

        Where more than ``crowded`` texts meet in one shingle, the next shared shingle is added
        to the key: what is shared is then less than SLACK, the two shingles, and whatever is
        more common than the second.

        ``m`` is the number of strong texts that meet and ``size`` the number of shingles of the
        text. All are ``strong`` where one shingle is met; on two, those of which some pair can
        reach the threshold among themselves, so each similar pair has one of them.
        Of its mass, ``share`` lies in this shingle, ``below`` in more common ones, ``unseen`` in
        prefix shingles that are too crowded to be met alone, and ``reach`` in a pair of
        shingles that is met and in whatever is more common.
        """
        need = (min_share(threshold) - SLACK) * (1.0 - MARGIN) * F.col("total")
        prefix = self.shingles.filter(F.col("upto") >= need)
        sizes = prefix.groupBy("shingle").agg(F.count("*").alias("m")).filter("m > 1")
        sized = split_join(prefix, sizes, "shingle", "m")
        small = sized.filter(F.col("m") <= crowded).select(
            "uid",
            F.col("shingle").alias("key"),
            F.lit("").alias("second"),
            "m",
            F.lit(True).alias("strong"),
            (F.col("c2") / F.col("total")).alias("share"),
            ((F.col("upto") - F.col("c2")) / F.col("total")).alias("below"),
            "size",
        )
        large = materialise(
            sized.filter(F.col("m") > crowded).select(
                "uid",
                F.col("shingle").alias("key"),
                F.col("c2").alias("c2_1"),
                F.col("n").alias("n_1"),
                "total",
                "size",
            )
        )
        if large.isEmpty():
            return small.withColumns({"unseen": F.lit(0.0), "reach": F.lit(0.0)})
        unseen = large.groupBy("uid").agg(
            (F.sum("c2_1") / F.max("total")).alias("unseen")
        )
        small = small.join(unseen, "uid", "left").withColumns(
            {"unseen": F.coalesce("unseen", F.lit(0.0)), "reach": F.lit(0.0)}
        )
        more_common = (F.col("n") > F.col("n_1")) | (
            (F.col("n") == F.col("n_1")) & (F.col("shingle") < F.col("key"))
        )
        pairs = (
            large.drop("total", "size")
            .join(self.shingles, "uid")
            .filter(more_common & (F.col("upto") + F.col("c2_1") >= need))
            .select(
                "uid",
                "key",
                F.col("shingle").alias("second"),
                "size",
                ((F.col("upto") + F.col("c2_1")) / F.col("total")).alias("reach"),
            )
        )
        alone = large.filter(F.col("c2_1") >= need).select(
            "uid",
            "key",
            F.lit("").alias("second"),
            "size",
            (F.col("c2_1") / F.col("total")).alias("reach"),
        )
        refined = materialise(pairs.unionByName(alone))
        counts = refined.groupBy("key", "second").agg(F.count("*").alias("m")).filter("m > 1")
        keyed = F.concat_ws("\t", "key", "second")
        joined = split_join(
            refined.withColumn("_k", keyed), counts.select(keyed.alias("_k"), "m"), "_k", "m"
        )
        met = self._possible(joined, small, threshold)
        none = F.lit(0.0)
        return small.unionByName(
            met.withColumns({"share": none, "below": F.lit(1.0), "unseen": none})
        )

    def _possible(self, met: DataFrame, small: DataFrame, threshold: float) -> DataFrame:
        """The members of blocks on two shingles that can reach the threshold with some member.

        A pair that shares more than ``SLACK`` of either text in small blocks is listed there. Any
        other shares only shingles of at most ``SLACK`` there, no more than that in all, and the
        reach of the block. So a member whose bound fails even with the farthest reaching member
        has no partner here, and a block of texts that differ in the rest is gone before any join.
        """
        most = SLACK * (1.0 + MARGIN)
        alone = small.filter(F.col("share") <= most).groupBy("uid").agg(F.least(F.sum("share"), F.lit(most)).alias("_small"))
        mass = F.coalesce("_small", F.lit(0.0)) + F.col("reach")
        rated = met.join(alone, "uid", "left").withColumn("_ratio", norm_ratio(mass))
        best = rated.groupBy("key", "second").agg(F.max("_ratio").alias("_best"))
        enough = F.col("_ratio") * F.col("_best") >= threshold * (1.0 - MARGIN)
        left = materialise(
            rated.join(best, ["key", "second"])
            .filter(enough)
            .withColumn("strong", F.col("_ratio") * F.col("_ratio") >= threshold * (1.0 - 2 * MARGIN))
            .select("uid", "key", "second", "strong", "size", "reach")
        )
        counts = left.groupBy("key", "second").agg(F.count_if("strong").alias("m"), F.count("*").alias("_all"))
        several = counts.filter("_all > 1").drop("_all")
        return left.join(several, ["key", "second"]).select("uid", "key", "second", "m", "strong", "size", "reach")

    def verify(self, candidates: DataFrame, threshold: float, strict: bool) -> DataFrame:
        """(uid_a, uid_b, similarity) of the candidate pairs that reach the threshold.

        The shingles of ``uid_a`` are looked up in ``uid_b``, so the shorter text should come first.
        """
        side = self.shingles.select("uid", "shingle", "c2", "total")
        a = side.select(
            F.col("uid").alias("uid_a"), "shingle", F.col("c2").alias("a2"), F.col("total").alias("ta")
        )
        b = side.select(
            F.col("uid").alias("uid_b"), "shingle", F.col("c2").alias("b2"), F.col("total").alias("tb")
        )
        sums = (
            candidates.join(a, "uid_a")
            .join(b, ["uid_b", "shingle"])
            .groupBy("uid_a", "uid_b")
            .agg(
                F.sum(F.sqrt(F.col("a2")) * F.sqrt(F.col("b2"))).alias("dot"),
                F.sum("a2").alias("sa"),
                F.max("ta").alias("aa"),
                F.sum("b2").alias("sb"),
                F.max("tb").alias("bb"),
            )
        )
        value = cosine(*[F.col(c) for c in ("dot", "sa", "aa", "sb", "bb")])
        reached = F.col("similarity") > threshold if strict else F.col("similarity") >= threshold
        return sums.select("uid_a", "uid_b", value.alias("similarity")).filter(reached)

    def pairs(self, threshold: float, strict: bool = False, blocks: DataFrame | None = None) -> DataFrame:
        """Every pair of texts that reaches the threshold, once, the shorter text first."""
        blocks = self.blocks(threshold) if blocks is None else blocks
        return self.verify(candidate_pairs(blocks, threshold), threshold, strict)


def norm_ratio(mass: Column) -> Column:
    """The largest share of a text's norm that shared shingles of this share of its mass give."""
    mass = F.least(F.lit(1.0), mass + MARGIN)
    return F.sqrt(mass / (mass + (1 - mass) * K2))


def candidate_pairs(blocks: DataFrame, threshold: float, left: DataFrame | None = None) -> DataFrame:
    """Pairs of texts that can reach the threshold: the strong texts of a block are joined with all
    of it, so a block of few strong ones is linear in the others; summed per pair.

    The shorter text comes first. With ``left`` (uid) only pairs of one of its texts with another
    one that is not in it are met, and the one in it comes first.

    Everything two texts share is met in a block, or is more common than each shingle they met
    in, or is in a crowded shingle. If they share little before their first crowded shingle,
    everything is met in a block or within the reach of that shingle and the next. Either sum
    bounds the shared mass of each text, and the product of the norm ratios their cosine.
    """

    measures = ["share", "below", "unseen", "reach"]

    def side(name: str, rows: DataFrame) -> DataFrame:
        return rows.select("key", "second", F.struct("size", "uid", "strong", *measures).alias(name))

    def meet(ours: DataFrame, theirs: DataFrame) -> DataFrame:
        return side("a", ours).join(side("b", theirs), ["key", "second"])

    strong = blocks.filter("strong")
    if left is None:
        # Two strong texts meet twice; they are taken once.
        found = meet(strong, blocks).filter(~F.col("b.strong") | (F.col("a.uid") < F.col("b.uid")))
        shorter = F.struct("a.size", "a.uid") < F.struct("b.size", "b.uid")
        first, other = F.when(shorter, F.col("a")).otherwise(F.col("b")), F.when(shorter, F.col("b")).otherwise(F.col("a"))
        met = found.select(first.alias("a"), other.alias("b"))
    else:
        ours = blocks.join(left.select("uid"), "uid", "left_semi")
        theirs = blocks.join(left.select("uid"), "uid", "left_anti")
        met = meet(ours.filter("strong"), theirs).unionByName(meet(ours.filter("NOT strong"), theirs.filter("strong")))
    met = met.select(*[F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("uid", *measures)])
    sums = met.groupBy("uid_a", "uid_b").agg(
        *[
            measure(f"{c}_{s}").alias(f"{c}_{s}")
            for s in "ab"
            for c, measure in (
                ("share", F.sum), ("below", F.min), ("unseen", F.max), ("reach", F.max)
            )
        ]
    )

    def possible(*parts: str) -> Column:
        ratios = [norm_ratio(sum(F.col(f"{p}_{s}") for p in parts)) for s in "ab"]
        return ratios[0] * ratios[1] >= threshold * (1.0 - MARGIN)

    enough = F.greatest("share_a", "share_b") > SLACK * (1.0 - MARGIN)
    listed = enough & possible("share", "below", "unseen")
    refined = (F.col("reach_a") > 0) & possible("share", "reach")
    return sums.filter(listed | refined).select("uid_a", "uid_b")
