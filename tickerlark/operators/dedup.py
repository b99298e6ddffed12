"""Removal of exact, near and time-clustered duplicates.

"First" always means first by (post_ts, id). Exact stages aggregate before they shuffle, so a
text with most of the rows costs one partial row per task. The greedy stages keep a row unless
it is similar to an earlier kept row; they are solved in rounds whose work is linear in the
rows still open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.functions import text as tx
from tickerlark.operators.blockwise import similar_pairs
from tickerlark.operators.families import (
    alike_throughout,
    connected,
    cut_at_pauses,
    dropped_by_text,
    kept_in_time,
    similar_or_close,
)
from tickerlark.operators.similarity import (
    CROWDED,
    HELD_CHARS,
    HELD_TEXTS,
    SimilarityIndex,
    candidate_pairs,
    pair_similarity,
    similar_to_held,
    split_join,
    words,
)
from tickerlark.params import DEFAULTS, Params
from tickerlark.schema import require
from tickerlark.session import materialise

ORDER = ("post_ts", "id")
# Texts of a family that one task resolves; larger families take distributed rounds.
MOST_TEXTS = 20_000
# Posts of a segment without a pause that one task sweeps, if there is another way.
SWEEP_ROWS = 1_000_000
# Texts of a family that are compared with each other to find whether they act as one text.
MOST_ALIKE = 2_000
# --- fixed values: marks of a repost -----------------------------------------
REPOST_MARKS = rf"(?i)^RT @[{tx.WORD}]+:|RT:|Retweet:|🔄"
REPOST_PREFIX = rf"(?i)^RT @[{tx.WORD}]+:[{tx.SPACE}]*"


# ----------------------------------------------------------------------------- exact stages


def content_hash(df: DataFrame, algorithm: str = "md5", content: str = "content") -> DataFrame:
    """Add ``content_hash`` of the comparison text.

    md5 is the default: at hundreds of billions of posts 64 bits are no longer free of
    collisions, and a collision would remove a post.
    """
    text = tx.comparison_text(F.col(content))
    value = F.xxhash64(text) if algorithm == "xxhash64" else F.md5(text)
    return df.withColumn("content_hash", value)


def user_content_hash(df: DataFrame) -> DataFrame:
    """Add ``user_content_hash`` of user and comparison text."""
    user = F.lower(F.coalesce("username", F.lit("")))
    text = tx.comparison_text(F.col("content"))
    return df.withColumn("user_content_hash", F.md5(F.concat_ws(":", user, text)))


def keep_first(df: DataFrame, key: Column, order: Sequence[str] = ORDER) -> DataFrame:
    """The first row per key. ``min_by`` has a partial stage, so each task sends one row per
    key, however often the key occurs."""
    first = df.groupBy(key.alias("_key")).agg(
        F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    )
    return first.select("_row.*")


def dedup_exact(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    text = tx.comparison_text(F.col("content"))
    return keep_first(require(df, "content", *order), F.unhex(F.md5(text)), order)


def dedup_user_content(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    user = F.lower(F.coalesce("username", F.lit("")))
    text = tx.comparison_text(F.col("content"))
    key = F.unhex(F.md5(F.concat_ws(":", user, text)))
    return keep_first(require(df, "username", "content", *order), key, order)


def dedup_collect(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """First per lower-cased text with collapsed whitespace."""
    text = tx.collapse_whitespace(F.lower(F.coalesce("content", F.lit(""))))
    return keep_first(require(df, "content", *order), F.unhex(F.md5(text)), order)


# ----------------------------------------------------------------------------- pairs


def similar_texts(pairs: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Add ``similarity`` to (id_a, content_a, id_b, content_b) rows."""
    prepared = pairs.withColumns(
        {f"_{s}": tx.comparison_text(F.col(f"content_{s}")) for s in "ab"}
    )
    return pair_similarity(prepared, "_a", "_b", stop_words=params.stop_words).drop("_a", "_b")


def _is_repost(c: Column) -> Column:
    return F.coalesce(c.rlike(REPOST_MARKS), F.lit(False))


def _without_prefix(c: Column) -> Column:
    return tx.comparison_text(F.regexp_replace(c, REPOST_PREFIX, ""))


def is_repost_pair(pairs: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Add ``is_repost_pair``: both are reposts and their texts without the mark are alike."""
    prepared = pairs.withColumns({f"_{s}": _without_prefix(F.col(f"content_{s}")) for s in "ab"})
    scored = pair_similarity(prepared, "_a", "_b", stop_words=params.stop_words)
    both = _is_repost(F.col("content_a")) & _is_repost(F.col("content_b"))
    return scored.withColumn(
        "is_repost_pair", both & (F.col("similarity") > params.repost_threshold)
    ).drop("_a", "_b", "similarity")


def near_duplicate_pairs(
    df: DataFrame, threshold: float = DEFAULTS.review_threshold, params: Params = DEFAULTS,
    id_col: str = "id", content: str = "content", order: Sequence[str] = ORDER, every_copy: bool = False,
) -> DataFrame:
    """Pairs with at least this similarity, most similar first.

    Equal texts are represented by their first row: it is paired with each of its copies
    (similarity 1) and with the first rows of other texts. The pairs of the copies follow from
    these rows, which stay linear in the number of copies. With ``every_copy`` all pairs of rows
    are listed instead.
    """
    text = tx.comparison_text(F.col(content))
    rows = require(df, id_col, content).select(
        F.col(id_col).alias("id"), F.struct(*order).alias("at"), text.alias("text")
    )
    rows = rows.filter(F.size(words(F.col("text"), params.stop_words)) > 0).withColumn(
        "key", F.unhex(F.md5("text"))
    )
    rows = materialise(rows)
    groups = materialise(
        rows.groupBy("key").agg(
            F.min_by(F.struct("id", "at"), "at").alias("first"),
            F.any_value(F.length("text")).alias("chars"),
            F.count("*").alias("copies"),
        )
    )
    chars = groups.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    texts = rows.groupBy(F.col("key").alias("uid")).agg(words(F.any_value("text"), params.stop_words).alias("words"))
    pairs = similar_pairs(texts, threshold, chars)
    if every_copy:
        # The number tells rows of one place apart.
        members = rows.select("key", "id", F.struct("at", F.monotonically_increasing_id().alias("row")).alias("at"))
        members = materialise(members)
    else:
        members = groups.select("key", "first.id", "first.at")
    side = lambda s: members.select(F.col("key").alias(f"uid_{s}"), F.col("id").alias(f"id_{s}"), F.col("at").alias(f"at_{s}"))
    placed = pairs.join(side("a"), "uid_a").join(side("b"), "uid_b")
    earlier = F.col("at_a") < F.col("at_b")
    between = placed.select(
        F.when(earlier, F.col("id_a")).otherwise(F.col("id_b")).alias("id_a"),
        F.when(earlier, F.col("id_b")).otherwise(F.col("id_a")).alias("id_b"),
        "similarity",
    )
    one = F.lit(1.0).alias("similarity")
    repeated = groups.filter("copies > 1")
    if every_copy:
        own = members.join(repeated.select("key"), "key", "left_semi")
        first, other = (own.select("key", F.col("id").alias(f"id_{s}"), F.col("at").alias(f"at_{s}")) for s in "ab")
        copies = first.join(other, "key").filter("at_a < at_b").select("id_a", "id_b", one)
    else:
        # Each repeated text is met by its rows through a split join on a checked size.
        repeated = repeated.select("key", "copies", F.col("first.id").alias("id_a"))
        copies = split_join(rows.select("key", "id"), repeated, "key", "copies")
        copies = copies.filter(F.col("id") != F.col("id_a")).select("id_a", F.col("id").alias("id_b"), one)
    return between.unionByName(copies).orderBy(F.desc("similarity"), "id_a", "id_b")


def near_duplicates_between(
    left: DataFrame, right: DataFrame, threshold: float = DEFAULTS.review_threshold, params: Params = DEFAULTS,
    held_chars: int = HELD_CHARS,
) -> DataFrame:
    """(id_a, id_b, similarity): rows of ``left`` with similar rows of ``right``, each (id, content).

    Where the texts of ``left`` are few, of ``held_chars`` at most in all, each task holds them and
    the rows of ``right`` are compared where they are. Otherwise texts are compared once, however
    many rows have them: only texts of different tables meet. Equal texts have similarity 1;
    texts without a usable word are similar to nothing.
    """
    def rows(df: DataFrame, side: str) -> DataFrame:
        text = tx.comparison_text(F.col("content"))
        known = require(df, "id", "content").select(F.col("id").alias(f"id_{side}"), text.alias("_text"))
        known = known.filter(F.size(words(F.col("_text"), params.stop_words)) > 0)
        return materialise(known.withColumn("uid", F.concat(F.lit(side), F.md5("_text"))))

    given = {"a": rows(left, "a")}
    texts = materialise(given["a"].groupBy("uid").agg(F.any_value("_text").alias("text"), F.count("*").alias("copies")))
    chars = F.coalesce(F.sum(F.length("text")), F.lit(0))
    if texts.select((chars <= held_chars) & (F.count("*") <= HELD_TEXTS)).first()[0]:
        others = require(right, "id", "content").select("id", tx.comparison_text(F.col("content")).alias("text"))
        pairs = similar_to_held(texts, others, threshold, params.stop_words)
        pairs = materialise(pairs.select(F.col("uid").alias("uid_a"), F.col("id").alias("id_b"), "similarity"))
        return _named(pairs, texts, given).select("id_a", "id_b", "similarity")
    # A text of both tables is a node of each.
    given["b"] = rows(right, "b")
    both = given["a"].select("uid", "_text").union(given["b"].select("uid", "_text"))
    texts = materialise(both.groupBy("uid").agg(F.any_value("_text").alias("_text"), F.count("*").alias("copies")))
    index = SimilarityIndex.build(texts, "uid", "_text", params.stop_words)
    blocks = materialise(index.blocks(threshold))
    met = candidate_pairs(blocks, threshold, texts.filter(F.col("uid").startswith("a")).select("uid"))
    pairs = materialise(index.verify(met, threshold, False))
    return _named(pairs, texts, given).select("id_a", "id_b", "similarity")


def _named(pairs: DataFrame, texts: DataFrame, given: dict[str, DataFrame]) -> DataFrame:
    """Add the ids of the ``given`` rows (id, uid) of each side to pairs of texts (uid, copies)."""
    for side, own in given.items():
        uid = f"uid_{side}"
        load = texts.select(F.col("uid").alias(uid), "copies")
        wanted = materialise(pairs.select(uid).distinct().join(load, uid))
        # Its rows are the result's: a pair of texts stands for its rows on this side.
        own = split_join(own.select(F.col("uid").alias(uid), f"id_{side}"), wanted, uid, "copies").drop("copies")
        pairs = pairs.join(own, uid)
    return pairs


# ----------------------------------------------------------------------------- greedy by text


def _similar(met: DataFrame, spaces: Sequence[tuple[SimilarityIndex, float]]) -> DataFrame:
    """(uid_a, uid_b) of the pairs (uid_a, uid_b, block) that are similar in the block's space."""
    found = None
    for number, (index, threshold) in enumerate(spaces):
        own = met.filter(F.col("block.space") == number).select("uid_a", "uid_b").distinct()
        similar = index.verify(own, threshold, True).select("uid_a", "uid_b")
        found = similar if found is None else found.union(similar)
    return found.distinct()


def _resolve(
    order: DataFrame, spaces: Sequence[tuple[SimilarityIndex, float]], crowded: int
) -> DataFrame:
    """The uids dropped by keep-first: similar to an earlier uid that is kept.

    ``order`` is (uid, at). Pairs are listed only inside blocks of at most ``crowded`` texts. In
    a larger block the first open texts are compared among themselves, and with the others once
    they are kept: a group of near copies costs one comparison per member and kept text, not all
    pairs. Their number doubles with each round, so texts that are not similar after all are
    settled in as many rounds as the logarithm of the block. The first open text of all is
    settled in each round, so the rounds always end.
    """
    edges, heavy = None, None
    for number, (index, threshold) in enumerate(spaces):
        blocks = materialise(index.blocks(threshold, crowded))
        listed = index.pairs(threshold, True, blocks.filter(F.col("m") <= crowded))
        listed = listed.select("uid_a", "uid_b")
        large = blocks.filter(F.col("m") > crowded).select(
            "uid", F.struct(F.lit(number).alias("space"), "key", "second").alias("block")
        )
        edges = listed if edges is None else edges.unionByName(listed)
        heavy = large if heavy is None else heavy.unionByName(large)
    at = lambda side: order.select(F.col("uid").alias(f"uid_{side}"), F.col("at").alias(f"at_{side}"))
    edges = edges.distinct().join(at("a"), "uid_a").join(at("b"), "uid_b")
    forward = F.col("at_a") < F.col("at_b")
    edges = materialise(
        edges.select(
            F.when(forward, F.col("uid_a")).otherwise(F.col("uid_b")).alias("first"),
            F.when(forward, F.col("uid_b")).otherwise(F.col("uid_a")).alias("later"),
        )
    )
    heavy = materialise(heavy.join(order, "uid"))
    any_heavy = not heavy.isEmpty()
    touched = edges.select(F.col("first").alias("uid")).union(edges.select("later"))
    touched = touched.union(heavy.select("uid")).distinct()
    open_uids = materialise(touched)
    dropped = open_uids.limit(0)
    first = 16
    while not open_uids.isEmpty():
        blocked = edges.select(F.col("later").alias("uid"))
        if any_heavy:
            rank = F.row_number().over(Window.partitionBy("block").orderBy("at", "uid"))
            heads = heavy.withColumn("_rank", rank).filter(F.col("_rank") <= first).drop("_rank")
            heads = materialise(heads)
            behind = heavy.join(heads.select("block", "uid"), ["block", "uid"], "left_anti")
            ahead = heads.select("block", F.col("uid").alias("uid_a"), F.col("at").alias("_before"))
            among = ahead.join(heads, "block").filter(F.col("_before") < F.col("at"))
            known = edges.select(F.col("first").alias("uid_a"), F.col("later").alias("uid_b"))
            found = _similar(among.select("uid_a", F.col("uid").alias("uid_b"), "block"), spaces)
            # verify() puts the shorter text first; here the earlier one leads
            found = found.join(order.select(F.col("uid").alias("uid_a"), F.col("at").alias("at_a")), "uid_a")
            found = found.join(order.select(F.col("uid").alias("uid_b"), F.col("at").alias("at_b")), "uid_b")
            led = F.col("at_a") < F.col("at_b")
            found = found.select(
                F.when(led, F.col("uid_a")).otherwise(F.col("uid_b")).alias("uid_a"),
                F.when(led, F.col("uid_b")).otherwise(F.col("uid_a")).alias("uid_b"),
            )
            edges = materialise(
                known.union(found).distinct().select(F.col("uid_a").alias("first"), F.col("uid_b").alias("later"))
            )
            blocked = edges.select(F.col("later").alias("uid")).union(behind.select("uid"))
            first *= 2
        kept = materialise(open_uids.join(blocked.distinct(), "uid", "left_anti"))
        hit = edges.join(kept.withColumnRenamed("uid", "first"), "first").select(
            F.col("later").alias("uid")
        )
        if any_heavy:
            leaders = heavy.join(kept, "uid").select(F.col("uid").alias("uid_a"), "block")
            met = leaders.join(behind, "block").select("uid_a", F.col("uid").alias("uid_b"), "block")
            hit = hit.union(_similar(met, spaces).select(F.col("uid_b").alias("uid")))
        gone = materialise(hit.distinct())
        decided = kept.union(gone)
        dropped = dropped.union(gone)
        open_uids = materialise(open_uids.join(decided, "uid", "left_anti"))
        still = open_uids
        edges = materialise(
            edges.join(still.withColumnRenamed("uid", "first"), "first", "left_semi").join(
                still.withColumnRenamed("uid", "later"), "later", "left_semi"
            )
        )
        if any_heavy:
            heavy = materialise(heavy.join(still, "uid", "left_semi"))
            any_heavy = not heavy.isEmpty()
    return dropped


def _compared(df: DataFrame, params: Params) -> DataFrame:
    """Add the texts that are compared, and whether there is a word in them."""
    content = F.coalesce("content", F.lit(""))
    rows = require(df, "id", "post_ts", "content").withColumns(
        {"_text": tx.comparison_text(content), "_repost": _is_repost(content)}
    )
    rows = rows.withColumn("_origin", F.when(F.col("_repost"), _without_prefix(content)))
    usable = (F.size(words(F.col("_text"), params.stop_words)) > 0) | (
        F.coalesce(F.size(words(F.col("_origin"), params.stop_words)), F.lit(0)) > 0
    )
    return rows.withColumn("_usable", usable)


def dedup_similarity(
    df: DataFrame, params: Params = DEFAULTS, crowded: int = CROWDED, most_texts: int = MOST_TEXTS
) -> DataFrame:
    """Drop a row if an earlier kept row is similar, or a repost of the same text.

    Rows equal in every compared text are one unit, represented by the first. A text without
    any usable word is similar to nothing, not even to its copies, and is always kept. Families of
    more than ``most_texts`` units are resolved in distributed rounds, the others in one pass.
    """
    rows = _compared(df, params)
    identity = F.unhex(F.md5(F.concat_ws("\n", "_text", F.coalesce("_origin", F.lit("\r")))))
    units = materialise(keep_first(rows.filter("_usable"), identity).withColumnRenamed("id", "uid"))
    spaces = _spaces(units, params)
    edges = [similar_or_close(index, threshold, crowded) for index, threshold in spaces]
    families = connected(edges[0].unionByName(edges[1]))
    dropped = _dropped(units, spaces, families, params, crowded, most_texts)
    kept = units.join(dropped, "uid", "left_anti").withColumnRenamed("uid", "id")
    return kept.unionByName(rows.filter("not _usable")).select(*df.columns)


def _spaces(units: DataFrame, params: Params) -> list[tuple[SimilarityIndex, float]]:
    """Indices of the texts and of what reposts repeat, with their thresholds."""
    texts = SimilarityIndex.build(units, "uid", "_text", params.stop_words)
    origins = SimilarityIndex.build(units.filter("_repost"), "uid", "_origin", params.stop_words)
    return [(texts, params.similarity_threshold), (origins, params.repost_threshold)]


def _dropped(
    units: DataFrame, spaces: Sequence[tuple[SimilarityIndex, float]], families: DataFrame,
    params: Params, crowded: int, most_texts: int,
) -> DataFrame:
    """The uids of ``units`` dropped by keep-first.

    Families of bounded size are resolved in one grouped pass, in order. Larger ones take the
    rounds of :func:`_resolve`, which never holds a family in one task.
    """
    located = units.join(families, "uid")
    size = F.sum(F.size(F.split("_text", " ")))
    sizes = located.groupBy("family").agg(F.count("*").alias("n"), size.alias("words")).filter("n > 1")
    sizes = materialise(sizes)
    large = (F.col("n") > most_texts) | (F.col("words") > most_texts * 100)
    order = F.struct(*[F.col("uid" if c == "id" else c) for c in ORDER]).alias("at")
    origin = F.when(F.col("_repost"), words(F.col("_origin"), params.stop_words)).alias("origin")
    small = located.join(sizes.filter(~large).select("family"), "family")
    small = small.select("family", order, "uid", words(F.col("_text"), params.stop_words).alias("words"), origin)
    dropped = dropped_by_text(small, (spaces[0][1], spaces[1][1]))
    giant = sizes.filter(large).select("family")
    if giant.isEmpty():
        return dropped
    giant = materialise(located.join(giant, "family").select("uid", order))
    own = giant.select("uid")
    parts = [(SimilarityIndex(materialise(index.shingles.join(own, "uid", "left_semi"))), t) for index, t in spaces]
    return dropped.union(_resolve(giant, parts, crowded).select("uid"))


# ----------------------------------------------------------------------------- greedy by time

# Slots for looking up the next post of a text. Points are distinct microseconds, so a slot
# has a fixed largest size.
_SLOT = 10_000_000


def _kept_in_chains(points: DataFrame, width: int) -> DataFrame:
    """(text, t) kept when a text is similar only to itself.

    A post after a pause is kept; each kept post decides the next one: the first more than
    ``width`` after it. Those links are followed by doubling, in as many rounds as the
    logarithm of the longest chain.
    """
    bucket = F.floor(F.col("t") / width)
    spans = points.groupBy("text", bucket.alias("b")).agg(
        F.min("t").alias("lo"), F.max("t").alias("hi")
    )
    before = spans.select("text", (F.col("b") + 1).alias("b"), F.col("hi").alias("last"))
    paused = F.col("last").isNull() | (F.col("last") < F.col("lo") - width)
    roots = spans.join(before, ["text", "b"], "left").filter(paused)
    kept = materialise(roots.select("text", F.col("lo").alias("t")))

    seek = F.col("t") + width + 1
    none = F.lit(None).cast("bigint")
    events = points.select(
        "text", F.floor(F.col("t") / _SLOT).alias("slot"), F.col("t").alias("k"),
        F.col("t").alias("point"), none.alias("source"),
    ).union(
        points.select(
            "text", F.floor(seek / _SLOT).alias("slot"), seek.alias("k"), none, F.col("t")
        )
    )
    within = (
        Window.partitionBy("text", "slot").orderBy(F.desc("k"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = events.withColumn("near", F.min("point").over(within)).filter("source is not null")
    later = Window.partitionBy("text").orderBy(F.desc("slot")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    slots = events.groupBy("text", "slot").agg(F.min("point").alias("head"))
    slots = slots.withColumn("far", F.min("head").over(later)).select("text", "slot", "far")
    jump = found.join(slots, ["text", "slot"]).select(
        "text", F.col("source").alias("t"), F.coalesce("near", "far").alias("to")
    )
    jump = materialise(jump.filter("to is not null"))
    while True:
        reached = kept.join(jump, ["text", "t"]).select("text", F.col("to").alias("t")).distinct()
        new = materialise(reached.join(kept, ["text", "t"], "left_anti"))
        if new.isEmpty():
            return kept
        kept = materialise(kept.union(new))
        ahead = jump.select("text", F.col("t").alias("to"), F.col("to").alias("far"))
        jump = materialise(jump.join(ahead, ["text", "to"]).select("text", "t", F.col("far").alias("to")))


def dedup_temporal(
    df: DataFrame, params: Params = DEFAULTS, sweep_rows: int = SWEEP_ROWS, crowded: int = CROWDED
) -> DataFrame:
    """Drop a post if a kept post of similar text was made at most the window before it.

    One pass in time over each family of texts, cut at pauses longer than the window. Segments of
    more than ``sweep_rows`` posts whose texts are all similar follow `next post` links instead,
    which no single task walks.
    """
    text = tx.comparison_text(F.coalesce("content", F.lit("")))
    rows = require(df, "id", "post_ts", "content").withColumn("_text", text)
    usable = F.size(words(F.col("_text"), params.stop_words)) > 0
    rows = rows.withColumn("_usable", usable)
    points = materialise(
        rows.filter("_usable").select(
            F.md5("_text").alias("text"), F.unix_micros("post_ts").alias("t"), "id", "_text"
        )
    )
    texts = materialise(points.groupBy("text").agg(F.any_value("_text").alias("_text"), F.count("*").alias("copies")))
    index = SimilarityIndex.build(texts, "text", "_text", params.stop_words)
    families = connected(similar_or_close(index, params.temporal_threshold, crowded))
    kept = _kept_in_time(points.select("text", "t", "id"), texts, families, params, sweep_rows)
    return rows.filter("_usable").join(kept, "id", "left_semi").unionByName(rows.filter("not _usable")).select(*df.columns)


def _kept_in_time(
    points: DataFrame, texts: DataFrame, families: DataFrame, params: Params, sweep_rows: int
) -> DataFrame:
    """(id) of the kept posts of ``points`` (text, t, id); ``texts`` is (text, _text, copies)."""
    width, threshold = params.temporal_window_minutes * 60_000_000, params.temporal_threshold
    named = families.withColumnRenamed("uid", "text")
    shown = words(F.col("_text"), params.stop_words)
    known = texts.join(named, "text", "left").select(
        "text", "copies", F.coalesce("family", "text").alias("family"), F.when(F.col("family").isNotNull(), shown).alias("words")
    )
    known = materialise(known)
    located = split_join(points, known, "text", "copies").drop("copies")
    located = materialise(cut_at_pauses(located, width))
    kept = kept_in_time(located.filter(F.col("rows") <= sweep_rows), width, threshold)
    large = located.filter(F.col("rows") > sweep_rows)
    names = materialise(large.select("family").distinct())
    if names.isEmpty():
        return kept
    several = known.filter("words is not null").join(names, "family", "left_semi").select("family", "text", "words")
    odd = several.select("family").distinct().join(alike_throughout(several, threshold, MOST_ALIKE), "family", "left_anti")
    odd = materialise(odd)
    kept = kept.union(kept_in_time(large.join(F.broadcast(odd), "family", "left_semi"), width, threshold))
    one = large.join(F.broadcast(odd), "family", "left_anti")
    firsts = materialise(one.groupBy(F.col("family").alias("text"), "t").agg(F.min("id").alias("id")))
    chains = firsts.join(_kept_in_chains(firsts.select("text", "t"), width), ["text", "t"])
    return kept.union(chains.select("id"))


# ----------------------------------------------------------------------------- pipeline


def dedup_stages(
    df: DataFrame, params: Params = DEFAULTS, sweep_rows: int = SWEEP_ROWS, crowded: int = CROWDED, most_texts: int = MOST_TEXTS
) -> DataFrame:
    """The first row of each text with ``copies``, rows of the text, and ``removed_at_stage``.

    The label is null for the rows that the pipeline keeps. After the exact stage every text is
    unique, so no (user, text) can repeat; one index and one set of families serve the two
    greedy stages. Stored once: result and counts read the same table.
    """
    text = F.unhex(F.md5(tx.comparison_text(F.col("content"))))
    first = df.groupBy(text.alias("_key")).agg(
        F.min_by(F.struct(*df.columns), F.struct(*ORDER)).alias("_row"), F.count("*").alias("copies")
    )
    rows = materialise(_compared(first.select("_row.*", "copies"), params).withColumnRenamed("id", "uid"))
    units = rows.filter("_usable")
    spaces = _spaces(units, params)
    least = min(params.similarity_threshold, params.temporal_threshold)
    edges = [similar_or_close(index, t, crowded) for index, t in ((spaces[0][0], least), spaces[1])]
    families = connected(edges[0].unionByName(edges[1]))
    worded = F.size(words(F.col("_text"), params.stop_words)) > 0
    texts = units.filter(worded).select(F.col("uid").alias("text"), "_text", F.lit(1).cast("bigint").alias("copies"))
    points = units.filter(worded).select(F.col("uid").alias("text"), F.unix_micros("post_ts").alias("t"), F.col("uid").alias("id"))
    in_time = _kept_in_time(points, texts, families, params, sweep_rows).withColumnRenamed("id", "uid")
    late = materialise(points.select(F.col("id").alias("uid")).join(in_time, "uid", "left_anti"))
    left = materialise(units.join(late, "uid", "left_anti"))
    gone = _dropped(left, spaces, families, params, crowded, most_texts)
    labels = late.withColumn("removed_at_stage", F.lit("temporal_clustering")).union(gone.withColumn("removed_at_stage", F.lit("similarity")))
    labelled = rows.join(labels, "uid", "left").withColumnRenamed("uid", "id")
    return materialise(labelled.select(*df.columns, "copies", "removed_at_stage"))


def dedup_pipeline(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Exact, user, temporal, then similarity."""
    return dedup_stages(df, params).filter("removed_at_stage IS NULL").select(*df.columns)


def _stage_rows(counts: DataFrame) -> DataFrame:
    removed = F.col("original_count") - F.col("unique_count")
    rate = F.when(F.col("original_count") > 0, removed / F.col("original_count"))
    return counts.select(
        "stage",
        "original_count",
        "unique_count",
        removed.alias("duplicates_removed"),
        F.coalesce(rate, F.lit(0.0)).alias("deduplication_rate"),
    )


def dedup_stats(df: DataFrame) -> DataFrame:
    """Counts of the exact stages and their sum, without building their results."""
    text = F.md5(tx.comparison_text(F.col("content")))
    counts = df.groupBy(text.alias("k")).agg(F.count("*").alias("m")).agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("n"), F.count("*").alias("u")
    )
    n, u = F.col("n"), F.col("u")
    rows = [("exact_content", n, u), ("user_content", u, u), ("summary", n, u)]
    return _stage_rows(
        counts.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(stage).alias("stage"),
                            before.alias("original_count"),
                            after.alias("unique_count"),
                        )
                        for stage, before, after in rows
                    ]
                )
            )
        )
    )


def dedup_pipeline_stats(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Counts of every stage of the pipeline and of the whole, from one run of it."""
    return stage_counts(dedup_stages(df, params))


def stage_counts(stages: DataFrame) -> DataFrame:
    """The counts of a table of :func:`dedup_stages`, in one aggregation."""
    label = F.coalesce("removed_at_stage", F.lit(""))
    counts = stages.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("a"), F.count("*").alias("b"),
        F.count_if(label != "temporal_clustering").alias("c"), F.count_if(label == "").alias("d"),
    )
    spans = [("exact_content", "a", "b"), ("user_content", "b", "b"), ("temporal_clustering", "b", "c"), ("similarity", "c", "d"), ("summary", "a", "d")]
    rows = [F.struct(F.lit(s).alias("stage"), F.col(x).alias("original_count"), F.col(y).alias("unique_count")) for s, x, y in spans]
    return _stage_rows(counts.select(F.inline(F.array(*rows))))
