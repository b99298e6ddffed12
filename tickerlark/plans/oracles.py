"""Independent SQL for the registered queries, written for DuckDB.

The SQL shares constants with the library, not code: other functions, two-pass statistics,
full joins instead of blocks, ranking instead of partial aggregates.
"""

from __future__ import annotations

from tickerlark import constants as const
from tickerlark.functions.text import SPACE, WORD
from tickerlark.params import DEFAULTS
from tickerlark.plans import queries as q
from tickerlark.sources.posts import POST_EXPRESSIONS

REF = f"TIMESTAMP '{q.REF_TS}'"
K = "(1.0::DOUBLE + ln(1.5::DOUBLE))"


def r(expr: str, digits: int = 6) -> str:
    """Round half to even, after snapping to ten digits."""
    return (
        f"(round_even(round_even(({expr})::DOUBLE * 1e10, 0) / 1e10 * 1e{digits}, 0)"
        f" / 1e{digits} + 0.0::DOUBLE)"
    )


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sub(expr: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expr}, '{pattern}', '{to}', '{flags}')"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- posts ------------------------------------------------------------------------

RAW = "raw AS (SELECT " + ", ".join(f"{sql} AS {n}" for n, sql in POST_EXPRESSIONS.items()) + " FROM events)"
POSTS = f"""posts AS (SELECT *, username AS display_name,
  regexp_extract_all(lower(content), '#[{WORD}]+') AS hashtags,
  regexp_extract_all(lower(content), '@[{WORD}]+') AS mentions,
  '' AS url, starts_with(content, 'RT @') AS is_retweet, 'en' AS language FROM raw)"""
BASE = [RAW, POSTS]


def word_cut(expr: str, pattern: str, to: str) -> str:
    return sub(expr, f"(^|[^{WORD}])(?:{pattern})([^{WORD}]|$)", rf"\1{to}\2", "gi")


def no_urls(expr: str) -> str:
    for p in (
        f"https?://[^{SPACE}]+", rf"www\.[^{SPACE}]+", rf"t\.co/[{WORD}]+",
        rf"pic\.twitter\.com/[{WORD}]+", rf"tinyurl\.com/[{WORD}]+", rf"bit\.ly/[{WORD}]+",
    ):
        expr = sub(expr, p, "", "gi")
    return expr


def no_runs(expr: str) -> str:
    return sub(sub(sub(expr, r"\.{3,}", "..."), r"!{2,}", "!"), r"\?{2,}", "?")


def no_specials(expr: str) -> str:
    return sub(expr, rf"[^{WORD}{SPACE}\-+%₹$#@.,!?():/]", " ")


def standard(expr: str) -> str:
    for p, to in (
        ("nse", "NSE"), ("bse", "BSE"), (f"nifty[{SPACE}]*50", "NIFTY50"),
        (f"bank[{SPACE}]*nifty", "BANKNIFTY"), (f"fin[{SPACE}]*nifty", "FINNIFTY"), ("rupees?", "₹"),
    ):
        expr = word_cut(expr, p, to)
    return sub(expr, rf"(^|[^{WORD}])rs\.?[{SPACE}]*(\p{{Nd}}+)", r"\1₹\2", "gi")


def one_space(expr: str) -> str:
    return sub(expr, f"[{SPACE}]+", " ")


def user(expr: str) -> str:
    return f"lower({sub(expr, f'[^{WORD}]', '')})"


_TEXT = f"trim({standard(one_space(no_specials(no_runs(no_urls('trimmed')))))})"
_TAGS = "list_transform(hashtags, lambda t: lower(trim(replace(t, '#', ''))))"
CLEANED = f"""decoded AS (SELECT *, trim({one_space("replace(content, '&amp;', '&')")}) AS trimmed FROM posts),
cleaned AS (SELECT id, {user('username')} AS username, display_name, post_ts, {_TEXT} AS content,
  greatest(replies_count, 0) AS replies_count, greatest(retweets_count, 0) AS retweets_count,
  greatest(likes_count, 0) AS likes_count, greatest(views_count, 0) AS views_count,
  list_sort(list_distinct(list_transform(list_filter({_TAGS}, lambda t: length(t) > 1), lambda t: '#' || t))) AS hashtags,
  list_sort(list_distinct(list_transform(mentions, lambda m: '@' || {user('m')}))) AS mentions,
  url, is_retweet, language, {REF} AS cleaned_at, length(content) AS original_length, length({_TEXT}) AS cleaned_length
  FROM decoded),
clean AS (SELECT * FROM cleaned WHERE cleaned_length >= 10)"""
CLEAN = [*BASE, CLEANED]


def compared(expr: str) -> str:
    bare = sub(f"lower({expr})", rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+")
    bare = sub(sub(bare, f"@[{WORD}]+"), f"#[{WORD}]+")
    return f"trim({sub(sub(bare, f'[^{WORD}{SPACE}]', ' '), f'[{SPACE}]+', ' ')})"


# --- features -----------------------------------------------------------------------

_BULL2, _BULL1 = quoted(const.BULLISH_STRONG), quoted(const.BULLISH_MODERATE + const.BULLISH_HINDI)
_BEAR2, _BEAR1 = quoted(const.BEARISH_STRONG), quoted(const.BEARISH_MODERATE + const.BEARISH_HINDI)
_SIGNED = (
    f"CASE WHEN t IN ({_BULL2}) THEN 2.0 WHEN t IN ({_BULL1}) THEN 1.0"
    f" WHEN t IN ({_BEAR2}) THEN -2.0 WHEN t IN ({_BEAR1}) THEN -1.0 END"
)
_ACTION = "CASE t " + " ".join(f"WHEN '{w}' THEN {v}" for w, v in const.ACTION_WEIGHTS.items()) + " END"
_URGENT = " + ".join(
    f"CASE WHEN contains(lower(content), '{w}') THEN {v} ELSE 0 END" for w, v in const.URGENCY_SCORES.items()
)
_TARGETS = quoted(const.TARGET_HASHTAGS)


def found(case: str) -> str:
    return f"list_filter(list_transform(tok, lambda t: ({case})::DOUBLE), lambda v: v IS NOT NULL)"


def featured(source: str) -> str:
    """CTEs from ``source`` to ``features``."""
    return f"""tokenised AS (SELECT *, string_split_regex(lower(content), '[^{WORD}]+') AS tok,
  regexp_extract_all(content, '[+-]?\\p{{Nd}}+(?:\\.\\p{{Nd}}+)?%') AS pct FROM {source}),
scored AS (SELECT *, {found(_SIGNED)} AS w, {found(_ACTION)} AS act FROM tokenised),
parts AS (SELECT *,
  CASE WHEN len(w) > 0 THEN list_sum(w) / list_sum(list_transform(w, lambda v: abs(v))) ELSE 0 END::DOUBLE AS market_sentiment,
  CASE WHEN len(w) > 0 THEN list_sum(w) / 2 / len(w) ELSE 0 END::DOUBLE AS basic_sentiment,
  CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda v: abs(v))) / 2 / len(w) ELSE 0 END::DOUBLE AS sentiment_confidence,
  CASE WHEN len(act) > 0 THEN list_sum(act) / len(act) ELSE 0 END::DOUBLE AS action_sentiment,
  CASE WHEN len(pct) > 0 THEN list_sum(list_transform(pct, lambda p: greatest(-10, least(10, replace(p, '%', '')::DOUBLE)) / 10)) / len(pct)
    ELSE 0 END::DOUBLE AS price_sentiment
  FROM scored),
features AS (SELECT *,
  greatest(-1, least(1, 0.3 * basic_sentiment + 0.4 * market_sentiment + 0.2 * action_sentiment + 0.1 * price_sentiment))::DOUBLE AS sentiment_score,
  length(content) AS content_length, len(regexp_extract_all(content, '[^{SPACE}]+')) AS word_count,
  len(hashtags) AS hashtag_count, len(mentions) AS mention_count,
  regexp_matches(content, '₹|\\$|\\p{{Nd}}+%') AS has_price_mention,
  list_has_any(hashtags, [{_TARGETS}]) AS has_target_hashtag,
  least(1, ({_URGENT}) / 5.0)::DOUBLE AS urgency_score,
  ln(1 + replies_count::DOUBLE) AS replies_count_log, ln(1 + retweets_count::DOUBLE) AS retweets_count_log,
  ln(1 + likes_count::DOUBLE) AS likes_count_log, ln(1 + views_count::DOUBLE) AS views_count_log,
  hour(post_ts) AS hour, isodow(post_ts) - 1 AS day_of_week, hour(post_ts) BETWEEN 9 AND 15 AS is_market_hours
  FROM parts)"""


FEATURES = [*CLEAN, featured("clean")]

SIGNALLED = """st AS (SELECT count(*) AS n, avg(replies_count_log) AS m1, coalesce(stddev_samp(replies_count_log), 0) AS s1,
  avg(retweets_count_log) AS m2, coalesce(stddev_samp(retweets_count_log), 0) AS s2,
  avg(likes_count_log) AS m3, coalesce(stddev_samp(likes_count_log), 0) AS s3,
  max(replies_count_log + retweets_count_log + likes_count_log) AS top FROM features),
comp AS (SELECT f.*, top, ((replies_count_log - m1) / (s1 + 1e-8) + (retweets_count_log - m2) / (s2 + 1e-8)
  + (likes_count_log - m3) / (s3 + 1e-8)) / 3 AS volume_signal FROM features f, st),
comp2 AS (SELECT *, 0.4 * sentiment_score + 0.3 * volume_signal + 0.3 * urgency_score AS composite_signal FROM comp),
cs AS (SELECT avg(composite_signal) AS cm, coalesce(stddev_samp(composite_signal), 0) AS csd FROM comp2),
strong AS (SELECT comp2.*, cm, csd, CASE WHEN csd > 0 THEN tanh((composite_signal - cm) / csd) ELSE composite_signal END AS signal_strength
  FROM comp2, cs),
conf AS (SELECT *, (sentiment_confidence + (replies_count_log + retweets_count_log + likes_count_log) / top
  + CASE WHEN has_target_hashtag THEN 1.0 ELSE 0.5 END + 1 - exp(-2 * abs(signal_strength))) / 4 AS raw_confidence FROM strong),
signals AS (SELECT *, greatest(0, least(1, raw_confidence))::DOUBLE AS signal_confidence,
  CASE WHEN signal_strength <= -0.3 THEN 'strong_bearish' WHEN signal_strength <= -0.1 THEN 'weak_bearish'
    WHEN signal_strength <= 0.1 THEN 'neutral' WHEN signal_strength <= 0.3 THEN 'weak_bullish' ELSE 'strong_bullish' END AS signal_category,
  greatest(0, least(1, raw_confidence)) >= 0.6 AS high_confidence, post_ts AS signal_timestamp, hour(post_ts) AS signal_hour FROM conf),
good AS (SELECT * FROM signals WHERE signal_confidence >= 0.6)"""
SIGNALS = [*FEATURES, SIGNALLED]
_SIGNAL_OUT = (
    f"{r('signal_strength')} AS signal_strength, {r('signal_confidence')} AS signal_confidence, signal_category,"
    " high_confidence, signal_timestamp, signal_hour"
)

# --- aggregates ------------------------------------------------------------------------


def _sums(*names: str) -> str:
    return ", ".join(f"CAST(sum({n}_count) AS BIGINT) AS {n}_count_sum" for n in names)


_COMMON = f"""{r('avg(signal_strength)', 4)} AS signal_strength_mean, {r('stddev_samp(signal_strength)', 4)} AS signal_strength_std,
  count(*) AS signal_strength_count, {r('avg(signal_confidence)', 4)} AS signal_confidence_mean,
  {r('avg(sentiment_score)', 4)} AS sentiment_score_mean, {r('avg(urgency_score)', 4)} AS urgency_score_mean"""


def windowed(name: str, interval: str, label: str) -> str:
    return f"""{name}_raw AS (SELECT time_bucket(INTERVAL '{interval}', signal_timestamp) AS time_window, '{label}' AS window_size,
  {_COMMON}, {r('stddev_samp(sentiment_score)', 4)} AS sentiment_score_std, {_sums('replies', 'retweets', 'likes', 'views')},
  avg(CASE WHEN signal_strength > 0 THEN 1.0 ELSE 0.0 END) AS direction_consistency
  FROM good GROUP BY 1 HAVING count(*) >= 3),
{name} AS (SELECT *, abs(signal_strength_mean) * signal_confidence_mean * ln(1 + signal_strength_count) AS signal_intensity,
  coalesce(signal_strength_std, 0) AS signal_volatility, {REF} AS aggregation_timestamp FROM {name}_raw)"""


W15, W60 = windowed("w15", "15 minutes", "15min"), windowed("w60", "1 hour", "1hour")
TAGS = f"""tags_raw AS (SELECT hashtag, {_COMMON}, {_sums('replies', 'retweets', 'likes')}
  FROM (SELECT *, lower(unnest(hashtags)) AS hashtag FROM good) GROUP BY 1 HAVING count(*) >= 3),
tags AS (SELECT *, signal_strength_mean * ln(1 + signal_strength_count) AS hashtag_momentum FROM tags_raw)"""
OVERALL = """o AS (SELECT count(*) AS n, avg(signal_strength) AS mean, stddev_samp(signal_strength) AS std,
  avg(signal_confidence) AS confidence,
  greatest(count(*) FILTER (signal_strength > 0), count(*) FILTER (signal_strength < 0)) / count(*)::DOUBLE AS consistency FROM good)"""
_WINDOW_OUT = f"""time_window, window_size, {r('signal_strength_mean')} AS signal_strength_mean, {r('signal_strength_std')} AS signal_strength_std,
  signal_strength_count, {r('signal_confidence_mean')} AS signal_confidence_mean, {r('sentiment_score_mean')} AS sentiment_score_mean,
  {r('sentiment_score_std')} AS sentiment_score_std, replies_count_sum, retweets_count_sum, likes_count_sum, views_count_sum,
  {r('urgency_score_mean')} AS urgency_score_mean, {r('signal_intensity')} AS signal_intensity,
  {r('direction_consistency')} AS direction_consistency, {r('signal_volatility')} AS signal_volatility, aggregation_timestamp"""

# --- recommendations ---------------------------------------------------------------------

_DIRECTION = f"""direction AS (SELECT 'market_direction' AS type,
  CASE WHEN mean > 0 THEN 'bullish' WHEN mean < 0 THEN 'bearish' ELSE 'neutral' END AS direction,
  CASE WHEN abs(mean) >= 0.8 THEN 'strong' WHEN abs(mean) >= 0.5 THEN 'moderate' WHEN abs(mean) >= 0.2 THEN 'weak' ELSE 'neutral' END AS strength,
  {r('confidence * 0.4 + consistency * 0.3 + least(1.0, n / 50.0) * 0.3', 3)} AS confidence,
  {r('mean', 3)} AS signal_score, {r('consistency', 3)} AS consistency, n AS supporting_signals, {r('consistency * 100', 1)} AS pct
  FROM o WHERE n >= 3),
direction_out AS (SELECT * EXCLUDE (pct), printf('%s%s %s signal with %.1f%% consistency based on %d tweets',
  upper(strength[1]), strength[2:], direction, pct, supporting_signals) AS description FROM direction)"""
_RISK = f"""risk_raw AS (SELECT ((((0.5::DOUBLE + CASE WHEN std > 0.5 THEN 0.2 ELSE 0 END::DOUBLE) + CASE WHEN consistency < 0.6 THEN 0.2 ELSE 0 END::DOUBLE)
  + CASE WHEN n < 10 THEN 0.1 ELSE 0 END::DOUBLE) + CASE WHEN confidence < 0.7 THEN 0.15 ELSE 0 END::DOUBLE) AS raw,
  array_to_string(list_filter([CASE WHEN std > 0.5 THEN 'High signal volatility detected' END, CASE WHEN consistency < 0.6 THEN 'Low sentiment consistency' END,
  CASE WHEN n < 10 THEN 'Low signal volume' END, CASE WHEN confidence < 0.7 THEN 'Below average signal confidence' END], lambda f: f IS NOT NULL), '; ') AS risk_factors
  FROM o WHERE n > 0),
risk AS (SELECT CASE WHEN raw >= 0.8::DOUBLE THEN 'high' WHEN raw >= 0.6::DOUBLE THEN 'medium' ELSE 'low' END AS risk_level, {r('raw', 3)} AS risk_score, risk_factors, raw FROM risk_raw),
risk_out AS (SELECT * EXCLUDE (raw), printf('Risk level: %s (score: %.2f)', upper(risk_level), {r('raw', 2)}) AS description FROM risk)"""
_SCORE = f"score_out AS (SELECT {r('abs(mean) * 0.3 + consistency * 0.25 + confidence * 0.25 + least(1.0, n / 50.0) * 0.2', 3)} AS overall_score FROM o WHERE n >= 3)"
_STATUS = """status_out AS (SELECT CASE WHEN total = 0 THEN 'no_data' WHEN n < 3 THEN 'insufficient_data' ELSE 'success' END AS status,
  total AS total_signals_analyzed, n AS high_confidence_signals FROM o, (SELECT count(*) AS total FROM signals))"""


def _latest(name: str) -> str:
    return f"""(SELECT 'time_based_' || window_size AS type, window_size AS time_window, {r('signal_strength_mean', 3)} AS latest_signal,
  {r('signal_intensity', 3)} AS signal_intensity, signal_strength_count AS supporting_signals, {r('direction_consistency', 3)} AS consistency,
  {r('signal_volatility', 3)} AS volatility, printf('Last %s: %s sentiment with %d supporting tweets', window_size,
  CASE WHEN signal_strength_mean > 0 THEN 'Bullish' ELSE 'Bearish' END, signal_strength_count) AS description
  FROM {name} ORDER BY {name}.time_window DESC LIMIT 1)"""


_TIMES = f"times_out AS ({_latest('w15')} UNION ALL {_latest('w60')})"
_TAG_REC = f"""tag_out AS (SELECT 'hashtag_momentum' AS type, hashtag, {r('hashtag_momentum', 3)} AS momentum, {r('signal_strength_mean', 3)} AS signal_strength,
  signal_strength_count AS supporting_signals, {r('signal_confidence_mean', 3)} AS average_confidence,
  printf('Strong momentum in %s with %d supporting tweets', hashtag, signal_strength_count) AS description
  FROM tags ORDER BY hashtag_momentum DESC, tags.hashtag LIMIT 3)"""
RECS = [*SIGNALS, W15, W60, TAGS, OVERALL, _DIRECTION, _RISK, _SCORE, _STATUS, _TIMES, _TAG_REC]
_NO = {t: f"NULL::{t.upper()}" for t in ("varchar", "double", "bigint")}
_REC_TYPES = {
    "type": "varchar", "direction": "varchar", "strength": "varchar", "confidence": "double", "signal_score": "double",
    "consistency": "double", "supporting_signals": "bigint", "time_window": "varchar", "latest_signal": "double",
    "signal_intensity": "double", "volatility": "double", "hashtag": "varchar", "momentum": "double",
    "signal_strength": "double", "average_confidence": "double", "risk_level": "varchar", "risk_score": "double",
    "risk_factors": "varchar", "overall_score": "double", "status": "varchar", "description": "varchar",
}


def _rec(source: str, seq: str, *columns: str, fixed_type: str | None = None) -> str:
    given = {c: c for c in columns}
    if fixed_type:
        given["type"] = f"'{fixed_type}'"
    cells = ", ".join(f"{given.get(c, _NO[t])} AS {c}" for c, t in _REC_TYPES.items())
    return f"SELECT ({seq})::INTEGER AS seq, {cells} FROM {source}"


_ALL_RECS = " UNION ALL ".join(
    [
        _rec("direction_out", "1", "type", "direction", "strength", "confidence", "signal_score", "consistency", "supporting_signals", "description"),
        _rec("times_out", "CASE time_window WHEN '15min' THEN 2 ELSE 3 END", "type", "time_window", "latest_signal", "signal_intensity",
             "supporting_signals", "consistency", "volatility", "description"),
        _rec("tag_out", "3 + row_number() OVER (ORDER BY momentum DESC, hashtag)", "type", "hashtag", "momentum", "signal_strength",
             "supporting_signals", "average_confidence", "description"),
        _rec("risk_out", "7", "risk_level", "risk_score", "risk_factors", "description", fixed_type="risk_assessment"),
        _rec("score_out", "8", "overall_score", fixed_type="overall_score"),
        _rec("status_out", "9", "status", fixed_type="status"),
    ]
)

# --- similarity ---------------------------------------------------------------------------

_STOP = quoted(DEFAULTS.stop_words)


def shingled(source: str, key: str, text: str, name: str, min_chars: int = 2) -> str:
    """CTEs from comparison texts to ``name`` (key, s, c)."""
    split = f"list_filter(string_split({text}, ' '), lambda t: length(t) >= {min_chars} AND t NOT IN ({_STOP}))"
    return f"""{name}_t AS (SELECT {key} AS k, {split} AS t FROM {source}),
{name}_s AS (SELECT k, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS s FROM {name}_t),
{name} AS (SELECT k, s, count(*)::DOUBLE AS c FROM {name}_s GROUP BY ALL)"""


def cosine(dot: str, sa: str, a: str, sb: str, b: str) -> str:
    k2 = f"({K} * {K})"
    return f"{dot} / (sqrt({sa} + ({a} - {sa}) * {k2}) * sqrt({sb} + ({b} - {sb}) * {k2}))"


def given_pairs(pairs: str) -> list[str]:
    """CTEs from ``pairs`` (a, b, ta, tb) to ``sims`` (a, b, similarity)."""
    return [
        shingled(f"{pairs}", "a", "ta", "sha"),
        shingled(f"{pairs}", "a", "tb", "shb"),
        f"""norms AS (SELECT k, sum(c * c) AS a2 FROM sha GROUP BY k), normb AS (SELECT k, sum(c * c) AS b2 FROM shb GROUP BY k),
shared AS (SELECT sha.k, sum(sha.c * shb.c) AS dot, sum(sha.c * sha.c) AS sa, sum(shb.c * shb.c) AS sb FROM sha JOIN shb USING (k, s) GROUP BY sha.k),
sims AS (SELECT p.a, p.b, coalesce({cosine('dot', 'sa', 'a2', 'sb', 'b2')}, 0) AS similarity
  FROM {pairs} p LEFT JOIN shared ON shared.k = p.a LEFT JOIN norms ON norms.k = p.a LEFT JOIN normb ON normb.k = p.a)""",
    ]


def every_near_pair(source: str, key: str, text: str, order: str, threshold: float) -> str:
    """Full self-join of all rows."""
    return with_(
        f"txt AS (SELECT {key} AS id, {compared(text)} AS t, row_number() OVER (ORDER BY {order}) AS pos FROM {source})",
        shingled("txt", "pos", "t", "sh"),
        "norm AS (SELECT k, sum(c * c) AS n2 FROM sh GROUP BY k)",
        f"""meet AS (SELECT x.k AS ka, y.k AS kb, sum(x.c * y.c) AS dot, sum(x.c * x.c) AS sa, sum(y.c * y.c) AS sb
  FROM sh x JOIN sh y ON x.s = y.s AND x.k < y.k GROUP BY 1, 2)""",
        f"""pairs AS (SELECT ka, kb, {cosine('dot', 'sa', 'na.n2', 'sb', 'nb.n2')} AS similarity
  FROM meet JOIN norm na ON na.k = ka JOIN norm nb ON nb.k = kb)""",
    ) + f"""SELECT x.id AS id_a, y.id AS id_b, {r('similarity')} AS similarity
FROM pairs JOIN txt x ON x.pos = ka JOIN txt y ON y.pos = kb WHERE similarity >= {threshold}::DOUBLE"""


def near_pairs(source: str, key: str, text: str, order: str, threshold: float) -> str:
    """Full self-join of the first rows of each text, and each text with its copies."""
    return with_(
        *([*BASE] if source == "posts" else []),
        f"txt AS (SELECT {key} AS id, {compared(text)} AS t, row_number() OVER (ORDER BY {order}) AS pos FROM {source})",
        "grp AS (SELECT *, first_value(id) OVER (PARTITION BY t ORDER BY pos) AS head FROM txt)",
        "heads AS (SELECT * FROM grp WHERE id = head)",
        shingled("heads", "id", "t", "sh"),
        "norm AS (SELECT k, sum(c * c) AS n2 FROM sh GROUP BY k)",
        f"""meet AS (SELECT x.k AS ka, y.k AS kb, sum(x.c * y.c) AS dot, sum(x.c * x.c) AS sa, sum(y.c * y.c) AS sb
  FROM sh x JOIN sh y ON x.s = y.s AND x.k < y.k GROUP BY 1, 2)""",
        f"""pairs AS (SELECT ka, kb, {cosine('dot', 'sa', 'na.n2', 'sb', 'nb.n2')} AS similarity
  FROM meet JOIN norm na ON na.k = ka JOIN norm nb ON nb.k = kb)""",
    ) + f"""SELECT CASE WHEN ha.pos < hb.pos THEN ka ELSE kb END AS id_a, CASE WHEN ha.pos < hb.pos THEN kb ELSE ka END AS id_b, {r('similarity')} AS similarity
FROM pairs JOIN heads ha ON ha.id = ka JOIN heads hb ON hb.id = kb WHERE similarity >= {threshold}::DOUBLE
UNION ALL SELECT head, id, 1.0::DOUBLE FROM grp WHERE id <> head AND head IN (SELECT k FROM norm)"""


# --- keep-first, one row after the other ----------------------------------------------------------


def similar_texts(source: str, p: str) -> list[str]:
    """CTEs to ``{p}sim`` (ta, tb, similarity) of the distinct texts ``t`` of ``source``."""
    return [
        f"{p}txt AS (SELECT DISTINCT t FROM {source})",
        shingled(f"{p}txt", "t", "t", f"{p}sh"),
        f"{p}norm AS (SELECT k, sum(c * c) AS n2 FROM {p}sh GROUP BY k)",
        f"""{p}meet AS (SELECT x.k AS ka, y.k AS kb, sum(x.c * y.c) AS dot, sum(x.c * x.c) AS sa, sum(y.c * y.c) AS sb
  FROM {p}sh x JOIN {p}sh y ON x.s = y.s GROUP BY 1, 2)""",
        f"""{p}sim AS MATERIALIZED (SELECT ka AS ta, kb AS tb, {cosine('dot', 'sa', 'na.n2', 'sb', 'nb.n2')} AS similarity
  FROM {p}meet JOIN {p}norm na ON na.k = ka JOIN {p}norm nb ON nb.k = kb)""",
    ]


def keep_first(rows: str, near: str, name: str) -> list[str]:
    """CTEs from ``rows`` (i = 1, 2, .., ...) and ``near`` (later, earlier) to the kept rows ``name``.

    ``low`` is the earliest row that this row or a later one still asks for.
    """
    return [
        f"""{name}_n AS MATERIALIZED (SELECT o.i, coalesce(list(n.earlier) FILTER (n.earlier IS NOT NULL), []::BIGINT[]) AS near,
  min(coalesce(min(n.earlier), o.i)) OVER (ORDER BY o.i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS low
  FROM {rows} o LEFT JOIN {near} n ON n.later = o.i GROUP BY o.i)""",
        f"""{name}_g AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept, false AS keep UNION ALL
  SELECT n.i, CASE WHEN list_has_any(g.kept, n.near) THEN list_filter(g.kept, lambda x: x >= n.low)
    ELSE list_append(list_filter(g.kept, lambda x: x >= n.low), n.i) END, NOT list_has_any(g.kept, n.near)
  FROM {name}_g g JOIN {name}_n n ON n.i = g.i + 1)""",
        f"{name} AS (SELECT o.* FROM {rows} o JOIN {name}_g g ON g.i = o.i WHERE g.keep)",
    ]


def kept_in_time(source: str, name: str) -> list[str]:
    """Rows without a kept similar row in the five minutes before."""
    p = f"{name}_"
    return [
        f"{p}o AS MATERIALIZED (SELECT id, post_ts, content, {compared('content')} AS t, row_number() OVER (ORDER BY post_ts, id) AS i FROM {source})",
        *similar_texts(f"{p}o", p),
        f"""{p}near AS MATERIALIZED (SELECT b.i AS later, a.i AS earlier FROM {p}o a JOIN {p}o b ON a.i < b.i AND b.post_ts - a.post_ts <= INTERVAL 5 MINUTES
  JOIN {p}sim s ON s.ta = a.t AND s.tb = b.t AND s.similarity > 0.8::DOUBLE)""",
        *keep_first(f"{p}o", f"{p}near", name),
    ]


def kept_by_text(source: str, name: str) -> list[str]:
    """Rows without a kept similar row before. (All reposts of the view have one text, so the rule
    for reposts adds no pair.)"""
    p = f"{name}_"
    return [
        f"{p}o AS MATERIALIZED (SELECT id, post_ts, content, {compared('content')} AS t, row_number() OVER (ORDER BY post_ts, id) AS i FROM {source})",
        *similar_texts(f"{p}o", p),
        f"""{p}h AS (SELECT *, row_number() OVER (ORDER BY i) AS j FROM (SELECT * FROM {p}o WHERE t IN (SELECT k FROM {p}norm) QUALIFY row_number() OVER (PARTITION BY t ORDER BY i) = 1))""",
        f"{p}u AS (SELECT id, post_ts, content, t, j AS i FROM {p}h)",
        f"{p}near AS MATERIALIZED (SELECT b.i AS later, a.i AS earlier FROM {p}sim s JOIN {p}u a ON a.t = s.ta JOIN {p}u b ON b.t = s.tb WHERE a.i < b.i AND s.similarity > 0.85::DOUBLE)",
        *keep_first(f"{p}u", f"{p}near", f"{p}kept"),
        f"{name} AS (SELECT id, post_ts, content FROM {p}kept UNION ALL SELECT id, post_ts, content FROM {p}o WHERE t NOT IN (SELECT k FROM {p}norm))",
    ]


def recursive(*ctes: str) -> str:
    return with_(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def pipeline() -> list[str]:
    exact = f"ex AS (SELECT id, post_ts, content FROM posts {_FIRST.format(key=compared('content'))})"
    return [*BASE, exact, *kept_in_time("ex", "timed"), *kept_by_text("timed", "final")]


# --- TF-IDF -----------------------------------------------------------------------------------


def vocabulary(source: str, key: str, text: str, min_chars: int) -> list[str]:
    words = f"array_to_string(string_split_regex(lower({text}), '[^{WORD}]+'), ' ')"
    return [
        shingled(source, key, words, "sh", min_chars),
        "voc AS (SELECT s, count(*) AS df FROM sh GROUP BY s)",
    ]


# --- registry -----------------------------------------------------------------------------------

_FIRST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY post_ts, id) = 1"
_NEXT_DOC = f"""pr AS (SELECT a.doc_id AS a, b.doc_id AS b, {compared('a.text')} AS ta, {compared('b.text')} AS tb
  FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"""
_RT = rf"(?i)^RT @[{WORD}]+:|RT:|Retweet:|🔄"
_RT_CUT = rf"(?i)^RT @[{WORD}]+:[{SPACE}]*"


def _cut(side: str) -> str:
    return compared(f"regexp_replace({side}.content, '{_RT_CUT}', '')")


_NEXT_POST = f"""pr AS (SELECT a.n AS a, b.n AS b, {_cut('a')} AS ta, {_cut('b')} AS tb,
  regexp_matches(a.content, '{_RT}') AND regexp_matches(b.content, '{_RT}') AS rt
  FROM (SELECT *, id[2:]::BIGINT AS n FROM posts) a JOIN (SELECT *, id[2:]::BIGINT AS n FROM posts) b ON b.n = a.n + 1)"""
_RAW_TAGS = "[" + ", ".join(q._RAW_TAGS) + "]"
_TAG_LIST = ", ".join(f"'{t}'" for t in const.COLLECTED_HASHTAGS)
_TOKEN_SCORE = "CASE t " + " ".join(f"WHEN '{w}' THEN {{}}" for w, _, _ in q.LEXICON_TABLE) + " END"
_TABLE_POL = _TOKEN_SCORE.format(*[p for _, p, _ in q.LEXICON_TABLE])
_TABLE_SUB = _TOKEN_SCORE.format(*[s for _, _, s in q.LEXICON_TABLE])


def _digest(expr: str) -> str:
    return f"SELECT doc_id, md5({expr}) AS digest, length({expr}) AS chars FROM documents"


def _list_mean(case: str) -> str:
    return f"CASE WHEN len({found(case)}) > 0 THEN list_sum({found(case)}) / len({found(case)}) ELSE 0 END"


def _dates(source: str, columns: str, where: str = "true") -> str:
    return with_(*BASE) + f"SELECT {columns}, year(post_ts) AS year, month(post_ts) AS month, day(post_ts) AS day FROM {source} WHERE {where}"


def oracle_sql() -> dict[str, str]:
    base, clean, feats, sigs = with_(*BASE), with_(*CLEAN), with_(*FEATURES), with_(*SIGNALS)
    raw_signals = with_(*BASE, featured("posts"), SIGNALLED)

    def f(*columns: str) -> str:
        return feats + "SELECT id, " + ", ".join(f"{r(c)} AS {c}" for c in columns) + " FROM features"

    by_window = with_(*SIGNALS, W15, W60)
    rolled = f"({_WINDOW_OUT.join(['SELECT ', ' FROM w15'])} UNION ALL {_WINDOW_OUT.join(['SELECT ', ' FROM w60'])})"
    roll = f"""roll AS (SELECT event_id, user_id, ts, count(*) OVER w100 AS samples,
  {r("avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) OVER w100", 10)} AS ok, {r('avg(value / 20) OVER w50', 10)} AS took FROM events
  WINDOW w100 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 99 PRECEDING), w50 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 49 PRECEDING))"""
    advice = """CASE WHEN samples >= 10 AND ok > 0.9::DOUBLE AND took < 2.0 THEN 'raise'
  WHEN samples >= 10 AND (ok < 0.7::DOUBLE OR took > 5.0) THEN 'lower' ELSE 'hold' END"""
    hist = f"""SELECT b AS bin, {r('lo + b * (hi - lo) / 30')} AS bin_start, {r('lo + (b + 1) * (hi - lo) / 30')} AS bin_end,
  count(v) AS frequency, {r('any_value(mean)')} AS mean FROM (SELECT unnest(range(30)) AS b) bins
  CROSS JOIN (SELECT min(signal_strength) AS lo, max(signal_strength) AS hi, avg(signal_strength) AS mean FROM signals) m
  LEFT JOIN (SELECT signal_strength AS v FROM signals) x ON least(29, floor((v - lo) / (hi - lo) * 30)) = b GROUP BY b, lo, hi"""
    stats = sigs + f"""SELECT n, {r('m1')} AS replies_count_log_mean, {r('s1')} AS replies_count_log_std, {r('m2')} AS retweets_count_log_mean,
  {r('s2')} AS retweets_count_log_std, {r('m3')} AS likes_count_log_mean, {r('s3')} AS likes_count_log_std, {r('top')} AS engagement_max,
  {r('cm')} AS composite_mean, {r('csd')} AS composite_std FROM st, cs"""
    return {
        # sources and sinks
        "scan_posts": base + "SELECT id, username, post_ts, content, views_count, array_to_string(hashtags, ' ') AS hashtags FROM posts",
        "filter_date_range": _dates("posts", "id, post_ts", "post_ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'"),
        "filter_hashtags": base + "SELECT id, array_to_string(hashtags, ' ') AS hashtags FROM posts WHERE list_has_any(hashtags, ['#nifty50', '#finnifty'])",
        "write_posts_partitioned": _dates("posts", "id, content, likes_count"),
        "write_single": sigs + f"""SELECT count(*) AS total_signals, count(*) FILTER (high_confidence) AS high_confidence_signals,
  {r('avg(signal_strength)')} AS average_signal_strength, {r('avg(signal_confidence)')} AS average_confidence FROM signals""",
        "save_posts": _dates("posts", f"id, {REF} AS collected_at, '1.0' AS data_version"),
        "save_processed": feats + f"SELECT id, {r('urgency_score')} AS urgency_score, 'nightly' AS meta_run, 3 AS meta_version FROM features",
        "save_output_json": sigs + f"SELECT signal_category, count(*) AS frequency, {r('count(*) / sum(count(*)) OVER ()')} AS share FROM signals GROUP BY 1",
        "partition_profile": "SELECT year(ts) AS year, month(ts) AS month, day(ts) AS day, count(*) AS rows FROM events GROUP BY ALL",
        "retention_filter": base + f"SELECT id, post_ts FROM posts WHERE post_ts >= {REF} - INTERVAL 7 DAYS",
        "expired_partitions": f"SELECT DISTINCT year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events WHERE ts::DATE < ({REF} - INTERVAL 7 DAYS)::DATE",
        "coerce_storage_types": "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS created_at FROM events",
        "collect_union": base + f"SELECT id, content, tag FROM posts, (SELECT unnest([{_TAG_LIST}]) AS tag) WHERE list_contains(hashtags, tag)",
        "search_by_hashtag": base + f"""SELECT id, post_ts, content FROM posts WHERE list_contains(hashtags, '#sensex')
  AND post_ts BETWEEN {REF} - INTERVAL 72 HOURS AND {REF} ORDER BY post_ts DESC, id LIMIT 100""",
        "per_source_quota": base + f"""SELECT id, post_ts, tag AS source_tag FROM posts, (SELECT unnest([{_TAG_LIST}]) AS tag) WHERE list_contains(hashtags, tag)
  QUALIFY row_number() OVER (PARTITION BY tag ORDER BY post_ts DESC, id) <= 100""",
        "per_role_quota": """SELECT conv_id, turn, role, md5(text) AS digest FROM conversations WHERE role IN ('user', 'assistant')
  QUALIFY row_number() OVER (PARTITION BY role ORDER BY conv_id DESC, turn) <= 50""",
        # cleaning
        "clean_posts": clean + """SELECT id, username, display_name, post_ts, content, replies_count, retweets_count, likes_count, views_count,
  array_to_string(hashtags, ' ') AS hashtags, array_to_string(mentions, ' ') AS mentions, url, is_retweet, language, cleaned_at, original_length, cleaned_length FROM clean""",
        "cleaning_stats": clean + f"""SELECT count(*) AS original_count, count(*) FILTER (cleaned_length >= 10) AS cleaned_count,
  count(*) FILTER (cleaned_length < 10) AS removed_count,
  {r('avg((original_length - cleaned_length) / original_length::DOUBLE) FILTER (cleaned_length >= 10)')} AS avg_length_reduction,
  {r('count(*) FILTER (cleaned_length >= 10) / count(*)::DOUBLE')} AS success_rate FROM cleaned""",
        "normalize_unicode": base + "SELECT id, replace(content, '&amp;', '&') AS content FROM posts",
        "collapse_whitespace": _digest(f"trim({one_space('text')})"),
        "remove_urls": base + f"SELECT id, {no_urls('content')} AS content FROM posts",
        "remove_mentions": base + f"SELECT id, {sub('content', f'@[{WORD}]+')} AS content FROM posts",
        "remove_hashtags": base + f"SELECT id, {sub('content', f'#[{WORD}]+')} AS content FROM posts",
        "collapse_punctuation": _digest(no_runs("text")),
        "strip_special_chars": _digest(no_specials("text")),
        "standardize_terms": base + f"SELECT id, {standard('content')} AS content FROM posts",
        "min_length_filter": base + "SELECT id, content FROM posts WHERE length(trim(content)) >= 60",
        "clean_username": base + "SELECT id, lower(username) || 'é' AS username FROM posts",
        "normalize_hashtags": f"""SELECT event_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(list_transform({_RAW_TAGS},
  lambda t: lower(trim(replace(t, '#', '')))), lambda t: length(t) > 1), lambda t: '#' || t))), ' ') AS tags FROM events""",
        "normalize_mentions": f"""SELECT event_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(list_transform({_RAW_TAGS},
  lambda t: {user('t')}), lambda t: t <> ''), lambda t: '@' || t))), ' ') AS names FROM events""",
        "validate_engagement": "SELECT event_id, CASE WHEN event_id % 5 = 3 THEN user_id ELSE 0 END AS likes_count FROM events",
        "parse_timestamp": f"""SELECT event_id, CASE event_id % 7 WHEN 2 THEN ts WHEN 3 THEN date_trunc('day', ts) WHEN 6 THEN {REF}
  ELSE date_trunc('second', ts) END AS parsed FROM events""",
        "parse_relative_timestamp": f"""SELECT event_id, {REF} - CASE event_id % 5 WHEN 0 THEN to_seconds(user_id) WHEN 1 THEN to_minutes(user_id)
  WHEN 2 THEN to_hours(user_id) WHEN 3 THEN to_hours(24 * user_id) ELSE to_seconds(0) END AS parsed FROM events""",
        "default_fields": base + """SELECT id, lower(username) AS display_name, '' AS url, is_retweet,
  CASE WHEN is_retweet THEN 'hi' ELSE 'en' END AS language FROM posts""",
        "extract_hashtags": base + "SELECT id, array_to_string(hashtags, ' ') AS hashtags FROM posts",
        "extract_mentions": base + "SELECT id, array_to_string(mentions, ' ') AS mentions FROM posts",
        "extract_market_entities": clean + r"""SELECT id,
  array_to_string(regexp_extract_all(content, '\b(?:NIFTY|SENSEX|BANKNIFTY|FINNIFTY|RELIANCE|TCS|INFY|HDFC|ICICI)\b'), '|') AS symbols,
  array_to_string(regexp_extract_all(content, '₹?[0-9]+(?:[.,][0-9]+)*(?: *(?:cr|crore|lakh|k|million|billion))?'), '|') AS prices,
  array_to_string(regexp_extract_all(content, '[+-]?[0-9]+(?:\.[0-9]+)?%'), '|') AS percentages,
  array_to_string(regexp_extract_all(content, '9:15|9\.15|15:30|15\.30|pre-market|post-market|opening|closing'), '|') AS timings FROM clean""",
        "high_confidence_filter": sigs + f"SELECT id, {r('signal_confidence')} AS signal_confidence FROM good",
        # deduplication
        "comparison_text": _digest(compared("text")),
        "content_hash": base + f"SELECT id, md5({compared('content')}) AS content_hash FROM posts",
        "user_content_hash": base + f"SELECT id, md5(lower(username) || ':' || {compared('content')}) AS user_content_hash FROM posts",
        "dedup_exact": base + "SELECT id, post_ts, content FROM posts " + _FIRST.format(key=compared("content")),
        "dedup_exact_documents": f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {compared('text')}",
        "dedup_user_content": base + "SELECT id, username, content FROM posts " + _FIRST.format(key=f"lower(username), {compared('content')}"),
        "dedup_collect": base + "SELECT id, content FROM posts " + _FIRST.format(key=f"trim({one_space('lower(content)')})"),
        "pair_similarity": with_(_NEXT_DOC, *given_pairs("pr")) + f"SELECT a AS id_a, b AS id_b, {r('similarity')} AS similarity FROM sims",
        "is_repost_pair": with_(*BASE, _NEXT_POST, *given_pairs("pr")) + "SELECT pr.a AS id_a, pr.b AS id_b, rt AND similarity > 0.9 AS is_repost_pair FROM pr JOIN sims USING (a, b)",
        "near_duplicate_pairs": every_near_pair("documents", "doc_id", "text", "doc_id", 0.8),
        "near_duplicates_between": with_(
            f"pr AS (SELECT 'a' || item_id AS k, item_id AS id, {compared('text')} AS t FROM benchmark UNION ALL SELECT 'b' || doc_id, doc_id, {compared('text')} FROM documents)",
            shingled("pr", "k", "t", "sh"), "norm AS (SELECT k, sum(c * c) AS n2 FROM sh GROUP BY k)",
            """meet AS (SELECT x.k AS ka, y.k AS kb, sum(x.c * y.c) AS dot, sum(x.c * x.c) AS sa, sum(y.c * y.c) AS sb
  FROM sh x JOIN sh y ON x.s = y.s WHERE x.k[1] = 'a' AND y.k[1] = 'b' GROUP BY 1, 2)""",
            f"pairs AS (SELECT ka, kb, {cosine('dot', 'sa', 'na.n2', 'sb', 'nb.n2')} AS similarity FROM meet JOIN norm na ON na.k = ka JOIN norm nb ON nb.k = kb)",
        ) + f"SELECT a.id AS id_a, b.id AS id_b, {r('similarity')} AS similarity FROM pairs JOIN pr a ON a.k = ka JOIN pr b ON b.k = kb WHERE similarity >= 0.3::DOUBLE",
        "near_duplicate_posts": near_pairs("posts", "id", "content", "post_ts, id", 0.8),
        "dedup_similarity": recursive(*BASE, *kept_by_text("posts", "final")) + "SELECT id, post_ts, content FROM final",
        "dedup_temporal": recursive(*BASE, *kept_in_time("posts", "timed")) + "SELECT id, post_ts, content FROM timed",
        "dedup_pipeline": recursive(*pipeline()) + "SELECT id, post_ts, content FROM final",
        "dedup_pipeline_stats": recursive(*pipeline(), """c AS (SELECT (SELECT count(*) FROM posts) AS a, (SELECT count(*) FROM ex) AS b,
  (SELECT count(*) FROM timed) AS c, (SELECT count(*) FROM final) AS d), rws AS (SELECT 'exact_content' AS stage, a AS n, b AS k FROM c
  UNION ALL SELECT 'user_content', b, b FROM c UNION ALL SELECT 'temporal_clustering', b, c FROM c UNION ALL SELECT 'similarity', c, d FROM c
  UNION ALL SELECT 'summary', a, d FROM c)""") + f"""SELECT stage, n AS original_count, k AS unique_count, n - k AS duplicates_removed,
  {r('(n - k) / n::DOUBLE')} AS deduplication_rate FROM rws""",
        "dedup_stats": with_(*BASE, f"u AS (SELECT count(*) AS n, count(DISTINCT {compared('content')}) AS k FROM posts)",
          f"""d AS (SELECT lower(username) AS un, {compared('content')} AS t FROM posts {_FIRST.format(key=compared('content'))}),
d2 AS (SELECT count(*) AS n, count(DISTINCT (un, t)) AS k FROM d), rws AS (SELECT 'exact_content' AS stage, n, k FROM u UNION ALL SELECT 'user_content', n, k FROM d2
  UNION ALL SELECT 'summary', u.n, d2.k FROM u, d2)""") + f"""SELECT stage, n AS original_count, k AS unique_count, n - k AS duplicates_removed,
  {r('(n - k) / n::DOUBLE')} AS deduplication_rate FROM rws""",
        # features
        "market_sentiment": f("market_sentiment"),
        "action_sentiment": f("action_sentiment"),
        "price_sentiment": f("price_sentiment"),
        "basic_sentiment": f("basic_sentiment", "sentiment_confidence"),
        "basic_sentiment_from_table": feats + f"SELECT id, {r(_list_mean(_TABLE_POL))} AS basic_sentiment, {r(_list_mean(_TABLE_SUB))} AS sentiment_confidence FROM features",
        "sentiment_score": f("sentiment_score"),
        "text_stats": feats + "SELECT id, content_length, word_count, hashtag_count, mention_count FROM features",
        "text_stats_documents": f"SELECT doc_id, length(text) AS content_length, len(regexp_extract_all(text, '[^{SPACE}]+')) AS word_count, 0 AS hashtag_count FROM documents",
        "has_price_mention": feats + "SELECT id, has_price_mention FROM features",
        "has_target_hashtag": feats + "SELECT id, has_target_hashtag FROM features",
        "urgency_score": with_(*BASE, featured("posts")) + f"SELECT id, {r('urgency_score')} AS urgency_score FROM features",
        "engagement_log": with_(*BASE, featured("posts")) + "SELECT id, " + ", ".join(
            f"{r(f'{c}_count_log')} AS {c}_count_log" for c in ("replies", "retweets", "likes", "views")) + " FROM features",
        "time_features": with_(*BASE, featured("posts")) + "SELECT id, hour, day_of_week, is_market_hours FROM features",
        "extract_features": feats + "SELECT id, " + ", ".join(
            f"{r(c)} AS {c}" if c.endswith(("_score", "_sentiment", "_log", "_confidence")) else c for c in q.FEATURE_COLUMNS) + " FROM features",
        "tfidf_vectors": with_(*CLEAN, "tagged AS (SELECT id, content || ' ' || array_to_string(hashtags, ' ') AS txt FROM clean)",
          *vocabulary("tagged", "id", "txt", 1), """wt AS (SELECT k, sh.s, c * (ln((1 + (SELECT count(*) FROM tagged)) / (1 + df)::DOUBLE) + 1) AS w FROM sh JOIN voc ON voc.s = sh.s)""")
          + f"SELECT k AS id, s AS term, {r('w / sqrt(sum(w * w) OVER (PARTITION BY k))')} AS weight FROM wt",
        "count_vectors": with_(*vocabulary("documents", "doc_id", "text", 2)) + "SELECT k AS doc_id, sh.s AS term, c::BIGINT AS count FROM sh JOIN voc ON voc.s = sh.s",
        # signals
        "batch_stats": stats,
        "stream_stats": stats,
        "volume_signal": sigs + f"SELECT id, {r('volume_signal')} AS volume_signal FROM signals",
        "composite_signal": sigs + f"SELECT id, {r('composite_signal')} AS composite_signal FROM signals",
        "signal_strength": sigs + f"SELECT id, {r('signal_strength')} AS signal_strength FROM signals",
        "signal_confidence": sigs + f"SELECT id, {r('signal_confidence')} AS signal_confidence FROM signals",
        "signal_category": sigs + "SELECT id, signal_category FROM signals",
        "generate_signals": sigs + f"SELECT id, {_SIGNAL_OUT} FROM signals",
        "posts_to_signals": raw_signals + f"SELECT id, {r('sentiment_score')} AS sentiment_score, {_SIGNAL_OUT} FROM signals",
        # aggregation
        "aggregate_by_time": with_(*SIGNALS, W15) + f"SELECT {_WINDOW_OUT} FROM w15",
        "signal_intensity": with_(*SIGNALS, windowed("w30", "30 minutes", "30min")) + f"SELECT time_window, {r('signal_intensity')} AS signal_intensity FROM w30",
        "direction_consistency": with_(*SIGNALS, W60) + f"SELECT time_window, {r('direction_consistency')} AS direction_consistency FROM w60",
        "signal_volatility": with_(*SIGNALS, windowed("w240", "4 hours", "4hour")) + f"SELECT time_window, {r('signal_volatility')} AS signal_volatility FROM w240",
        "multi_window_rollup": by_window + f"SELECT * FROM {rolled}",
        "explode_hashtags": base + "SELECT id, unnest(hashtags) AS hashtag FROM posts",
        "aggregate_by_hashtag": with_(*SIGNALS, TAGS) + f"""SELECT hashtag, signal_strength_mean, signal_strength_std, signal_strength_count, signal_confidence_mean,
  sentiment_score_mean, replies_count_sum, retweets_count_sum, likes_count_sum, urgency_score_mean, {r('hashtag_momentum')} AS hashtag_momentum FROM tags""",
        "hashtag_momentum": with_(*CLEAN, f"uniq AS (SELECT * FROM clean {_FIRST.format(key=compared('content'))})", featured("uniq"), SIGNALLED, TAGS)
          + f"SELECT hashtag, signal_strength_count, {r('hashtag_momentum')} AS hashtag_momentum FROM tags",
        "having_min_support": sigs + "SELECT username, count(*) AS signal_strength_count FROM signals GROUP BY 1 HAVING count(*) >= 3",
        "signal_summary": sigs + f"""SELECT count(*) AS total_signals, count(*) FILTER (high_confidence) AS high_confidence_signals,
  {r('avg(signal_strength)')} AS average_signal_strength, {r('avg(signal_confidence)')} AS average_confidence FROM signals""",
        "analysis_period": sigs + f"""SELECT min(signal_timestamp) AS start_time, max(signal_timestamp) AS end_time,
  {r("(epoch_us(max(signal_timestamp)) - epoch_us(min(signal_timestamp))) / 3600000000.0::DOUBLE")} AS duration_hours FROM signals""",
        "sentiment_consistency": sigs + f"""SELECT count(*) FILTER (signal_strength > 0) AS positive, count(*) FILTER (signal_strength < 0) AS negative, count(*) AS total,
  {r('greatest(count(*) FILTER (signal_strength > 0), count(*) FILTER (signal_strength < 0)) / count(*)::DOUBLE')} AS consistency FROM good""",
        "distinct_ratio": with_(*BASE, *[f"x{i} AS (SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS k, count(*) AS n FROM posts)"
          for i, c in enumerate(("username", "content", "likes_count", "language"))]) + " UNION ALL ".join(
          f"SELECT \"column\", k AS distinct_values, n AS rows, {r('k / n::DOUBLE')} AS ratio FROM x{i}" for i in range(4)),
        # recommendations
        "market_direction": with_(*RECS) + "SELECT * FROM direction_out",
        "time_recommendation": with_(*RECS) + "SELECT * FROM times_out",
        "hashtag_recommendation": with_(*RECS) + "SELECT * FROM tag_out",
        "assess_risk": with_(*RECS) + "SELECT * FROM risk_out",
        "overall_score": with_(*RECS) + "SELECT * FROM score_out",
        "recommendation_status": with_(*RECS) + "SELECT * FROM status_out",
        "recommendations": with_(*RECS) + _ALL_RECS,
        "analysis_summary": with_(*RECS) + f"""SELECT 'summary' AS section, unnest(['total_signals', 'high_confidence_signals', 'average_signal_strength', 'average_confidence']) AS metric,
  unnest([count(*)::VARCHAR, (count(*) FILTER (high_confidence))::VARCHAR, printf('%.3f', {r('avg(signal_strength)', 3)}), printf('%.3f', {r('avg(signal_confidence)', 3)})]) AS value FROM signals
  UNION ALL SELECT 'direction', unnest(['description', 'confidence']), unnest([description, printf('%.3f', confidence)]) FROM direction_out
  UNION ALL SELECT 'risk', unnest(['level', 'score', 'factors']), unnest([upper(risk_level), printf('%.3f', risk_score), risk_factors]) FROM risk_out
  UNION ALL SELECT 'score', 'overall_score', printf('%.3f', overall_score) FROM score_out""",
        # charts
        "sort_by_time": base + "SELECT id, post_ts FROM posts ORDER BY post_ts, id",
        "timeline_downsample": sigs + f"""SELECT time_bucket(INTERVAL '5 minutes', signal_timestamp) AS signal_timestamp, {r('avg(signal_strength)')} AS signal_strength,
  {r('avg(signal_confidence)')} AS signal_confidence, {r('avg(sentiment_score)')} AS sentiment_score FROM signals GROUP BY 1""",
        "trend_line": sigs + f"""SELECT count(*) AS points, {r('regr_slope(signal_strength, x) * 1e6')} AS slope_per_million, {r('regr_intercept(signal_strength, x)')} AS intercept
  FROM (SELECT signal_strength, (row_number() OVER (ORDER BY signal_timestamp, id) - 1)::DOUBLE AS x FROM signals)""",
        "histogram": sigs + hist,
        "category_counts": sigs + f"SELECT signal_category, count(*) AS frequency, {r('count(*) / sum(count(*)) OVER ()')} AS share FROM signals GROUP BY 1",
        "confidence_scatter_sample": sigs + f"""SELECT id, {r('signal_confidence')} AS signal_confidence, {r('signal_strength')} AS signal_strength,
  {r('sentiment_score')} AS sentiment_score, signal_category FROM signals QUALIFY row_number() OVER (PARTITION BY signal_category ORDER BY md5(id), id) <= 100""",
        "scan_posts_tolerant": """SELECT year(ts) AS year, month(ts) AS month, day(ts) AS day, count(*) AS rows,
  CASE WHEN day(ts) = 7 THEN 1 ELSE 0 END AS skipped FROM events GROUP BY ALL""",
        "confidence_scatter": sigs + f"SELECT id, {r('signal_confidence')} AS signal_confidence, {r('signal_strength')} AS signal_strength, {r('sentiment_score')} AS sentiment_score FROM signals",
        "top_hashtags": with_(*SIGNALS, TAGS) + f"""SELECT hashtag, {r('hashtag_momentum')} AS hashtag_momentum, signal_strength_count, signal_strength_mean,
  CASE WHEN tags.hashtag_momentum > 0 THEN '#2E8B57' ELSE '#DC143C' END AS colour, {r('abs(tags.hashtag_momentum) * 100')} AS bubble_size
  FROM tags ORDER BY tags.hashtag_momentum DESC, hashtag LIMIT 10""",
        "window_trend_series": by_window + "SELECT window_size, time_window, signal_strength_mean, signal_confidence_mean FROM w15 UNION ALL SELECT window_size, time_window, signal_strength_mean, signal_confidence_mean FROM w60",
        "recommendation_type_counts": with_(*RECS) + f"SELECT type, count(*) AS frequency FROM ({_ALL_RECS}) WHERE seq <= 6 GROUP BY 1",
        "limit_rows": base + "SELECT id, post_ts FROM posts ORDER BY post_ts, id LIMIT 50",
        # rolling
        "trailing_request_count": """SELECT event_id, event_type, c AS trailing_requests, c - 1 >= 5 AS over_limit FROM (SELECT event_id, event_type,
  count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW) AS c FROM events)""",
        "rolling_success_rate": with_(roll) + f"SELECT user_id, event_id, samples, {r('ok')} AS success_rate, {r('took')} AS mean_response FROM roll",
        "throttle_advice": with_(roll) + f"""SELECT event_id, samples, {advice} AS advice,
  (CASE ({advice}) WHEN 'raise' THEN 65 WHEN 'lower' THEN 55 ELSE 60 END)::INTEGER AS advised_rate FROM roll""",
        # streaming
        "stream_time_agg": with_(*SIGNALS, W15) + f"SELECT {_WINDOW_OUT} FROM w15",
        "stream_dedup": with_(*BASE, f"h AS (SELECT id, post_ts, md5({compared('content')}) AS content_hash FROM posts)",
          "g AS (SELECT *, CASE WHEN post_ts - lag(post_ts) OVER w <= INTERVAL 10 MINUTES THEN 0 ELSE 1 END AS new FROM h WINDOW w AS (PARTITION BY content_hash ORDER BY post_ts, id))",
          "n AS (SELECT *, sum(new) OVER (PARTITION BY content_hash ORDER BY post_ts, id) AS run FROM g)") + """SELECT arg_min(id, (post_ts, id)) AS id,
  min(post_ts) AS post_ts, content_hash, count(*) AS copies FROM n GROUP BY content_hash, run""",
        "latest_points": sigs + f"""SELECT id, signal_timestamp, {r('signal_strength')} AS signal_strength, {r('sentiment_score')} AS sentiment_score,
  retweets_count + likes_count AS volume FROM signals ORDER BY signals.signal_timestamp DESC, id LIMIT 1000""",
        "stream_latest_points": sigs + f"""SELECT id, signal_timestamp, {r('signal_strength')} AS signal_strength, {r('sentiment_score')} AS sentiment_score,
  retweets_count + likes_count AS volume FROM signals ORDER BY signals.signal_timestamp DESC, id LIMIT 1000""",
        "stream_signals": sigs + f"SELECT id, {_SIGNAL_OUT} FROM signals",
        "stream_feed": base + "SELECT id, post_ts, content FROM posts",
    }
