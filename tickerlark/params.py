"""Settings with their effective defaults, in one immutable value."""

from __future__ import annotations

from dataclasses import dataclass, field

from tickerlark import constants as const


@dataclass(frozen=True)
class Params:
    # text cleaning
    min_content_length: int = 10
    remove_urls: bool = True
    remove_mentions: bool = False
    remove_hashtags: bool = False
    keep_marks: bool = True
    # deduplication
    similarity_threshold: float = 0.85
    repost_threshold: float = 0.9
    temporal_threshold: float = 0.8
    temporal_window_minutes: int = 5
    review_threshold: float = 0.8
    stop_words: tuple[str, ...] = field(default=tuple(const.ENGLISH_STOP_WORDS))
    # signals
    sentiment_weight: float = 0.4
    volume_weight: float = 0.3
    urgency_weight: float = 0.3
    min_confidence: float = 0.6
    min_support: int = 3
    target_hashtags: tuple[str, ...] = field(default=tuple(const.TARGET_HASHTAGS))
    # vectors and charts
    max_features: int | None = None  # of a vocabulary; None keeps all terms
    max_points: int = 1_000


DEFAULTS = Params()
