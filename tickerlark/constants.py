"""Fixed values. Results depend on them, so they are stated as plain text."""

# --- fixed values: market lexicon ------------------------------------------
BULLISH_STRONG = [
    "buy", "bull", "bullish", "long", "rise", "up", "gain", "profit", "green", "rocket", "moon",
    "surge", "breakout", "rally"
]
BULLISH_MODERATE = [
    "positive", "good", "better", "growth", "increase", "support", "strong", "confident",
    "optimistic"
]
BULLISH_HINDI = [
    "तेजी", "बुल", "खरीद", "फायदा", "बढ़ोतरी"
]
BEARISH_STRONG = [
    "sell", "bear", "bearish", "short", "fall", "down", "loss", "red", "crash", "dump", "drop",
    "breakdown"
]
BEARISH_MODERATE = [
    "negative", "bad", "worse", "decline", "decrease", "resistance", "weak", "worried",
    "pessimistic"
]
BEARISH_HINDI = [
    "मंदी", "बेयर", "बेच", "नुकसान", "गिरावट"
]
STRONG_WEIGHT = 2.0
OTHER_WEIGHT = 1.0

# --- fixed values: trading actions and their weights -----------------------
ACTION_WEIGHTS = {
    "buy": 2.0, "sell": -2.0, "hold": 0.0,
    "long": 1.5, "short": -1.5,
    "call": 1.0, "put": -1.0,
    "bullish": 1.8, "bearish": -1.8,
    "breakout": 2.5, "breakdown": -2.5,
}

# --- fixed values: urgency markers and their scores ------------------------
URGENCY_SCORES = {
    "urgent": 3.0, "breaking": 3.0, "alert": 2.5, "now": 2.0, "immediate": 2.5,
    "quickly": 2.0, "asap": 3.0, "!!!": 2.0, "emergency": 3.0,
}

# --- fixed values: hashtags ------------------------------------------------
COLLECTED_HASHTAGS = ["#nifty50", "#sensex", "#intraday", "#banknifty"]
TARGET_HASHTAGS = ["#nifty50", "#sensex", "#banknifty", "#finnifty", "#intraday"]

# --- fixed values: window sizes --------------------------------------------
WINDOW_SIZES = {
    "5min": "5 minutes", "15min": "15 minutes", "30min": "30 minutes",
    "1hour": "1 hour", "4hour": "4 hours",
}

# --- fixed values: chart colours -------------------------------------------
BULLISH_COLOUR = "#2E8B57"
BEARISH_COLOUR = "#DC143C"

# --- fixed values: the English stop words of StopWordsRemover ---------------
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would"
]

# --- fixed values: sentences of recommendations ----------------------------
DIRECTION_SENTENCE = "%s %s signal with %.1f%% consistency based on %d tweets"
RISK_SENTENCE = "Risk level: %s (score: %.2f)"
TIME_SENTENCE = "Last %s: %s sentiment with %d supporting tweets"
HASHTAG_SENTENCE = "Strong momentum in %s with %d supporting tweets"
