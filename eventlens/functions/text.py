"""Text column functions (F01-F03).  All are plain Column expressions, so
they run inside whole-stage codegen and serve batch and stream alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Stop list of the 24-hour trending-word report (3+ letter words).  The
# reference lists "her" and "now" twice; as a set that changes nothing.
TRENDING_STOP_WORDS = (
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "had", "her",
    "was", "one", "our", "out", "day", "get", "has", "him", "his", "how", "its",
    "may", "new", "now", "old", "see", "two", "who", "boy", "did", "man", "way",
    "she", "use", "her", "now", "oil", "sit", "set",
)
# Stop list of the exploratory words-by-sentiment report (4+ letter words).
EXPLORE_STOP_WORDS = (
    "this", "that", "with", "have", "will", "from", "they", "been", "were", "said",
    "each", "which", "their", "time", "would", "there", "could", "other", "more",
    "very", "what", "know", "just", "first", "into", "over", "think", "also",
    "your", "work", "life", "only", "can", "still", "should", "after", "being",
    "now", "made", "before", "here", "through", "when", "where", "much", "some",
    "these", "many", "then", "them", "well", "were",
)
# Lexicon of the streaming sentiment scorer.
POSITIVE_WORDS = ("good", "great", "excellent", "amazing", "love", "best", "awesome",
                  "🚀", "💎", "📈")
NEGATIVE_WORDS = ("bad", "terrible", "awful", "hate", "worst", "crash", "dump",
                  "📉", "😰", "💸")
# Scores given to empty text.
EMPTY_SCORES = (0.33, 0.34, 0.33)
# Model label names.
LABEL_NAMES = {"LABEL_0": "negative", "LABEL_1": "neutral", "LABEL_2": "positive"}
# ---------------------------------------------------------------------------

URL_PATTERN = r"http\S+|www\S+|https\S+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c, max_len: int | None = None) -> Column:
    """drop URLs, turn every symbol except ``@`` and ``#`` into a space,
    squeeze whitespace and trim.  The text is kept whole; ``max_len`` exists
    only for model inputs with a hard length limit.

    One regex pass: a URL always ends at whitespace or at the end, so
    replacing it by a space instead of removing it gives the same text once
    runs of non-word characters (symbols and whitespace alike) become one
    space and the ends are trimmed.
    """
    out = F.trim(F.regexp_replace(_col(c), URL_PATTERN + r"|(?U:[^\w@#]+)", " "))
    if max_len is not None:
        out = F.substring(out, 1, max_len)
    return out


def words(c, min_len: int = 3, pattern: str | None = None) -> Column:
    """array of lower-case ASCII letter runs of at least ``min_len``.

    Runs are found in the original text and each word is lower-cased (the
    reports lower-case ASCII only, so the runs are the same as in the
    lower-cased text); lower-casing whole multi-lingual texts is the slow
    path of ``lower``."""
    pat = pattern or f"[a-zA-Z]{{{min_len},}}"
    return F.transform(F.regexp_extract_all(_col(c), F.lit(pat), 0), lambda w: F.lower(w))


def explode_words(df, text_col: str, min_len: int = 3, stop_words=(), alias: str = "word",
                  pattern: str | None = None, keep_text: bool = False):
    """Explode F02 words into rows and drop stop words.  Each occurrence is a
    row (the reference counts occurrences, not documents).  The text column
    is not carried into the exploded rows unless ``keep_text``."""
    others = [c for c in df.columns if keep_text or c != text_col]
    out = df.select(*others, F.explode(words(text_col, min_len, pattern)).alias(alias))
    if stop_words:
        out = out.where(~F.col(alias).isin(*sorted(set(stop_words))))
    return out


def _hits(low: Column, vocab) -> Column:
    return reduce(lambda a, b: a + b,
                  [F.when(low.contains(w), F.lit(1)).otherwise(F.lit(0)) for w in vocab])


def with_lexicon_sentiment(df, text_col: str = "text", positive=POSITIVE_WORDS,
                           negative=NEGATIVE_WORDS, prefix: str = "sentiment_"):
    """substring lexicon scorer as plain columns (no UDF).

    positive = hits/len(positive), negative = hits/len(negative),
    neutral = 1 - positive - negative, each divided by their sum; the label
    is the arg-max with ties resolved positive, neutral, negative; empty
    text scores .33/.34/.33 neutral.  Operation order follows the reference
    so the doubles are bit-identical.

    Adds ``{prefix}positive``, ``{prefix}neutral``, ``{prefix}negative``,
    ``predicted_sentiment`` and ``confidence``.  The work is staged in three
    projections so the hit counts are computed once per row (Catalyst does
    not collapse projections that would duplicate them).
    """
    text = F.col(text_col)
    low = F.lower(text)
    hp, hn = "__lex_hp", "__lex_hn"
    d = df.withColumns({hp: _hits(low, positive).cast("double") / F.lit(float(len(positive))),
                        hn: _hits(low, negative).cast("double") / F.lit(float(len(negative)))})
    p0, n0 = F.col(hp), F.col(hn)
    u0 = F.lit(1.0) - p0 - n0
    total = p0 + n0 + u0
    empty = text.isNull() | (text == "")
    e_pos, e_neu, e_neg = EMPTY_SCORES
    cp, cu, cn = f"{prefix}positive", f"{prefix}neutral", f"{prefix}negative"
    d = d.withColumns({
        cp: F.when(empty, F.lit(e_pos)).when(total > 0, p0 / total).otherwise(F.lit(0.33)),
        cu: F.when(empty, F.lit(e_neu)).when(total > 0, u0 / total).otherwise(F.lit(0.33)),
        cn: F.when(empty, F.lit(e_neg)).when(total > 0, n0 / total).otherwise(F.lit(0.33)),
    }).drop(hp, hn)
    pos, neu, neg = F.col(cp), F.col(cu), F.col(cn)
    first = (pos >= neu) & (pos >= neg)
    return d.withColumns({
        "predicted_sentiment": F.when(first, F.lit("positive")).when(neu >= neg, F.lit("neutral"))
                                .otherwise(F.lit("negative")),
        "confidence": F.when(first, pos).when(neu >= neg, neu).otherwise(neg),
    })


def label_name(c) -> Column:
    """Model label -> sentiment name; other labels are lower-cased."""
    m = F.create_map(*[F.lit(x) for kv in LABEL_NAMES.items() for x in kv])
    return F.coalesce(m[_col(c)], F.lower(_col(c)))
