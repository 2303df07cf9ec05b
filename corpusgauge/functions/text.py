"""Text columns: normalization, tokens, character n-grams, hashing and bands."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 29 code points that separate words in normalized text.
WHITESPACE = (
    r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD = r"[\p{L}\p{N}_]{2,}"

# Upper bounds and names of the text-length bands.
LENGTH_BANDS = [(100, "<100"), (200, "100-199"), (400, "200-399"), (None, "400+")]
# Upper bounds and names of the confidence bands.
CONFIDENCE_BANDS = [
    (0.5, "[0.0,0.5)"),
    (0.6, "[0.5,0.6)"),
    (0.7, "[0.6,0.7)"),
    (0.8, "[0.7,0.8)"),
    (0.9, "[0.8,0.9)"),
    (None, "[0.9,1.0]"),
]


@F.pandas_udf(T.StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFC")


def nfc(text: Column) -> Column:
    """Unicode composition. Text below U+0300 is composed already and never leaves the JVM."""
    return F.coalesce(_compose(F.when(text.rlike(r"[^\x{0}-\x{2FF}]"), text)), text)


def normalize_text(text: Column) -> Column:
    """Compose, turn each run of whitespace into one space, and trim."""
    return F.trim(F.regexp_replace(nfc(text), f"[{WHITESPACE}]+", " "))


def is_blank(text: Column) -> Column:
    """True for NULL and for text made of whitespace only."""
    return F.coalesce(~text.rlike(f"[^{WHITESPACE}]"), F.lit(True))


def words(text: Column) -> Column:
    """Lower-cased words split at whitespace, without empty ones."""
    return F.array_remove(F.split(F.lower(text), f"[{WHITESPACE}]+"), "")


def tokens(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)


def token_ngrams(units: Column, low: int, high: int) -> Column:
    """N-grams of every length from ``low`` to ``high`` of a token column, joined by one space.

    ``units`` must be a plain column: an expression would be evaluated again for every n-gram.
    """
    grams = []
    for length in range(low, high + 1):
        if length == 1:
            grams.append(units)
            continue
        starts = F.when(
            F.size(units) >= length, F.sequence(F.lit(1), F.size(units) - (length - 1))
        ).otherwise(F.array().cast("array<int>"))
        grams.append(
            F.transform(starts, lambda at: F.array_join(F.slice(units, at, length), " "))
        )
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def hash_int(*parts: Column | str) -> Column:
    """First 32 bits of md5 over the parts joined by ':', as a BIGINT."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def band(value: Column, bands: list[tuple[float | None, str]]) -> Column:
    """Name of the first band whose upper bound lies above ``value``; NULL stays NULL."""
    picked = F.lit(bands[-1][1])
    for upper, name in reversed(bands[:-1]):
        picked = F.when(value < upper, F.lit(name)).otherwise(picked)
    return F.when(value.isNotNull(), picked)


def position(value: Column, ordered: list[str]) -> Column:
    """1-based place of ``value`` in ``ordered``; values outside come last."""
    place = F.lit(len(ordered) + 1)
    for index, name in reversed(list(enumerate(ordered, start=1))):
        place = F.when(value == name, F.lit(index)).otherwise(place)
    return place


def ratio(part: Column, whole: Column) -> Column:
    """Double division, NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """Double division with 0/0 = 0, as in precision and recall."""
    return F.coalesce(ratio(part, whole), F.lit(0.0))
