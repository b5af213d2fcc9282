"""Column builders shared by the operators; all stay native Spark expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.rules import CITY_CENTER, KM_PER_DEGREE, LONGITUDE_FACTOR


# Characters outside ASCII whose lower case contains an ASCII letter: Kelvin sign, dotted capital I.
_FOLDS_TO_ASCII = "\u212a\u0130"
_WORD_PATTERN = re.compile(r"\(\?i\)(\()?([A-Za-z ]+(?:\|[A-Za-z ]+)*)(?(1)\))")


def fold_case(col: Column) -> Column:
    """Lower-case text for ``contains_any``. ``(?i)`` only folds ASCII letters, and so does this."""
    for character in _FOLDS_TO_ASCII:
        col = F.replace(col, F.lit(character), F.lit("?"))
    return F.lower(col)


def contains_any(col: Column, pattern: str, folded: Column | None = None) -> Column:
    """``col.rlike(pattern)``, faster where ``folded`` holds ``fold_case(col)``.

    A case-insensitive choice of plain words, as in most rule tables, is then a choice of substring
    searches, which take about a third of the time of the regex. Other patterns stay regexes.
    """
    words = _WORD_PATTERN.fullmatch(pattern)
    if folded is None or words is None:
        return col.rlike(pattern)
    return reduce(or_, [folded.contains(word) for word in words[2].lower().split("|")])


def classify(col: Column, rules: Sequence[tuple[str, str]], default: str,
             null_value: str | None = None, folded: Column | None = None) -> Column:
    """Label of the first regex in ``rules`` found in ``col``; ``default`` if none is.

    ``folded`` is explained in ``contains_any``.
    """
    chain = F.when(col.isNull(), F.lit(default if null_value is None else null_value))
    for pattern, label in rules:
        chain = chain.when(contains_any(col, pattern, folded), F.lit(label))
    return chain.otherwise(F.lit(default))


def bucketize(col: Column, bounds: Sequence[float], labels: Sequence[str],
              null_label: str, closed: str = "left") -> Column:
    """Label of the interval that holds ``col``; ``labels`` has one entry more than ``bounds``.

    ``closed="left"`` puts a value equal to a bound in the upper interval, ``"right"`` in the lower.
    """
    if len(labels) != len(bounds) + 1 or list(bounds) != sorted(bounds):
        raise ValueError("need ascending bounds and one more label than bounds")
    chain = F.when(col.isNull(), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        chain = chain.when(col < bound if closed == "left" else col <= bound, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def map_codes(col: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Exact code lookup in a literal map."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.create_map(*pairs)[col], F.lit(default))


def null_safe_flag(condition: Column) -> Column:
    """Boolean that is false where ``condition`` is unknown."""
    return F.coalesce(condition, F.lit(False))


def standardize_address(col: Column, expand_ave: bool = False) -> Column:
    """Single-spaced, trimmed, upper-case address with the word ST (and AVE) written out.

    Abbreviations are expanded before upper-casing, so only upper-case ones are.
    """
    text = F.trim(F.regexp_replace(col, r"\s+", " "))
    text = F.regexp_replace(text, r"\bST\b", "STREET")
    if expand_ave:
        text = F.regexp_replace(text, r"\bAVE\b", "AVENUE")
    return F.upper(text)


def bbox_valid(lat: Column, lon: Column, bounds: Mapping[str, tuple[float, float]]) -> Column:
    """True for a point inside ``bounds``; null, NaN and zero coordinates are not."""
    def usable(col: Column, name: str) -> Column:
        low, high = bounds[name]
        return ~F.isnan(col) & (col != 0) & col.between(low, high)

    return null_safe_flag(usable(lat, "lat") & usable(lon, "lon"))


def planar_km(lat: Column, lon: Column, center: tuple[float, float] = CITY_CENTER,
              km_per_deg: float = KM_PER_DEGREE, lon_factor: float = LONGITUDE_FACTOR) -> Column:
    """Flat-earth distance in km from ``center``, rounded to 2 digits."""
    north = (lat - F.lit(center[0])) * km_per_deg
    east = (lon - F.lit(center[1])) * km_per_deg * lon_factor
    return F.round(F.sqrt(F.pow(north, F.lit(2)) + F.pow(east, F.lit(2))), 2)


def with_share(df: DataFrame, count_col: str, out: str = "pct", digits: int = 1) -> DataFrame:
    """Add each row's percentage of the grand total of ``count_col`` (batch frames).

    The total is a scalar subquery, so an open set of groups is never moved to a single task.
    """
    total = df.agg(F.sum(count_col)).scalar()
    return df.withColumn(out, F.round(F.col(count_col) / total * 100, digits))
