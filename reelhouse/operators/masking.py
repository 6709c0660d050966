"""Column masking rules for pseudonymised views.

``mask(df, {column: rule})`` applies one rule per column and keeps the column
name.  Rules are plain expressions (JVM side):

* ``hash``             64-bit key of the value (``surrogate_key``)
* ``keep_prefix(n)``   first ``n`` characters of the text + ``**``
* ``first_word``       text before the first space + ``' *****'``
* ``bucket``           rating generalised to LOW / MID / HIGH / UNKNOWN
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.exprs import first_word, rating_band, surrogate_key

Rule = Callable[[Column], Column]


def hash_rule(algo: str = "md5_60") -> Rule:
    return lambda c: surrogate_key(c, algo)


def keep_prefix(n: int, fill: str = "**") -> Rule:
    return lambda c: F.concat(F.substring(c.cast("string"), 1, n), F.lit(fill))


def first_word_rule(fill: str = "*****") -> Rule:
    return lambda c: F.concat(first_word(c), F.lit(" "), F.lit(fill))


def bucket_rule(low: float = 6.0, high: float = 8.0) -> Rule:
    return lambda c: rating_band(c, low, high)


def _resolve(rule) -> Rule:
    if callable(rule):
        return rule
    named = {"hash": hash_rule(), "first_word": first_word_rule(), "bucket": bucket_rule()}
    if rule in named:
        return named[rule]
    raise ValueError(f"unknown mask rule {rule!r}")


def mask(df: DataFrame, rules: dict) -> DataFrame:
    """Replace each column in ``rules`` by its masked value (same name, same position)."""
    fns = {c: _resolve(r) for c, r in rules.items()}
    return df.select([fns[c](F.col(c)).alias(c) if c in fns else F.col(c) for c in df.columns])
