"""Null, ordering and key rules that differ from Spark's defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def newest(c) -> Column:
    """Descending with NULLs first."""
    return _col(c).desc_nulls_first()


def oldest(c) -> Column:
    """Ascending with NULLs last."""
    return _col(c).asc_nulls_last()


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])


def greatest_strict(*cols) -> Column:
    """Largest value, NULL as soon as one argument is NULL."""
    return F.when(~_any_null(cols), F.greatest(*[_col(c) for c in cols]))


def least_strict(*cols) -> Column:
    """Smallest value, NULL as soon as one argument is NULL."""
    return F.when(~_any_null(cols), F.least(*[_col(c) for c in cols]))


def concat_ws_strict(sep: str, *cols) -> Column:
    """Join texts; NULL as soon as one argument is NULL (concat has that rule, concat_ws has not)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)


def surrogate_key(*cols) -> Column:
    """MD5 over the '-'-joined text of the key columns, NULL spelled out."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in cols]))


def full_match(c, pattern: str) -> Column:
    """Regex test against the whole text; rlike alone searches for a substring."""
    return _col(c).rlike(f"^(?:{pattern})$")


def part(c, sep: str, n: int) -> Column:
    """n-th piece of a delimited text, 0 meaning 1, empty text past the end."""
    return F.split_part(_col(c), F.lit(sep), F.lit(n or 1))


def drop_null_entries(m) -> Column:
    """Map without the NULL valued pairs."""
    return F.map_filter(_col(m), lambda _k, v: v.isNotNull())


def base64_text(c) -> Column:
    """Base64 to text, NULL when the input is not base64 or not text."""
    return F.try_validate_utf8(F.try_to_binary(_col(c), F.lit("base64")).cast("string"))


def ratio(num, den) -> Column:
    """Division that gives NULL on a zero denominator."""
    return F.try_divide(_col(num), _col(den))


def usd_unless_outlier(own, other, suspect, limit: float = 0.75) -> Column:
    """One leg's USD value, rounded to cents.

    A suspect leg is nulled when the other leg has no value or the two differ by more than `limit` of
    either. A ratio over zero is unknown, and an unknown test does not null the value.
    """
    a, b, s = _col(own), _col(other), _col(suspect)
    far = (F.abs(F.try_divide(a - b, b)) > limit) | (F.abs(F.try_divide(a - b, a)) > limit)
    return F.round(F.when(s & (b.isNull() | far), F.lit(None)).otherwise(a), 2)


def usd_below(amount, cap: float = 1e15) -> Column:
    """USD value, NULL at or above an implausible cap."""
    return F.round(F.when(_col(amount) < cap, _col(amount)), 2)
