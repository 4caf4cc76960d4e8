"""Hex payloads: 32-byte words, 256-bit numbers, addresses, texts.

All native expressions. Numbers that do not fit decimal(38,0) are NULL as numbers; their exact value is
available as decimal text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import _col

_DIGIT = 10**19  # decimal digits per position of the long form


def _lit_dec(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def strip_0x(c) -> Column:
    c = _col(c)
    return F.when(c.startswith("0x") | c.startswith("0X"), F.substr(c, F.lit(3))).otherwise(c)


def hex_words(c, size: int = 64) -> Column:
    """Cut a payload into fixed-size words; a short tail is dropped."""
    return F.regexp_extract_all(strip_0x(c), F.lit("(.{%d})" % size), F.lit(1))


def word(words, i: int) -> Column:
    """i-th word from 0, NULL past the end."""
    return F.get(_col(words), F.lit(i))


_ZEROS = "0" * 64


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, where it would otherwise be repeated in the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _with_padded(c, body) -> Column:
    """body(the 64 digits of a hex text); NULL when the text is no hex of at most 32 bytes."""
    digits = F.regexp_extract(_col(c), "^(?:0[xX])?([0-9a-fA-F]{1,64})$", 1)
    return let(digits, lambda d: F.when(d != "", let(F.lpad(d, 64, "0"), body)))


def _limb(h: Column, start: int, size: int) -> Column:
    return F.conv(F.substring(h, start, size), 16, 10).cast("decimal(38,0)")


def _zero_head(h: Column, n: int) -> Column:
    return F.left(h, F.lit(n)) == _ZEROS[:n]


def _number(h: Column) -> Column:
    """64 digits to decimal(38,0). Values under 2^60, nearly all in practice, take one conversion."""
    low, mid, high = _limb(h, 50, 15), _limb(h, 35, 15), _limb(h, 20, 15)
    # 2^120 * limb may exceed 38 digits and must give NULL
    wide = F.try_add(F.try_add(F.try_multiply(mid, _lit_dec(2**60)), low), F.try_multiply(high, _lit_dec(2**120)))
    return F.when(_zero_head(h, 49), low).when(_zero_head(h, 19), wide.cast("decimal(38,0)"))


def _long_text(h: Column) -> Column:
    """64 digits to decimal text by Horner's rule over 60-bit limbs, carrying 19 decimal digits per
    position, which keeps every product inside 38 digits."""
    limbs = F.array(*[_limb(h, s, n) for s, n in ((1, 4), (5, 15), (20, 15), (35, 15), (50, 15))])
    start = F.array(*[_lit_dec(0)] * 5)
    base, digit = _lit_dec(2**60), _lit_dec(_DIGIT)

    def step(acc, limb):
        out, carry = [], limb
        for i in range(5):
            total = (F.get(acc, F.lit(i)) * base + carry).cast("decimal(38,0)")
            out.append((total % digit).cast("decimal(38,0)"))
            # used once per position, so the expression grows with the square of the positions only
            carry = F.call_function("div", total, digit).cast("decimal(38,0)")
        return F.array(*out)

    def as_text(acc):
        joined = F.concat(*[F.lpad(F.get(acc, F.lit(i)).cast("string"), 19, "0") for i in (4, 3, 2, 1, 0)])
        return F.regexp_replace(joined, "^0+", "")

    return F.aggregate(limbs, start, step, as_text)


def hex_to_number(c) -> Column:
    """Unsigned hex to decimal(38,0); NULL when it is not hex or does not fit."""
    return _with_padded(c, _number)


def hex_to_text_number(c) -> Column:
    """Unsigned hex to exact decimal text, up to 78 digits."""
    return _with_padded(c, lambda h: F.when(_zero_head(h, 33), _number(h).cast("string")).otherwise(_long_text(h)))


def signed_hex_to_number(c) -> Column:
    """Two's complement 256-bit word to decimal(38,0); NULL when it does not fit."""

    def signed(h):
        flipped = F.translate(h, "0123456789abcdefABCDEF", "fedcba9876543210543210")
        minus = F.try_subtract(_lit_dec(-1), let(flipped, _number)).cast("decimal(38,0)")
        return F.when(F.substring(h, 1, 1) >= "8", minus).otherwise(_number(h))

    return _with_padded(c, signed)


def number_to_hex(c) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(_col(c).cast("bigint"))))


def topic_address(c) -> Column:
    """Last 20 bytes of a 32-byte word as an address."""
    return F.concat(F.lit("0x"), F.substring(strip_0x(c), 25, 40))


def hex_to_text(c) -> Column:
    """Bytes to text without padding NULs; NULL when the input is no hex or no text."""
    raw = F.try_to_binary(strip_0x(c), F.lit("hex"))
    return F.regexp_replace(F.try_validate_utf8(raw.cast("string")), "\u0000", "")


def decimal_adjust(raw, decimals) -> Column:
    """raw / 10^decimals as exact decimal text, for digit texts of any length."""
    text, d = _col(raw).cast("string"), _col(decimals).cast("int")
    digits = F.regexp_replace(text, "^-", "")
    wide = F.when(F.length(digits) > d, digits).otherwise(F.lpad(digits, d + 1, "0"))
    whole = F.substr(wide, F.lit(1), F.length(wide) - d)
    frac = F.regexp_replace(F.substr(wide, F.length(wide) - d + 1, d), "0+$", "")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    shifted = F.concat(sign, whole, F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")))
    return F.when(d == 0, text).otherwise(shifted)


def packet_slice(payload, fields: dict[str, tuple[int, int]]) -> dict[str, Column]:
    """Fixed-offset fields of a hex packet; offsets and lengths count hex digits from 0."""
    body = strip_0x(payload)
    return {name: F.substring(body, at + 1, size) for name, (at, size) in fields.items()}


def dynamic_array(words, head: int, width: int = 1, base: int = 0) -> Column:
    """ABI dynamic array: the head word holds the byte offset, counted from word `base`, of a count followed
    by its elements.

    Returns array<array<string>>: `width` words per element. The guard keeps an empty list empty;
    sequence() would otherwise count downwards.
    """
    w = _col(words)
    none = F.array().cast("array<array<string>>")

    def as_int(word_text):
        return let(word_text, lambda x: hex_to_number(x).cast("int"))

    def elements(at, count):
        items = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(w, at + 2 + i * width, F.lit(width)))
        return F.when(count > 0, items).otherwise(none)

    at_word = (as_int(word(w, head)) / 32).cast("int") + base
    return let(at_word, lambda at: let(as_int(F.get(w, at)), lambda count: elements(at, count)))
