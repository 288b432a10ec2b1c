"""Text renderings used in reports and the bar hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_utc(ts) -> Column:
    """ISO-8601 text of a UTC timestamp: ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``.

    Fractional seconds appear only when non-zero (as Python's isoformat).
    Assumes the session zone is UTC.
    """
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, ".SSSSSS")
    has_frac = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) != 0
    return F.when(ts.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(whole, F.when(has_frac, frac).otherwise(F.lit("")), F.lit("+00:00"))
    )


def hash_time_text(ts) -> Column:
    """Second-precision UTC text used in the bar hash payload."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


_EXACT_LOW, _EXACT_HIGH = 2.0**53, 2.0**100  # integers whose digits are worked out, not taken from Java's text
_LEAST_NORMAL = 2.2250738585072014e-308
_LEAST = "4.94065645841246544177"  # of the least double's digits, which are those of 2^-1074


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once a row."""
    return F.transform(F.array(value), body)[0]


def _count(n) -> Column:
    return F.lit(n).cast("int")


def _java_digits(a: Column) -> Column:
    """Significant digits and the power of ten of the first one, as in Java's
    text of a positive double: ``0.0012345``, ``123.45`` or ``1.2345E-10``."""
    text = a.cast("string")
    mantissa = F.substring_index(text, "E", 1)
    whole, part = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    power = (
        F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).try_cast("int"))
        .when(whole != "0", F.length(whole) - 1)
        .otherwise(F.length(F.ltrim(part, F.lit("0"))) - F.length(part) - 1)
    )
    return F.struct(F.trim(F.concat(whole, part), F.lit("0")).alias("digits"), power.alias("power"))


def _exact_digits(a: Column) -> Column:
    """All digits of an integer from 2^53 to 2^100, in two exact halves."""
    high = F.floor(a / 2.0**40)
    low = (a - high.cast("double") * 2.0**40).cast("bigint")
    text = (high.cast("decimal(19,0)") * F.lit(2**40).cast("decimal(13,0)") + low.cast("decimal(19,0)")).cast("string")
    return F.struct(text.alias("digits"), (F.length(text) - 1).alias("power"))


def _tiny_digits(a: Column) -> Column:
    """Digits of a double below the least normal one: a whole multiple of 2^-1074."""
    number = ((a / 5e-324).cast("decimal(16,0)") * F.lit(_LEAST).cast("decimal(21,20)")).cast("string")
    return F.struct(F.rtrim(F.replace(number, F.lit("."), F.lit("")), F.lit("0")).alias("digits"),
                    (F.length(F.substring_index(number, ".", 1)) - 325).alias("power"))


def _shortest(a: Column, known: Column) -> Column:
    """The fewest digits that read back as ``a``, next to the ``known`` ones.

    Both the known digits and the wanted ones lie among the numbers that read
    as ``a``, so the wanted ones are the known ones cut off, or one more. Fewer
    than 15 need a look only below the least normal double: no two numbers of
    15 digits read as the same one."""
    digits, power = known["digits"], known["power"]
    n = F.length(digits)
    least = F.when(a < _LEAST_NORMAL, 1).otherwise(F.least(n, _count(15)))

    def cut(k: Column) -> Column:
        head, rest = F.substr(digits, _count(1), k).cast("bigint"), F.substr(digits, k + 1)
        half = F.rpad(F.lit("5"), n - k, F.lit("0"))
        up = (k < n) & ((rest > half) | ((rest == half) & (head % 2 == 1)))
        number = lambda h: F.struct(h.cast("string").alias("head"), (power - k + 1).alias("scale"))
        return F.when(up, F.array(number(head + 1), number(head))).otherwise(F.array(number(head), number(head + 1)))

    numbers = F.flatten(F.transform(F.sequence(least.cast("int"), F.least(n, _count(17))), cut))
    found = F.filter(numbers, lambda c: F.concat(c["head"], F.lit("E"), c["scale"].cast("string")).cast("double") == a)
    return _let(F.get(found, F.lit(0)), lambda c: F.struct(
        F.rtrim(c["head"], F.lit("0")).alias("digits"), (c["scale"] + F.length(c["head"]) - 1).alias("power")))


def _python_text(d: Column) -> Column:
    """Digits and power as ``repr`` sets them: plain from 1e-4 to below 1e16."""
    digits, power = d["digits"], d["power"]
    n = F.length(digits)
    rest = F.when(n > 1, F.concat(F.lit("."), F.substr(digits, _count(2)))).otherwise("")
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string"))
    return (
        F.when((power < -4) | (power >= 16), F.concat(F.substr(digits, _count(1), _count(1)), rest, F.lit("e"), exponent))
        .when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits))
        .when(power >= n - 1, F.concat(digits, F.repeat(F.lit("0"), power - n + 1), F.lit(".0")))
        .otherwise(F.concat(F.substr(digits, _count(1), power + 1), F.lit("."), F.substr(digits, power + 2)))
    )


def _one_less_reads(size: Column, text: Column) -> Column:
    """Whether Java's plain text, cut by its last digit, still reads as the
    same value (cut off, or one more). If not, no shorter text does."""
    size_text = F.ltrim(text, F.lit("-"))
    fraction = F.length(F.substring_index(text, ".", -1))
    head = F.replace(F.substr(size_text, _count(1), F.length(size_text) - 1), F.lit("."), F.lit("")).try_cast("bigint")  # NULL for text with an exponent
    reads = lambda h: F.concat(h.cast("string"), F.lit("E"), (1 - fraction).cast("string")).cast("double") == size
    return _let(head, lambda h: reads(h) | reads(h + 1))


def _repr(c: Column) -> Column:
    return _let(c.cast("string"), lambda text: _repr_from(c, text))


def _repr_from(c: Column, text: Column) -> Column:
    size = F.abs(c)
    plain = (size < 1e7) & ((size >= 1e-3) | (size == 0)) & ((F.length(text) <= 16) | ~_one_less_reads(size, text))
    known = (
        F.when(size < _LEAST_NORMAL, _tiny_digits(size))
        .when((size >= _EXACT_LOW) & (size < _EXACT_HIGH), _exact_digits(size))
        .otherwise(_java_digits(size))
    )
    anew = _let(known, lambda k: _let(_shortest(size, k), _python_text))
    return (
        F.when(plain, text)
        .when(F.isnan(c), "nan")
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when(c.isNotNull(), F.concat(F.when(c < 0, "-").otherwise(""), anew))
    )


def float_reprs(*cols) -> Column:
    """Array of the texts of several doubles (see ``float_repr``); one
    expression serves them all."""
    return F.transform(F.array(*[_col(c).cast("double") for c in cols]), _repr)


def float_repr(c) -> Column:
    """Shortest round-trip text of a double, exactly as Python's ``repr``.

    Java's text of a double reads back equal, but may have a digit more than
    it needs, and turns to exponents outside [1e-3, 1e7). Where it is plain and
    has at most 15 digits, or cannot be cut by one, it is the text already; any
    other value is shortened and set anew, all in column expressions. NULL stays
    NULL (NaN renders as ``nan``, infinities as ``inf`` and ``-inf``).
    """
    return float_reprs(c)[0]
