"""Check digits of public identifier schemes, as Catalyst expressions (no Python per row)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, whole


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(c: Column, pattern: str, body: Callable[[Column], Column]) -> Column:
    """body of the digits (an array of numbers) of a text that, but for white space around it, matches the pattern; else false. The text is
    matched once."""
    found = F.regexp_extract(c, rf"(?U)\A\s*({pattern})\s*\z", 1)
    as_numbers = lambda t: F.transform(F.split(t, ""), lambda d: F.ascii(d) - 48)
    told = _once(found, lambda t: F.when(F.length(t) > 0, _once(as_numbers(t), body)))
    return F.coalesce(told, F.lit(False))


def luhn(c: Column) -> Column:
    """Luhn's formula (ISO/IEC 7812): from the right, every second digit doubled, digits added up to a multiple of ten."""

    def body(d: Column) -> Column:
        turned = F.transform(F.reverse(d), lambda x, k: F.when(k % 2 == 0, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0)))
        return F.aggregate(turned, F.lit(0), lambda acc, x: acc + x) % 10 == 0

    return _digits(c, "[0-9]{2,}", body)


def _weighed(d: Column, weights: list[int]) -> Column:
    """The sum of the first digits, each times its weight."""
    terms = F.zip_with(F.slice(d, 1, len(weights)), F.array(*map(F.lit, weights)), lambda x, w: x * w)
    return F.aggregate(terms, F.lit(0), lambda acc, x: acc + x)


def eleven_digit_id(c: Column) -> Column:
    """Personal number of 11 digits: not 0 at the front; the tenth is 7 times the odd places less the even ones, modulo 10;
    the last is the sum of the first ten, modulo 10."""

    def body(d: Column) -> Column:
        tenth = F.pmod(_weighed(d, [7, -1, 7, -1, 7, -1, 7, -1, 7]), F.lit(10)) == F.element_at(d, 10)
        return tenth & (_weighed(d, [1] * 10) % 10 == F.element_at(d, 11))

    return _digits(c, "[1-9][0-9]{10}", body)


def ten_digit_tax_id(c: Column) -> Column:
    """Tax number of 10 digits: place i adds s * 2 ** (9 - i) modulo 9 (9 for 0) of s = (digit + 9 - i) mod 10, and nothing
    but s where s is 0 or 9; the last digit fills up to ten."""

    def body(d: Column) -> Column:
        shifted = F.transform(F.slice(d, 1, 9), lambda x, i: (x + 9 - i) % 10)
        power = F.array(*(F.lit(2 ** (9 - i)) for i in range(9)))
        term = F.zip_with(shifted, power, lambda s, p: F.when(s == 0, 0).when(s * p % 9 == 0, 9).otherwise(s * p % 9))
        return (10 - F.aggregate(term, F.lit(0), lambda acc, x: acc + x) % 10) % 10 == F.element_at(d, 10)

    return _digits(c, "[0-9]{10}", body)


def iban(c: Column) -> Column:
    """ISO 13616: the first four characters moved to the end, letters as 10 to 35, the number is 1 modulo 97."""

    def body(text: Column) -> Column:
        turned = F.concat(F.substring(text, 5, 30), F.substring(text, 1, 4))
        code = F.transform(F.split(turned, ""), lambda x: F.ascii(x))
        value = F.transform(code, lambda a: F.when(a < 65, a - 48).otherwise(a - 55))
        rest = F.aggregate(value, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97)
        return whole(text, "[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}") & (rest == 1)

    return F.coalesce(_once(F.upper(F.replace(strip(c), F.lit(" "), F.lit(""))), body), F.lit(False))


CHECKSUMS: dict[str, Callable[[Column], Column]] = {
    "luhn": luhn,
    "eleven_digit_id": eleven_digit_id,
    "ten_digit_tax_id": ten_digit_tax_id,
    "iban": iban,
}
