"""Numbers in text, Arabic and Chinese, in one written form. Arrow-batched: the grammar is beyond expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

# The Chinese numerals, and the measures behind which one alone is a number.
DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "兩": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}
MYRIADS = {"萬": 10**4, "億": 10**8}
MEASURES = frozenset("%倍歲年週天人例次劑成種個月日")

_DIGIT, _UNIT, _MYRIAD = ("".join(t) for t in (DIGITS, UNITS, MYRIADS))
_NUMERAL = _DIGIT + _UNIT + _MYRIAD
#: A term of a group (a digit or written number times a unit), and what a group ends with besides.
_TERM, _LAST = re.compile(f"([0-9]+|[{_DIGIT}])?([{_UNIT}])"), re.compile(f"(?:[0-9]+|[{_DIGIT}])$")

# The scanner's tokens, each tried where a number may start.
_RUN = re.compile(f"[\\d{_NUMERAL}]+")
_SPOKEN = re.compile(f"[{_NUMERAL}點]+")
_GROUPED = re.compile(r"\d{1,3}(?:,\d{3})+(?!\d)")
_LISTED = re.compile(r"\d(?:\s?[、,]\s?\d)+(?![\d.])")
_WRITTEN = re.compile(f"\\d+(?:\\.\\d+(?![\\d{_NUMERAL}]*[{_UNIT}]))?")
_SCALE, _SIGN = re.compile(f"\\s*([{_MYRIAD}])"), re.compile(r"\s?%")
_START = re.compile(f"[\\d{_NUMERAL}點]")
_HUNDREDTHS = "百分之"


def plain(value: Decimal) -> str:
    """At most six places, without trailing zeros."""
    text = f"{value:.6f}".rstrip("0").rstrip(".")
    return text or "0"


def _figure(piece: str) -> int:
    return DIGITS[piece] if piece in DIGITS else int(piece)


def _group(group: str) -> int:
    """What stands below a myriad: terms, and a last digit."""
    terms = sum((_figure(times) if times else 1) * UNITS[unit] for times, unit in _TERM.findall(group))
    last = _LAST.search(group)
    return terms + (_figure(last[0]) if last else 0)


def _by_units(numeral: str) -> int:
    """Hundreds of millions before the last 億, and myriads and the rest after it."""
    high, _, low = numeral.rpartition("億")
    *myriads, rest = low.split("萬")
    return (_by_units(high) if high else 0) * MYRIADS["億"] + sum(map(_group, myriads)) * MYRIADS["萬"] + _group(rest)


def chinese_number(numeral: str) -> str | None:
    """A numeral's digits: positional (二零二四), by units (三百二十), with 點, mixed (2千3百萬); None if it is none."""
    whole, point, places = numeral.partition("點")
    if point:
        positional = places and all(c in DIGITS for c in places)
        front = chinese_number(whole) if whole and positional else None
        return None if front is None else front + "." + chinese_number(places)
    if not all(c in _NUMERAL or c in "0123456789" for c in numeral):
        return None
    return "".join(str(DIGITS[c]) for c in numeral) if all(c in DIGITS for c in numeral) else str(_by_units(numeral))


def _counts(run: str, before: str, after: str) -> bool:
    """Whether a spoken run is a number: not an ordinal or a bare unit; one numeral alone only before a measure."""
    if before == "第" or run[0] not in DIGITS and run[0] != "十":
        return False
    return len(run) > 1 or (run not in "零〇一" and after in MEASURES and after != "")


def _number_at(t: str, at: int) -> tuple[str | None, int]:
    """The number that starts at ``at`` (None if none does), and where the scan goes on."""
    if t.startswith(_HUNDREDTHS, at):
        start = at + len(_HUNDREDTHS)
        m = _SPOKEN.match(t, start) or _WRITTEN.match(t, start)
        run = _RUN.match(t, start)
        mixed = run and _mixed(run[0])
        number = None if not m or mixed else m[0] if m[0][0].isdecimal() else chinese_number(m[0])
        return (number + "%", m.end()) if number is not None else (None, start if m else at + 1)
    run = _RUN.match(t, at + (t[at] == "點"))
    if run and _mixed(run[0]):
        return _suffixed(t, chinese_number(run[0]), run.end())
    if t[at].isdecimal():
        m = None if t[at - 1 : at] == "." else _GROUPED.match(t, at) or _LISTED.match(t, at)
        digits = "".join(c for c in m[0] if c.isdecimal()) if m else None
        m = m or _WRITTEN.match(t, at)
        return _suffixed(t, digits or m[0], m.end())
    m = _SPOKEN.match(t, at)
    if not _counts(m[0], t[at - 1 : at], t[m.end() : m.end() + 1]):
        return None, m.end()
    number = chinese_number(m[0])
    return _suffixed(t, number, m.end()) if number is not None else (None, m.end())


def _mixed(run: str) -> bool:
    """Whether digits and units stand together: 2千3百."""
    return any(c in "0123456789" for c in run) and any(c in UNITS for c in run)


def _suffixed(t: str, number: str, end: int) -> tuple[str, int]:
    """A number with the myriad and the sign that follow it."""
    scale = _SCALE.match(t, end)
    if scale:
        number, end = plain(Decimal(number) * MYRIADS[scale[1]]), scale.end()
    sign = _SIGN.match(t, end)
    return (number + "%", sign.end()) if sign else (number, end)


def numbers_in(text: str | None) -> list[str]:
    """The numbers of a text in order: thousands joined, single-digit lists as one, percentages with their sign, 3萬 as 30000."""
    t = unicodedata.normalize("NFKC", text or "")
    found = []
    start = _START.search(t)
    while start:
        number, at = _number_at(t, start.start())
        if number is not None:
            sign = "%" * number.endswith("%")
            bare = number.removesuffix("%")
            found.append((plain(Decimal(bare)) if "." in bare else bare) + sign)
        start = _START.search(t, at)
    return found


def _column(fn: Callable, kind: str, arrow: pa.DataType) -> Callable[[Column], Column]:
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fn(t) for t in texts.to_pylist()], arrow)

    return arrow_udf(run, kind)


def numbers(text: Column) -> Column:
    """Array of the numbers in ``text``; empty for null."""
    return _column(numbers_in, "array<string>", pa.list_(pa.string()))(text)


def chinese_numeral(text: Column) -> Column:
    """The number that a numeral writes, or null."""
    return _column(lambda t: chinese_number(t) if t else None, "string", pa.string())(text)
