"""Silver cleaning rules as native Column expressions.

Each function maps a raw Bronze string column to its cleaned form with the exact
semantics of the original row-at-a-time Python rules, but as JVM expressions: no
Python worker, codegen-friendly, and filters on the results still push down.
"""

from __future__ import annotations

import datetime as _dt
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import PY_WS, PY_WS_CHARS, blank_to_null, col_of, literal_map, ustrip

# Month names accepted by convert_date (English, then Polish genitive).
MONTH_NUMBERS = {
    "january": "01", "february": "02", "march": "03", "april": "04",
    "may": "05", "june": "06", "july": "07", "august": "08",
    "september": "09", "october": "10", "november": "11", "december": "12",
    "stycznia": "01", "lutego": "02", "marca": "03", "kwietnia": "04",
    "maja": "05", "czerwca": "06", "lipca": "07", "sierpnia": "08",
    "września": "09", "października": "10", "listopada": "11", "grudnia": "12",
}

# Work-mode translations (keys are lower-cased, stripped items).
WORK_MODES = {"hybrydowa": "hybrid", "zdalna": "remote", "stacjonarna": "full office"}

# Contract-type translations (exact, case-sensitive, untrimmed match).
CONTRACT_TYPES = {
    "kontrakt B2B (pełny etat)": "B2B contract (full-time)",
    "umowa o pracę (pełny etat)": "contract of employment (full-time)",
    "kontrakt B2B (część etatu, pełny etat)": "B2B contract (part-time, full-time)",
    "kontrakt B2B": "B2B contract",
}

# Substrings that mark a multi-location offer, and the replacement label.
MULTI_LOCATION_PATTERNS = ["Oferta w wielu lokalizacjach", "Multiple locations offer"]
MULTI_LOCATION_LABEL = "Multiple locations"

# Frequency keywords (searched in the lower-cased text).
MONTHLY_KEYS = ["mth", "mies"]
HOURLY_KEYS = ["hr", "godz"]

# Characters replaced by a plain space before salary parsing.
SALARY_SPACES = "\u00a0\u2009\u202f"
_TOKEN = f"[^{PY_WS_CHARS}]+"
_THREE_PARTS = rf"\A{PY_WS}*({_TOKEN}){PY_WS}+({_TOKEN}){PY_WS}+({_TOKEN}){PY_WS}*\z"
SALARY_PATTERN = rf"([\p{{Nd}}{PY_WS_CHARS},]+){PY_WS}*-{PY_WS}*([\p{{Nd}}{PY_WS_CHARS},]+)"


def as_of_col(as_of: _dt.date | str | None) -> Column:
    """The reference date: a fixed literal, or ``current_date()`` when None."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()).cast("date")


def convert_date(c: Column | str) -> Column:
    """``'day month_name year'`` -> ``'YYYY-MM-DD'`` string, else NULL.

    Exactly three whitespace-separated parts (one anchored pattern both checks the
    shape and captures all parts; U+001F, a white space, separates them, and text of any
    other shape becomes empty parts); the month is looked up lower-cased; a
    one-character day gets a leading zero (longer days are kept whole, never truncated).
    Empty parts need no test of their own: no month has an empty name.  A projection
    evaluates the match once a row, a filter (which shares nothing) once per part.
    """
    parts = F.split(F.regexp_replace(col_of(c), rf"{_THREE_PARTS}|(?s:\A.*\z)", "$1\x1f$2\x1f$3"), "\x1f")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i - 1))

    month_num = F.try_element_at(literal_map(MONTH_NUMBERS), F.lower(part(2)))
    padded_day = F.regexp_replace(part(1), r"(?s)^(.)$", "0$1")
    # concat() is NULL as soon as any piece is NULL: no match or unknown month -> NULL
    return F.concat(part(3), F.lit("-"), month_num, F.lit("-"), padded_day)


def parse_iso_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text -> DATE; unparseable or impossible dates -> NULL."""
    return F.try_to_date(col_of(c), "yyyy-MM-dd")


def to_listing_date(c: Column | str) -> Column:
    """Raw listing date text -> DATE (``convert_date`` then ``parse_iso_date``)."""
    return parse_iso_date(convert_date(c))


def days_left(expiration: Column | str, as_of=None) -> Column:
    return F.datediff(col_of(expiration), as_of_col(as_of))


def days_since_posted(posted: Column | str, as_of=None) -> Column:
    return F.datediff(as_of_col(as_of), col_of(posted))


def clean_location(c: Column | str) -> Column:
    loc = col_of(c)
    hit = None
    for p in MULTI_LOCATION_PATTERNS:
        cond = loc.contains(p)
        hit = cond if hit is None else (hit | cond)
    return F.when(hit, F.lit(MULTI_LOCATION_LABEL)).otherwise(loc)


def translate_work_modes(c: Column | str) -> Column:
    """Split on ',', strip + lower each item, translate known Polish modes, join ', '.

    Written without a lambda (a higher-order function would take the whole projection
    out of whole-stage codegen): lower-case the text, strip whitespace around every
    comma and at both ends, replace each known item when it is a whole item, then
    join with ', '."""
    raw = col_of(c)
    text = F.regexp_replace(ustrip(F.lower(raw)), f"{PY_WS}*,{PY_WS}*", ",")
    for polish, english in WORK_MODES.items():
        text = F.regexp_replace(text, rf"(^|,){re.escape(polish)}(?=,|\z)", f"$1{english}")
    return F.when(blank_to_null(raw).isNotNull(), F.replace(text, F.lit(","), F.lit(", ")))


def clean_job_level(c: Column | str) -> Column:
    """Every bullet becomes a comma, then spaces are trimmed from both ends."""
    return F.trim(F.replace(col_of(c), F.lit("•"), F.lit(",")))


def translate_contract_type(c: Column | str) -> Column:
    raw = col_of(c)
    return F.coalesce(F.try_element_at(literal_map(CONTRACT_TYPES), raw), blank_to_null(raw))


def translate_frequency(c: Column | str) -> Column:
    """monthly / hourly by keyword (checked on the lower-cased text), else unchanged.

    Stripping cannot create or remove a keyword (none contains whitespace), so the
    keyword test runs on ``lower(text)`` directly."""
    raw = col_of(c)
    low = F.lower(raw)
    return (
        F.when(blank_to_null(raw).isNull(), F.lit(None).cast("string"))
        .when(low.rlike("|".join(MONTHLY_KEYS)), F.lit("monthly"))
        .when(low.rlike("|".join(HOURLY_KEYS)), F.lit("hourly"))
        .otherwise(raw)
    )


def _unicode_digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit and its ASCII value, generated from the Unicode
    database (Python's float() reads any decimal digit; Spark's cast reads ASCII)."""
    src, dst = [], []
    for cp in range(128, 0x110000):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.decimal(ch)))
    return "".join(src), "".join(dst)


_DIGITS_FROM, _DIGITS_TO = _unicode_digits()


def _salary_side(g: Column) -> Column:
    num = F.replace(F.replace(ustrip(g), F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return F.translate(num, _DIGITS_FROM, _DIGITS_TO).try_cast("double").try_cast("int")


def extract_salary_range(c: Column | str) -> Column:
    """``'20 000 - 23 500'`` -> struct(min_salary, max_salary); NULLs unless both parse.

    Text that is missing, empty or contains 'null' (any case) gives NULLs.  Three exotic
    spaces become plain spaces; the first ``digits - digits`` match (ASCII hyphen only)
    is taken; each side is stripped, spaces removed, ',' read as a decimal point and the
    number truncated to an integer.
    """
    raw = col_of(c)
    text = F.translate(raw, SALARY_SPACES, " " * len(SALARY_SPACES))
    lo = _salary_side(F.regexp_extract(text, SALARY_PATTERN, 1))
    hi = _salary_side(F.regexp_extract(text, SALARY_PATTERN, 2))
    usable = blank_to_null(raw).isNotNull() & ~F.lower(raw).contains("null")
    # each side is kept only if the other side parsed too (a NULL side stays NULL)
    return F.struct(
        F.when(usable & hi.isNotNull(), lo).alias("min_salary"),
        F.when(usable & lo.isNotNull(), hi).alias("max_salary"),
    )


def salary_for(frequency: Column | str, salary: Column | str, wanted: str) -> Column:
    """The salary figure when the (translated) frequency equals ``wanted``, else NULL."""
    return F.when(col_of(frequency) == wanted, col_of(salary))


def after_first_colon(c: Column | str) -> Column:
    """Text after the first ':' (stripped); the whole text when there is no colon."""
    t = col_of(c)
    return F.when(F.instr(t, ":") > 0, ustrip(F.element_at(F.split(t, ":", 2), 2))).otherwise(t)
