"""Text helpers with Python ``str`` semantics, expressed as native Spark columns.

Python's ``strip()``/``split()``/``\\s`` treat every character for which
``str.isspace()`` is true as whitespace.  Spark's ``trim`` removes only U+0020 and
Java's ``\\s`` is ASCII-only, so the class below expresses the Python set for the
Java regex engine.  Everything stays a JVM expression inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set as a Java regex class body: Unicode
# White_Space plus U+001C..U+001F (checked equal over every code point).  The property
# form matches far faster than an explicit union of ranges.
PY_WS_CHARS = r"\x{1C}-\x{1F}\p{IsWhite_Space}"
PY_WS = f"[{PY_WS_CHARS}]"

_STRIP_RE = f"^{PY_WS}+|{PY_WS}+$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: Column | str) -> Column:
    """``s.strip()`` with Python's whitespace set."""
    return F.regexp_replace(col_of(c), _STRIP_RE, "")


def blank_to_null(c: Column | str) -> Column:
    """Python truthiness of a string: NULL and '' are both 'missing'."""
    return F.nullif(col_of(c), F.lit(""))


def literal_map(mapping: dict[str, str]) -> Column:
    """A constant ``map<string,string>`` (constant-folded by Catalyst)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)
