"""Column expressions for cleaning and parsing violation records.

All of them are built-in Spark expressions (JVM-side, codegen'd). Spark 4
runs with ANSI on, so every cast that can fail is a ``try_`` form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour: a fine is valid
# only when it matches this pattern (no sign, no exponent); timestamps are
# tried in this order, so dd/MM wins over MM/dd; these severities count as
# severe.
FINE_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
ISO_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm:ss")
SEVERE_LEVELS = ("High", "Severe", "Critical")
#: Largest absolute latitude and longitude; other numbers are no coordinates.
COORDINATE_LIMITS = (90.0, 180.0)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    """Trim spaces at both ends."""
    return F.trim(_c(c))


def fine_amount(c) -> Column:
    """Strict fine parse (P2): plain non-negative decimal text, else null."""
    c = _c(c)
    return F.when(c.rlike(FINE_PATTERN), c.try_cast("double"))


def lenient_double(c) -> Column:
    """Lenient numeric coercion (P3): signs and exponents accepted, bad -> null."""
    return F.trim(_c(c)).try_cast("double")


def parse_ts(c, formats: Sequence[str] | None = TIMESTAMP_FORMATS) -> Column:
    """First format that parses wins (P4/P5); ``None`` = Spark's default parse.

    The result is a wall-clock ``timestamp_ntz``, so it does not shift with the
    session time zone.
    """
    c = _c(c)
    if formats is None:
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    parsed = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]
    first = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    return first.cast("timestamp_ntz")


def coordinate(c, index: int) -> Column:
    """Part ``index`` of ``"lat,lon"`` text as double.

    Null when absent, not a number, not finite or out of range.
    """
    value = F.trim(F.get(F.split(_c(c), ","), index)).try_cast("double")
    return F.when(F.abs(value) <= COORDINATE_LIMITS[index], value)


def grid_cell(c, size: float, mode: str = "trunc") -> Column:
    """Grid cell of a coordinate (P10).

    ``trunc`` keeps the reference rule (cast to int truncates toward zero, so
    the cell around 0 is twice as wide); ``floor`` gives equal-width cells.
    """
    ratio = _c(c) / F.lit(float(size))
    if mode == "trunc":
        whole = F.when(ratio < 0, F.ceil(ratio)).otherwise(F.floor(ratio))
    elif mode == "floor":
        whole = F.floor(ratio)
    else:
        raise ValueError(f"unknown grid mode {mode!r}")
    return (whole * F.lit(float(size))).cast("double")


def title_case(c) -> Column:
    """Trim, lower-case, then capitalise each run of letters (P11): ``red-light`` gives ``Red-Light``."""
    text = F.lower(F.trim(_c(c)))
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    capital = F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
    # plain words, the usual case, need no runs: initcap capitalises after blanks
    return F.when(text.rlike("^[a-z ]*$"), F.initcap(text)).otherwise(F.array_join(capital, ""))


def is_severe(c, levels: Sequence[str] = SEVERE_LEVELS) -> Column:
    """Severity in the severe list."""
    return _c(c).isin(list(levels))
