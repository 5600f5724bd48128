"""Column helpers that built-in functions do not already give."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price bands as (label, lowest price, highest price).
TEN_BANDS = [(f"{low}-{low + 99}", low, low + 100) for low in range(100, 1000, 100)]
HALF_OPEN_BANDS = [("0-50", None, 50), ("50-100", 50, 100), ("100-300", 100, 300), ("300-1000", 300, 1000)]
CLOSED_BANDS = [("0-99", 0, 99), ("100-199", 100, 199), ("200-499", 200, 499), ("500-999", 500, 999)]
TOP_BAND = "1000+"

# Fixed value: characters a message may consist of.
ALLOWED_TEXT = "^[\u4e00-\u9fa5a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)\"]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_band(price, bands: str = "ten") -> Column:
    """Band label of a price; the first matching band wins, everything else is ``1000+``."""
    p = _col(price)
    if bands == "ten":
        rules = [(p < 100, "0-99")] + [(p.between(low, high), label) for label, low, high in TEN_BANDS]
    elif bands == "half_open":
        rules = [((p < high) if low is None else (p >= low) & (p < high), label) for label, low, high in HALF_OPEN_BANDS]
    elif bands == "closed":
        rules = [(p.between(low, high), label) for label, low, high in CLOSED_BANDS]
    else:
        raise ValueError(f"unknown band table {bands!r}")
    chain = reduce(lambda acc, rule: acc.when(*rule), rules[1:], F.when(*rules[0]))
    return chain.otherwise(TOP_BAND)


def safe_ratio(a, b, scale: int, on_zero: float | None = None) -> Column:
    """``a / b`` rounded; null, or ``on_zero``, where ``b`` is zero or missing."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    ratio = F.round(F.try_divide(a, b), scale)
    return ratio if on_zero is None else F.when(F.coalesce(b, F.lit(0.0)) == 0, F.lit(float(on_zero))).otherwise(ratio)


def percent(a, b, scale: int = 4) -> Column:
    return F.round(F.try_divide(_col(a).cast("double"), _col(b).cast("double")) * 100, scale)


def has_keys(json_text, paths: list[str], not_blank: bool = False) -> Column:
    """True where the JSON text holds a value for every path (and, if asked, no blank one)."""
    tests = []
    for path in paths:
        value = F.get_json_object(_col(json_text), f"$.{path}")
        tests.append((F.trim(value) != "") if not_blank else value.isNotNull())
    return F.coalesce(reduce(lambda x, y: x & y, tests), F.lit(False))


def json_text(json, path: str) -> Column:
    return F.get_json_object(_col(json), f"$.{path}")


def safe_number(text, kind: str = "decimal(10,2)") -> Column:
    """Number in the text, null for empty or unreadable text."""
    return _col(text).try_cast(kind)


def clean_id(text) -> Column:
    return F.trim(F.replace(_col(text), F.lit("\n"), F.lit("")))


def last_part(text, sep: str = ",") -> Column:
    return F.element_at(F.split(_col(text), f"[{sep}]"), -1)


def is_blank(text) -> Column:
    t = _col(text)
    return t.isNull() | (F.trim(t) == "")


def allowed_text(text) -> Column:
    """True where the text has only whitelisted letters, digits and marks."""
    return _col(text).rlike(ALLOWED_TEXT)


def half_up(value, scale: int = 3) -> Column:
    return F.round(_col(value), scale)


def row_key(key) -> Column:
    return F.md5(_col(key).cast("string"))


def as_text(value) -> Column:
    return _col(value).cast("string")


def money(value) -> Column:
    """Exact decimal sums leave the library as double, the type reports use."""
    return _col(value).cast("double")
