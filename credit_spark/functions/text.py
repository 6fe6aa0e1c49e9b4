"""String cleaning as built-in Column expressions (no Python UDFs).

Each function takes and returns a ``Column`` so that it stays inside
whole-stage codegen and composes into one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import GENDER_MAP, MISSING_LABEL, NA_TOKENS

# A plain decimal or scientific number with optional sign and surrounding
# whitespace; the number itself is group 1. Text outside this shape (``nan``,
# ``inf``, ``1_000``, ``1.0d``) is treated as not a number, identically in Spark
# and DuckDB. ``$`` would also match before a line separator that isn't ``\s``.
NUMBER_PATTERN = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*\z"

# Runs of letters and runs of non-letters.
_WORD_RUNS = r"(\p{L}+|[^\p{L}]+)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing whitespace of every kind (tabs too);
    ``trim`` removes spaces only."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def na_to_null(c) -> Column:
    """Map the text tokens a CSV reader treats as missing to NULL."""
    c = _c(c)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def title_case(c) -> Column:
    """Title case where a letter after any non-letter is capitalised
    (``self-employed`` → ``Self-Employed``, ``3rd`` → ``3Rd``); unlike
    ``initcap``, which only capitalises after spaces."""
    runs = F.regexp_extract_all(_c(c), F.lit(_WORD_RUNS), 1)
    cased = F.transform(runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))),
                                                 F.lower(F.substring(w, 2, 1 << 30))))
    return F.array_join(cased, "")


def clean_category(c, missing_label: str = MISSING_LABEL) -> Column:
    """Title-case then strip; a missing value becomes ``missing_label``."""
    return strip(title_case(F.coalesce(_c(c), F.lit(missing_label.lower()))))


def clean_gender(c) -> Column:
    """Lower-case, strip and map m/male/f/female; anything else is NULL."""
    key = F.lower(strip(F.coalesce(_c(c), F.lit("nan"))))
    return F.element_at(F.create_map(*[F.lit(x) for kv in GENDER_MAP.items() for x in kv]), key)


def parse_number(c) -> Column:
    """Text to DOUBLE when it has the shape of a number, else NULL.

    One regex, and ``c`` is named once: what is named twice is planned, compiled and often run twice."""
    return F.regexp_extract(_c(c), NUMBER_PATTERN, 1).try_cast("double")


def numeric_text(c, strict: bool = False) -> Column:
    """The numeric-text rule: delete every ``.0.0`` then every ``.0`` and
    parse. So ``303200.0.0`` → 303200 and ``58.0`` → 58, but also
    ``1234.05`` → 12345 and ``3.00`` → 30, as in the original rule.
    ``strict=True`` removes only trailing ``(.0+)+`` groups instead."""
    c = _c(c).cast("string")
    if strict:
        text = F.regexp_replace(c, r"(\.0+)+(\s*)$", "$2")
    else:
        text = F.replace(F.replace(c, F.lit(".0.0"), F.lit("")), F.lit(".0"), F.lit(""))
    return parse_number(text)


def numeric_value(c, dtype) -> Column:
    """Numeric-text rule for STRING columns; plain DOUBLE cast for columns
    that are already numeric (never format a double as text first:
    Spark prints ``1.0E7``)."""
    from pyspark.sql.types import StringType
    if isinstance(dtype, StringType):
        return numeric_text(c)
    return _c(c).cast("double")


def extract_age(c) -> Column:
    """First run of digits as a number (the sign is lost: ``-5`` → 5);
    no digits → NULL."""
    return F.regexp_extract(_c(c), r"(\d+)", 1).try_cast("double")


def comma_number(c) -> Column:
    """Remove thousands separators, strip, parse."""
    return parse_number(F.replace(_c(c).cast("string"), F.lit(","), F.lit("")))


def before_dot(c) -> Column:
    """Text before the first ``.``, parsed as a number."""
    return parse_number(F.split_part(_c(c).cast("string"), F.lit("."), F.lit(1)))


def coerce_number(c) -> Column:
    """Plain coercion: a number or NULL."""
    return parse_number(_c(c).cast("string"))


def badge(c) -> Column:
    """Display label of a predicted class; unknown labels pass through."""
    from ..schema import BADGES
    m = F.create_map(*[F.lit(x) for kv in BADGES.items() for x in kv])
    return F.coalesce(F.element_at(m, _c(c)), _c(c))


def money(c) -> Column:
    """``₹ 1,234.56`` display text."""
    return F.concat(F.lit("₹ "), F.format_number(_c(c), 2))
