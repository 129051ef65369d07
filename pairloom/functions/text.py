"""Text and value expressions; every one compiles to JVM-side Catalyst expressions.

``as_text`` and ``falsy`` depend on the column's type, which is known when the plan is built, so
they take the data type as an argument instead of testing it per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

# --- Fixed values -----------------------------------------------------------------------------
# The characters Python's str.split() treats as whitespace, as inclusive code point ranges.
WHITESPACE_RANGES = (
    (0x0009, 0x000D),
    (0x001C, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
# Curly quotes and the straight ones that replace them.
CURLY_QUOTES = "“”‘’"
STRAIGHT_QUOTES = "\"\"''"
# Prompt template: header, instruction, separator, response.
PROMPT_HEAD = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n"
)
PROMPT_MIDDLE = "\n\n### Response:\n"
# What the template shows for a missing value.
PROMPT_MISSING = "None"
# ----------------------------------------------------------------------------------------------

WHITESPACE = "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))

# Above this code point lie all curly quotes and the whitespace of other scripts.
_HIGH_FROM = 0x1680
_HIGH = f"[^\\x{{0}}-\\x{{{_HIGH_FROM - 1:x}}}]"
_VISIBLE = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"
# Listed one by one: Java looks up single low characters in a table but tries ranges in turn.
_LOW_WHITESPACE = (
    "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE if c != " " and ord(c) < _HIGH_FROM) + "]"
)


def as_text(col: Column | str, dtype: T.DataType) -> Column:
    """The string itself, or ``''`` for null and for anything that is not a string.

    Numbers, booleans and nested values are not converted to text. A variant column is tested per
    row, since each of its values has its own type.
    """
    col = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.StringType):
        return F.coalesce(col, F.lit(""))
    if isinstance(dtype, T.VariantType):
        is_string = F.schema_of_variant(col) == "STRING"
        return F.coalesce(F.when(is_string, F.try_variant_get(col, "$", "string")), F.lit(""))
    return F.lit("")


def collapse_whitespace(col: Column | str) -> Column:
    """Trim, and turn every run of Unicode whitespace into one space."""
    return _squeeze(_replace_chars(col, WHITESPACE, " " * len(WHITESPACE)))


def straighten_quotes(col: Column | str) -> Column:
    """Curly quotes to straight ones. ``translate`` looks up every character, so it is left to the
    texts that have any; a byte search for the four quotes costs next to nothing."""
    col = F.col(col) if isinstance(col, str) else col
    has_any = reduce(Column.__or__, [F.contains(col, F.lit(q)) for q in CURLY_QUOTES])
    return F.when(has_any, F.translate(col, CURLY_QUOTES, STRAIGHT_QUOTES)).otherwise(col)


def clean_text(col: Column | str) -> Column:
    """``collapse_whitespace`` and ``straighten_quotes`` in one go; null is ``''``.

    The two act on different characters, so the order does not matter.
    """
    plain = _replace_chars(
        col, WHITESPACE + CURLY_QUOTES, " " * len(WHITESPACE) + STRAIGHT_QUOTES
    )
    return F.coalesce(_squeeze(plain), F.lit(""))


def _replace_chars(col: Column | str, old: str, new: str) -> Column:
    """Whitespace to spaces, and quotes if ``old`` has them; runs of spaces may remain.

    ``translate`` covers all of it but looks up every character. Texts without any high character,
    which ASCII texts are by their length alone, need only the low whitespace replaced, and for
    that a regex over one small class takes half the time.
    """
    col = F.col(col) if isinstance(col, str) else col
    no_high = (F.octet_length(col) == F.length(col)) | ~col.rlike(_HIGH)
    low = F.regexp_replace(col, _LOW_WHITESPACE + "+", " ")
    return F.when(no_high, low).otherwise(F.translate(col, old, new))


def _squeeze(col: Column) -> Column:
    squeezed = F.regexp_replace(col, "  +", " ")
    return F.trim(F.when(F.contains(col, F.lit("  ")), squeezed).otherwise(col))


def has_visible_text(col: Column | str) -> Column:
    """True where ``clean_text`` is not empty, without cleaning: the search stops at the first
    character that is not whitespace."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.rlike(_VISIBLE), F.lit(False))


def falsy(col: Column | str, dtype: T.DataType) -> Column:
    """Python's ``not value``: null, ``''``, zero, false and empty collections.

    Of a variant each value has its own type: the text ``"0"`` is not falsy, the number is.
    """
    col = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.BooleanType):
        empty = ~col
    elif isinstance(dtype, T.NumericType):
        empty = col == 0
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        empty = F.length(col) == 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        empty = F.size(col) == 0
    elif isinstance(dtype, T.VariantType):
        shown = F.try_variant_get(col, "$", "string")
        looks = shown.isin("false", "[]", "{}") | (shown.try_cast("double") == 0)
        # Only what looks falsy is asked for its type, which for a large value takes a walk through it.
        empty = F.when(shown == "", True).when(looks, F.schema_of_variant(col) != "STRING")
        empty = F.is_variant_null(col) | F.coalesce(empty, F.lit(False))
    else:
        empty = F.lit(False)
    return col.isNull() | F.coalesce(empty, F.lit(False))


def render_prompt(instruction: Column | str, response: Column | str) -> Column:
    """Training text of one pair; no trailing newline is added."""
    return F.concat(
        F.lit(PROMPT_HEAD),
        F.coalesce(instruction, F.lit(PROMPT_MISSING)),
        F.lit(PROMPT_MIDDLE),
        F.coalesce(response, F.lit(PROMPT_MISSING)),
    )
