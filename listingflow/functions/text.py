"""Text columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# The white space of Unicode, the non-breaking space included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Asset-type phrases removed from company names, in this order.
ASSET_PHRASES = [
    " ETF Trust",
    " ETF",
    " Units",
    " Unit",
    " Warrants to purchase ",
    " Warrants",
    " Warrant",
    " Rights",
    " Class A Common Stock",
    " Class A Ordinary Shares",
    " Class A Ordinary Share",
    " Subordinate Voting Shares",
    " American Depository Shares",
    " American Depositary Shares",
    " Common Stock",
    " Common Shares",
    " Ordinary Shares",
]

# Punctuation dropped from names before comparing them, and the legal suffixes dropped after that.
_NAME_PUNCTUATION = r"[.,()\\/]"
_LEGAL_SUFFIX = r"(?iU)\slimited$|\sltd|\ssa$|\sa/s$|\sinc$"
_LEGAL_SUFFIX_ANCHORED = r"(?iU)\s(limited|ltd|sa|as|inc)$"

# Characters ignored when two ticker symbols are compared.
_SYMBOL_NOISE = ".'*"


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def extract(value: Column | str, pattern: str, group: int = 1) -> Column:
    """The regex group, null when the pattern does not match (or matches nothing)."""
    return F.nullif(F.regexp_extract(col_of(value), "(?U)" + pattern, group), F.lit(""))


def replace_pattern(value: Column | str, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(col_of(value), "(?U)" + pattern, replacement)


def replace_text(value: Column | str, text: str, replacement: str = "", ignore_case: bool = False) -> Column:
    """Literal replacement."""
    if ignore_case:
        safe = replacement.replace("\\", "\\\\").replace("$", "\\$")
        flags = "(?i)" if text.isascii() else "(?iu)"
        return F.regexp_replace(col_of(value), flags + re.escape(text), safe)
    return F.replace(col_of(value), F.lit(text), F.lit(replacement))


def remove_phrases(value: Column | str, phrases: list[str] = ASSET_PHRASES, ignore_case: bool = True) -> Column:
    """Remove each phrase in turn; the order matters because phrases overlap."""
    return reduce(lambda c, phrase: replace_text(c, phrase, "", ignore_case), phrases, col_of(value))


def strip(value: Column | str) -> Column:
    """Drop outer white space of any kind, the non-breaking space included."""
    return F.trim(col_of(value), F.lit(WHITE_SPACE))


def blank_to_null(value: Column | str) -> Column:
    c = col_of(value)
    return F.when(strip(c) != "", c)


def null_if_in(value: Column | str, placeholders: list[str]) -> Column:
    c = col_of(value)
    return F.when(~c.isin(placeholders), c)


def truncate(value: Column | str, length: int) -> Column:
    return F.substring(col_of(value), 1, length)


def concat_blank(*values: Column | str) -> Column:
    """Concatenate, reading null as the empty text."""
    return F.concat(*[F.coalesce(col_of(v), F.lit("")) for v in values])


def normalise_company(value: Column | str, strict: bool = False) -> Column:
    """The name form used to match companies.

    The default also removes `` ltd`` in the middle of a name, as the ledgers already written by earlier runs expect;
    ``strict`` removes suffixes only at the end.
    """
    bare = F.regexp_replace(F.lower(col_of(value)), _NAME_PUNCTUATION, "")
    return strip(F.regexp_replace(bare, _LEGAL_SUFFIX_ANCHORED if strict else _LEGAL_SUFFIX, ""))


def clean_symbol(value: Column | str) -> Column:
    return reduce(lambda c, sign: F.replace(c, F.lit(sign), F.lit("")), _SYMBOL_NOISE, col_of(value))


def join_list(value: Column | str, separator: str = ", ") -> Column:
    return F.array_join(col_of(value), separator)


# --- predicates: a null value is "no match", never "unknown" -----------------------------------------------------


def contains(value: Column | str, text: str) -> Column:
    return F.coalesce(col_of(value).contains(text), F.lit(False))


def starts_with(value: Column | str, text: str) -> Column:
    return F.coalesce(col_of(value).startswith(text), F.lit(False))


def contains_any(value: Column | str, texts: list[str], ignore_case: bool = False) -> Column:
    pattern = ("(?iu)" if ignore_case else "") + "|".join(re.escape(t) for t in texts)
    return F.coalesce(col_of(value).rlike(pattern), F.lit(False))


def is_not(value: Column | str, other) -> Column:
    """``value != other`` that keeps rows where the value is null."""
    return ~col_of(value).eqNullSafe(F.lit(other) if not isinstance(other, Column) else other)


def differs_or_missing(internal: Column | str, external: Column | str) -> Column:
    """The internal value is absent or not equal to the external one; an absent external value alone is no difference."""
    left, right = col_of(internal), col_of(external)
    return F.coalesce(left != right, F.lit(False)) | left.isNull()
