"""Classification and normalisation of names."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of what is no holding; each is matched from the start of the name.
PATTERNS = {
    "balance_sheet": [
        r"(?i)^\s*(?:Net\s+)?Non[- ]?Investments?a?\s+(?:Assets?|Liabilities)",
    ],
    "subtotal": [
        r"(?i)^\s*(?:sub)?total\b.*$",
    ],
    "accounting_entry": [
        r"(?i)^\s*(?:quarterly|annual|cumulative)\s+.*gain\s*/?\s*\(?loss(?:es)?\)?\s*$",
        r"(?i)^\s*(?:quarterly|annual)\s+unrealized\s+gains?\s*/?\s*\(?losses?\)?\s*$",
        r"(?i)^\s*AFS\s+gain\s*/?\s*\(?loss\)?\s*$",
        r"(?i)^\s*annual\s+current\s+cost\s+gain\s*/?\s*\(?loss\)?\s*$",
        r"(?i)^\s*ASC\s*\d+[-\d]*\s+accrual\s*$",
        r"(?i)^\s*tax\s+distributions?\s*$",
        r"(?i)^\s*(?:cumulative\s+)?(?:unrealized\s+)?(?:gain|loss)?\s*.{0,20}foreign\s+currency\s+translation.*$",
        r"(?i)^\s*foreign\s+currency\s+translation\s*$",
        r"(?i)^\s*(?:idle\s+)?cash(?:\s+and\s+cash\s+equivalents)?\.?\s*$",
        r"(?i)^\s*pending\s+escrow\s*$",
        r"(?i)^\s*.*transfer\s+receivable\s*$",
        r"(?i)^\s*realized\s+proceeds\s+applied\s+to\s+loan\s+repayment\s*$",
    ],
    "unnamed_aggregate": [
        r"(?i)^\s*other\b.*$",
        r"(?i)^\s*.*\bseed\s+(?:investments?|deals?)\s*$",
        r"(?i)^\s*seed\s+\d{4}[-\w]*\s*$",
        r"(?i)^\s*(?:active|realized)\s+seed\s+deals\s*$",
        r"(?i)^\s*diversified\s+credit\s*$",
        r"(?i)^\s*residential\s*$",
        r"(?i)^\s*commercial\s+real\s+estate\s+debt\s*&\s*equity\s+securities\s*$",
        r"(?i)^\s*(?:realized\s+)?fund\s+investments?\s*$",
        r"(?i)^\s*passive\s+investments?\s*$",
        r"(?i)^\s*passive\s*/\s*quickstart\s+and\s+seed\s+investments?\s*$",
        r"(?i)^\s*quickstart\s+and\s+seed\s+investments?\s*$",
        r"(?i)^\s*recycled\s+investments?\s*$",
        r"(?i)^\s*secondary\s+market\s+investments?\s*$",
    ],
}
# Each pattern above needs one of these, so that most names are decided by one search.
TRIGGERS = r"(?i)non[- ]?inv|total|gain|accrual|tax|foreign|cash|escrow|receivable|loan|other|seed|diversified|residential|commercial|fund|passive|recycled|secondary"
# Names to review, the prefix that an earlier rule went by, the form of identifiers, and words that names are compared without.
REVIEW = r"(?i)^\s*(?:edge|hero|thales|greylock\s+scout)\s+investments?\s*$"
PREFIX_ONLY = r"(?i)^(?:Net\s+)?Non[- ]?Investments?a?\s+(?:Assets|Liabilities)"
ID_SHAPE = r"^[0-9A-Za-z]{6,8}$"
SUFFIXES = r"\b(inc|inc\.|incorporated|llc|l\.l\.c|ltd|ltd\.|limited|corp|corp\.|corporation|co|co\.|company|lp|l\.p|llp|plc|holdings?|group|gmbh|s\.a|sa|nv|bv|pte|pty|ag|ab|oy|technologies|technology)\b"
MATCH_TOKENS = r"\b(inc|incorporated|ltd|limited|llc|corp|corporation|co|company|dba|the)\b"


#: Character classes of patterns mean all of Unicode, as a no-break space is a blank in a name too. Spark's dialect only.
WIDE = "(?U)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def truthy(condition: Column) -> Column:
    """condition with null as false: what a comparison with a missing value means here."""
    return F.coalesce(condition, F.lit(False))


def source_asset_class(name: Column) -> Column:
    """First class whose pattern matches; a null or blank name is an accounting entry."""
    out = F.when(name.isNull() | ~name.rlike(WIDE + r"\S"), "accounting_entry").when(~name.rlike(TRIGGERS), "holding")
    for kind, patterns in PATTERNS.items():
        out = out.when(reduce(or_, [name.rlike(WIDE + p) for p in patterns]), kind)
    return out.otherwise("holding")


def needs_review(name: Column) -> Column:
    return truthy(name.rlike("(?i)investment") & name.rlike(WIDE + REVIEW))


def malformed(identifier: Column) -> Column:
    """Present, but not of the shape of an identifier."""
    return truthy(~identifier.rlike(ID_SHAPE))


def norm_name(name: Column) -> Column:
    """Lower case without parentheses, punctuation and legal suffixes."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(name), r"\(.*?\)", " "), r"[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, SUFFIXES, " "), r"\s+", " "))


def match_name(name: Column) -> Column:
    """Lower case without a few marks and company words; other punctuation stays."""
    plain = F.regexp_replace(F.lower(name), r"""["'().,]""", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, MATCH_TOKENS, " "), WIDE + r"\s+", " "))


def sorted_tokens(name: Column) -> Column:
    return F.array_join(F.sort_array(F.split(name, " ")), " ")
