"""Text column functions: punctuation stripping, cleaning, tokens, n-grams.

All are native Spark SQL expressions (whole-stage codegen, no Python worker).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (behaviour that must match the reference):
# - the punctuation stripper deletes every character that is neither a word
#   character nor white space in Python's Unicode sense; combining marks are not
#   word characters there, and Python also counts \x1c-\x1f as white space.
STRIP_CLASS = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"
# - Python's str.strip() white space (Unicode White_Space plus \x1c-\x1f)
PY_SPACE = r"[\s\x1c-\x1f]"
# - the header of an extracted article block
DOC_OPEN_TAG = r"<doc [^>]*>"
# - tokenizer splits on each Java white-space char (no Unicode flag)
TOKEN_SPLIT = r"\s"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_punctuation(c) -> Column:
    """FEA-1: delete every char that is neither a word char nor white space."""
    return F.regexp_replace(_c(c), STRIP_CLASS, "")


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode white space."""
    return F.regexp_replace(_c(c), rf"(?U)^{PY_SPACE}+|{PY_SPACE}+$", "")


def clean_article(c) -> Column:
    """FEA-2: trim, delete ``<doc …>`` headers, then strip punctuation."""
    return strip_punctuation(F.regexp_replace(py_strip(c), DOC_OPEN_TAG, ""))


def tokenize(c) -> Column:
    """FEA-3: lower-case, split at each white-space char.

    Same result as ``ml.feature.Tokenizer`` (Java ``String.split``): empty tokens
    at the start and inside are kept, trailing ones dropped; ``''`` gives
    ``['']`` and an all-blank text gives ``[]``.
    """
    low = F.lower(_c(c))
    return (F.when(low == "", F.array(F.lit("")))
            .when(low.rlike(r"^\s+$"), F.array().cast("array<string>"))
            .otherwise(F.split(F.regexp_replace(low, r"\s+$", ""), TOKEN_SPLIT)))


def drop_empty_tokens(tokens) -> Column:
    """Q4 option ``drop_empty``: remove '' tokens."""
    return F.filter(_c(tokens), lambda t: t != "")


def ngrams(tokens, n: int) -> Column:
    """FEA-4: n consecutive tokens joined by a blank; too short -> empty list.

    Built from ``n`` shifted slices zipped together, so the lambda never refers
    to the outer array (an outer reference would be re-evaluated per element
    once Catalyst inlines the token expression)."""
    w = _c(tokens)
    length = F.greatest(F.size(w) - n + 1, F.lit(0))
    zipped = F.arrays_zip(*[F.slice(w, k + 1, length) for k in range(n)])
    grams = F.transform(zipped, lambda s: F.concat_ws(" ", *[s[str(k)] for k in range(n)]))
    return F.when(F.size(w) >= n, grams).otherwise(F.array().cast("array<string>"))


def explode_terms(c) -> Column:
    """``explode`` for token arrays, written as ``explode_outer`` + a later
    null filter (see :func:`kiln.operators.features.term_occurrences`): an
    inner explode makes Catalyst infer a ``size(arr) > 0`` filter that is pushed
    below the projection and evaluates the whole token expression twice."""
    return F.explode_outer(_c(c))


def is_wiki_text_line(c) -> Column:
    """FLT-1: not blank, not a ``<doc…>`` header, not ``</doc>``."""
    line = _c(c)
    return (line.rlike(r"(?U)[^\s\x1c-\x1f]")
            & ~line.rlike(r"(?U)^[\s\x1c-\x1f]*(<doc.*>|</doc>)[\s\x1c-\x1f]*$"))


def is_article_text_line(c) -> Column:
    """FLT-2: not blank and not a ``====`` section header."""
    line = _c(c)
    return (line.rlike(r"(?U)[^\s\x1c-\x1f]")
            & ~line.rlike(r"(?U)^[\s\x1c-\x1f]*===="))


def lines_of(c) -> Column:
    """Split a text into its lines (LF or CRLF)."""
    return F.split(_c(c), r"\r?\n")
