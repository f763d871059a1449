"""Text column functions.

Two rules matter for matching results of the original line-oriented jobs:

* Delimited records are split the way ``String.split(regex)`` splits them in
  Java: trailing empty fields are dropped. Spark's ``split`` keeps them, so we
  strip trailing delimiters first. A record whose wanted field is missing then
  yields null, which the sources treat as malformed.
* The tokenizer is a fixed chain of regular-expression rewrites.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the original jobs' behaviour:
#   markup tag pattern     <[^>]*>
#   non-letter run         [^a-zA-Z]+
#   escaped line break     the two characters backslash, n
#   whitespace delimiter   \s+
TAG_PATTERN = r"<[^>]*>"
NON_LETTERS = r"[^a-zA-Z]+"
ESCAPED_NEWLINE = "\\n"
WHITESPACE = r"\s+"
TAB = "\t"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(value: Column | str, delimiter: str = TAB) -> Column:
    """Split a record on a regex delimiter, dropping trailing empty fields."""
    v = _col(value)
    # \z is the absolute end; a delimiter that already repeats gets no extra
    # quantifier (a nested one would backtrack exponentially).
    trailing = f"(?:{delimiter})\\z" if delimiter.endswith("+") else f"(?:{delimiter})+\\z"
    stripped = F.regexp_replace(v, trailing, "")
    # An all-delimiter record has no fields at all; an empty record has one.
    return F.when((stripped == "") & (v != ""), F.array().cast("array<string>")).otherwise(
        F.split(stripped, delimiter)
    )


def field(parts: Column, i: int) -> Column:
    """Null-safe positional access (null means the record is too short)."""
    return F.get(parts, i)


def clean_words(body: Column | str) -> Column:
    """Tags and escaped line breaks become spaces, non-letters collapse to
    one space, then lower-case and trim."""
    b = _col(body)
    s = F.regexp_replace(b, TAG_PATTERN, " ")
    s = F.replace(s, F.lit(ESCAPED_NEWLINE), F.lit(" "))
    s = F.regexp_replace(s, NON_LETTERS, " ")
    return F.trim(F.lower(s))


def token_array(body: Column | str) -> Column:
    """Words of a body; an empty cleaned body gives one empty word."""
    return F.split(clean_words(body), " ")


def clean_glued(body: Column | str) -> Column:
    """The second tokenizer's cleaning: tags and escaped line breaks are
    removed (gluing the text around them), non-letters become one space,
    lower-case, no trim."""
    b = _col(body)
    s = F.regexp_replace(b, TAG_PATTERN, "")
    s = F.replace(s, F.lit(ESCAPED_NEWLINE), F.lit(""))
    s = F.regexp_replace(s, NON_LETTERS, " ")
    return F.lower(s)


def token_array_glued(body: Column | str) -> Column:
    """Whitespace split of :func:`clean_glued` with trailing empties dropped.

    An empty cleaned body gives one empty word; a body that cleans to spaces
    only gives no words; a leading space gives a leading empty word.
    """
    return split_fields(clean_glued(body), WHITESPACE)
