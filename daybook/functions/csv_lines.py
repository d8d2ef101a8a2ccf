"""Looking at single CSV lines without parsing whole files."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A quoted field: a quote right after a separator (or at the line start), any
# text with doubled quotes inside, and the closing quote.
_QUOTED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
_HEADER_FIELD = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*)'


def _without_quoted(line: Column) -> Column:
    stripped = F.regexp_replace(line, _QUOTED_FIELD, "$1")
    return F.when(F.contains(line, F.lit('"')), stripped).otherwise(line)


def field_count(line: Column) -> Column:
    bare = _without_quoted(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def has_open_quote(line: Column) -> Column:
    """A quoted field starts here and does not end on this line."""
    return F.contains(line, F.lit('"')) & F.regexp_like(_without_quoted(line), F.lit('(^|,)"'))


def header_names(line: Column) -> Column:
    """Column names of a header line, quotes removed, blanks and case kept."""
    line = F.regexp_replace(line, "^﻿", "")
    names = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_HEADER_FIELD), F.lit(1))
    return F.transform(
        names,
        lambda name: F.when(
            F.startswith(name, F.lit('"')),
            F.replace(F.regexp_replace(name, '^"|"$', ""), F.lit('""'), F.lit('"')),
        ).otherwise(name),
    )
