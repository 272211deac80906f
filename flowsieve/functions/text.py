"""String column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separator controls that Python's str.strip also removes.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip_whitespace(column: Column | str) -> Column:
    """Remove every kind of white space from both ends."""
    return F.regexp_replace(column, _EDGE_SPACE, "")


def contains_ignore_case(column: Column | str, needle: str) -> Column:
    """Case-insensitive literal substring test; null counts as no match."""
    text = F.lower(F.col(column) if isinstance(column, str) else column)
    return F.coalesce(F.contains(text, F.lit(needle.lower())), F.lit(False))
