"""Text cleaning."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import COLUMN_WIDTHS, SANITIZED_LENGTH

# Unicode white space, plus the four separators U+001C..U+001F.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def sanitize(value, max_length: int = SANITIZED_LENGTH) -> Column:
    """Strip white space of every kind at both ends, then cut to a length."""
    return F.left(F.regexp_replace(value, _EDGE_SPACE, ""), F.lit(max_length))


def clip(value, width: int) -> Column:
    """Cut over-long text to the declared width, counted in characters."""
    return F.left(value, F.lit(width))


def clip_columns(df, widths=None):
    """Cut every declared text column of a frame to its width."""
    widths = COLUMN_WIDTHS if widths is None else widths
    return df.withColumns({c: clip(F.col(c), w) for c, w in widths.items() if c in df.columns})
