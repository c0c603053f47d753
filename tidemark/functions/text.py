"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An HTML tag, and runs of line breaks.
TAG = r"<[^>]*>"
LINE_BREAKS = r"[\r\n]+"


def strip_tags(html: Column) -> Column:
    """HTML without tags, every run of line breaks replaced by one blank."""
    return F.regexp_replace(F.regexp_replace(html, TAG, ""), LINE_BREAKS, " ")


def contains_pattern(needle: Column) -> Column:
    """``%needle%`` for a LIKE test; wildcards inside the needle stay wildcards."""
    return F.concat(F.lit("%"), needle, F.lit("%"))
