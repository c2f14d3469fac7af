"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leavewatch import fixed_values as fixed


def cleaned_artist(artist: Column) -> Column:
    """Blank out every character that is not an ASCII letter or digit."""
    return F.regexp_replace(artist, fixed.ARTIST_NOISE, " ")


def cleaned_user_agent(agent: Column) -> Column:
    """Reduce a browser string to lower-case words.

    Each run of other characters becomes one blank. The last pass does not
    overlap: of two single letters in a row only the first goes, and a single
    letter at either end stays.
    """
    words = F.trim(F.lower(F.regexp_replace(agent, fixed.AGENT_NOISE, " ")))
    return F.regexp_replace(words, fixed.LONE_LETTER, " ")


def user_key_by_path(line: Column) -> Column:
    """User id of a raw JSON line, by JSON path."""
    return F.get_json_object(line, "$.userId")


def user_key_by_pattern(line: Column) -> Column:
    """User id of a raw JSON line, by pattern; null when the key is absent.

    Cheaper than parsing, and right only while ids hold no escaped quotes.
    """
    found = F.regexp_extract(line, fixed.USER_KEY_IN_LINE, 1)
    return F.when(F.regexp_like(line, F.lit(fixed.USER_KEY_IN_LINE)), found)
