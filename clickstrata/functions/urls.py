"""Expressions on page addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the website marks its pages and its visitors.
FACEBOOK_MARK = "fbclid="
MOTION_PATH = "visa-motion/"
MOTION_PARAMETER = "?motion="
EMBEDDED_PAGE = "about:srcdoc"

# What counts as a number: surrounding blanks, a sign, a fraction, an exponent or infinity.
NUMERIC_TEXT = r"(?i)^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)\s*$"


def clean_url(url: Column) -> Column:
    """The address without its query and fragment."""
    return F.substring_index(F.substring_index(url, "?", 1), "#", 1)


def from_facebook(url: Column) -> Column:
    """1 when the visitor followed a Facebook link to this page, else 0."""
    return F.coalesce(url.contains(FACEBOOK_MARK).cast("int"), F.lit(0))


def is_motion_page(url: Column) -> Column:
    return url.contains(MOTION_PATH)


def motion_id(url: Column) -> Column:
    """The text after ``?motion=`` up to the first ``&``; not yet checked to be a number."""
    return F.substring_index(F.substring_index(url, "&", 1), MOTION_PARAMETER, -1)


def is_numeric_text(text: Column) -> Column:
    return text.rlike(NUMERIC_TEXT)
