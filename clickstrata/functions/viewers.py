"""Device type and visitor key of a request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Viewer headers in the order in which they are tried.
VIEWER_HEADERS = (
    ("CloudFront-Is-Mobile-Viewer", "mobile"),
    ("CloudFront-Is-Desktop-Viewer", "desktop"),
    ("CloudFront-Is-SmartTV-Viewer", "smarttv"),
    ("CloudFront-Is-Tablet-Viewer", "tablet"),
)
UNKNOWN_DEVICE = "unknown"


def device_type(headers: Column) -> Column:
    """The first viewer header that says exactly ``true``, else ``unknown``."""
    found = [
        F.when(F.try_element_at(headers, F.lit(header)) == "true", F.lit(device))
        for header, device in VIEWER_HEADERS
    ]
    return F.coalesce(*found, F.lit(UNKNOWN_DEVICE))


def fingerprint(address: Column, agent: Column) -> Column:
    """Pseudonymous visitor key: md5 of address and agent without a separator."""
    return F.md5(F.concat(address, agent).cast("binary"))
