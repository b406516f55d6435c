"""Listing identity: listing id from a URL, absolute URLs for relative links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# Lower-case 8-4-4-4-12 hex UUID; the site root prefixed to relative links.
LISTING_ID_PATTERN = r"([a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12})"
SITE_ROOT = "https://theprotocol.it"


def listing_id(url: Column | str) -> Column:
    """First lower-case UUID in the URL, else NULL."""
    return F.nullif(F.regexp_extract(col_of(url), LISTING_ID_PATTERN, 1), F.lit(""))


def absolute_url(href: Column | str, site_root: str = SITE_ROOT) -> Column:
    """Prefix the site root to a non-empty href that does not start with 'http'."""
    h = col_of(href)
    return F.when((h != "") & ~h.startswith("http"), F.concat(F.lit(site_root), h)).otherwise(h)
