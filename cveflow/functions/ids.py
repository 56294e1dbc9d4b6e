"""Advisory identifiers: normalising, validating and picking them out of lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The strict form is for key columns, the loose one for items inside lists.
CVE_ID = r"^CVE-\d{4}-\d{4,}$"
CVE_IN_LIST = r"^CVE-[0-9]{4}-[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def is_valid(c: Column | str) -> Column:
    c = _col(c)
    return c.isNotNull() & c.rlike(CVE_ID)


def keep_cves(arr: Column | str) -> Column:
    """Items that are ids as they stand: no trimming, no upper-casing."""
    return F.filter(_col(arr), lambda item: item.rlike(CVE_IN_LIST))


def extract_list(c: Column | str, sep: str = ";") -> Column:
    return keep_cves(F.split(_col(c), re.escape(sep)))
