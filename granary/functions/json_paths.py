"""Lookups in JSON text with a default."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_or_default(c: Column, path: str, default: Any, data_type: str = "string") -> Column:
    """Value at ``path`` as ``data_type``; ``default`` when absent, null or malformed."""
    found = F.get_json_object(c, path).try_cast(data_type)
    return F.coalesce(found, F.lit(default).cast(data_type))


def estimated_recipients(c: Column) -> Column:
    """Recipient estimate of a campaign response document."""
    return path_or_default(c, "$.data.attributes.estimated_recipient_count", 0, "bigint")


def html_template(c: Column) -> Column:
    """Markup of a message template response document, null when there is none."""
    return F.get_json_object(c, "$.data.attributes.html")
