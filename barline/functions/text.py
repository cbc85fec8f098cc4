"""Text for display: one line, bounded, safe inside HTML."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def one_line(text: Column, limit: int | None = None) -> Column:
    """text with runs of white space as one blank; longer than limit, it ends in an ellipsis."""
    out = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    if limit is None:
        return out
    return F.when(F.length(out) > limit, F.concat(F.rtrim(F.substring(out, 1, limit - 1)), F.lit("…"))).otherwise(out)


def html_escaped(text: Column) -> Column:
    out = text
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def safe_url(url: Column) -> Column:
    """The address if it is one of the web, escaped; else null."""
    return F.when(url.rlike("^https?://[^ ]+$"), html_escaped(url))
