"""Platform, category and competitor labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import refdata
from .sqltext import listed, quote, stripped


def canonical_platform(
    source: str,
    allowed: list[str] = refdata.PLATFORMS,
    vendor_aliases: list[str] = refdata.VENDOR_ALIASES,
) -> Column:
    """One of the allowed platforms; the first matching rule decides."""
    p = stripped(f"lower(coalesce({source}, ''))")
    return F.expr(
        f"""CASE
            WHEN contains({p}, 'reddit') THEN 'reddit'
            WHEN contains({p}, 'hacker') OR {p} = 'hn' THEN 'hackernews'
            WHEN contains({p}, 'stack') OR {p} = 'so' THEN 'stackoverflow'
            WHEN {p} IN ('twitter', 'x.com', 'x') THEN 'x'
            WHEN {p} IN ('bsky', 'bluesky') THEN 'bluesky'
            WHEN contains({p}, 'vendor') OR contains({p}, 'repost') OR contains({p}, 're:post')
              OR {p} IN ({listed(vendor_aliases)}) THEN {quote(refdata.VENDOR_PLATFORM)}
            WHEN {p} IN ({listed(allowed)}) THEN {p}
            ELSE 'other' END"""
    )


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def known_categories(source: str, allowed: list[str] = refdata.CATEGORIES) -> Column:
    """Categories of the taxonomy, in their order, repeats kept."""
    return F.expr(f"filter(coalesce({source}, array()), x -> x IN ({listed(allowed)}))")


def canonical_competitors(source: str, names: list[str] = refdata.COMPETITORS) -> Column:
    """Known competitors in canonical spelling, each once, in order of first mention."""
    rules = " ".join(f"WHEN {quote(n.lower())} THEN {quote(n)}" for n in names)
    return F.expr(
        f"""array_distinct(array_compact(transform(coalesce({source}, array()),
            x -> CASE lower({stripped('x')}) {rules} END)))"""
    )


def has_competitor(c: Column) -> Column:
    return F.size(or_empty(c)) > 0
