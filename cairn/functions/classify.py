"""Ordered rule classification (CASE WHEN chains) as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Referrer rules, evaluated in this order; the first pattern that
# matches (SQL LIKE '%pattern%') names the source. The literal rules are kept
# as written, so 't.co' also matches 'pinterest.com' (documented quirk).
REFERRER_RULES: tuple[tuple[str, str], ...] = (
    ("linkedin", "Linkedin"),
    ("t.co", "Twitter"),
    ("google", "Google"),
    ("lnkd", "Linkedin"),
)
# Our own site's hosts count as 'On Site'; a parameter, this is the default.
ON_SITE_PATTERNS: tuple[str, ...] = ("example.org",)


def threshold_class(value: Column, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """``value > t1 -> c1, value > t2 -> c2, ... else default`` (first match wins)."""
    expr = None
    for t, label in thresholds:
        expr = F.when(value > F.lit(t), F.lit(label)) if expr is None else expr.when(value > F.lit(t), F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def _host_match(host: Column, pattern: str) -> Column:
    """``pattern`` is the host, a parent domain of it, or one of its labels."""
    return ((host == pattern) | host.endswith("." + pattern) | host.startswith(pattern + ".")
            | host.contains("." + pattern + "."))


def classify_referrer(ref: Column, rules: Sequence[tuple[str, str]] = REFERRER_RULES,
                      on_site: Sequence[str] = ON_SITE_PATTERNS, match: str = "like") -> Column:
    """First matching rule names the referrer, else the raw value.

    ``match='like'``: ``LIKE '%pattern%'`` on the whole URL (the original rule);
    ``match='host'``: the pattern must match whole labels of the URL's host."""
    all_rules = list(rules) + [(p, "On Site") for p in on_site]
    host = F.lower(F.try_parse_url(ref, F.lit("HOST")))   # a malformed URL gives NULL
    expr = None
    for pattern, label in all_rules:
        cond = _host_match(host, pattern) if match == "host" else ref.like(f"%{pattern}%")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(ref) if expr is not None else ref


def referrer_case_sql(col: str = "referrer", rules=REFERRER_RULES, on_site=ON_SITE_PATTERNS) -> str:
    """The same rule chain as SQL text (used by the SQL oracles)."""
    parts = [f"WHEN {col} LIKE '%{p}%' THEN '{label}'" for p, label in rules]
    parts += [f"WHEN {col} LIKE '%{p}%' THEN 'On Site'" for p in on_site]
    return "CASE " + " ".join(parts) + f" ELSE {col} END"
