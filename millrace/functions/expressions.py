"""Column expressions: identities and scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which stands in the expression once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normal_text(c: Column) -> Column:
    """Lower case without blanks, punctuation and symbols; null gives ''."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[\s\p{P}\p{S}]+", "")


def canonical_name(name: Column) -> Column:
    """Letters and digits of a name in lower case, a leading listing mark aside."""
    return normal_text(F.regexp_replace(name, r"(?i)^S?\*?ST(?=[^a-z])", ""))


def stable_id(*parts: Column, length: int = 20) -> Column:
    """Hex prefix of the SHA-256 of the parts, NUL between them."""
    joined = F.concat_ws("\x00", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, length)


def age_days(later: Column, earlier: Column) -> Column:
    """Whole days between two instants, by elapsed time."""
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / 86_400_000_000)


def freshness(days: Column) -> Column:
    return F.when(days.isNull(), 82).when(days <= 7, 98).when(days <= 30, 95).when(days <= 180, 86).otherwise(68)


def suffixes(hostname: Column) -> Column:
    """A host and its parent domains of two labels and more."""
    labels = F.split(hostname, r"\.")
    return F.when(F.size(labels) < 2, F.array(hostname)).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")))
