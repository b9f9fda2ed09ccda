"""Marketing channel of a visit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Medium -> channel.
MEDIUM_CHANNEL = {
    "cpc": "paid_search",
    "ppc": "paid_search",
    "paid_search": "paid_search",
    "paid_social": "paid_social",
    "social": "organic_social",
    "email": "email",
    "organic": "organic_search",
    "referral": "referral",
}


def channel(medium: Column, source: Column) -> Column:
    """A known medium decides; with neither medium nor source the visit is direct."""
    known = F.create_map(*[F.lit(x) for pair in MEDIUM_CHANNEL.items() for x in pair])
    unknown = F.when(medium.isNull() & source.isNull(), "direct").otherwise("other")
    return F.coalesce(F.element_at(known, medium), unknown)
