"""Row predicates: valid gift trades and traffic-source definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_trades(status="trade_status", room="room_id", product="product_name", item="item_id",
                 product_value: str = "platform") -> Column:
    """A completed platform gift trade: status 1, positive room and item, platform product."""
    return ((F.col(status) == 1) & (F.col(room) > 0) & (F.col(product) == product_value)
            & (F.col(item) > 0))


@dataclass(frozen=True)
class Source:
    """A named traffic source: a boolean condition on page-view columns.

    The three shapes used by the reports are built with the class methods; the
    regexes are the caller's (dots are wildcards, as in any regex search).
    """

    name: str
    condition: Column

    @classmethod
    def referrer_and_landing(cls, name, referrer_re, landing_re, referrer="source_url", url="url"):
        return cls(name, F.col(referrer).rlike(referrer_re) & F.col(url).rlike(landing_re))

    @classmethod
    def empty_or_referrer_and_landing(cls, name, referrer_re, landing_re, referrer="source_url",
                                      url="url"):
        # An empty referrer counts as this source; a NULL one does not.
        ref = F.col(referrer)
        return cls(name, ((ref == "") | ref.rlike(referrer_re)) & F.col(url).rlike(landing_re))

    @classmethod
    def tracking_id(cls, name, tid_re, tid="tid"):
        return cls(name, F.col(tid).rlike(tid_re))
