"""Credit arithmetic over the ``credits`` array of a billing-export row.

The per-row credit sums are higher-order functions on the row's own array:
no explode, no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import ROW_DECIMAL, money

# Credit types counted as commitment (CUD) savings.
CUD_CREDIT_TYPES = (
    "COMMITTED_USAGE_DISCOUNT",
    "COMMITTED_USAGE_DISCOUNT_DOLLAR_BASE",
    "FEE_UTILIZATION_OFFSET",
)

# Credit types counted as other savings.
OTHER_CREDIT_TYPES = (
    "CREDIT_TYPE_UNSPECIFIED",
    "PROMOTION",
    "SUSTAINED_USAGE_DISCOUNT",
    "DISCOUNT",
    "FREE_TIER",
    "SUBSCRIPTION_BENEFIT",
    "RESELLER_MARGIN",
)


def credit_sum(credits: Column | str, types: Sequence[str]) -> Column:
    """Sum of ``amount`` over credits whose ``type`` is in ``types``, as DECIMAL(26,9).

    NULL array, empty array, no matching type and all-NULL amounts give 0,
    like IFNULL((SELECT SUM(...) FROM UNNEST(credits) WHERE type IN ...), 0).
    """
    arr = F.col(credits) if isinstance(credits, str) else credits
    wanted = F.filter(arr, lambda c: c["type"].isin(list(types)) & c["amount"].isNotNull())
    total = F.aggregate(wanted, F.lit(0).cast(ROW_DECIMAL),
                        lambda acc, c: (acc + money(c["amount"])).cast(ROW_DECIMAL))
    return F.coalesce(total, F.lit(0).cast(ROW_DECIMAL))


def cud_credits(credits: Column | str = "credits") -> Column:
    return credit_sum(credits, CUD_CREDIT_TYPES)


def other_savings(credits: Column | str = "credits") -> Column:
    return credit_sum(credits, OTHER_CREDIT_TYPES)
