"""Named quality rules, the reason string and the accept / reject split.

Every rule has two forms:

* ``fires`` - the rule exactly as the source evaluates it, three-valued:
  ``NOT (channel IN (...))`` is NULL for a NULL channel and so does not
  fire, ``net_revenue < 0`` does not fire for NULL or NaN.
* ``passes`` - the two-valued complement ``NOT coalesce(fires, false)``,
  written in positive, null-rejecting form (``product_name IS NOT NULL``,
  ``_duplicate_rank <= 1``). Catalyst can use it: the accept filter turns
  the dimension left joins into inner joins and the rank filter becomes a
  partial + final ``WindowGroupLimit`` (top-1 per key before the shuffle).

The reason string joins the labels of the fired rules with ``|`` in rule
order; a line is accepted exactly when no rule fires (the string is "").
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.dedup import DUPLICATE_RANK

QUALITY_REASON = "quality_reason"
REASON_SEPARATOR = "|"

# The accepted channel and status codes.
VALID_CHANNELS = ("store", "online", "marketplace")
VALID_STATUSES = ("paid", "cancelled")


@dataclass(frozen=True)
class Rule:
    reason: str
    fires: Callable[[], Column]
    passes: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


def _null_or(reason: str, name: str, bad: Callable[[Column], Column], good: Callable[[Column], Column]) -> Rule:
    return Rule(
        reason,
        lambda: _c(name).isNull() | bad(_c(name)),
        lambda: _c(name).isNotNull() & good(_c(name)),
    )


def _is_null(reason: str, name: str) -> Rule:
    return Rule(reason, lambda: _c(name).isNull(), lambda: _c(name).isNotNull())


def _not_in(reason: str, name: str, allowed: Sequence[str]) -> Rule:
    return Rule(
        reason,
        lambda: ~_c(name).isin(*allowed),
        lambda: F.coalesce(_c(name).isin(*allowed), F.lit(True)),
    )


# Rule labels in the order the reason string lists them.
RULES: list[Rule] = [
    Rule(
        "duplicate_transaction",
        lambda: _c(DUPLICATE_RANK) > 1,
        lambda: _c(DUPLICATE_RANK) <= 1,
    ),
    _null_or("missing_product_id", "product_id", lambda c: c == "", lambda c: c != ""),
    _is_null("unknown_product", "product_name"),
    _is_null("unknown_store", "city"),
    _is_null("missing_calendar_date", "year"),
    _null_or("invalid_quantity", "quantity", lambda c: c <= 0, lambda c: c > 0),
    _null_or("invalid_unit_price", "unit_price", lambda c: c <= 0, lambda c: c > 0),
    _null_or("invalid_unit_cost", "unit_cost", lambda c: c < 0, lambda c: c >= 0),
    _not_in("invalid_channel", "channel", VALID_CHANNELS),
    _not_in("invalid_order_status", "order_status", VALID_STATUSES),
    Rule(
        "invalid_net_revenue",
        lambda: _c("net_revenue") < 0,
        lambda: F.coalesce(~(_c("net_revenue") < 0), F.lit(True)),
    ),
]
RULES_BY_REASON: dict[str, Rule] = {r.reason: r for r in RULES}
REASONS: list[str] = [r.reason for r in RULES]


def reason_column(rules: Sequence[Rule] = RULES) -> Column:
    """Labels of the fired rules joined by ``|``; "" when none fires (never NULL)."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(r.fires(), F.lit(r.reason)) for r in rules])


def accept_condition(rules: Sequence[Rule] = RULES) -> Column:
    """TRUE exactly when no rule fires (the reason string is empty)."""
    condition = rules[0].passes()
    for rule in rules[1:]:
        condition = condition & rule.passes()
    return condition


def add_quality_reason(enriched: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    return enriched.withColumn(QUALITY_REASON, reason_column(rules))


def accepted_only(enriched: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Accepted lines without building the reason string (Catalyst-friendly)."""
    return enriched.where(accept_condition(rules))


def rejected_only(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(QUALITY_REASON) != "")


def rule_hits(checked: DataFrame, reason: str) -> DataFrame:
    """Lines on which one rule fires."""
    return checked.where(RULES_BY_REASON[reason].fires())


def reason_mentions(reason: str) -> Column:
    """Substring test on the joined reason (one line can count for several kinds)."""
    return F.col(QUALITY_REASON).contains(reason)
