"""Random small frames: Spark's reasons equal a brute-force evaluation of the rules."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.plans.silver import accepted_sales, checked_sales
from tests.fixtures import tables

CAL_START, CAL_END = dt.date(2025, 1, 1), dt.date(2025, 1, 31)
PRODUCTS = {"P001", "P002"}
STORES = {"S001", "S002"}
MONEY = [None, "-1.00", "0.00", "0.01", "10.00"]

line = st.tuples(
    st.sampled_from([None, "T1", "T2", "T3"]),
    st.sampled_from([None, "", "   ", "P001", " P001 ", "P002", "P999", "\tP001"]),
    st.sampled_from([None, "S001", " S002", "S999"]),
    st.sampled_from([None, CAL_START, CAL_END, dt.date(2025, 2, 1)]),
    st.sampled_from([None, -1, 0, 1, 5]),
    st.sampled_from(MONEY),
    st.sampled_from(MONEY),
    st.sampled_from(MONEY),
    st.sampled_from([None, "store", " ONLINE ", "Marketplace", "kiosk", "", "\tstore"]),
    st.sampled_from([None, "paid", " PAID ", "cancelled", "refunded", ""]),
)


def _row(i, t):
    tid, product, store, day, qty, price, cost, net, channel, status = t
    m = (lambda x: None if x is None else Decimal(x))
    return (tid, f"O{i}", day, product, store, channel, qty, m(price), Decimal("0.00"), m("10.00"),
            m(net), m(cost), m("1.00"), m("1.00"), status)


def _spaces(s):
    return None if s is None else s.strip(" ")


def _expected(lines) -> list[str]:
    seen: dict = {}
    out = []
    for tid, product, store, day, qty, price, cost, net, channel, status in lines:
        seen[tid] = seen.get(tid, 0) + 1
        p, s = _spaces(product), _spaces(store)
        ch = None if channel is None else _spaces(channel).lower()
        stt = None if status is None else _spaces(status).lower()
        d = lambda x: None if x is None else Decimal(x)
        fired = [
            ("duplicate_transaction", seen[tid] > 1),
            ("missing_product_id", p is None or p == ""),
            ("unknown_product", p not in PRODUCTS),
            ("unknown_store", s not in STORES),
            ("missing_calendar_date", day is None or not CAL_START <= day <= CAL_END),
            ("invalid_quantity", qty is None or qty <= 0),
            ("invalid_unit_price", d(price) is None or d(price) <= 0),
            ("invalid_unit_cost", d(cost) is None or d(cost) < 0),
            ("invalid_channel", ch is not None and ch not in ("store", "online", "marketplace")),
            ("invalid_order_status", stt is not None and stt not in ("paid", "cancelled")),
            ("invalid_net_revenue", d(net) is not None and d(net) < 0),
        ]
        out.append("|".join(name for name, hit in fired if hit))
    return out


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line, min_size=1, max_size=25))
def test_reasons_match_brute_force(spark, lines):
    t = tables(spark, [_row(i, x) for i, x in enumerate(lines)], start=str(CAL_START), end=str(CAL_END))
    got = [r["quality_reason"] for r in checked_sales(t).orderBy("_source_row_id").collect()]
    assert got == _expected(lines)
    accepted = accepted_sales(t).count()
    assert accepted == sum(1 for reason in got if reason == "")
    assert checked_sales(t).where(F.col("quality_reason") != "").count() == len(got) - accepted


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.sampled_from([None, "A", "B", "C", "D"]), min_size=20, max_size=300),
    st.integers(min_value=2, max_value=9),
    st.randoms(use_true_random=False),
)
def test_split_rank_equals_window(spark, keys, buckets, rnd):
    from salesmart.operators.dedup import SkewPolicy, rank_duplicates

    order = rnd.sample(range(10_000), len(keys))  # unique source order
    df = spark.createDataFrame(list(zip(keys, order)), "transaction_id string, _source_row_id long")
    policy = SkewPolicy(rows_per_cut=buckets)
    plain = {(r[0], r[1]): r[2] for r in rank_duplicates(df, skew=None).collect()}
    split = {(r[0], r[1]): r[2] for r in rank_duplicates(df, skew=policy).collect()}
    assert split == plain


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.integers(min_value=1, max_value=60),
    st.decimals(min_value=Decimal("0.01"), max_value=Decimal("9999.99"), places=2),
    st.sampled_from([Decimal(x) for x in ("0", "5", "12.5", "15", "33.33", "45")]),
    st.decimals(min_value=Decimal("0.00"), max_value=Decimal("5000.00"), places=2),
    st.sampled_from(["paid", "cancelled", " Cancelled "]),
), min_size=1, max_size=30))
def test_line_measures_match_decimal_half_up(spark, lines):
    from decimal import ROUND_HALF_UP

    from salesmart.operators.normalize import line_measures

    cent = Decimal("0.01")

    def r(x):
        return x.quantize(cent, rounding=ROUND_HALF_UP)

    df = spark.createDataFrame(
        [(i, *x) for i, x in enumerate(lines)],
        "i int, q int, price decimal(18,2), disc decimal(18,2), cost decimal(18,2), status string",
    )
    got = {row["i"]: row for row in df.select(
        "i", *line_measures(F.col("q"), F.col("price"), F.col("disc"), F.col("cost"), F.col("status"))).collect()}
    for i, (q, price, disc, cost, status) in enumerate(lines):
        gross = r(q * price)
        net = r(gross * (100 - disc) / 100)
        total = r(q * cost)
        margin = r(net - total)
        cancelled = status.strip().lower() == "cancelled"
        row = got[i]
        assert (row["gross_revenue"], row["total_cost"]) == (gross, total)
        assert row["net_revenue"] == (Decimal("0.00") if cancelled else net)
        assert row["margin"] == (Decimal("0.00") if cancelled else margin)
