"""The enriched columns against a row-by-row model in Python, on random rows with gaps."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from tallyshelf import fixed_values as fixed
from tallyshelf.plans.overview import apply_transformations
from tests.test_clean import sale, sales

WEEKDAYS = "Sunday Monday Tuesday Wednesday Thursday Friday Saturday".split()


def cents(amount):
    if amount is None:
        return None
    return float(Decimal(repr(amount)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def minus(a, b):
    return None if a is None or b is None else a - b


def times(a, b):
    return None if a is None or b is None else a * b


def holds(test, *values):
    return all(v is not None for v in values) and test(*values)


def season(r):
    if holds(lambda x: x > 5, r["rain_mm"]):
        return "Monsoon"
    if r["temperature"] is None or 8 <= r["temperature"] <= 17:
        return "Autumn/Spring"
    return "Winter" if r["temperature"] < 8 else "Summer"


def band(share):
    if share is None or share > 0.5:
        return "50%+"
    if share == 0:
        return "No Discount"
    return "0-10%" if share <= 0.1 else "10-25%" if share <= 0.25 else "25-50%"


def risk(r):
    if r["stock_out_flag"] == 1:
        return "Stock Out"
    if holds(lambda stock, units: stock < units, r["stock_on_hand"], r["units_sold"]):
        return "Understocked"
    return "Long Lead Time" if holds(lambda days: days >= 14, r["lead_time_days"]) else "Normal"


def model(r):
    cost = cents(times(r["purchase_cost"], r["units_sold"]))
    sold = holds(lambda units: units > 0, r["units_sold"])
    per_unit = None if r["net_sales"] is None else cents(r["net_sales"] / r["units_sold"]) if sold else 0.0
    return {
        "season": season(r),
        "weekday_name": WEEKDAYS[r["weekday"]] if r["weekday"] in range(7) else "Saturday",
        "discount_amount": cents(minus(r["gross_sales"], r["net_sales"])),
        "total_cost": cost,
        "profit_amount": cents(minus(r["net_sales"], cost)),
        "revenue_per_unit": per_unit if sold else 0.0,
        "discount_band": band(r["discount_pct"]),
        "inventory_risk": risk(r),
    }


def random_sale(pick):
    def maybe(value):
        return None if pick.random() < 0.1 else value

    def money():
        return maybe(pick.choice([0.0, 1.005, 2.675, 0.125, round(pick.uniform(0, 500), pick.choice([0, 1, 2, 3, 5]))]))

    return sale(
        weekday=maybe(pick.randint(-1, 8)),
        temperature=maybe(pick.choice([8.0, 17.0, 7.999, 17.001, pick.uniform(-20, 40)])),
        rain_mm=maybe(pick.choice([5.0, 5.001, 0.0, pick.uniform(0, 7)])),
        units_sold=maybe(pick.randint(-2, 30)),
        discount_pct=maybe(pick.choice([0.0, 0.1, 0.25, 0.5, -0.1, pick.uniform(0, 0.8)])),
        gross_sales=money(),
        net_sales=money(),
        stock_on_hand=maybe(pick.randint(0, 30)),
        stock_out_flag=maybe(pick.randint(0, 2)),
        lead_time_days=maybe(pick.randint(10, 18)),
        purchase_cost=money(),
    )


def test_enriched_columns_equal_the_model(spark):
    pick = random.Random(7)
    rows = [random_sale(pick) for _ in range(3000)]
    numbered = sales(spark, *rows).coalesce(1)
    found = [row.asDict() for row in apply_transformations(numbered).collect()]
    assert len(found) == len(rows)
    for row, enriched in zip(rows, found, strict=True):
        source = dict(zip(fixed.SALES, row, strict=True))
        assert {name: enriched[name] for name in source} == source
        wanted = model(source)
        assert {name: enriched[name] for name in wanted} == wanted, source
