"""Plain-Python statements of the semantics, for small fixtures only."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta
from statistics import median, pstdev

COLUMNS = (
    "order_id string, customer_id string, order_date date, category string, "
    "order_value double, contribution_margin double, used_discount int, "
    "acquisition_channel string, region string"
)
CLASSES = ("Books", "Garden", "Music", "Tools")


def random_orders(seed, customers=12, days=900, start=date(2022, 1, 1), hot=0):
    """Random histories; ``hot`` extra orders all belong to one customer."""
    rng = random.Random(seed)
    rows = []

    def add(customer, day):
        rows.append(
            (
                f"o{len(rows):06d}",
                customer,
                day,
                rng.choice(CLASSES + ("Unlisted",)) if rng.random() < 0.1 else rng.choice(CLASSES),
                round(rng.uniform(5, 200), 2),
                round(rng.uniform(-5, 60), 2),
                int(rng.random() < 0.3),
                rng.choice(("web", "shop", "mail")),
                rng.choice(("north", "south")),
            )
        )

    for index in range(customers):
        for _ in range(rng.randint(1, 30)):
            day = start + timedelta(days=rng.randint(0, days))
            add(f"c{index:03d}", day)
            if rng.random() < 0.15:
                add(f"c{index:03d}", day)
    for _ in range(hot):
        add("hot", start + timedelta(days=rng.randint(0, days)))
    rng.shuffle(rows)
    return rows


def features(history, day, classes=CLASSES):
    """Feature dict of one customer's strictly earlier orders, or None if not eligible."""
    history = sorted(history, key=lambda r: (r[2], r[0]))
    if len(history) < 3:
        return None
    last = history[-1]
    recency = (day - last[2]).days
    if recency > 365:
        return None

    def within(n):
        return [r for r in history if r[2] >= day - timedelta(days=n)]

    year, mid, short = within(365), within(90), within(30)
    gaps = [(b[2] - a[2]).days for a, b in zip(history, history[1:])][-8:]
    gap = float(median(gaps)) if gaps else 90.0
    tenure = (day - history[0][2]).days
    counts = {}
    for row in year:
        counts.setdefault(row[3], []).append(row)
    favourite = min(counts, key=lambda c: (-len(counts[c]), counts[c][0][2], counts[c][0][0]))
    if tenure <= 150 and len(history) <= 4:
        segment = "New"
    elif recency > max(60.0, 1.5 * gap):
        segment = "At Risk"
    elif len(mid) >= 3:
        segment = "Loyal"
    else:
        segment = "Growing"
    out = {
        "acquisition_channel": last[7],
        "region": last[8],
        "lifecycle_segment": segment,
        "last_category": last[3],
        "favorite_category": favourite,
        "customer_tenure_days": tenure,
        "recency_days": recency,
        "orders_lifetime": len(history),
        "orders_365d": len(year),
        "orders_90d": len(mid),
        "orders_30d": len(short),
        "order_momentum": len(mid) / max(len(year) / 4, 0.25),
        "average_order_value_365d": sum(r[4] for r in year) / len(year),
        "total_margin_365d": sum(r[5] for r in year),
        "discount_share_365d": sum(r[6] for r in year) / len(year),
        "weekend_share_365d": sum(r[2].weekday() >= 5 for r in year) / len(year),
        "category_diversity_365d": len(counts),
        "favorite_category_share_365d": len(counts[favourite]) / len(year),
        "average_gap_days": gap,
        "gap_variability_days": pstdev(gaps) if gaps else 0.0,
        "cadence_progress": recency / max(gap, 7.0),
        "last_order_value": last[4],
        "last_order_margin": last[5],
        "score_month": day.month,
        "score_quarter": (day.month + 2) // 3,
    }
    for name in classes:
        bought = counts.get(name, [])
        key = name.lower()
        out[f"{key}_orders_365d"] = len(bought)
        out[f"{key}_share_365d"] = len(bought) / len(year)
        out[f"{key}_recency_days"] = (day - bought[-1][2]).days if bought else 400
    return out


def labels(orders, day):
    future = sorted((r for r in orders if r[2] >= day), key=lambda r: (r[2], r[0]))
    days = (future[0][2] - day).days if future else 10**6
    return {
        "purchase_within_30d": int(days <= 30),
        "next_category": future[0][3] if days <= 60 else None,
        "days_to_next_purchase": days if days <= 60 else None,
    }


def by_customer(rows):
    grouped = {}
    for row in rows:
        grouped.setdefault(row[1], []).append(row)
    return grouped


def labeled_snapshots(rows, start, end, step=28):
    last = max(r[2] for r in rows)
    out = {}
    day = start
    while day <= end:
        if day + timedelta(days=60) <= last:
            for customer, orders in by_customer(rows).items():
                row = features([r for r in orders if r[2] < day], day)
                if row:
                    out[customer, day] = row | labels(orders, day)
        day += timedelta(days=step)
    return out


def scoring_snapshot(rows, day):
    out = {}
    for customer, orders in by_customer(rows).items():
        row = features([r for r in orders if r[2] < day], day)
        if row:
            out[customer, day] = row
    return out


def same(expected, actual):
    if isinstance(expected, float) and actual is not None:
        return math.isclose(expected, actual, rel_tol=1e-9, abs_tol=1e-9)
    return expected == actual


def assert_snapshots(frame, expected):
    rows = {(r["customer_id"], r["score_date"]): r.asDict() for r in frame.collect()}
    assert rows.keys() == expected.keys()
    for key, wanted in expected.items():
        for name, value in wanted.items():
            assert same(value, rows[key][name]), (key, name, value, rows[key][name])
