"""Where each measure goes on the report sheets.

A place is (sheet, block, measure, row, offset); the column of a period is
period + offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from tillgrid.functions import codes

# Rows of the member and advertising blocks.
MEMBER_ROWS = {
    "new_members": 6,
    "friend": 8,
    "agency": 9,
    "ok_total_count": 11,
    "ok_direct_count": 12,
    "ok_parcel_count": 13,
    "total_growth": 14,
    "direct_growth": 15,
    "parcel_growth": 16,
    "requests": 17,
}
AD_ROWS = {"signups": 7, "cost": 19, "conversions": 25, "avg_roas": 27}

# Rows of the sales blocks.
DIRECT_ROWS = {
    "supply_price": 34,
    "discount_price": 35,
    "point": 37,
    "coupon": 39,
    "delivery_price": 41,
    "orders": 42,
    "buyers": 43,
    "first_order_users": 44,
    "orders_sku": 45,
}
PARCEL_ROWS = {
    "supply_price": 60,
    "discount_price": 61,
    "point": 63,
    "coupon": 65,
    "delivery_price": 67,
    "orders": 68,
    "buyers": 69,
    "first_order_users": 70,
    "orders_sku": 71,
}
TOTAL_ROWS = {"buyers": 95, "first_order_users": 96}

# First rows of the band blocks, bands ascending below.
DIRECT_BANDS_ROW = 47
PARCEL_BANDS_ROW = 73
TOTAL_BANDS_ROW = 99

# Category blocks, ten rows apart, and the measures they show.
FIRST_CATEGORY_ROW = 115
CATEGORY_STEP = 10
CATEGORY_MEASURES = ["pg_supply_price", "orders", "buyers", "first_order_users", "orders_sku"]

# Rows of the point sheets.
POINT_ROWS = {"first_order": 3, "joined": 4, "referral": 5}

MEMBERS, ADS, TOTAL = "members", "ads", "total"

Place = tuple[str, str, str, int, int]


def main_layout(sheet: str) -> list[Place]:
    """Member, advertising, sales and band blocks; period 1 is column B."""
    blocks = [
        (MEMBERS, MEMBER_ROWS),
        (ADS, AD_ROWS),
        (codes.DIRECT, DIRECT_ROWS),
        (codes.PARCEL, PARCEL_ROWS),
        (TOTAL, TOTAL_ROWS),
    ]
    band_rows = [
        (codes.DIRECT, DIRECT_BANDS_ROW),
        (codes.PARCEL, PARCEL_BANDS_ROW),
        (TOTAL, TOTAL_BANDS_ROW),
    ]
    places = [
        (sheet, block, measure, row, 1) for block, rows in blocks for measure, row in rows.items()
    ]
    for block, first in band_rows:
        places += [
            (sheet, block, band, first + step, 1) for step, band in enumerate(codes.BASKET_BANDS)
        ]
    return places


def category_layout(sheet: str, categories: Sequence[str]) -> list[Place]:
    """One block per category in the given order."""
    return [
        (sheet, category, measure, FIRST_CATEGORY_ROW + CATEGORY_STEP * rank + offset, 1)
        for rank, category in enumerate(categories)
        for offset, measure in enumerate(CATEGORY_MEASURES)
    ]


def point_layout(sheet: str, first_period: int) -> list[Place]:
    """One row per reported reason; ``first_period`` is column B."""
    return [
        (sheet, reason, "share", row, 2 - first_period)
        for reason, row in zip(codes.REPORTED_REASONS, POINT_ROWS.values())
    ]
