"""Code lists, their report labels, and classifying expressions.

The labels are data of the reports and stay in the language of the reports.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shipment status code -> label.
SHIPMENT_STATUS = {
    "PENDING": "입금대기",
    "PAYMENT": "결제완료",
    "READY_SHIPMENT": "배송준비",
    "SHIPPING": "배송중",
    "SHIPPING_COMPLETE": "배송완료",
    "CANCEL_REQUEST": "취소요청",
    "CANCEL": "취소완료",
    "DELETE": "삭제",
}
SHIPMENT_STATUS_OTHER = "기타"

# Item status code -> label.
ITEM_STATUS = {
    "PENDING": "입금대기",
    "ORDER": "주문",
    "CANCEL_PARTIAL": "부분취소",
    "CANCEL_REQUEST": "취소요청",
    "CANCEL": "취소완료",
}
ITEM_STATUS_OTHER = "UNKNOWN"

# Point event code -> label.
POINT_EVENT = {
    "REWARD": "충전",
    "USED": "사용",
    "EXPIRED": "만료",
    "ADMIN_SUBTRACT": "차감",
}
POINT_EVENT_OTHER = ""

# Point reason code -> label.
POINT_REASON = {
    "ORDER": "주문",
    "NONE": "해당사항없음",
    "ORDER_CANCEL": "주문취소",
    "DY": "계근환급",
    "EVENT": "이벤트",
    "JOINED": "회원가입",
    "MAKE_UP": "임의조정",
    "EXPIRED": "만료",
    "FIRST_ORDER_EVENT": "첫구매이벤트",
    "REFERRAL_MEMBER": "친구추천(추천인)",
    "FIRST_ORDER_REFERRED": "친구추천(신규회원)",
    "SHIPMENT_DATE_OPTIONS_EVENT": "반짝적립",
}
POINT_REASON_OTHER = ""

# The reasons that are reported, in report order, and the label
# under which both sides of a referral are added up.
REFERRAL = "친구추천"
FIRST_ORDER_REASON = POINT_REASON["FIRST_ORDER_EVENT"]
JOINED_REASON = POINT_REASON["JOINED"]
REFERRAL_REASONS = [POINT_REASON["REFERRAL_MEMBER"], POINT_REASON["FIRST_ORDER_REFERRED"]]
REPORTED_REASONS = [FIRST_ORDER_REASON, JOINED_REASON, REFERRAL]

# Which codes the sales reports count.
ORDERED_ITEM = "ORDER"
SHIPPED_STATUSES = ["READY_SHIPMENT", "SHIPPING", "SHIPPING_COMPLETE"]
VALID_ORDER_STATUSES = ["PENDING", "PAYMENT", "READY_SHIPMENT", "SHIPPING", "SHIPPING_COMPLETE"]
CHARGED_EVENT = "REWARD"
TAXED = "TAX"

# Delivery types and the courier code of direct delivery.
DIRECT = "직배"
PARCEL = "택배"
DIRECT_COURIER = "SFN"

# Sign-up referral types.
AGENCY_REFERRAL = "영업대행"
FRIEND_REFERRAL = "친구추천"

# Basket bands, ascending, each from its lower bound up.
BASKET_BANDS = {
    "under_150k": None,
    "from_150k": 150_000,
    "from_200k": 200_000,
    "from_250k": 250_000,
    "from_300k": 300_000,
}

# Business categories in report order.
BUSINESS_CATEGORIES = [
    "서양식·피자·파스타·햄버거",
    "카페·샐러드·샌드위치",
    "한식·분식",
    "베이커리",
    "주점",
    "중식",
    "일식",
    "치킨",
    "뷔페·급식·구내식당",
    "아시안",
]


def label(code: Column, labels: dict[str, str], other: str) -> Column:
    """Label of a code; unknown codes and NULL get ``other``."""
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[code], F.lit(other))


def position(value: Column, ordered: list[str]) -> Column:
    """1-based place of a value in a fixed order; NULL if it is not listed."""
    pairs = [F.lit(item) for pair in zip(ordered, range(1, len(ordered) + 1)) for item in pair]
    return F.create_map(*pairs)[value]


def delivery_type(courier: Column, direct_courier: str = DIRECT_COURIER) -> Column:
    """Direct or parcel; no courier means parcel."""
    return F.when(courier == direct_courier, DIRECT).otherwise(PARCEL)


def referral_type(recommender: Column, strict: bool) -> Column:
    """Agency (leading ``#``), friend (letters and digits), else NULL.

    ``strict`` asks for letters and digits to the end; otherwise one leading
    letter or digit is enough.
    """
    friend = "^[a-zA-Z0-9]+$" if strict else "^[a-zA-Z0-9]+"
    return F.when(recommender.rlike("^#"), AGENCY_REFERRAL).when(
        recommender.rlike(friend), FRIEND_REFERRAL
    )


def basket_band(total: Column) -> Column:
    """Band of a basket total; NULL total gives no band."""
    names = list(BASKET_BANDS)
    band = F.when(total < BASKET_BANDS[names[1]], names[0])
    for name, next_name in zip(names[1:], names[2:]):
        band = band.when(total < BASKET_BANDS[next_name], name)
    return band.when(total.isNotNull(), names[-1])


def reported_reason(reason: Column) -> Column:
    """Reason label with both referral labels folded into one."""
    return F.when(reason.isin(REFERRAL_REASONS), REFERRAL).otherwise(reason)
