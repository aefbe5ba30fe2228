"""Keyword rules: legal papers, furniture, project stage, property type, page number, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import UNKNOWN, _col, contains_any, first_rule, is_blank, is_empty, plain_ascii, squeeze, strip, title_case

# Legal paper keywords and the message when none is found.
LEGAL_KEYWORDS = {
    "have_red_book": ["sổ đỏ", "so do"],
    "have_pink_book": ["sổ hồng", "so hong"],
    "have_sale_contract": ["hợp đồng mua bán", "hop dong mua ban", "hđmb", "hdmb"],
    "have_agreement_document": ["văn bản", "van ban", "vbtt"],
}
LEGAL_UNCLEAR = "Giấy tờ cần xử lý thủ công"

# Furniture keywords and the message when none is found.
FURNITURE_FULL = ["đầy đủ", "full", "hoàn thiện"]
FURNITURE_BASIC = ["cơ bản", "basic", "đơn giản"]
FURNITURE_PREMIUM = ["cao cấp", "sang trọng", "premium", "luxury"]
FURNITURE_UNCLEAR = "Nội thất cần xử lý thủ công"

# Words of projects in preparation, which come before all stages.
PREPARATION = "Chuẩn bị"
PREPARATION_KEYWORDS = [
    "du kien",
    "chuan bi",
    "ra mat trong",
    "dang cap nhat",
    "sap ra mat",
    "sap mo ban",
    "sap khoi cong",
    "sap trien khai",
]

# Project stages in order of precedence, matched in accent-free text.
STAGE_KEYWORDS = [
    (
        "Đã bàn giao",
        [
            "da ban giao",
            "da co so hong",
            "da ban giao toa",
            "da ban giao thap",
            "da ban giao giai doan",
            "da ban giao phan khu",
            "da xay dung hoan thien",
        ],
    ),
    (
        "Bàn giao",
        [
            "ban giao nam",
            "ban giao thang",
            "ban giao quy",
            "ban giao vao",
            "ban giao ngay",
            "ban giao toa",
            "ban giao toan",
            "ban giao giai doan",
            "ban giao trong",
            "sap ban giao",
            "chuan bi ban giao",
            "dang ban giao",
        ],
    ),
    (
        "Đang bán",
        [
            "dang ban",
            "dang mo ban",
            "ban het",
            "ban toan bo",
            "ban gio hang",
            "ban nhung can cuoi",
            "dang ban phan khu",
            "dang ban toa",
        ],
    ),
    (
        "Mở bán",
        [
            "mo ban",
            "ra mat thap",
            "ra mat du an",
            "mo ban dot",
            "mo ban giai doan",
            "mo ban gio hang",
            "ra mat khu",
        ],
    ),
    (
        "Nhận booking",
        [
            "nhan booking",
            "nhan dat cho",
            "giu cho",
            "dat cho",
            "nhan giu cho",
        ],
    ),
    (
        "Cất nóc",
        [
            "cat noc",
            "sap cat noc",
        ],
    ),
    (
        "Khởi công",
        [
            "khoi cong",
            "dong tho",
        ],
    ),
    (
        "thi công",
        [
            "thi cong",
            "thi cong tro lai",
            "dang thi cong",
        ],
    ),
]
STAGE_OTHER = "Khác"

# Property types by URL pattern, in order of precedence, and messages.
PROPERTY_TYPES = [
    ("ban-nha-biet-thu", "Nhà biệt thự"),
    ("ban-can-ho-chung-cu", "Căn hộ chung cư"),
    ("ban-nha-rieng", "Nhà riêng"),
    ("ban-dat-xa", "Đất xã"),
    ("ban-dat-duong", "Đất đường"),
    ("ban-dat-nen", "Đất nền"),
    ("ban-condotel", "Condotel"),
    ("ban-shophouse", "Shophouse"),
    ("ban-loai-bat-dong-san-khac", "Bất động sản khác"),
    ("ban-nha-mat-pho", "Nhà mặt phố"),
    ("ban-dat-phuong", "Đất phường"),
    ("ban-trang-trai", "Trang trại"),
]
URL_EMPTY = "URL rỗng"
URL_UNMATCHED = "URL không khớp với pattern nào: "
URL_NOT_TEXT = "expected string or bytes-like object, got 'NoneType'"


def page_number(main_page_url: Column | str) -> Column:
    return F.regexp_extract(_col(main_page_url), "/p([0-9]+)", 1).try_cast("int")


def page_number_error(main_page_url: Column | str) -> Column:
    return F.when(_col(main_page_url).isNull(), URL_NOT_TEXT)


def direction(raw: Column | str) -> Column:
    raw = _col(raw)
    dashed = squeeze(F.replace(raw, F.lit("-"), F.lit(" ")))
    text = F.when(F.contains(raw, F.lit("-")), dashed).otherwise(strip(raw))
    return F.when(is_empty(raw), UNKNOWN).otherwise(title_case(text))


def legal_flags(lowered: Column | str) -> dict[str, Column]:
    """0/1 flags from lower-cased text; null text gives all 0."""
    text = F.coalesce(_col(lowered), F.lit(""))
    return {name: contains_any(text, words).cast("int") for name, words in LEGAL_KEYWORDS.items()}


def legal_error(lowered: Column | str, flags: list[Column]) -> Column:
    none_set = F.greatest(*flags) == 0
    return F.when(~is_empty(lowered) & none_set, LEGAL_UNCLEAR)


def furniture_fields(lowered: Column | str) -> dict[str, Column]:
    text = F.coalesce(_col(lowered), F.lit(""))
    kind = (
        F.when(contains_any(text, FURNITURE_BASIC), "basic")
        .when(contains_any(text, FURNITURE_FULL), "full")
        .otherwise(UNKNOWN)
    )
    return {
        "furniture_type": kind,
        "has_premium_furniture": contains_any(text, FURNITURE_PREMIUM).cast("int"),
    }


def furniture_error(lowered: Column | str, kind: Column | str, premium: Column | str) -> Column:
    unclear = (_col(kind) == UNKNOWN) & (_col(premium) == 0)
    return F.when(~is_empty(lowered) & unclear, FURNITURE_UNCLEAR)


def project_title(raw: Column | str) -> Column:
    """Project and investor names: single spaces, title case, blank is unknown."""
    text = squeeze(raw)
    return F.when(is_empty(text), UNKNOWN).otherwise(title_case(text))


def status_stage(raw: Column | str, plain: Column | str | None = None) -> Column:
    """Stage of a project; ``plain`` is ``plain_ascii(raw)`` if already computed."""
    raw = _col(raw)
    plain = plain_ascii(raw) if plain is None else _col(plain)
    stage = F.when(is_blank(raw) | (raw == "(blank)") | is_empty(plain), UNKNOWN)
    stage = stage.when(plain == "khong xac dinh", UNKNOWN)
    rules = [(PREPARATION, PREPARATION_KEYWORDS), *STAGE_KEYWORDS]
    return stage.otherwise(F.coalesce(first_rule(plain, rules), F.lit(STAGE_OTHER)))


def property_type(lowered_url: Column | str) -> Column:
    return first_rule(lowered_url, [(label, [pattern]) for pattern, label in PROPERTY_TYPES])


def property_type_error(url: Column | str, kind: Column | str) -> Column:
    return F.when(is_empty(url), URL_EMPTY).when(
        _col(kind).isNull(), F.concat(F.lit(URL_UNMATCHED), _col(url))
    )
