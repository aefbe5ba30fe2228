"""Hand-derived tables: raw value to cleaned value and message."""

import pytest
from pyspark.sql import functions as F

from homelake.functions import address, dates, labels, measures
from homelake.functions.text import UNKNOWN as U
from homelake.functions.text import quoted_message
from homelake.operators.conditions import has_fields
from homelake.plans import clean as P
from homelake.schemas import RAW_COLUMNS, REQUIRED_COLUMNS

FIELDS = ["specific_area", "hamlet_neighborhood", "ward_commune", "district", "province_city"]


def parse_addresses(spark, texts, mode="reference"):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
    rows = rows.withColumn("p", address.address_parts("x"))
    rows = rows.withColumns({"c": address.city_text("p"), "d": address.district_text("p", mode)})
    out = rows.select(
        "i",
        address.address_error("x", "p", "c", "d").alias("error"),
        *[c.alias(n) for n, c in address.address_fields("p", "c", "d").items()],
    )
    return out.orderBy("i").collect()


def test_addresses(spark):
    table = {
        "Phường 11, Quận 1, Thành phố Hồ Chí Minh": [U, U, "Phường 11", "1", "Hồ Chí Minh"],
        "Đường Nguyễn Văn Linh, Liên Hà, Đông Anh, Hà Nội": [U, "Đường Nguyễn Văn Linh", "Liên Hà", "Đông Anh", "Hà Nội"],
        "Vinhomes Golden City, Hòa Nghĩa, Dương Kinh, Hà Nội": ["Vinhomes Golden City", U, "Hòa Nghĩa", "Dương Kinh", "Hà Nội"],
        "Nhà An Khê, Lỗ Khê, Liên Hà, Đông Anh, Hà Nội": ["Nhà An Khê", "Lỗ Khê", "Liên Hà", "Đông Anh", "Hà Nội"],
        "A, B, Huyện Hoàng Mai, TP. Hà Nội": ["A", U, "B", "Oàng Mai", "Hà Nội"],
        "Liên Hà, , Tp.": [U, U, "Liên Hà", U, U],
        " , Hà Đông , Hà Nội": [U, U, "", "À Đông", "Hà Nội"],
    }
    for row, expected in zip(parse_addresses(spark, list(table)), table.values()):
        assert row.error is None and [row[f] for f in FIELDS] == expected


def test_address_errors(spark):
    table = {
        "": "Address is required",
        " 　 ": "Address is required",
        "Liên Hà, Hà Nội": "Invalid address format",
        "a, b, c, d, e, f": "Invalid address format",
        "A, B, Hà Nội 2": "Tỉnh/Thành phố không được chứa số.",
        "A, B, Quận Đông": "Quận không được chứa trong tỉnh/thành phố",
        "A, Phường B, Huế": "Phường không được chứa trong quận/huyện",
    }
    assert [r.error for r in parse_addresses(spark, list(table))] == list(table.values())


def test_anchored_districts_keep_their_names(spark):
    rows = parse_addresses(spark, ["A, B, Huyện Hoàng Mai, Hà Nội", "A, B, Q. Ba Đình, Hà Nội", "A, Quận 1, Huế", "A, Hà Đông, Hà Nội"], "anchored")
    assert [r.district for r in rows] == ["Hoàng Mai", "Ba Đình", "1", "Hà Đông"]


def test_area(values):
    text = measures.area_text("x")
    value = measures.area_m2(text)
    probes = ["50,5 m²", "50.5m²", "1.234,5 m2", "abc", "", None, "120M2", "2,675"]
    assert values(value, probes) == [50.5, 505.0, 1234.5, None, None, None, 120.0, 2.68]
    found = values(quoted_message(measures.area_error("x", text, value)), probes)
    assert found == [None, None, None, "could not convert string to float: 'abc'", "Area is required", "Area is required", None, None]


def price(values, area, probes):
    text = measures.price_text("x")
    number = measures.price_number(text)
    value = measures.million_per_m2("x", text, number, F.lit(area).cast("double"))
    error = quoted_message(measures.price_error("x", number, value))
    return list(zip(values(value, probes), values(error, probes)))


def test_price(values):
    probes = ["1,5 tỷ", "50 triệu", "5 triệu/m²", "Thỏa thuận", "thoa thuan", "5 tỷ 500 triệu", "2 Tỷ/m²", "~7,25 triệu/m²", ""]
    found = price(values, 20, probes)
    assert [v for v, _ in found] == [75.0, 2.5, 5.0, -1.0, -1.0, 250.0, 100.0, 7.25, -1.0]
    assert all(e is None for _, e in found)
    unusable = price(values, 20, ["1.234,5 tỷ", "Liên hệ", "500 nghìn/m²", "..tỷ"])
    assert [e for _, e in unusable] == [
        "could not convert string to float: '1.234.5'",
        "Price 'Liên hệ' không phù hợp",
        "Price '500 nghìn/m²' không phù hợp",
        "could not convert string to float: '..'",
    ]
    assert price(values, 0, ["1 tỷ", "x"]) == [(-1.0, None), (-1.0, None)]
    assert price(values, None, ["1 tỷ"]) == [(-1.0, None)]


def test_direction(values):
    probes = [None, "", "Đông - Nam", "tây bắc", "  ", " TÂY-nam "]
    assert values(labels.direction("x"), probes) == [U, U, "Đông Nam", "Tây Bắc", "", "Tây Nam"]


@pytest.mark.parametrize(
    "text, probes, expected",
    [
        (measures.facade_text, [None, "", "5,5m", "7M", "  ", " 6 m"], [-1.0, -1.0, 5.5, None, None, 6.0]),
        (measures.way_in_text, [None, "", '"5m"', "3,5 M", "  ", "'4'"], [-1.0, -1.0, 5.0, 3.5, None, 4.0]),
    ],
)
def test_widths(values, text, probes, expected):
    value = measures.width("x", text("x"))
    assert values(value, probes) == expected
    messages = values(quoted_message(measures.width_error(text("x"), value)), probes)
    assert [m is not None for m in messages] == [v is None for v in expected]


def test_legal(values):
    probes = [None, "", "Sổ đỏ/ Sổ hồng", "HĐMB", "văn bản thỏa thuận", "đang chờ sổ", " "]
    flags = labels.legal_flags(F.lower("x"))
    digits = F.concat(*[c.cast("string") for c in flags.values()])
    assert values(digits, probes) == ["0000", "0000", "1100", "0010", "0001", "0000", "0000"]
    errors = values(labels.legal_error(F.lower("x"), list(flags.values())), probes)
    assert [bool(e) for e in errors] == [False] * 5 + [True, True]


def test_furniture(values):
    probes = [None, "Đầy đủ", "Đầy đủ nội thất cơ bản", "Cao cấp", "không", "LUXURY full"]
    kind, premium = labels.furniture_fields(F.lower("x")).values()
    assert values(kind, probes) == [U, "full", "basic", U, U, "full"]
    assert values(premium, probes) == [0, 0, 0, 1, 0, 1]
    errors = values(labels.furniture_error(F.lower("x"), kind, premium), probes)
    assert [bool(e) for e in errors] == [False] * 4 + [True, False]


def test_counts(values):
    probes = [None, "", "3 phòng", "2 - 4 phòng", "nhiều", "99999999999"]
    value = measures.count_field("x")
    assert values(value, probes) == [-1, -1, 3, 2, None, None]
    assert values(measures.count_error("x", value), probes)[4] == "Error cleaning number field 'nhiều'"


def test_names(values):
    probes = [None, "  ", "  vinhomes   golden city "]
    assert values(labels.project_title("x"), probes) == [U, U, "Vinhomes Golden City"]


def test_stages(values):
    table = {
        "(blank)": U, "Không xác định": U, "Đã bàn giao tòa A": "Đã bàn giao", "Bàn giao quý IV/2025": "Bàn giao",
        "Dự kiến mở bán": "Chuẩn bị", "Sắp bàn giao": "Bàn giao", "Đang mở bán": "Đang bán", "Mở bán đợt 2": "Mở bán",
        "Cất nóc": "Cất nóc", "Đang thi công": "thi công", "Bàn giao 2024": "Khác", "Chuẩn bị bàn giao": "Chuẩn bị",
        "giữ chỗ": "Nhận booking", "động thổ": "Khởi công", "": U, " 　": U, "???": U, " (blank) ": "Khác",
    }
    assert values(labels.status_stage("x"), list(table)) == list(table.values())
    assert values(labels.status_stage("x"), [None]) == [U]


def test_dates(values):
    table = {
        "1/12/2025": "2025-12-01", "31/2/2025": None, "2025-12-01": "2025-12-01", "05/06/2024 ": "2024-06-05",
        "2025-12-01T10:00:00Z": "2025-12-01T10:00:00+00:00", "2025-12-01T10:00:00": "2025-12-01T10:00:00",
        "2025-12-01 10:05": "2025-12-01T10:05:00", "2025-12-01T10:00:00.5+07:00": "2025-12-01T10:00:00.500000+07:00",
        "2025-12-01T10:00:00-00:00": "2025-12-01T10:00:00+00:00", "2025-12-01T10:00:00+0730": "2025-12-01T10:00:00+07:30",
        "2025-02-30": None, "2025-02-30T10:00:00": None, "2025-12-01T25:00:00": None, "1-12-2025": None, "": None,
        "  ": None, "1/12/25": None, "2025": None, "1/12/2025 10:00": None, "0/1/2025": None, "1/1/0000": None,
        "12/2025": None, "2025-12-01 10": "2025-12-01",
    }
    assert values(dates.post_date("x"), list(table)) == list(table.values())


def test_moments(values):
    found = values(F.unix_seconds(dates.to_moment("x")), ["2025-12-01T10:00:00Z", "2025-12-01T17:00:00+07:00", "x", "2025", None])
    assert found == [1764583200, 1764583200, None, None, None]


def test_property_types(values):
    kind = labels.property_type(F.lower("x"))
    probes = ["https://x/BAN-CONDOTEL-1", "https://x/cho-thue-16", "", None, "/ban-dat-xa-ban-nha-rieng"]
    assert values(kind, probes) == ["Condotel", None, None, None, "Nhà riêng"]
    assert values(labels.property_type_error("x", kind), probes) == [
        None, "URL không khớp với pattern nào: https://x/cho-thue-16", "URL rỗng", "URL rỗng", None,
    ]


def test_page_numbers(values):
    assert values(labels.page_number("x"), ["https://x/nha-dat-ban/p1", "https://x/", "/p12/p3", None]) == [1, None, 12, None]


def test_required_fields(spark):
    good = {c: "v" for c in REQUIRED_COLUMNS}
    rows = [good, good | {"price": ""}, good | {"title": None}, good | {"title": "  "}]
    df = spark.createDataFrame([tuple(r[c] for c in REQUIRED_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in REQUIRED_COLUMNS))
    assert [r.ok for r in df.select(has_fields(REQUIRED_COLUMNS).alias("ok")).collect()] == [True, False, False, True]


GOOD = {
    "main_page_url": "https://x/nha-dat-ban/p1", "subpage_url": "https://x/ban-dat-xa-1", "title": "t", "address": "A, B, Huế",
    "price": "1 tỷ", "area": "20 m²", "post_id": "1", "post_start_time": "1/1/2025", "post_end_time": "x", "post_type": "VIP",
}


def staging(spark, rows):
    full = [tuple(r.get(c) for c in RAW_COLUMNS) + (None, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", created_at timestamp, ingest_seq long")


def test_first_error_in_cleaning_order_is_reported(spark):
    rows = [
        GOOD,
        GOOD | {"price": "", "address": "x"},
        GOOD | {"main_page_url": None, "address": "x"},
        GOOD | {"address": "x", "area": "abc"},
        GOOD | {"area": "abc", "price": "Liên hệ"},
        GOOD | {"price": "Liên hệ", "facade": "7M"},
        GOOD | {"facade": "7M", "legal": "?"},
        GOOD | {"way_in": "  ", "subpage_url": "https://x/cho-thue"},
        GOOD | {"subpage_url": None},
    ]
    found = P.clean(staging(spark, rows)).orderBy("ingest_seq").select("error_message", "v_post_end_time").collect()
    assert [r.error_message for r in found] == [
        None,
        "Thiếu các trường bắt buộc",
        "expected string or bytes-like object, got 'NoneType'",
        "Invalid address format",
        "could not convert string to float: 'abc'",
        "Price 'Liên hệ' không phù hợp",
        "could not convert string to float: '7M'",
        "could not convert string to float: ''",
        "URL rỗng",
    ]
    assert found[0].v_post_end_time is None


def test_every_row_goes_one_way(spark):
    cleaned = P.clean(staging(spark, [GOOD, GOOD | {"price": ""}, GOOD | {"address": "x"}]))
    assert P.good_rows(cleaned).count() == 1 and P.rejected_rows(cleaned, ["ingest_seq"]).count() == 2
