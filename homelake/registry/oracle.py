"""The same results in ANSI-style SQL, to be run by another engine on the same tables."""

from __future__ import annotations

from ..schemas import CLEAN_COLUMNS, RAW_COLUMNS
from ..sources.sample_tables import LISTING_SQL

# Fixed values, written out here once more: a wrong one on either side shows as a difference.
LEGAL_KEYWORDS = {
    "have_red_book": ["sổ đỏ", "so do"],
    "have_pink_book": ["sổ hồng", "so hong"],
    "have_sale_contract": ["hợp đồng mua bán", "hop dong mua ban", "hđmb", "hdmb"],
    "have_agreement_document": ["văn bản", "van ban", "vbtt"],
}
STAGE_KEYWORDS = [
    (
        "Chuẩn bị",
        [
            "du kien", "chuan bi", "ra mat trong", "dang cap nhat", "sap ra mat", "sap mo ban", "sap khoi cong",
            "sap trien khai",
        ],
    ),
    (
        "Đã bàn giao",
        [
            "da ban giao", "da co so hong", "da ban giao toa", "da ban giao thap", "da ban giao giai doan",
            "da ban giao phan khu", "da xay dung hoan thien",
        ],
    ),
    (
        "Bàn giao",
        [
            "ban giao nam", "ban giao thang", "ban giao quy", "ban giao vao", "ban giao ngay", "ban giao toa",
            "ban giao toan", "ban giao giai doan", "ban giao trong", "sap ban giao", "chuan bi ban giao",
            "dang ban giao",
        ],
    ),
    (
        "Đang bán",
        [
            "dang ban", "dang mo ban", "ban het", "ban toan bo", "ban gio hang", "ban nhung can cuoi",
            "dang ban phan khu", "dang ban toa",
        ],
    ),
    (
        "Mở bán",
        [
            "mo ban", "ra mat thap", "ra mat du an", "mo ban dot", "mo ban giai doan", "mo ban gio hang",
            "ra mat khu",
        ],
    ),
    ("Nhận booking", ["nhan booking", "nhan dat cho", "giu cho", "dat cho", "nhan giu cho"]),
    ("Cất nóc", ["cat noc", "sap cat noc"]),
    ("Khởi công", ["khoi cong", "dong tho"]),
    ("thi công", ["thi cong", "thi cong tro lai", "dang thi cong"]),
]
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
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
REQUIRED_COLUMNS = ["title", "address", "area", "price", "post_id", "post_start_time", "post_end_time", "post_type"]

U = "'Không xác định'"
# Space characters that can occur in the tables.
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288)"
NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"

LISTINGS = "listings as (" + LISTING_SQL.format(orders="orders", customer="customer", nation="nation") + ")"


def title(x: str) -> str:
    words = rf"regexp_extract_all(lower({x}), '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+')"
    first = "case when w[1] = 'ß' then 'Ss' else upper(w[1]) end"
    return f"array_to_string(list_transform({words}, lambda w: {first} || w[2:]), '')"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g'))"


def plain(x: str) -> str:
    folded = f"lower(replace(replace(strip_accents({x}), 'đ', 'd'), 'Đ', 'd'))"
    return f"trim(regexp_replace({folded}, '[^a-z0-9/]+', ' ', 'g'))"


def number(x: str) -> str:
    return f"case when regexp_matches({strip(x)}, {NUMBER}) then try_cast({strip(x)} as double) end"


def round2(x: str) -> str:
    return f"cast(round(cast({x} as decimal(30, 10)), 2) as double)"


def not_float(x: str) -> str:
    quote = f"case when contains({x}, '''') and not contains({x}, '\"') then '\"' else '''' end"
    return f"'could not convert string to float: ' || {quote} || {x} || {quote}"


def any_of(x: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, '{w}')" for w in words) + ")"


def empty(x: str) -> str:
    return f"coalesce({x}, '') = ''"


def post_date(x: str) -> str:
    return f"""case
      when contains({x}, '-') or contains({x}, 'T') then case
        when regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
          then strftime(try_strptime({x}, '%Y-%m-%d'), '%Y-%m-%d')
        when try_strptime({x}, '%Y-%m-%dT%H:%M:%SZ') is not null
          then strftime(try_strptime({x}, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%S') || '+00:00' end
      when regexp_matches({x}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$')
        then strftime(try_strptime({x}, '%d/%m/%Y'), '%Y-%m-%d') end"""


def count_field(c: str) -> str:
    return f"case when {empty(c)} then -1 else try_cast(regexp_extract({c}, '[0-9]+') as integer) end"


_stage = " ".join(
    f"when regexp_matches(status, '{'|'.join(keys)}') then '{label}'"
    for label, keys in STAGE_KEYWORDS
)
_type = " ".join(f"when contains(lower(subpage_url), '{p}') then '{t}'" for p, t in PROPERTY_TYPES)
_complete = " and ".join(f"not ({empty(c)})" for c in REQUIRED_COLUMNS)
_flags = ", ".join(
    f"cast({any_of('coalesce(lower(legal), $$$$)', words)} as integer) as {name}" for name, words in LEGAL_KEYWORDS.items()
)

PREPARED = f"""prepared as (select *,
  string_split({title("address")}, ',') as parts,
  replace(replace({strip("replace(replace(" + strip("lower(area)") + ", 'm²', ''), 'm2', '')")}, '.', ''), ',', '.') as area_s,
  replace({strip("lower(price)")}, ',', '.') as price_s,
  {strip("replace(replace(facade, ',', '.'), 'm', '')")} as facade_s,
  {strip("replace(replace(replace(replace(lower(way_in), '\"', ''), '''', ''), 'm', ''), ',', '.')")} as way_s,
  {plain("project_status")} as status,
  {strip("post_start_time")} as start_s, {strip("post_end_time")} as end_s,
  lower(coalesce(furniture, '')) as furniture_s
from listings)"""

VALUES = f"""valued as (select *,
  len(parts) as n_parts,
  {title(strip("replace(replace(replace(lower(replace(parts[-1], '.', '')), 'thành phố', ''), 'tỉnh', ''), 'tp', '')"))} as city_s,
  {title(strip("replace(replace(replace(replace(parts[-2], 'Quận', ''), 'Huyện', ''), 'Q', ''), 'H', '')"))} as district_s,
  try_cast(nullif(regexp_extract(main_page_url, '/p([0-9]+)', 1), '') as integer) as page_number,
  {round2(number("area_s"))} as area_m2,
  regexp_extract(price_s, '[0-9.]+') as price_n,
  case when {empty("facade")} then -1.0 else {round2(number("facade_s"))} end as v_facade,
  case when {empty("way_in")} then -1.0 else {round2(number("way_s"))} end as way_in_m,
  {_flags},
  case when {any_of("furniture_s", ["cơ bản", "basic", "đơn giản"])} then 'basic'
    when {any_of("furniture_s", ["đầy đủ", "full", "hoàn thiện"])} then 'full' else {U} end as furniture_type,
  cast({any_of("furniture_s", ["cao cấp", "sang trọng", "premium", "luxury"])} as integer) as has_premium_furniture,
  {", ".join(f"{count_field(c)} as v_{c}" for c in ["number_bedroom", "number_bathroom", "number_floor"])},
  {", ".join(f"case when {empty(c)} then {U} when contains({c}, '-') then {title(squeeze(f'replace({c}, $$-$$, $$ $$)'))} else {title(strip(c))} end as v_{c}" for c in ["house_direction", "balcony_direction"])},
  {", ".join(f"case when {empty(strip(c))} then {U} else {title(squeeze(c))} end as v_{c}" for c in ["project_name", "project_investor"])},
  case when {empty(strip("project_status"))} or project_status = '(blank)' or status in ('', 'khong xac dinh') then {U}
    {_stage} else 'Khác' end as project_status_stage,
  {post_date("start_s")} as v_post_start_time, {post_date("end_s")} as v_post_end_time,
  case {_type} end as loai_bat_dong_san
from prepared)"""

PRICED = f"""priced as (select *,
  case when {empty("price")} or area_m2 is null or area_m2 <= 0 or {any_of("price_s", ["thỏa thuận", "thoa thuan"])} then -1.0
    when contains(price_s, 'tỷ') then {round2(f"({number('price_n')}) * 1000 / area_m2")}
    when contains(price_s, 'triệu/m²') then {round2(number("price_n"))}
    when contains(price_s, 'triệu') then {round2(f"({number('price_n')}) / area_m2")} end as million_per_m2,
  case when n_parts = 5 then {strip("parts[1]")}
    when n_parts = 4 and not contains(lower(parts[1]), 'đường') then {strip("parts[1]")} else {U} end as specific_area,
  case when n_parts = 5 then {strip("parts[2]")}
    when n_parts = 4 and contains(lower(parts[1]), 'đường') then {strip("parts[1]")} else {U} end as hamlet_neighborhood,
  {strip("parts[-3]")} as ward_commune,
  case when district_s = '' then {U} else district_s end as v_district,
  case when city_s = '' then {U} else city_s end as v_city,
  case when {empty(strip("address"))} then 'Address is required'
    when n_parts < 3 or n_parts > 5 then 'Invalid address format'
    when regexp_matches(parts[-1], '[0-9]') then 'Tỉnh/Thành phố không được chứa số.'
    when contains(city_s, 'Quận') then 'Quận không được chứa trong tỉnh/thành phố'
    when contains(district_s, 'Phường') then 'Phường không được chứa trong quận/huyện' end as e_address,
  case when {empty("area")} then 'Area is required' when area_m2 is null then {not_float("area_s")} end as e_area,
  case when v_facade is null then {not_float("facade_s")} end as e_facade,
  case when not ({empty("legal")}) and have_red_book + have_pink_book + have_sale_contract + have_agreement_document = 0
    then 'Giấy tờ cần xử lý thủ công' end as e_legal,
  case when furniture_s <> '' and furniture_type = {U} and has_premium_furniture = 0
    then 'Nội thất cần xử lý thủ công' end as e_furniture,
  {", ".join(f"case when v_{c} is null then 'Error cleaning number field ''' || {c} || '''' end as e_{c}" for c in ["number_bedroom", "number_bathroom", "number_floor"])},
  case when way_in_m is null then {not_float("way_s")} end as e_way_in,
  case when {empty("subpage_url")} then 'URL rỗng'
    when loai_bat_dong_san is null then 'URL không khớp với pattern nào: ' || subpage_url end as e_type
from valued)"""

CHECKED = f"""cleaned as (select *, coalesce(
    case when not ({_complete}) then 'Thiếu các trường bắt buộc' end,
    case when main_page_url is null then 'expected string or bytes-like object, got ''NoneType''' end,
    e_address, e_area, e_price, e_facade, e_legal, e_furniture,
    e_number_bedroom, e_number_bathroom, e_number_floor, e_way_in, e_type) as error_message
  from (select *, case when million_per_m2 is null then
    case when price_n <> '' and ({number("price_n")}) is null then {not_float("price_n")}
      else 'Price ''' || price || ''' không phù hợp' end end as e_price from priced))"""

_ALL = f"with {LISTINGS}, {PREPARED}, {VALUES}, {PRICED}, {CHECKED}"

_RENAMED = {
    "district": "v_district",
    "province_city": "v_city",
    "store_staging_at": "created_at",
    **{
        c: f"v_{c}"
        for c in [
            "house_direction", "balcony_direction", "facade", "number_bedroom", "number_bathroom", "number_floor",
            "project_name", "project_investor", "post_start_time", "post_end_time",
        ]
    },
}
_CLEAN = [c for c in CLEAN_COLUMNS if c != "transformed_at"]
_CLEAN_SELECT = ", ".join(f"{_RENAMED.get(c, c)} as {c}" for c in _CLEAN)
_GOOD = f"good as (select {_CLEAN_SELECT}, ingest_seq from cleaned where error_message is null)"
_NEWEST = "row_number() over (partition by subpage_url order by store_staging_at desc nulls last, ingest_seq desc)"
_MERGED = f"""{_ALL}, {_GOOD},
  early as (select * from good where store_staging_at < timestamp '1999-01-01' qualify {_NEWEST} = 1),
  late as (select * from good where store_staging_at >= timestamp '1999-01-01' qualify {_NEWEST} = 1),
  merged as (select * from late union all
    select * from early where subpage_url not in (select subpage_url from late))"""
_MERGED_LATE = _MERGED.replace(
    "select * from late union all", "select * from early union all"
).replace("select * from early where subpage_url not in (select subpage_url from late)", "select * from late where subpage_url not in (select subpage_url from early)")
_AT_TEXT = ", ".join(
    "strftime(store_staging_at, '%Y-%m-%d %H:%M:%S') as store_staging_at" if c == "store_staging_at" else c for c in _CLEAN
)
_RAW = ", ".join(RAW_COLUMNS)
_QC = ", ".join(f"count(*) filter ({empty(c)}) as missing_{c}" for c in RAW_COLUMNS)
_DAILY = f"daily as (select cast(created_at as date) as crawl_date, count(*) as total_records, {_QC} from listings group by 1)"
_SERIES = " union all ".join(
    f"select crawl_date, 'missing_{c}' as metric, missing_{c} as n, 'Missing {c.replace('_', ' ').title()}' as label from daily"
    for c in RAW_COLUMNS
)
_ERRORS = """faults as (select cast(created_at as date) as report_date, created_at,
    case ingest_seq % 3 when 0 then 'pending' when 1 then 'resolved' else 'failed' end as retry_status
    from cleaned where error_message is not null),
  fault_days as (select report_date, count(*) as total_errors,
    count(*) filter (retry_status = 'pending') as total_pending,
    count(*) filter (retry_status = 'resolved') as total_resolved,
    count(*) filter (retry_status = 'failed') as total_failed, max(created_at) as latest_error_time
    from faults group by 1)"""
_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def _decode(x: str) -> str:
    for entity, char in [
        ("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"),
        ("&apos;", "''''"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'"),
    ]:
        x = f"replace({x}, '{entity}', {char})"
    return x


_DOC = r"regexp_replace(html, '(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g')"


def _inner(tag: str) -> str:
    text = f"regexp_replace(regexp_extract({_DOC}, '(?s)<{tag}[^>]*>(.*?)</{tag}>', 1), '<[^>]*>', '', 'g')"
    return f"nullif({strip(_decode(text))}, '')"


_LINKS = rf"""links as (select page_id, url, unnest(hrefs) as href, unnest(range(len(hrefs))) as position,
    regexp_extract(url, '^(https?://[^/?#]+)', 1) as base
  from (select page_id, url, regexp_extract_all({_DOC}, '<a\s[^>]*href="([^">]+)"', 1) as hrefs from pages)),
  whole as (select page_id, url, position, {_decode("href")} as h, base from links),
  kept as (select page_id, url, position, case when h like '/%' then base || h else h end as subpage_url
    from whole where h like '/%' or starts_with(h, base))"""

_PAGE_TEXT = {
    **{c: f"nullif(trim({c}), '') as {c}" for c in ["title", "address", "project_name"]},
    **{c: f"nullif(trim({c}), '') as {c}" for c in ["post_id", "post_start_time", "post_end_time", "post_type"]},
    **{c: c for c in ["main_page_url", "subpage_url", "source", "crawled_at"]},
}
_PAGE_SELECT = ", ".join(_PAGE_TEXT.get(c, f"coalesce(trim({c}), '') as {c}") for c in RAW_COLUMNS)

_RAW_NULLED = f"""with {LISTINGS} select {", ".join(
        f"case when {c} in ({_TOKENS}) then null else {c} end as {c}" for c in RAW_COLUMNS)} from listings"""

ORACLE = {
    "page_number": f"{_ALL} select ingest_seq, main_page_url, page_number from cleaned",
    "address_parse": f"""{_ALL} select ingest_seq, e_address as error, {", ".join(
        f"case when e_address is null then {_RENAMED.get(c, c)} end as {c}"
        for c in ["specific_area", "hamlet_neighborhood", "ward_commune", "district", "province_city"])} from cleaned""",
    "area_clean": f"{_ALL} select ingest_seq, area_m2, e_area as error from cleaned",
    "price_per_m2": f"{_ALL} select ingest_seq, million_per_m2, e_price as error from cleaned",
    "direction": f"{_ALL} select ingest_seq, v_house_direction as house_direction, v_balcony_direction as balcony_direction from cleaned",
    "widths": f"""{_ALL} select ingest_seq, v_facade as facade, e_facade as error_facade, way_in_m,
        e_way_in as error_way_in from cleaned""",
    "legal_flags": f"{_ALL} select ingest_seq, {', '.join(LEGAL_KEYWORDS)}, e_legal as error from cleaned",
    "furniture": f"{_ALL} select ingest_seq, furniture_type, has_premium_furniture, e_furniture as error from cleaned",
    "number_fields": f"""{_ALL} select ingest_seq, {", ".join(f"v_{c} as {c}, e_{c} as error_{c}"
        for c in ["number_bedroom", "number_bathroom", "number_floor"])} from cleaned""",
    "project_names": f"{_ALL} select ingest_seq, v_project_name as project_name, v_project_investor as project_investor from cleaned",
    "status_stage": f"{_ALL} select ingest_seq, status as plain_status, project_status_stage from cleaned",
    "date_fields": f"{_ALL} select ingest_seq, v_post_start_time as post_start_time, v_post_end_time as post_end_time from cleaned",
    "property_type": f"{_ALL} select ingest_seq, loai_bat_dong_san, e_type as error from cleaned",
    "timestamp_text": "select event_id, case when event_type <> 'error' then epoch_us(ts) end as micros from events",
    "text_forms": f"""select doc_id, md5({title("text")}) as title_md5, md5({squeeze("text")}) as squeezed_md5,
        md5({plain("text")}) as plain_md5 from documents""",
    "required_fields": f"with {LISTINGS} select ingest_seq, {_complete} as is_complete from listings",
    "clean_rows": f"{_ALL}, {_GOOD} select * from good",
    "error_rows": f"""{_ALL} select ingest_seq, {_RAW}, created_at, error_message, 'pending' as retry_status
        from cleaned where error_message is not null""",
    "split_counts": f"""{_ALL} select case when error_message is null then 'good' else 'error' end as route,
        count(*) as n from cleaned group by 1""",
    "errors_by_message": f"{_ALL} select error_message, count(*) as n from cleaned where error_message is not null group by 1",
    "price_by_type": f"""{_ALL}, {_GOOD} select loai_bat_dong_san, count(*) as n,
        cast(sum(cast(million_per_m2 as decimal(18, 2))) as double) / count(*) as avg_million_per_m2 from good where million_per_m2 > 0 group by 1""",
    "latest_per_url": f"{_ALL}, {_GOOD} select * from good qualify {_NEWEST} = 1",
    "upsert_merge": f"{_MERGED} select * from merged",
    "exact_dedup": "select distinct md5(text) as text_md5, cast(length(text) as integer) as n_chars from documents",
    "first_copy": "select min(doc_id) as doc_id, lang, source from documents group by text, lang, source",
    "incremental_scan": "select * from events where ts > timestamp '2024-01-20'",
    "run_watermark": f"with {LISTINGS} select max(created_at) as last_date, count(*) as n_rows from listings",
    "two_runs": f"{_MERGED} select {_AT_TEXT} from merged",
    "run_summary": f"""{_ALL} select cast(1 as bigint) as run, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') as last_date,
        count(*) filter (error_message is null) as good_rows, count(*) filter (error_message is not null) as error_rows,
        count(*) filter (error_message is null)
          - count(distinct subpage_url) filter (error_message is null) as duplicate_rows from cleaned""",
    "streamed_clean": f"{_ALL}, {_GOOD} select {_AT_TEXT} from (select * from good qualify {_NEWEST} = 1)",
    "csv_round_trip": _RAW_NULLED,
    "file_log": f"""with {LISTINGS} select 'success' as status, '2025-10-27 09:48:51' as file_timestamp,
        count(*) as record_count from listings""",
    "null_tokens": """select p_partkey, case when p_partkey % 3 = 0 or p_partkey % 5 = 0 then null
          else string_split(p_type, ' ')[-1] end as label,
        case when p_size % 7 <> 0 then p_retailprice / p_size end as unit_price from part""",
    "file_times": """select event_id, case when event_type <> 'error' then strftime(ts, '%Y-%m-%d %H:%M:%S') end as file_time
        from events""",
    "qc_daily": f"with {LISTINGS}, {_DAILY} select * from daily",
    "qc_series": f"with {LISTINGS}, {_DAILY} {_SERIES}",
    "qc_totals": f"""with {LISTINGS}, {_DAILY} select cast(sum(total_records) as bigint) as total_records,
        cast(floor(avg(total_records)) as bigint) as avg_daily_records, count(distinct crawl_date) as num_days from daily""",
    "event_days": f"""select cast(ts as date) as crawl_date, count(*) as total_records,
        count(*) filter ({empty("event_type")}) as missing_event_type, count(*) filter ({empty("props")}) as missing_props
        from events group by 1""",
    "error_daily": f"{_ALL}, {_ERRORS} select * from fault_days",
    "error_totals": f"""{_ALL}, {_ERRORS}, last_day as (select * from fault_days order by report_date desc limit 1),
        totals as (select count(distinct report_date) as total_days, cast(sum(total_errors) as bigint) as total_errors,
          round(avg(total_errors), 2) as avg_daily_errors from fault_days)
      select t.total_days, t.total_errors, t.avg_daily_errors, total_pending as pending, total_resolved as resolved,
        total_failed as failed, round(total_resolved / d.total_errors * 100, 1) as resolution_rate,
        strftime(report_date, '%d/%m/%Y') as latest_report,
        strftime(latest_error_time, '%d/%m/%Y %H:%M') as latest_error_time, d.total_errors as latest_total_errors
      from totals t, last_day d""",
    "recent_errors": f"""{_ALL}, {_ERRORS} select strftime(report_date, '%d/%m/%Y') as report_date, total_errors,
        total_pending, total_resolved, total_failed, strftime(latest_error_time, '%d/%m/%Y %H:%M') as latest_error_time
      from (select * from fault_days order by fault_days.report_date desc limit 10)""",
    "latest_error_day": f"{_ALL}, {_ERRORS} select * from fault_days order by report_date desc limit 1",
    "filter_ops": """select * from orders where o_totalprice > 50000 and o_totalprice <= 400000
        and o_orderstatus in ('O', 'P') and o_orderpriority like '%-H%' and o_orderpriority <> '9-HIGH'
        and o_orderkey >= 100 and o_custkey < 1000000000""",
    "read_sorted": """select o_orderkey, o_totalprice from orders where o_orderstatus = 'O'
        order by o_orderkey limit 500 offset 20""",
    "paginate": "select * from orders order by o_totalprice, o_orderkey limit 50 offset 100",
    "page_size": "select 3 as page, 50 as page_size, count(*) as rows_in_page from (select * from orders limit 50 offset 100)",
    "count_filtered": """select count(*) as "count" from orders where o_orderstatus = 'F' and o_orderpriority = '2-HIGH'""",
    "update_where": """select o_orderkey, o_custkey,
        case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus,
        case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 0.0 else o_totalprice end as o_totalprice,
        o_orderdate, o_orderpriority from orders""",
    "delete_where": "select * from orders where o_orderstatus is null or o_orderstatus <> 'P'",
    "chunk_union": f"{_ALL} select ingest_seq, error_message from cleaned",
    "page_fields": f"select page_id, {_inner('h1')} as heading, {_inner('footer')} as footer from pages",
    "page_links": f"with {_LINKS} select page_id, cast(position as integer) as position, subpage_url from kept",
    "links_per_page": f"""with {_LINKS} select p.url as main_page_url, count(k.page_id) as subpage_count
        from pages p left join kept k on k.page_id = p.page_id group by 1""",
    "crawl_records": f"with {LISTINGS} select ingest_seq, {_PAGE_SELECT} from listings",
    "empty_pages": f"""with {LISTINGS} select ingest_seq, subpage_url,
        case when ingest_seq % 10 <> 0 then post_id end as post_id,
        case when ingest_seq % 10 = 0 then 'empty_item' end as error from listings""",
    "seed_pages": f"""with {LISTINGS}, seeds as (select 'https://example.org/nha-dat-ban/p' || i as main_page_url
          from range(0, 60) r(i))
        select s.main_page_url, count(l.ingest_seq) as subpage_count from seeds s
        left join listings l on l.main_page_url = s.main_page_url group by 1""",
    "payload_rows": f"with {LISTINGS} select {_RAW} from listings",
    "unknown_parents": f"""with {LISTINGS} select main_page_url, count(*) as n from listings
        where cast(regexp_extract(main_page_url, '([0-9]+)$', 1) as integer) < 5 group by 1""",
    "column_labels": """select event_id, 'Missing ' || upper(event_type[1]) || event_type[2:] || ' ' || user_id as label
        from events""",
    "late_load": f"{_MERGED_LATE} select {_AT_TEXT} from merged",
    "error_table": f"""{_ALL} select ingest_seq, subpage_url, error_message, 'pending' as retry_status
        from cleaned where error_message is not null""",
    "retry_update": f"""{_ALL} select ingest_seq, subpage_url, error_message,
        case when ingest_seq < 500 then 'resolved' when ingest_seq < 2000 then 'failed' else 'pending' end as retry_status
        from cleaned where error_message is not null""",
    "error_delete": f"""{_ALL} select ingest_seq, subpage_url, error_message, 'pending' as retry_status
        from cleaned where error_message is not null and error_message not like 'Thi%'""",
    "generic_insert": "select * from orders where o_orderstatus is not null",
    "ingest_two_files": _RAW_NULLED,
    "ingest_streams": _RAW_NULLED,
    "new_files": f"""with {LISTINGS} select case ingest_seq % 3 when 1 then '2025-10-28 09' else '2025-10-28 10' end as hour,
        count(*) as n from listings where ingest_seq % 3 > 0 group by 1""",
    "archived_files": f"""with {LISTINGS} select case ingest_seq % 2 when 0 then 'one_20251027_094851' else 'two_20251028_094851' end as folder,
          'success' as status, count(*) as record_count from listings group by 1
        union all select 'none_20251029_094851', 'failed', 0""",
    "nested_nulls": """select p_partkey, p_retailprice as whole, if(p_partkey % 4 = 3, p_retailprice, null) as odd,
        if(p_partkey % 4 = 3, p_retailprice, null) as first_item, p_retailprice as second_item,
        if(p_partkey % 4 = 3, p_retailprice, null) as listed, p_retailprice as listed_whole, 3 as n_listed,
        if(p_partkey % 4 = 3, p_retailprice, null) as mapped, p_brand as brand from part""",
    "qc_by_load": f"with {LISTINGS}, {_DAILY} select * from daily",
    "error_by_run": f"""{_ALL} select cast(created_at as date) as report_date, count(*) as total_errors,
        count(*) filter (ingest_seq % 3 = 2 or ingest_seq >= 2000) as total_pending,
        count(*) filter (ingest_seq % 3 < 2 and ingest_seq < 2000) as total_resolved, cast(0 as bigint) as total_failed,
        max(created_at) as latest_error_time from cleaned where error_message is not null group by 1""",
    "page_by_index": "select * from orders order by o_totalprice, o_orderkey limit 7 offset 1043",
    "open_items": f"""with {LISTINGS} select ingest_seq, {", ".join(f"nullif(trim(coalesce({c}, '')), '') as {c}"
        for c in ["title", "address", "facade", "legal", "furniture"])},
        coalesce(trim(price), '') as price, coalesce(trim(area), '') as area, 2 as n_items from listings""",
    "last_processed": f"with {LISTINGS} select true as is_newest, count(*) as record_count from listings",
    "csv_by_header": f"""with {LISTINGS} select {", ".join(
        f"case when {c} in ({_TOKENS}){' or ingest_seq % 3 = 2' if c == 'legal' else ''} then null else {c} end as {c}"
        for c in RAW_COLUMNS)} from listings""",
    "csv_latest": f"""with {LISTINGS} select subpage_url, post_id from listings
        qualify row_number() over (partition by subpage_url order by ingest_seq desc) = 1""",
    "page_after_key": """select * from orders where o_totalprice > 100000 or (o_totalprice = 100000 and o_orderkey > 0)
        order by o_totalprice, o_orderkey limit 50""",
    "sample_row": "select count(*) as n, count(o_orderkey) as n_keys from (select * from orders limit 1)",
    "preview": "select count(*) as n, count(distinct o_orderkey) as n_keys from (select * from orders limit 5)",
}
ORACLE = {name: sql.replace("$$$$", "''").replace("$$-$$", "'-'").replace("$$ $$", "' '") for name, sql in ORACLE.items()}
