"""Listing-shaped rows derived from the given orders, customer and nation tables.

``LISTING_SQL`` runs unchanged on Spark and on any engine with the same tables, so that a
check can start from the same rows. One listing per order; ``o_orderkey`` is unique and gives
the arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LISTING_COLUMNS = """
select o_orderkey as ingest_seq,
  'https://example.org/nha-dat-ban/p' || cast(o_orderkey % 40 as string) as main_page_url,
  'https://example.org/' || case o_orderkey % 13
     when 0 then 'ban-nha-biet-thu' when 1 then 'ban-can-ho-chung-cu' when 2 then 'ban-nha-rieng'
     when 3 then 'ban-dat-xa' when 4 then 'ban-dat-duong' when 5 then 'ban-dat-nen' when 6 then 'BAN-CONDOTEL'
     when 7 then 'ban-shophouse' when 8 then 'ban-loai-bat-dong-san-khac' when 9 then 'ban-nha-mat-pho'
     when 10 then 'ban-dat-phuong' when 11 then 'ban-trang-trai' else 'cho-thue' end
     || '-' || cast(o_custkey as string) as subpage_url,
  case when o_orderkey % 29 = 0 then null else 'Tin ' || o_orderpriority end as title,
  case o_orderkey % 7
     when 0 then 'phường 11, quận 1, Thành phố Hồ Chí Minh'
     when 1 then 'Đường Nguyễn Văn Linh, Liên Hà, Đông Anh, tỉnh ' || lower(n_name)
     when 2 then 'khu ' || lower(n_name) || ', Hòa Nghĩa, Huyện Hoàng Mai, TP. Hà Nội'
     when 3 then 'Nhà An Khê, Lỗ Khê, Liên Hà, Q. Ba Đình, Hà Nội'
     when 4 then 'Liên Hà, Hà Nội'
     when 5 then 'Lô a1-2b, Mỹ Đình, Nam Từ Liêm, Hà Nội 2'
     else 'Liên Hà, , Tp.' end as address,
  case o_orderkey % 8
     when 0 then 'Thỏa thuận'
     when 1 then cast(o_orderkey % 9 + 1 as string) || ',' || cast(o_orderkey % 10 as string) || ' tỷ'
     when 2 then cast(o_custkey % 900 + 50 as string) || ' triệu'
     when 3 then '~' || cast(o_custkey % 200 + 5 as string) || ',25 triệu/m²'
     when 4 then '1.234,5 tỷ' when 5 then 'Liên hệ' when 6 then '' else '2 Tỷ/m²' end as price,
  case when o_orderkey % 31 = 0 then 'abc' when o_orderkey % 37 = 0 then '0 m²'
     when o_orderkey % 3 = 0 then '1.' || cast(100 + o_custkey % 900 as string) || ',5 m²'
     else cast(20 + o_orderkey % 300 as string) || ',' || cast(o_orderkey % 10 as string) || 'M2' end as area,
  case o_orderkey % 4 when 0 then 'Đông - Nam' when 1 then 'tây bắc' when 2 then '' else null end
     as house_direction,
  case o_custkey % 5 when 0 then 'đông-bắc' when 1 then '  Tây  ' when 2 then null when 3 then 'NAM'
     else ' ' end as balcony_direction,
  case o_orderkey % 5 when 0 then '5,5 m' when 1 then '6m' when 2 then null when 3 then '12'
     else '7M' end as facade,
  case o_orderkey % 9 when 0 then 'Sổ đỏ/ Sổ hồng' when 1 then 'HĐMB' when 2 then 'văn bản thỏa thuận'
     when 3 then '' when 4 then 'đang chờ sổ' else 'so hong' end as legal,
  case o_orderkey % 6 when 0 then 'Đầy đủ' when 1 then 'Đầy đủ nội thất cơ bản' when 2 then 'Cao cấp'
     when 3 then null when 4 then 'không' else 'Basic' end as furniture,
  case o_orderkey % 5 when 0 then '3 phòng' when 1 then null when 2 then '10' when 3 then 'nhiều'
     else '2 - 4 phòng' end as number_bedroom,
  case when o_orderkey % 53 = 0 then 'một' when o_custkey % 3 = 0 then null
     else cast(o_custkey % 6 + 1 as string) || ' phòng' end as number_bathroom,
  case when o_orderkey % 59 = 0 then 'tầng trệt' when o_custkey % 4 = 0 then ''
     else cast(o_custkey % 30 + 1 as string) || ' tầng' end as number_floor,
  case o_orderkey % 4 when 0 then '"5m"' when 1 then '3,5 M' when 2 then null else '  ' end as way_in,
  case o_orderkey % 3 when 0 then '  vinhomes   golden city ' when 1 then null else '   ' end as project_name,
  case o_orderkey % 11 when 0 then 'Đã bàn giao tòa A' when 1 then 'Bàn giao quý IV/2025'
     when 2 then 'Sắp bàn giao' when 3 then 'Đang mở bán' when 4 then 'Mở bán đợt 2'
     when 5 then 'Dự kiến mở bán' when 6 then 'Cất nóc' when 7 then '(blank)' when 8 then 'Bàn giao 2024'
     when 9 then 'Không xác định' else 'Đang thi công' end as project_status,
  case o_custkey % 4 when 0 then 'tập đoàn ' || lower(n_name) when 1 then null when 2 then ' CÔNG  TY cp-' || n_name
     else '' end as project_investor,
  cast(o_orderkey as string) as post_id,
  case o_orderkey % 5 when 0 then '1/12/2025' when 1 then '31/2/2025' when 2 then '2025-12-01T10:00:00Z'
     when 3 then '2025-12-01' else '05/06/2024' end as post_start_time,
  case when o_orderkey % 41 = 0 then '' else '15/1/2026' end as post_end_time,
  'VIP ' || o_orderstatus as post_type, 'example.org' as source,
  cast(o_custkey as string) || 'T' as crawled_at,
  o_orderdate as created_at
"""
_LISTING_TABLES = """from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""
LISTING_SQL = _LISTING_COLUMNS + _LISTING_TABLES

#: Bytes of the orders table for one task of listing rows: a row of it is some ten bytes as stored, and
#: more than a thousand as a listing.
LISTING_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _size(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def listing_tasks(spark: SparkSession, folder: str) -> int:
    """Tasks that the listing rows need by their size."""
    return max(1, -(-_size(table(spark, folder, "orders")) // LISTING_BYTES))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for per-row work on a table that is less than one input split.

    At most the bytes of a split are exchanged; any larger table is read in as many tasks as it
    has splits.
    """
    size = _size(df)
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key) if size <= split else df


def _in_parts(name: str) -> F.Column:
    """The column as it is, through a function that Spark interprets: a projection that has one is compiled
    in parts. As one method, that of very many columns is beyond what the JVM compiles."""
    return F.get(F.transform(F.array(name), lambda value: value), F.lit(0))


def listings(spark: SparkSession, folder: str, ordered: bool = False) -> DataFrame:
    """Staging-shaped rows; joins are left to Spark, which broadcasts only what it knows is small.

    The joined rows are dealt to tasks before they grow to listings, by as many as their size asks for;
    with ``ordered`` all are sorted by ``ingest_seq``.
    """
    joined = spark.sql(
        "select o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_orderdate, n_name " + _LISTING_TABLES,
        orders=table(spark, folder, "orders"),
        customer=table(spark, folder, "customer"),
        nation=table(spark, folder, "nation"),
    )
    tasks = max(spark.sparkContext.defaultParallelism, listing_tasks(spark, folder))
    if ordered:
        dealt = joined.repartitionByRange(tasks, "o_orderkey").sortWithinPartitions("o_orderkey")
    else:
        dealt = joined.repartition(tasks, "o_orderkey", "o_custkey")
    rows = spark.sql(_LISTING_COLUMNS + "from {joined}", joined=dealt)
    return rows.withColumn("subpage_url", _in_parts("subpage_url"))


def _varied(plain: F.Column, nested: F.Column, referenced: F.Column) -> F.Column:
    """Three ways of writing the same block, by the row's number."""
    way = F.col("ingest_seq") % 3
    return F.coalesce(F.when(way == 0, plain).when(way == 1, nested).otherwise(referenced), F.lit(""))


def _item(tag_class: str, title: str, value: str, label: str, name: str) -> F.Column:
    """One labelled block, present only where the column has a value.

    Written plainly; with four levels of the same tag, other quotes and another order of
    attributes; and with character references and an item that has a label but no value before it.
    """
    plain = F.concat(
        F.lit(f'<div class="{tag_class}"><span class="{title}">{label}</span><span class="{value}">\n'),
        _escaped(name),
        F.lit("</span></div>"),
    )
    nested = F.concat(
        F.lit(
            f"<DIV data-x='a>b' class='{tag_class}'><div><div><div><span id=1 class={title}>{label}</span></div></div>"
            f"<div><span data-y=\"it's\" class='{value}'><span><span>"
        ),
        _escaped(name),
        F.lit("</span></span></span></div></div></DIV>"),
    )
    referenced = F.concat(
        F.lit(f'<div class="{tag_class}"><span class="{title}">{label}</span><br></div>'),
        F.lit(f'<div class="{tag_class}"><span class="{title}">{_references(label)}</span><span class="{value}">&nbsp;'),
        _referenced(name),
        F.lit("</span></div>"),
    )
    return _varied(plain, nested, referenced)


# The same letters as named, decimal and hexadecimal references.
_REFERENCES = [("ò", "&ograve;"), ("đ", "&#273;"), ("ấ", "&#x1EA5;"), ("Đ", "&#272;"), ("ả", "&#x1ea3;")]


def _references(text: str) -> str:
    for letter, reference in _REFERENCES:
        text = text.replace(letter, reference)
    return text


def _escaped(name: str) -> F.Column:
    text = F.col(name)
    for raw, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]:
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _referenced(name: str) -> F.Column:
    text = _escaped(name)
    for letter, reference in _REFERENCES:
        text = F.replace(text, F.lit(letter), F.lit(reference))
    return text


def listing_pages(rows: DataFrame, selectors) -> DataFrame:
    """Stored detail pages (main_page_url, url, html) written from listing rows.

    The inverse of page extraction: reading these pages must give the rows back.
    """
    parts = [
        F.lit("<html><head><script>var s='<h1 class=\"x\">no</h1>';</script></head><body><!-- <h1>no</h1> -->"),
        F.coalesce(
            F.concat(F.lit(f"<h1 class='{selectors.title_class}'> "), _escaped("title"), F.lit("</h1>")), F.lit("")
        ),
        F.coalesce(
            F.concat(F.lit(f'<span class="{selectors.address_class}">'), _escaped("address"), F.lit("</span>")),
            F.lit(""),
        ),
    ]
    for name, label in selectors.spec_labels.items():
        parts.append(_item(f"a {selectors.spec_item} b", selectors.spec_title, selectors.spec_value, label, name))
    parts.append(
        _varied(
            F.concat(F.lit(f'<div class="{selectors.project_class}"><b>'), _escaped("project_name"), F.lit("</b></div>")),
            F.concat(F.lit(f"<div class='{selectors.project_class}'><div><div><div>"), _escaped("project_name"), F.lit("</div></div></div></div>")),
            F.concat(F.lit(f'<div class="{selectors.project_class}">'), _referenced("project_name"), F.lit("</div>")),
        )
    )
    for name, icon in selectors.card_icons.items():
        card = F.concat(
            F.lit(f'<span class="{selectors.card_item}"><i class="re__icon {icon}"></i><span class="{selectors.card_value}">'),
            _escaped(name),
            F.lit("</span></span>"),
        )
        parts.append(F.coalesce(card, F.lit("")))
    for name, label in selectors.post_labels.items():
        classes = " ".join(selectors.post_item)
        parts.append(_item(classes, selectors.post_title, selectors.post_value, label, name))
    parts.append(F.lit("</body></html>"))
    return rows.select(
        "ingest_seq",
        "main_page_url",
        _in_parts("subpage_url").alias("url"),
        F.concat(*parts).alias("html"),
        "source",
        "crawled_at",
    )


def open_pages(rows: DataFrame) -> DataFrame:
    """Pages (ingest_seq, html) written from listing rows without the end tags that HTML lets a page leave out."""
    part = lambda opening, name: F.concat(F.lit(opening), F.coalesce(_escaped(name), F.lit("")))
    item = lambda name: part(f'<li class="item"><span class="t">{name}</span><span class="v">', name)
    html = F.concat(
        F.lit("<html><head><title>listing</title><body><ul>"), item("price"), F.lit("</span>"), item("area"), F.lit("</span><li>"),
        F.lit("none</ul>"), part('<p class="note">', "title"), part('<p class="place">', "address"),
        part('<table><tr><td class="a">', "facade"), part('<td class="b">', "legal"), part('<tr><td class="c">', "furniture"),
        F.lit("</table>after</body>"),
    )
    return rows.select("ingest_seq", html.alias("html"))
