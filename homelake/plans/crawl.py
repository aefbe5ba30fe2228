"""Stored pages to listing records, link lists and per-page payloads."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import SPACE
from ..schemas import RAW_COLUMNS


@dataclass(frozen=True)
class Selectors:
    """Where a detail page keeps its fields. Class names and labels of the site."""

    title_class: str = "re__pr-title pr-title js__pr-title"
    address_class: str = "re__pr-short-description js__pr-address"
    project_class: str = "re__project-title"
    link_class: str = "js__product-link-for-product-id"
    spec_item: str = "re__pr-specs-content-item"
    spec_title: str = "re__pr-specs-content-item-title"
    spec_value: str = "re__pr-specs-content-item-value"
    spec_labels: dict[str, str] = field(
        default_factory=lambda: {
            "price": "Khoảng giá",
            "area": "Diện tích",
            "house_direction": "Hướng nhà",
            "balcony_direction": "Hướng ban công",
            "facade": "Mặt tiền",
            "legal": "Pháp lý",
            "furniture": "Nội thất",
            "number_bedroom": "Số phòng ngủ",
            "number_bathroom": "Số phòng tắm, vệ sinh",
            "number_floor": "Số tầng",
            "way_in": "Đường vào",
        }
    )
    card_item: str = "re__prj-card-config-value"
    card_value: str = "re__long-text"
    card_icons: dict[str, str] = field(
        default_factory=lambda: {
            "project_status": "re__icon-info-circle--sm",
            "project_investor": "re__icon-office--sm",
        }
    )
    post_item: tuple[str, ...] = ("re__pr-short-info-item", "js__pr-config-item")
    post_title: str = "title"
    post_value: str = "value"
    post_labels: dict[str, str] = field(
        default_factory=lambda: {
            "post_id": "Mã tin",
            "post_start_time": "Ngày đăng",
            "post_end_time": "Ngày hết hạn",
            "post_type": "Loại tin",
        }
    )


def _choices(s: Selectors) -> dict[str, H.Choice]:
    spans = {name: H.element("span", name) for name in (s.spec_title, s.spec_value, s.card_value, s.post_title, s.post_value)}
    specs = H.Items(H.element("div", s.spec_item), spans[s.spec_value], spans[s.spec_title])
    cards = H.Items(H.element("span", s.card_item), spans[s.card_value])
    posts = H.Items(H.element("div", *s.post_item), spans[s.post_value], spans[s.post_title])
    return {
        **{c: H.Choice(specs, label) for c, label in s.spec_labels.items()},
        **{c: H.Choice(cards, f" {icon} ") for c, icon in s.card_icons.items()},
        **{c: H.Choice(posts, label, skip_blank=True) for c, label in s.post_labels.items()},
    }


def listing_records(
    pages: DataFrame, crawled_at: Column, source: Column, selectors: Selectors = Selectors(), keep: list[str] = []
) -> DataFrame:
    """One raw listing record per stored page (main_page_url, url, html), and ``error``.

    A page without content gives a record with only its addresses, marked ``empty_item``.
    """
    s = selectors
    heads = {
        "title": H.element("h1", exact_class=s.title_class),
        "address": H.element("span", exact_class=s.address_class),
        "project_name": H.element("div", exact_class=s.project_class),
    }
    choices = _choices(s)
    found = pages.withColumn("_page", H.fields("html", heads, choices=choices))
    texts = {c: H.trimmed(f"_page.{c}") for c in [*heads, *choices]}
    # Found once here, tested for blanks in the next projection; so is whether the page is blank, from its front alone.
    blank = F.coalesce(F.ltrim("html", F.lit(SPACE)) == "", F.lit(True))
    found = found.withColumns({f"_t_{c}": text for c, text in texts.items()} | {"_blank": blank})
    blank_when_absent = [*s.spec_labels, *s.card_icons]
    empty = F.col("_blank")
    values = {c: H.or_default(f"_t_{c}", "" if c in blank_when_absent else None) for c in texts}
    values = {c: F.when(~empty, v) for c, v in {**values, "crawled_at": crawled_at}.items()} | {
        "main_page_url": F.col("main_page_url"),
        "subpage_url": F.col("url"),
        "source": source,
    }
    return found.select(*[values[c].alias(c) for c in RAW_COLUMNS], F.when(empty, "empty_item").alias("error"), *keep)


def listing_links(
    pages: DataFrame, base: Column, link_class: str | None = Selectors.link_class, keep: list[str] = []
) -> DataFrame:
    """Links of a page in order, made absolute; links to other places than ``base`` are dropped."""
    found = pages.select(
        *keep, F.col("url").alias("main_page_url"), base.alias("_base"),
        F.posexplode(H.links("html", "url", link_class)).alias("position", "subpage_url"),
    )
    return found.where(F.col("subpage_url").startswith(F.col("_base"))).drop("_base")


def seed_pages(spark: SparkSession, base: str, start: int, end: int) -> DataFrame:
    """Addresses of the listing pages ``start`` to ``end``, both included."""
    return spark.range(start, end + 1).select(F.concat(F.lit(base), F.lit("p"), F.col("id")).alias("main_page_url"))


def items_per_page(seeds: DataFrame, items: DataFrame) -> DataFrame:
    """Item count of each seed page, 0 included; items of other pages are left out.

    Items are counted before the join, so a page with very many items is one row there.
    """
    counts = items.groupBy("main_page_url").agg(F.count("*").alias("n"))
    return seeds.join(counts, "main_page_url", "left").select(
        "main_page_url", F.coalesce("n", F.lit(0)).alias("subpage_count")
    )


def page_payloads(counts: DataFrame, items: DataFrame, columns: list[str], unique: str, chunk_size: int = 200) -> DataFrame:
    """Nested payloads (main_page_url, chunk, subpage_count, subpage_data) of about ``chunk_size`` items.

    A page with many items is spread over many payload rows by a hash of ``unique``, so no task
    gathers a whole page; ``subpage_count`` is the page's full count on each of its rows. A seed
    page without items has one row with an empty list. ``counts`` are those of ``items_per_page``,
    best from a written table: then Spark knows their size, and the items are derived once.
    """
    chunks = F.greatest(F.lit(1), F.ceil(F.col("subpage_count") / chunk_size))
    placed = items.join(counts, "main_page_url").withColumn("chunk", F.pmod(F.xxhash64(unique), chunks))
    lists = placed.groupBy("main_page_url", "chunk", "subpage_count").agg(
        F.collect_list(F.struct(*columns)).alias("subpage_data")
    )
    none = counts.where("subpage_count = 0").select(
        "main_page_url",
        F.lit(0).cast("long").alias("chunk"),
        "subpage_count",
        F.array().cast(lists.schema["subpage_data"].dataType).alias("subpage_data"),
    )
    return lists.unionByName(none)


def flat_rows(payloads: DataFrame) -> DataFrame:
    """Payloads back to one row per item with the raw columns."""
    items = payloads.select("main_page_url", F.explode("subpage_data").alias("item"))
    return items.select("main_page_url", *[F.col(f"item.{c}") for c in RAW_COLUMNS if c != "main_page_url"])
