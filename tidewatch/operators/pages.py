"""Crawled pages to table rows, with JVM regular expressions only.

Works on a ``(url, html)`` table; a page is one row, so nothing is grouped.
The pages' tables are flat (no table within a table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import (
    nav_status, parse_coord_sentence, parse_size, split_name_country, strip, stripped_or_null,
)
from tidewatch.operators.joins import dimension_join

C = F.col

ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def plain_text(html: Column, separator: str = "") -> Column:
    """Text of a fragment: tags replaced by the separator, entities decoded."""
    text = F.regexp_replace(html, r"<[^>]*>", separator)
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def lines_of(html: Column) -> Column:
    """Non-empty trimmed text lines, one per text node or line break."""
    parts = F.split(plain_text(html, "\n"), "\n")
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def _group(html: Column, pattern: str, idx: int = 1) -> Column:
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, idx))


def absolute(href: Column, base_url: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base_url), href))


def extract_list_rows(pages: DataFrame, base_url: str, page_type: Column) -> DataFrame:
    """Vessel records from the first table of list pages.

    The first row is the header. Rows with fewer than five cells or without a
    link in the first cell are skipped. The type is the second line of the
    first cell, else the page's.
    """
    table = _group(C("html"), r"(?is)<table[^>]*>(.*?)</table>")
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    exploded = pages.withColumn("_type", page_type).select(
        "url", "_type", F.posexplode(rows).alias("_n", "_row")
    ).filter(C("_n") > 0)
    cells = exploded.withColumn(
        "_c", F.regexp_extract_all("_row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1)
    ).filter(F.size("_c") >= 5)
    linked = cells.withColumn("_href", _group(C("_c")[0], r'(?is)<a[^>]*\shref="([^"]*)"')).filter(
        C("_href").isNotNull()
    )
    head = linked.withColumn("_l", lines_of(C("_c")[0]))
    length, beam = parse_size(strip(plain_text(C("_c")[4])))
    return head.select(
        C("url").alias("list_url"),
        F.get("_l", F.lit(0)).alias("name"),
        F.coalesce(F.get("_l", F.lit(1)), "_type").alias("type"),
        stripped_or_null(plain_text(C("_c")[1])).alias("year_built"),
        stripped_or_null(plain_text(C("_c")[2])).alias("gross_tonnage"),
        stripped_or_null(plain_text(C("_c")[3])).alias("deadweight"),
        length.alias("length(m)"),
        beam.alias("beam(m)"),
        absolute(C("_href"), base_url).alias("detail_link"),
    )


def _block(kind: str) -> Column:
    """Inner HTML of the voyage block of a kind, up to the next block or table."""
    return _group(C("html"), rf'(?is)<div class="vi__r1 {kind}">(.*?)(?=<div class="vi__r1|<table|</body|$)')


def _value(block: Column) -> Column:
    return strip(plain_text(_group(block, r'(?is)<div class="_value">(.*?)</div>')))


def extract_detail_fields(pages: DataFrame) -> DataFrame:
    """Ports, raw date texts, status and port link of vessel detail pages.

    A missing block gives NULLs; the date texts stay raw.
    """
    anchor = r'(?is)<a class="_npNa"[^>]*>(.*?)</a>'
    href = r'(?is)<a class="_npNa"[^>]*\shref="([^"]*)"'
    blocks = pages.withColumns({"_last": _block("vi__stp"), "_dest": _block("vi__sbt")})
    last_name, last_country = split_name_country(plain_text(_group(C("_last"), anchor)))
    dest_name, dest_country = split_name_country(plain_text(_group(C("_dest"), anchor)))
    table = _group(C("html"), r"(?is)<table[^>]*>(.*?)</table>")
    # every text node of the first table on its own line, as nav_status expects
    status_text = F.concat(F.array_join(lines_of(table), "\n"), F.lit("\n"))
    return blocks.select(
        C("url").alias("detail_link"),
        last_name.alias("last_port_name"),
        last_country.alias("last_port_country"),
        _value(C("_last")).alias("departure_date"),
        dest_name.alias("destination_port_name"),
        dest_country.alias("destination_port_country"),
        _value(C("_dest")).alias("arrival_date"),
        nav_status(status_text).alias("reported_status"),
        _group(C("_dest"), href).alias("port_link"),
    )


def port_coordinates(pages: DataFrame) -> DataFrame:
    """(port_link, lat, lon) texts from the sentence of port pages."""
    sentence = plain_text(_group(C("html"), r'(?is)<p class="text1">(.*?)</p>'))
    lat, lon = parse_coord_sentence(sentence)
    return pages.select(
        C("url").alias("port_link"), lat.alias("destination_port_lat"), lon.alias("destination_port_lon")
    )


def attach_port_coords(details: DataFrame, port_pages: DataFrame) -> DataFrame:
    """Coordinates per destination link; each port page is read once."""
    return dimension_join(details, port_coordinates(port_pages), ["port_link"], "left")


def page_links(pages: DataFrame) -> DataFrame:
    """(url, position, link, label) of the list anchors of any page."""
    items = F.regexp_extract_all("html", F.lit(r'(?is)<li><a href="([^"]*)">[^<]*</a></li>'), 1)
    labels = F.regexp_extract_all("html", F.lit(r'(?is)<li><a href="[^"]*">([^<]*)</a></li>'), 1)
    paired = F.arrays_zip(items.alias("link"), labels.alias("label"))
    return pages.select("page_id", "url", F.posexplode(paired).alias("position", "a")).select(
        "page_id", "url", "position", C("a.link").alias("link"), plain_text(C("a.label")).alias("label")
    )
