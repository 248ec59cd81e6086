"""Regions to location-tagged markup: column expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, text
from .layout import with_regions

#: Fixed tags by label.
TAGS = {"Text": "text", "Section-Header": "section_header_level_1", "Page-Header": "page_header", "Page-Footer": "page_footer", "Caption": "caption"}


def _tagged(tag: str, loc: Column, body: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), loc, body, F.lit(f"</{tag}>"))


def lines(region: Column, width: Column, height: Column) -> Column:
    """The markup lines of a region, an array; a region without a box has none."""
    loc = geometry.loc(geometry.parse_bbox(region["bbox"]), width, height)
    label, body = region["label"], region["text"]
    item = lambda x: _tagged("list_item", loc, text.strip_list_marker(x))
    listed = F.concat(F.array(F.lit("<unordered_list>")), F.transform(region["items"], item), F.array(F.lit("</unordered_list>")))
    none = F.array().cast("array<string>")
    out = F.when(region["bbox"] == "", none)
    for name, tag in TAGS.items():
        out = out.when(label == name, F.array(_tagged(tag, loc, body)))
    out = out.when(label == "Table", F.array(_tagged("table", loc, F.coalesce(region["table_html"], body))))
    out = out.when(label == "Image", F.when(region["has_image"], F.array(_tagged("picture", loc, region["alt"]))).otherwise(none))
    out = out.when((label == "List-Group") & region["items"].isNotNull(), listed)
    out = out.when((label == "List-Group") | (body != ""), F.array(_tagged("text", loc, body)))
    return out.otherwise(none)


def document(regions: Column, width: Column, height: Column) -> Column:
    """The whole document's markup."""
    every = F.flatten(F.transform(regions, lambda r: lines(r, width, height)))
    return F.concat(F.lit("<doctag>\n"), F.array_join(every, "\n"), F.lit("\n</doctag>"))


def bad_boxes(regions: Column) -> Column:
    """True if a region's box would fail the page."""
    return F.exists(regions, lambda r: (r["bbox"] != "") & ~r["bbox"].rlike(r"(?U)^[+-]?[0-9]+(\s+[+-]?[0-9]+){3}(\s|$)"))


def convert(pages: DataFrame, html: str = "html", width: str = "img_w", height: str = "img_h") -> DataFrame:
    """pages with ``doctags`` and ``error``: a page with a box that is no four integers, or without a size, fails alone."""
    d = with_regions(pages, html)
    failed = bad_boxes(F.col("regions")) | ((F.size("regions") > 0) & ((F.coalesce(F.col(width), F.lit(0)) <= 0) | (F.coalesce(F.col(height), F.lit(0)) <= 0)))
    d = d.withColumn("error", F.when(failed, "bad bounding box or page size"))
    return d.withColumn("doctags", F.when(F.col("error").isNull(), document(F.col("regions"), F.col(width), F.col(height)))).drop("regions")
