"""Archive links found in stored index pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of a link on a page: absolute, root-relative or relative."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://.*/)", 1)
    bare = F.concat(origin, F.lit("/"))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(F.length(folder) > F.length(origin) + 1, F.concat(folder, href))
        .otherwise(F.concat(bare, href))
    )


def extract_archive_links(
    pages: DataFrame,
    suffix: str = r"_tidalmask\.zip",
    html: str = "html",
    url: str = "url",
    prefix: str = "",
    order: str = "page_id",
) -> DataFrame:
    """Archive files linked from index pages: ``name, url``, one row per file name.

    ``suffix`` and ``prefix`` are regular expressions for the end of the link and the
    start of the file name. Among repeated names the last link wins, in page order
    and then in order of appearance.
    """
    found = F.regexp_extract_all(F.col(html), F.lit(f'(?i)href="([^"]+{suffix})"'), F.lit(1))
    links = pages.select(F.col(order).alias("_page"), F.col(url).alias("_base"), F.posexplode(found).alias("_at", "href"))
    named = links.withColumn("name", F.regexp_extract("href", r"([^/]*)/*$", 1))
    if prefix:
        named = named.where(F.col("name").rlike(f"^(?:{prefix})"))
    last = F.max_by(F.struct("_base", "href"), F.struct("_page", "_at")).alias("_l")
    return named.groupBy("name").agg(last).select("name", resolve_url(F.col("_l._base"), F.col("_l.href")).alias("url"))
