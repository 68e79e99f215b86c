"""Data-file link discovery over a table of web pages.

The source fetched one page and listed its ``<a href>`` targets ending in a data-file
suffix, making root-relative links absolute. Here the pages are rows, the anchors are
pulled out with ``regexp_extract_all`` and exploded with their position (a page can list
one file twice), and each page's own scheme and host make relative links absolute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger import fixed_values as fv

# The href of an <a> tag, quoted either way or not at all; group 1 keeps the quotes.
_ANCHOR_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _unescape(c):
    for ent, ch in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def discover_links(pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id",
                   suffixes: list[str] | None = fv.DATA_FILE_SUFFIXES) -> DataFrame:
    """(page id, position, absolute link) for every anchor whose target ends (case-insensitive)
    in one of ``suffixes``; ``suffixes=None`` keeps every anchor."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(_ANCHOR_HREF), 1)  # in page order
    exploded = pages.select(F.col(id_col), F.col(url_col), F.posexplode(hrefs).alias("pos", "href"))
    quoted = F.col("href").startswith('"') | F.col("href").startswith("'")
    value = F.when(quoted, F.substring("href", F.lit(2), F.length("href") - 2)).otherwise(F.col("href"))
    href = F.trim(_unescape(value))
    host = F.regexp_extract(F.col(url_col), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    absolute = F.when(href.startswith("/"), F.concat(host, href)).otherwise(href)
    out = exploded.select(F.col(id_col), F.col("pos").cast("long").alias("pos"), absolute.alias("enlace"),
                          href.alias("_href"))
    if suffixes:
        low = F.lower(F.col("_href"))
        cond = None
        for s in suffixes:
            c = low.endswith(s.lower())
            cond = c if cond is None else (cond | c)
        out = out.where(cond)
    return out.drop("_href")
