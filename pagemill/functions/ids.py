"""Record id Column functions (F5-F8) and the image template.

Ids are derived from content, not from a clock or MAC address, so a task
retried after an executor loss produces the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import as_ts


def uuid_from(*cols: Column) -> Column:
    """deterministic uuid-shaped id (md5 of the parts, 8-4-4-4-12)."""
    h = F.md5(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def data_uri(batch_id: Column, uuid: Column) -> Column:
    """``<first 6 chars of batch_id>/<uuid>``."""
    return F.concat_ws("/", F.substring(batch_id.cast("string"), 1, 6), uuid)


def picture_dir(img_dir: str, spider: Column, run_ts) -> Column:
    """``<img_dir>/<yyyyMMdd>/<spider>/<HHmmss>``."""
    ts = as_ts(run_ts)
    return F.concat_ws("/", F.lit(img_dir.rstrip("/")), F.date_format(ts, "yyyyMMdd"), spider,
                       F.date_format(ts, "HHmmss"))


def content_id(spider: Column, url: Column, title: Column, title_spiders, run_ts,
               counter: Column) -> Column:
    """F8: ``0_<spider>_<md5(title or url)>``; no URL: ``<time>_<spider>_<counter>``.

    Title is the key for spiders that de-duplicate by title.  ``counter`` is
    the per-source running number (W7).
    """
    key = F.when(spider.isin(*title_spiders), title).otherwise(url)
    fallback = F.concat(F.date_format(as_ts(run_ts), "yyyyMMddHHmmssSSSSSS"), F.lit("_"), spider,
                        F.lit("_"), counter.cast("string"))
    return F.when(F.coalesce(url, F.lit("")) == "", fallback) \
        .otherwise(F.concat(F.lit("0_"), spider, F.lit("_"), F.md5(F.coalesce(key, F.lit("")))))


# Fixed value: the content-image block template.  Slots, in order of
# appearance: div id, img id, alt, local url, original url, caption.  The CSS
# class prefix is a parameter.
IMAGE_TEMPLATE = ('<div id="%s" class="{p}ContentImage">\n'
                  '    <img id="%s" alt="%s" class="{p}ContentImage" src="%s" ori_src="%s">\n'
                  '    <span class="{p}ContentImageCaption">\n'
                  '    %s\n'
                  '    </span>\n'
                  '    </div>')


def image_html(div_id: Column, img_id: Column, url: Column, alt: Column, caption: Column,
               ori_url: Column, css_prefix: str = "pm") -> Column:
    """fill the image template (values inserted unescaped)."""
    return F.format_string(IMAGE_TEMPLATE.replace("{p}", css_prefix),
                           div_id, img_id, alt, url, ori_url, caption)
