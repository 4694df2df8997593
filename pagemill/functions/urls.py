"""URL Column functions.

URLs are split with one anchored regex (RFC 3986 appendix B), so malformed
URLs (unescaped ``[`` or ``|``) still get an answer instead of NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, pstrip

# RFC 3986 appendix B: scheme, authority, path, query, fragment.
URL_RE = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"

# File types kept for content images; others become "unknown".
IMAGE_TYPES = ("png", "jpg", "jpeg", "bmp", "webp")

# URL schemes that resolve relative references (urllib).
RELATIVE_SCHEMES = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https",
                    "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn",
                    "svn+ssh", "ws", "wss")
# Schemes whose last path segment may carry ``;params``.
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
                 "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")


def _part(url: Column, idx: int) -> Column:
    return F.regexp_extract(url, URL_RE, idx)


def url_parts(url: Column) -> dict:
    return {
        "scheme": F.lower(_part(url, 2)),
        "has_auth": _part(url, 3) != "",
        "netloc": _part(url, 4),
        "path": _part(url, 5),
        "has_query": _part(url, 6) != "",
        "query": _part(url, 7),
        "has_frag": _part(url, 8) != "",
        "frag": _part(url, 9),
    }


def _unparse(scheme: Column, has_auth: Column, netloc: Column, path: Column,
             query: Column, frag: Column) -> Column:
    """``urlunparse``: empty query / fragment are dropped."""
    p = F.when(has_auth & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    auth = F.when(has_auth, F.concat(F.lit("//"), netloc, p)).otherwise(p)
    out = F.when(scheme != "", F.concat(scheme, F.lit(":"), auth)).otherwise(auth)
    out = F.when(query != "", F.concat(out, F.lit("?"), query)).otherwise(out)
    return F.when(frag != "", F.concat(out, F.lit("#"), frag)).otherwise(out)


def _resolve(base_path: Column, ref_path: Column) -> Column:
    """Merge a relative path into the base path and remove dot segments."""
    bparts = F.split(base_path, "/")
    bparts = F.when(F.element_at(bparts, -1) != "", F.slice(bparts, 1, F.size(bparts) - 1)).otherwise(bparts)
    rparts = F.split(ref_path, "/")
    joined = F.concat(bparts, rparts)
    n = F.size(joined)
    middle = F.filter(F.slice(joined, 2, F.greatest(n - 2, F.lit(0))), lambda x: x != "")
    rel = F.when(n <= 2, joined).otherwise(
        F.concat(F.array(F.element_at(joined, 1)), middle, F.array(F.element_at(joined, -1))))
    segs = F.when(ref_path.startswith("/"), rparts).otherwise(rel)

    def walk(segs: Column) -> Column:
        stack = F.aggregate(
            segs, F.array().cast("array<string>"),
            lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(s == ".", acc)
            .otherwise(F.concat(acc, F.array(s))))
        return F.array_join(F.concat(stack, F.when(F.element_at(segs, -1).isin(".", ".."), F.array(F.lit("")))
                                     .otherwise(F.array().cast("array<string>"))), "/")

    return let(let(segs, walk), lambda out: F.when(out == "", F.lit("/")).otherwise(out))


def url_join(base: Column, ref: Column) -> Column:
    """``urllib.parse.urljoin(base, ref)``; both are split once."""
    def parts(url: Column) -> Column:
        return F.struct(*[v.alias(k) for k, v in url_parts(url).items()])

    def join(u: Column) -> Column:
        base, ref, b, r = u["base"], u["ref"], u["b"], u["r"]
        scheme = F.when(r["scheme"] != "", r["scheme"]).otherwise(b["scheme"])
        abs_ref = _unparse(scheme, r["has_auth"], r["netloc"], r["path"], r["query"], r["frag"])
        keep_path = _unparse(scheme, b["has_auth"], b["netloc"], b["path"],
                             F.when(r["query"] != "", r["query"]).otherwise(b["query"]), r["frag"])
        merged = let(_resolve(b["path"], r["path"]), lambda path: _unparse(
            scheme, b["has_auth"], b["netloc"], path, r["query"], r["frag"]))
        return (F.when(base == "", ref)
                .when(ref == "", base)
                .when((scheme != b["scheme"]) | ~scheme.isin(*RELATIVE_SCHEMES), ref)
                .when(r["has_auth"], abs_ref)
                .when(r["path"] == "", keep_path)
                .otherwise(merged))

    both = F.struct(base.alias("base"), ref.alias("ref"), parts(base).alias("b"), parts(ref).alias("r"))
    return F.when(base.isNotNull() & ref.isNotNull(), let(both, join))


def url_path(url: Column) -> Column:
    """``urlparse(url).path`` (``;params`` of the last segment removed)."""
    p = url_parts(url)
    last = F.regexp_extract(p["path"], "([^/]*)$", 1)
    with_params = p["scheme"].isin(*PARAM_SCHEMES) & last.contains(";")
    return F.when(with_params, F.regexp_replace(p["path"], ";[^/]*$", "")).otherwise(p["path"])


def url_basename(url: Column) -> Column:
    """``os.path.basename`` of the URL path."""
    return F.substring_index(url_path(url), "/", -1)


def url_file_type(url: Column) -> Column:
    """text after the last dot of the basename (whole basename if no dot)."""
    return F.substring_index(url_basename(url), ".", -1)


def image_type(url: Column) -> Column:
    """F10 + allowlist: lower-cased type, or ``unknown``."""
    t = F.lower(url_file_type(url))
    return F.when(t.isin(*IMAGE_TYPES), t).otherwise(F.lit("unknown"))


def next_page_url(url: Column, page: Column, param: str = "p") -> Column:
    """replace the whole query with ``<param>=<page>``, keep the fragment."""
    p = url_parts(url)
    head = F.regexp_extract(url, r"^([^?#]*)", 1)
    frag = F.when(p["frag"] != "", F.concat(F.lit("#"), p["frag"])).otherwise(F.lit(""))
    return F.concat(head, F.lit(f"?{param}="), page.cast("string"), frag)


def path_join(*parts) -> Column:
    """``os.path.join`` for relative parts (one separator between parts)."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    out = cols[0]
    for c in cols[1:]:
        out = F.when(c.startswith("/"), c).when(out.endswith("/") | (out == ""), F.concat(out, c)) \
            .otherwise(F.concat(out, F.lit("/"), c))
    return out


def keep_fetchable(urls: Column) -> Column:
    """stripped URLs starting with ``http`` or ``ftp``."""
    return F.filter(F.transform(urls, pstrip), lambda x: x.startswith("http") | x.startswith("ftp"))


def numbered_paths(local_base: Column, item_id: Column, urls: Column) -> Column:
    """``<base>/<item_id>_<i>.jpg`` per URL (i from 0)."""
    return F.transform(urls, lambda x, i: path_join(local_base, F.concat(item_id, F.lit("_"), i.cast("string"), F.lit(".jpg"))))


def url_to_path_map(local_base: Column, item_id: Column, urls: Column) -> Column:
    """URL -> numbered path map (a repeated URL keeps its last path)."""
    paths = numbered_paths(local_base, item_id, urls)
    distinct = F.array_distinct(urls)
    last = F.transform(distinct, lambda u: F.element_at(
        paths, (F.size(urls) - F.array_position(F.reverse(urls), u) + 1).cast("int")))
    return F.map_from_arrays(distinct, last)
