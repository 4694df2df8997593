"""DuckDB SQL fragments for the oracle twins (independent re-statements of the
operators in plain SQL over the bundled tables)."""

from __future__ import annotations

# The twins' own constants: Python's white space, month names.
PY_WS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
MONTHS_FULL = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
               "November", "December")
MONTHS_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

RUN_TS = "2024-01-31 00:00:00"
RUN_DATE = "2024-01-31"


def pstrip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_WS}+|{PY_WS}+$', '', 'g')"


def unescape(x: str) -> str:
    """The character references that occur in the bundled pages."""
    return (f"replace(replace(replace(replace(replace(replace(replace({x}, '&quot;', '\"'), '&lt;', '<'), "
            f"'&gt;', '>'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')")


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


def clean_lines(x: str, sep: str = "chr(10)") -> str:
    return (f"array_to_string(list_filter(list_transform(string_split({x}, chr(10)), lambda l: {pstrip('l')}), "
            f"lambda l: l <> ''), {sep})")


def norm_date(s: str, run_ts: str = RUN_TS) -> str:
    """F1 in SQL."""
    full = "|".join(MONTHS_FULL)
    abbr = "|".join(MONTHS_ABBR)
    d3 = f"try_strptime(substr({s}, 1, 10), '%Y-%m-%d')"
    return f"""(CASE
 WHEN {s} IS NULL THEN '{run_ts}'
 WHEN regexp_full_match({s}, '\\d\\d\\d\\d-\\d+-\\d+ \\d+:\\d+:\\d+') THEN {s}
 WHEN regexp_full_match({s}, '\\d\\d\\d\\d-\\d+-\\d+ \\d+:\\d+') THEN {s} || ':00'
 WHEN regexp_full_match({s}, '\\d\\d\\d\\d-\\d+-\\d+') THEN
   CASE WHEN {d3} IS NULL THEN NULL
        WHEN CAST({d3} AS DATE) < CAST(TIMESTAMP '{run_ts}' AS DATE) THEN strftime({d3}, '%Y-%m-%d') || ' 23:59:00'
        ELSE strftime({d3}, '%Y-%m-%d') || ' ' || strftime(TIMESTAMP '{run_ts}', '%H:%M:%S') END
 WHEN regexp_full_match({s}, '\\d{{4}}年\\d{{2}}月\\d{{2}}日 \\d{{2}}:\\d{{2}}') THEN strftime(try_strptime({s}, '%Y年%m月%d日 %H:%M'), '%Y-%m-%d %H:%M:00')
 WHEN regexp_full_match({s}, '\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}') THEN strftime(TIMESTAMP '{run_ts}', '%Y') || '-' || {s} || ':00'
 WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}(\\+|-)\\d{{2}}:\\d{{2}}') THEN strftime(try_strptime(substr({s}, 1, 19), '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%d %H:%M:%S')
 WHEN regexp_full_match({s}, '(?i)({full}) \\d{{1,2}}, \\d{{4}}') THEN strftime(try_strptime({s}, '%B %d, %Y'), '%Y-%m-%d %H:%M:%S')
 WHEN regexp_full_match({s}, '(?i)({abbr}) \\d{{1,2}}, \\d{{4}}') THEN strftime(try_strptime({s}, '%b %d, %Y'), '%Y-%m-%d %H:%M:%S')
 ELSE '{run_ts}' END)"""


def news_date(s: str, run_ts: str = RUN_TS) -> str:
    """F2 in SQL (input expression evaluated through F1)."""
    f = norm_date(s, run_ts)
    ts = f"try_strptime({f}, '%Y-%m-%d %H:%M:%S')"
    return (f"(CASE WHEN {ts} > TIMESTAMP '{run_ts}' THEN lpad(CAST(year({ts}) - 1 AS VARCHAR), 4, '0') || "
            f"strftime({ts}, '-%m-%d %H:%M:%S') ELSE {f} END)")


def uuid_from(*parts: str) -> str:
    """F5 in SQL: md5 of the parts joined by U+0001, shaped 8-4-4-4-12."""
    joined = " || chr(1) || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    h = f"md5({joined})"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


ARTICLE_INNER = "regexp_extract(html, '(?s)<article>(.*)</article>', 1)"


def article_blocks_cte(name: str = "ablocks") -> str:
    """Direct children of ``article`` in the bundled pages: the ``h1`` and one
    block per ``<p>`` start (an open ``p`` closes at the next one)."""
    return f"""{name} AS (
  SELECT page_id, seg, CAST(i AS BIGINT) AS ord FROM (
    SELECT page_id, unnest(s) AS seg, unnest(range(0, len(s))) AS i FROM (
      SELECT page_id, string_split(replace(replace({ARTICLE_INNER}, '<p>', chr(1) || '<p>'), '<h1>', chr(1) || '<h1>'), chr(1)) AS s
      FROM pages)) WHERE seg <> '')"""


def canonical(x: str) -> str:
    """The bundled articles' markup as the serializer writes it: their only unclosed elements are ``<p><b>...<br>``."""
    return (f"replace(regexp_replace(replace({x}, '&quot;', '\"'), '&(amp;?)?', '&amp;', 'g'), '<br>', '<br/></b></p>')")
