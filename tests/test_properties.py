"""Property checks: dedup twice = once, take-while keeps a prefix,
F2 never returns a time after run_ts (unless more than a year ahead)."""
import datetime as dt
import random
import re
import time

from pyspark.sql import functions as F

from pagemill.config import DedupConf
from pagemill.functions.dates import news_date, normalize_date, parse_loose
from pagemill.functions.text import clean_line_list, empty_strip, pstrip
from pagemill.operators.dedup import dedup
from pagemill.operators.listing import take_while

RUN_TS = "2024-01-31 00:00:00"
CONF = DedupConf(title_days=30, url_days=30, title_spiders=("s",))


def _batch(spark, n=300, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["s", "o"]), f"t{rnd.randint(0, 40)}", f"u{rnd.randint(0, 80)}",
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 700))) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, spider string, title string, source_addr string, created_at timestamp_ntz")


def test_dedup_twice_equals_once(spark):
    b = _batch(spark)
    hist = _batch(spark, 100, seed=3)
    once = dedup(b, hist, RUN_TS, CONF, F.col("id")).where("reason IS NULL").drop("reason")
    twice = dedup(once, hist, RUN_TS, CONF, F.col("id")).where("reason IS NULL").drop("reason")
    assert sorted(r.id for r in once.collect()) == sorted(r.id for r in twice.collect())


def test_take_while_keeps_a_prefix(spark):
    rnd = random.Random(11)
    rows = [(f"src{i % 3}", i // 10, i % 10, dt.datetime(2024, 1, 30) - dt.timedelta(hours=rnd.choice([1, 2, 3, 40])),
             rnd.random() < 0.1) for i in range(200)]
    df = spark.createDataFrame(rows, "source string, page_counter int, pos int, public_datetime timestamp_ntz, skip boolean")
    kept = take_while(df, F.lit(24), RUN_TS, max_page=100, skip=F.col("skip")).collect()
    by_src = {}
    for r in rows:
        by_src.setdefault(r[0], []).append(r)
    for src, rs in by_src.items():
        rs.sort(key=lambda r: (r[1], r[2]))
        expect = []
        for r in rs:
            if r[4]:
                continue
            if r[3] < dt.datetime(2024, 1, 30):
                break
            expect.append((r[1], r[2]))
        got = sorted((r.page_counter, r.pos) for r in kept if r.source == src)
        assert got == expect


def test_news_date_not_after_run(spark):
    cases = ["2024-01-30 10:00:00", "2024-02-05 10:00", "2024-01-31", "2024-01-30", "01-05 08:00",
             "2024-12-31T23:00:00-08:00", "March 5, 2024", "mar 5, 2024", "2024-13-01", "junk", " 2024-01-01",
             "2024年01月03日 08:19", "2024-02-29 10:00:00", "2026-01-01 00:00:00"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    out = df.select("s", normalize_date(F.col("s"), RUN_TS).alias("n"), news_date(F.col("s"), RUN_TS).alias("d"))
    got = {r.s: (r.n, r.d) for r in out.collect()}
    assert got["2024-01-30 10:00:00"] == ("2024-01-30 10:00:00", "2024-01-30 10:00:00")
    assert got["2024-02-05 10:00"][1] == "2023-02-05 10:00:00"           # future: one year back
    assert got["2024-01-31"][0] == "2024-01-31 00:00:00"                   # today: date + run time
    assert got["2024-01-30"][0] == "2024-01-30 23:59:00"                   # before today
    assert got["01-05 08:00"][0] == "2024-01-05 08:00:00"
    assert got["2024-12-31T23:00:00-08:00"] == ("2024-12-31 23:00:00", "2023-12-31 23:00:00")
    assert got["March 5, 2024"][0] == "2024-03-05 00:00:00"
    assert got["mar 5, 2024"][0] == "2024-03-05 00:00:00"
    assert got["2024-13-01"][0] is None                                     # invalid calendar date
    assert got["junk"][0] == RUN_TS and got[" 2024-01-01"][0] == RUN_TS     # not trimmed: branch 9
    assert got["2024年01月03日 08:19"][0] == "2024-01-03 08:19:00"
    assert got["2024-02-29 10:00:00"][1] == "2023-02-29 10:00:00"          # Q12: text kept
    ts = df.select("s", parse_loose(news_date(F.col("s"), RUN_TS)).alias("t")).collect()
    for r in ts:
        if r.t is not None and r.s != "2026-01-01 00:00:00":
            assert r.t <= dt.datetime(2024, 1, 31)
    assert {r.s: r.t for r in ts}["2024-02-29 10:00:00"] is None


def test_strips_equal_python_and_pass_over_inner_white_space(spark):
    """The ends alone are looked at: a long run of white space inside a line costs no more than its length."""
    space = "".join(c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if c.isspace())
    rnd = random.Random(5)
    texts = ["", *space, "a" + " " * 100_000 + "b", " " * 100_000, *space + "​"] + [
        "".join(rnd.choices(space + "​᠎abé\U0001F600", k=rnd.randint(1, 12))) for _ in range(400)]
    began = time.monotonic()
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pstrip("t"), empty_strip("t")).collect()
    assert len(got) == len(texts) and time.monotonic() - began < 30
    for t, a, b in got:
        assert a == t.strip() and b == t.strip(space + "​")


def test_clean_line_list_equals_python(spark):
    drop = re.compile("\t|\n|　|&nbsp;|\xa0|&#x3000;|\r")
    rnd = random.Random(6)
    bits = ["&nbsp;", "&#x3000;", "&nb", "sp;", "&#x30", "00;", "&", ";", "\t", "\r", "　", "\xa0", " ", "x", "é", "\U0001F600"]
    lists = [["".join(rnd.choices(bits, k=rnd.randint(0, 9))) for _ in range(3)] for _ in range(300)] + [[], [None, " a "], None]
    want = [ls and [x and re.sub("[\U00010000-\U0010FFFF]", "", drop.sub("", x.strip()).strip()) for x in ls] for ls in lists]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, ls array<string>")
    assert [r[0] for r in df.orderBy("i").select(clean_line_list(F.col("ls"))).collect()] == want
