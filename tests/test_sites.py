"""Many layouts in one pass over the node table."""

import dataclasses

import pytest

from pagemill.config import SiteSpec
from pagemill.operators.detail import page_fields, route_layouts
from pagemill.operators.select import desc, sel
from pagemill.operators.shred import nodes_by_page

RUN_TS = "2024-01-31 00:00:00"
BASE = SiteSpec(name="s", seed_url="http://x", title=sel(desc("h1")), category=sel(desc("i")))


@pytest.fixture(scope="module")
def nodes(spark):
    page = "<html><title>head {0}</title><h1>title {0}</h1><b class='k{1}'>b{0}</b><i>cat</i><header><h2>h{0}</h2></header></html>"
    rows = [(i, page.format(i, i % 12)) for i in range(36)] + [(90, "plain text"), (91, "")]
    return nodes_by_page(spark.createDataFrame(rows, "page_id long, html string"))


def specs():
    out = {}
    for k in range(10):
        out[f"l{k}"] = dataclasses.replace(
            BASE, layout=f"l{k}", base_tags=(f"t{k}",) if k % 2 else (),
            title=[sel(desc("h1")), sel(desc("title")), sel(desc("b", cls_eq=f"k{k}")), None, sel(desc("*", cls_sub="k"))][k % 5],
            header_scope=sel(desc("header")) if k % 3 == 0 else None, content_scope=sel(desc("missing")) if k == 4 else None)
    return out


def test_ten_layouts_equal_an_extractor_each_in_one_scan(spark, nodes):
    routed = spark.createDataFrame([(i, f"l{i % 12}") for i in [*range(36), 90, 91, 1]] + [(5, "l3"), (6, None)], "page_id long, layout string")
    got = route_layouts(routed, nodes, specs(), RUN_TS)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    want = []
    for name, spec in specs().items():
        want += routed.where(routed.layout == name).join(page_fields(nodes, spec, RUN_TS), "page_id").select(*got.columns).collect()
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and len(want) == 33          # an empty page has no node


def test_no_known_layout_gives_no_row(spark, nodes):
    routed = spark.createDataFrame([(1, "other")], "page_id long, layout string")
    assert route_layouts(routed, nodes, specs(), RUN_TS).collect() == []
