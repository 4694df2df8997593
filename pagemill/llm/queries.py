"""The registered queries of the corpus operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import ensure_checkpoint_dir

from .common import crc_part, read

WORD_TOKENIZER = "word_bpe_49k.json"
ALIGNED_TOKENIZERS = "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_nearest(spark: SparkSession, sf: str) -> DataFrame:
    from .ann import nearest
    return nearest(read(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    from .decontam import report
    r = report(read(spark, sf, "documents"), read(spark, sf, "benchmark"), n=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return r.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    from .toxicity import fit, score
    docs = read(spark, sf, "documents")
    part = crc_part(F.col("doc_id"), 5)
    model = fit(docs.where(part != 0), read(spark, sf, "labels").where(part != 0))
    return score(docs, model).select(
        "doc_id", F.coalesce(part == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    from .mixing import mix
    return mix(read(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    from .simhash import near_duplicates
    return near_duplicates(read(spark, sf, "documents"), shingle=3, max_bits=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    from .pii import KINDS, detect

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    r = detect(read(spark, sf, "documents"))
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return r.select("doc_id", *map(count, KINDS), F.sha2(listed(F.filter("spans", lambda s: s["plain"])), 256).alias("base_sha256"),
                    listed(F.col("spans")).alias("spans"))


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    from .urlfilter import filter_pages, rules_frame
    return filter_pages(read(spark, sf, "pages"), rules_frame(spark, URL_RULES))


def token_digests(spark: SparkSession, docs: DataFrame, slice_chars: int | None = None) -> DataFrame:
    import uuid

    import public_tokenizers

    from .tokens import read_documents, write_tokens
    out = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, public_tokenizers.path(WORD_TOKENIZER), out, by_words=True, slice_chars=slice_chars)
    return read_documents(spark, out, digest=True)


def op8_long_repeats(spark: SparkSession, sf: str) -> DataFrame:
    from .suffix import report
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return report(read(spark, sf, "documents"), 200).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    from .langid import fit, predict
    docs = read(spark, sf, "documents")
    part = crc_part(F.col("doc_id"), 4)
    model = fit(docs.where(part != 2).select("doc_id", "text", "lang"))
    return predict(docs, model).select(
        "doc_id", F.coalesce(part == 2, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op10_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return token_digests(spark, read(spark, sf, "documents"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import uuid

    import public_tokenizers

    from .align import align_documents, documents, pair_counts
    out = f"{ensure_checkpoint_dir(spark)}/aligned-{uuid.uuid4().hex}"
    align_documents(read(spark, sf, "documents"), *map(public_tokenizers.path, ALIGNED_TOKENIZERS), out, digest=True)
    slices = spark.read.parquet(out)
    return documents(slices, pair_counts(slices)).withColumnRenamed("said", "groups_sha256")


def op12_quality(spark: SparkSession, sf: str) -> DataFrame:
    from .compression import scores
    return scores(read(spark, sf, "documents"))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    from .trie import prefix_trie, share_starts, turns
    return prefix_trie(share_starts(turns(read(spark, sf, "conversations")))).drop("node").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


OPERATORS: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_nearest, op2_decontamination, op3_toxicity, op4_mixing, op5_simhash, op6_pii, op7_url_filter, op8_long_repeats, op9_language_id,
    op10_tokens, op11_alignment, op12_quality, op13_prefix_trie]

SQL: dict[str, str] = {}

# DuckDB twins -----------------------------------------------------------------

SQL["op2_decontamination"] = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g
        FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
dg AS (SELECT r, n, i, list_slice(w, i, i + n - 1) AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
       WHERE len(w) >= n),
hit AS (SELECT dg.r, dg.i, dg.n, win.item_id FROM dg JOIN win ON dg.g = win.g),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
        FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""

SQL["op7_url_filter"] = r"""
WITH rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT row_number() OVER () AS r, page_id,
        CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
             ELSE '' END AS path FROM pages),
m AS (SELECT r, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
             arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (r)"""

# crc32 bit by bit: the register, then every byte followed by seven zeros
SQL["op13_prefix_trie"] = r"""
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
             sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
             coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, list(struct_pack(role := role, text := text) ORDER BY pos) AS own,
        xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
          lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
          lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) % 9 AS h
      FROM o GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(list_slice(b.own, 1, c.h), []), list_slice(c.own, c.h + 1, len(c.own))) AS t
      FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
p AS (SELECT conv_id, t, d, list_slice(t, 1, d) AS pre FROM r, unnest(range(0, len(t) + 1)) AS x(d)),
n AS (SELECT pre, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(t) = d), '') AS ends,
        CASE WHEN any_value(d) = 0 THEN 0 ELSE any_value(strlen(t[d].text)) END AS last_bytes FROM p GROUP BY pre),
kids AS (SELECT list_slice(pre, 1, depth - 1) AS pre, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
up AS (SELECT list_slice(n.pre, 1, a) AS pre, sum(CAST(kids.n IS NULL AS BIGINT)) AS n_leaves, sum((n_convs - 1) * last_bytes) AS saved
       FROM n LEFT JOIN kids USING (pre), unnest(range(0, depth + 1)) AS x(a) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
       CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN up USING (pre) LEFT JOIN kids USING (pre)
  LEFT JOIN n AS m ON n.depth > 0 AND m.depth = n.depth - 1 AND m.pre = list_slice(n.pre, 1, n.depth - 1)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle() -> dict[str, str]:
    return dict(SQL)
