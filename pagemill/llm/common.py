"""Helpers shared by the corpus operators: tables, Arrow scans, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import ensure_checkpoint_dir


OUT_BYTES = 4 << 20      # text and bytes of an Arrow batch that a scan gives out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later reads survive a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scan(df: DataFrame, schema: str, rows: Callable[[Iterator[tuple]], Iterator[tuple]],
         cache: str | None = None) -> DataFrame:
    """Run ``rows`` over each partition: tuples of ``df``'s columns in, tuples of ``schema`` out.

    Rows go out in Arrow batches of at most 2,000 rows or about 4 MB of text
    and bytes, so memory does not depend on the size of a partition.
    """
    names = [f.split()[0] for f in _split(schema)]
    arrow = _arrow_schema(schema)

    def run(batches):
        worker_cache(cache)

        def rows_in():
            for batch in batches:
                yield from zip(*(_values(batch.column(i)) for i in range(batch.num_columns)))

        out, size = [], 0
        for row in rows(rows_in()):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(out) >= 2000 or size >= OUT_BYTES:
                yield _batch(out, names, arrow)
                out, size = [], 0
        if out:
            yield _batch(out, names, arrow)

    return df.mapInArrow(run, schema)


def rewrite(df: DataFrame, column: str, fn: Callable[[list], list], cache: str | None = None) -> DataFrame:
    """``df`` with ``column`` rewritten: ``fn`` takes some values and gives (new value,) for each, or None to drop the row.

    Rows go through in slices of about 4 MB of text, so neither the texts of a
    whole Arrow batch nor its copy are held.  All columns pass through as Arrow
    data, whatever their names and types.
    """
    at = df.columns.index(column)

    def run(batches):
        worker_cache(cache)
        for batch in batches:
            first = 0
            for some in groups((v,) for v in _values(batch.column(at))):
                part = batch.slice(first, len(some))
                first += len(some)
                new = fn([x for x, in some])
                keep = pa.array([v is not None for v in new], pa.bool_())
                cols = [c.filter(keep) for c in part.columns]
                cols[at] = pa.array([v[0] for v in new if v is not None], type=batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return df.mapInArrow(run, df.schema)


_CACHES: dict[str, dict] = {}       # this worker process's


def worker_cache(name: str | None) -> dict:
    """What tasks of operator ``name`` remember in this process; what others remembered is let go.

    A Python worker runs tasks of one operator after another; without this it
    would hold all their memories.
    """
    for other in [k for k in _CACHES if k != name]:
        del _CACHES[other]
        pa.default_memory_pool().release_unused()
    return _CACHES.setdefault(name, {}) if name else {}


def _split(schema: str) -> list[str]:
    """Top-level fields of a DDL string (commas inside <> do not count)."""
    out, depth, word = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(word.strip())
            word = ""
        else:
            word += ch
    return [*out, word.strip()]


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def _values(col: pa.Array) -> Iterator:
    """Python values of a column, one at a time: very long texts are not held together."""
    for v in col:
        yield v.as_py()


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=schema.field(i).type) for i, c in enumerate(cols)], names=names)


def groups(it, chars: int = 4 << 20):
    """Rows in groups of about ``chars`` characters of text (the last column)."""
    some, size = [], 0
    for row in it:
        some.append(row)
        size += len(row[-1] or "") + 64
        if size >= chars:
            yield some
            some, size = [], 0
    if some:
        yield some


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words between ASCII white space: (word number of each place, where each text ends, distinct words).

    The empty word may be among them (at the ends of a text).
    """
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    ends = lists.offsets.to_numpy()[1:].astype(np.int64)
    return coded.indices.to_numpy(), ends - lists.offsets[0].as_py(), coded.dictionary.to_pylist()


def crc_part(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(u, v)``: one row (node, root) per node.

    ``root`` is the smallest node of the component.  Alternating large-star
    and small-star steps (O(log^2) rounds); each round is a plain aggregate
    and join on the node and is cut with a reliable checkpoint.  Null ends and
    self links are ignored; no edges give no rows.
    """
    e = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .where("u > v").distinct())
    e = cut(e)
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small)
        before, state = state, _state(e)
        if before == state:
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.bit_xor(F.xxhash64("v", "u"))).first())
