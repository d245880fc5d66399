"""SimHash near-duplicate groups by tiled exact comparison.

Every text gets a 64-bit fingerprint of its word shingles. Distinct
fingerprints are laid out in tiles: all fingerprints of a tile have the same
population count in each of ``SEGMENTS`` equal bit ranges, and large tiles are
cut into parts of about ``TILE_ROWS``. Two fingerprints at most ``radius`` bits apart
have segment counts whose differences sum to at most ``radius``, so a tile meets
only the tiles inside that ball (41 of them for 4 segments and radius 2) and
all other tile pairs are skipped without loss. Each remaining pair is
compared whole with numpy exclusive-or and bit counts. A tile pair emits a
spanning forest of its links, never all pairs, and the links are closed to
components by repeated star contraction over written tables.

Defined results: a NULL or word-free text has fingerprint 0 and links like any
other; repeated rows stay repeated with equal results; a row without id keeps
its fingerprint and gets the component of that fingerprint (NULL when no
row with an id reaches it); an empty table gives an empty result. Only
``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import text_bytes

SEED = 42
SEGMENTS = 4
TILE_ROWS = 2048
HASH_CHUNK = 200_000
MAX_ROUNDS = 60


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the lower-cased words' shingles: a bit is 1 if set in over half of their XXH64 values."""
    words = text.lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), HASH_CHUNK):
        a, b = starts[i:i + HASH_CHUNK].tolist(), ends[i:i + HASH_CHUNK].tolist()
        h = np.array([digest(norm[s:e], SEED) for s, e in zip(a, b)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fp long")


def _tiles(distinct: DataFrame) -> DataFrame:
    """(cell, part, fps): fingerprints packed by their segment population counts, in parts of bounded size."""
    width = 64 // SEGMENTS
    mask = (1 << width) - 1
    counts = [F.bit_count(F.shiftrightunsigned("fp", width * s).bitwiseAND(F.lit(mask))).cast("int")
              for s in range(SEGMENTS)]
    celled = distinct.select("fp", F.array(*counts).alias("cell"))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS)).cast("int").alias("parts"))
    # A cell of any size is dealt to parts of about TILE_ROWS by the fingerprint's own hash.
    return (celled.join(sizes, "cell")
            .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"))
            .agg(F.sort_array(F.collect_list("fp")).alias("fps")))


def _ball(radius: int) -> list[tuple[int, ...]]:
    """The half of the segment-count differences within ``radius`` that is not below zero in dictionary order."""
    steps = product(range(-radius, radius + 1), repeat=SEGMENTS)
    return [d for d in steps if sum(map(abs, d)) <= radius and d >= (0,) * SEGMENTS]


def _forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles, as pairs of fingerprints."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for lo in range(0, len(a), 256):
        near = np.bitwise_count(a[lo:lo + 256, None] ^ b[None, :]) <= radius
        for i, j in zip(*np.nonzero(near)):
            x, y = int(a[lo + i]), int(b[j])
            if x != y and not (same and x > y):
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[max(rx, ry)] = min(rx, ry)
                    links.append((x, y))
    return links


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v): links between different fingerprints that connect all fingerprints at most ``radius`` bits apart."""
    tiles = materialize(_tiles(distinct), "simhash-tiles")
    shifts = F.array(*[F.array(*[F.lit(x) for x in d]) for d in _ball(radius)])
    probes = (tiles.withColumn("shift", F.explode(shifts))
              .select("part", F.col("fps").alias("left"), F.expr("forall(shift, x -> x = 0)").alias("same_cell"),
                      F.zip_with("cell", "shift", lambda c, s: c + s).alias("cell")))
    other = tiles.select("cell", F.col("part").alias("other"), F.col("fps").alias("right"))
    pairs = (probes.join(other, "cell").filter("NOT same_cell OR part <= other")
             .select("left", "right", F.expr("same_cell AND part = other").alias("same")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (np.asarray(batch.column(c)[k].values).view(np.uint64) for c in (0, 1))
                found = _forest(a, b, radius, batch.column(2)[k].as_py())
                if found:
                    uv = np.array(found, np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0]), pa.array(uv[:, 1])], names=["u", "v"])

    return pairs.mapInArrow(compare, "u long, v long")


def _signature(edges: DataFrame) -> tuple:
    """Row count and hash sum: equal for two rounds only if the links stopped changing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has a link.

    Alternating star contraction: every round each node hangs its larger
    neighbours, then its smaller ones, under the smallest neighbour; it ends
    when the links are stars. Rounds grow with the logarithm of the longest
    chain. Each round is a written table, so a lost executor costs one round.
    """
    cur = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .filter("u <> v").distinct(), "simhash-links")
    before = _signature(cur)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u AND v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        nxt = materialize(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(),
                          "simhash-links")
        after = _signature(nxt)
        cur, settled, before = nxt, after == before, after
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (see the module's notes)."""
    prints = materialize(fingerprints(docs, shingle), "simhash-prints")
    firsts = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(firsts.select("fp"), radius)).withColumnsRenamed({"node": "fp"})
    rooted = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "simhash-components")
    return (prints.join(named, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest id.

    Rows that repeat an id count as copies of one document; rows without an
    id cannot be named as a survivor and are all kept.
    """
    kept = (simhash_components(docs, shingle, radius).filter("doc_id = component_id")
            .select(F.col("doc_id").alias("__kept")).distinct())
    named = docs.filter(F.col("doc_id").isNotNull())
    one = named.join(kept, named["doc_id"] == kept["__kept"], "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.filter(F.col("doc_id").isNull()))
