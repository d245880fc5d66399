"""Conflict-constrained best-fit packing of documents into training sequences.

A bin holds up to ``capacity`` tokens and never two documents of the same source or of the same
duplicate cluster. Documents go in from the longest to the shortest. Bins are ordered
by residual capacity and carry a bitmap of their sources and one of their clusters; the search starts at the
smallest residual that fits and goes on to the next larger one until the bitmaps agree, so a
document lands in the tightest compatible bin, or opens a new one. The ordered bins are
kept in short runs with the intersection of their bitmaps: a run in which every bin conflicts is passed over at once.

Documents longer than a bin fill whole bins by themselves; their last piece is packed like a
document. Packing works on groups of about ``GROUP_ROWS`` pieces dealt by hash, so no task grows with the data
and a hot source is spread over all groups. Identical rows are counted before they
are dealt, so even a third of all rows being copies of one meets in no single task.

Defined results: a NULL or negative token count is 0 and an empty document still gets a slot; NULL sources and clusters conflict
with nothing; repeated rows are packed as often as they occur, ``copy`` numbers them; ties in length go by id; rows without
id are packed too; an empty table gives an empty result. Only the four named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

CAPACITY = 2048
GROUP_ROWS = 4096
RUN = 64

PLACED = "bin_id string, slot int, doc_id long, copy long, piece int, start long, n_tokens long"
PLACED_ARROW = pa.schema([("bin_id", pa.string()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("piece", pa.int32()),
                          ("start", pa.int64()), ("n_tokens", pa.int64())])


class Bins:
    """Open bins ordered by (residual, number), in runs of up to 2 * RUN with common conflict bitmaps."""

    def __init__(self):
        self.runs: list[list[tuple[int, int]]] = [[]]
        self.common: list[tuple[int, int]] = [(-1, -1)]   # sources and clusters that every bin of the run has
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def _refresh(self, r: int) -> None:
        s = c = -1
        for _, b in self.runs[r]:
            s &= self.sources[b]
            c &= self.clusters[b]
        self.common[r] = (s, c)

    def _run_of(self, key: tuple[int, int]) -> int:
        """The first run whose last bin is not below the key (the last run if there is none)."""
        lo, hi = 0, len(self.runs) - 1
        while lo < hi:
            mid = (lo + hi) // 2
            if self.runs[mid] and self.runs[mid][-1] >= key:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def take(self, need: int, source: int, cluster: int) -> tuple[int, int] | None:
        """Remove and return (residual, bin) of the tightest compatible bin."""
        key = (need, -1)
        for r in range(self._run_of(key), len(self.runs)):
            run, (s, c) = self.runs[r], self.common[r]
            if s & source or c & cluster:
                continue
            for i in range(bisect_left(run, key), len(run)):
                b = run[i][1]
                if not (self.sources[b] & source or self.clusters[b] & cluster):
                    found = run.pop(i)
                    if not run and len(self.runs) > 1:
                        del self.runs[r], self.common[r]
                    else:
                        self._refresh(r)
                    return found
        return None

    def put(self, residual: int, b: int, source: int, cluster: int) -> None:
        if b == len(self.sources):
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[b] |= source
        self.clusters[b] |= cluster
        r = self._run_of((residual, b))
        insort(self.runs[r], (residual, b))
        if len(self.runs[r]) >= 2 * RUN:
            self.runs.insert(r + 1, self.runs[r][RUN:])
            self.common.insert(r + 1, (0, 0))
            del self.runs[r][RUN:]
            self._refresh(r + 1)
        self._refresh(r)


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin number of every piece, taken in the given order; None conflicts with nothing."""
    number: dict = {}
    seen: dict = {}
    for c in clusters:
        seen[c] = seen.get(c, 0) + 1
    several = {c: k for k, c in enumerate(c for c, n in seen.items() if n > 1 and c is not None)}
    bins, out = Bins(), []
    for size, s, c in zip(sizes, sources, clusters):
        source = 0 if s is None else 1 << number.setdefault(s, len(number))
        cluster = 1 << several[c] if c in several else 0
        residual, b = bins.take(size, source, cluster) or (capacity, len(bins.sources))
        bins.put(residual - size, b, source, cluster)
        out.append(b)
    return out


def pack(docs: DataFrame, n_tokens: Column, source: Column, cluster: Column, capacity: int = CAPACITY) -> DataFrame:
    """One row for each placed piece: bin, slot in it, document, copy, piece, its first token and length."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.greatest(F.coalesce(n_tokens.cast("long"), F.lit(0)), F.lit(0)).alias("total"),
                       source.cast("string").alias("source"), cluster.cast("long").alias("cluster"))
    rows = rows.groupBy("doc_id", "total", "source", "cluster").agg(F.count(F.lit(1)).alias("copies"))
    # Small rows that are read three times below; the texts are read once.
    rows = materialize(rows, "packing-rows")
    n = rows.agg(F.sum("copies")).first()[0] or 0
    groups = max(1, -(-n // GROUP_ROWS))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    whole = F.expr(f"total div {capacity}")
    full = (rows.filter(F.col("total") >= capacity)
            .withColumn("piece", F.explode(F.sequence(F.lit(0), (whole - 1).cast("int"))))
            .select(F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                                F.hex(F.xxhash64("total", "source", "cluster")), "copy", "piece").alias("bin_id"),
                    F.lit(0).alias("slot"), "doc_id", "copy", "piece", (F.col("piece").cast("long") * capacity).alias("start"),
                    F.lit(capacity).cast("long").alias("n_tokens")))
    rest = (rows.withColumns({"piece": whole.cast("int"), "size": F.col("total") % capacity})
            .filter("size > 0 OR total = 0")
            .withColumn("part", F.pmod(F.xxhash64("doc_id", "total", "source", "cluster", "copy"), F.lit(groups)).cast("int")))

    def run(group: pa.Table) -> pa.Table:
        pieces = sorted(group.to_pylist(), key=lambda p: (-p["size"], p["doc_id"] is None, p["doc_id"] or 0, p["copy"], p["source"] or "", p["cluster"] or 0))
        bins = best_fit([p["size"] for p in pieces], [p["source"] for p in pieces], [p["cluster"] for p in pieces], capacity)
        filled: dict[int, int] = {}
        out = []
        for p, b in zip(pieces, bins):
            filled[b] = filled.get(b, -1) + 1
            out.append({"bin_id": f"{p['part']}-{b}", "slot": filled[b], "doc_id": p["doc_id"], "copy": p["copy"], "piece": p["piece"],
                        "start": p["piece"] * capacity, "n_tokens": p["size"]})
        return pa.Table.from_pylist(out, schema=PLACED_ARROW)

    return rest.groupBy("part").applyInArrow(run, PLACED).unionByName(full)


def words_and_end(text: str = "text") -> Column:
    """Words of a text and one end token."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1


def same_text(text: str = "text") -> Column:
    """Cluster of texts that are equal but for case and white space; NULL for texts without words."""
    norm = F.trim(F.lower(F.regexp_replace(F.col(text), r"[\x20\x09-\x0D]+", " ")))
    return F.when(F.length(norm) > 0, F.xxhash64(norm))
