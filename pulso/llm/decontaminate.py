"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items are built into one suffix automaton over word
numbers. Training words are streamed through it, carrying the state and the
length of the longest item passage that ends at each word. A matched length of
``window`` or more marks those words as hit, as does a whole item of fewer
words; the automaton states also say which items the passage belongs to.
``remove`` cuts hit spans out of the texts and drops documents whose hit share
exceeds a limit.

The benchmark is not assumed to be small: items are dealt to blocks of about
``BLOCK_WORDS`` words, one automaton is broadcast at a time, and between blocks
the texts with the spans found so far are a written table.

Defined results: NULL, empty and word-free texts have no words and no hits;
items without words match nothing; repeated items count once by id; an
item without id marks words but is not listed; an empty benchmark
leaves every text clean; an empty table gives an empty result. All columns of
``docs`` are carried along untouched; the added column is named by the caller.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.letters import quoted
from .common import text_bytes

WINDOW = 10
BLOCK_WORDS = 200_000
CHUNK_BYTES = 1 << 20
# Word bytes after lower-casing A-Z: digits, a-z and every byte of a non-ASCII character.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")

FOUND = ("struct<n_words:bigint, n_hit:bigint, items:array<string>, "
         "spans:array<struct<first:bigint, last:bigint, start:bigint, end:bigint>>>")


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items that own each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.arcs: list[dict[int, int]] = [{}]
        self.fail = [-1]
        self.length = [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
                 for name, words in items if words]
        for _, codes in coded:
            at = 0
            for c in codes:
                at = self._append(at, c)
        self.shortest = min((min(len(codes), window) for _, codes in coded), default=window)
        # Owners of the state that holds a whole window; ends[s]: nearest state on s's failure path that ends a short item.
        self.owners: dict[int, set[str]] = {}
        short: dict[int, int] = {}
        for name, codes in coded:
            need = min(len(codes), window)
            for _, state, size in self.stream(codes):
                if size >= need:
                    holder = self.holder(state, need)
                    self.owners.setdefault(holder, set()).update([] if name is None else [name])
                    if need < window:
                        short[holder] = need
        self.short = short
        self.ends = [-1] * len(self.arcs)
        for s in sorted(range(1, len(self.arcs)), key=self.length.__getitem__):
            self.ends[s] = s if s in short else self.ends[self.fail[s]]

    def _state(self, length: int, fail: int, arcs: dict[int, int]) -> int:
        self.length.append(length)
        self.fail.append(fail)
        self.arcs.append(arcs)
        return len(self.arcs) - 1

    def _split(self, before: int, word: int) -> int:
        """The state for ``before`` + word, cut off from a longer class if need be."""
        there, size = self.arcs[before][word], self.length[before] + 1
        if self.length[there] == size:
            return there
        twin = self._state(size, self.fail[there], dict(self.arcs[there]))
        self.fail[there] = twin
        while before >= 0 and self.arcs[before].get(word) == there:
            self.arcs[before][word] = twin
            before = self.fail[before]
        return twin

    def _append(self, at: int, word: int) -> int:
        if word in self.arcs[at]:
            return self._split(at, word)
        new = self._state(self.length[at] + 1, 0, {})
        while at >= 0 and word not in self.arcs[at]:
            self.arcs[at][word] = new
            at = self.fail[at]
        if at >= 0:
            self.fail[new] = self._split(at, word)
        return new

    def holder(self, state: int, size: int) -> int:
        """The state on the failure path of ``state`` that holds its suffix of ``size`` words."""
        while self.length[self.fail[state]] >= size:
            state = self.fail[state]
        return state

    def stream(self, codes) -> Iterator[tuple[int, int, int]]:
        """(position, state, longest match) after every word; starts at the root."""
        arcs, fail, length = self.arcs, self.fail, self.length
        state = size = 0
        for i, c in enumerate(codes):
            while state and c not in arcs[state]:
                state = fail[state]
                size = length[state]
            nxt = arcs[state].get(c)
            if nxt is not None:
                state = nxt
                size += 1
            yield i, state, size

    def codes(self, text: bytes) -> np.ndarray:
        """The numbers of a lower-cased text's words, -1 for words of no item."""
        parts, at = [], 0
        get = self.vocabulary.get
        while at < len(text):
            cut = BREAK.search(text, at + CHUNK_BYTES) if at + CHUNK_BYTES < len(text) else None
            end = cut.start() if cut else len(text)
            words = WORD.findall(text, at, end)
            parts.append(np.fromiter((get(w, -1) for w in words), np.int32, len(words)))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def hits(self, codes: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges (first, last) inside occurrences, in order of their ends, and the items that occur."""
        known = np.concatenate(([0], (codes >= 0).astype(np.int8), [0]))
        step = np.diff(known)
        starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        # An unknown word sends the automaton to its root, so runs of known words are independent.
        for a, b in zip(starts[stops - starts >= self.shortest].tolist(), stops[stops - starts >= self.shortest].tolist()):
            for i, state, size in self.stream(codes[a:b].tolist()):
                if size >= self.window:
                    found.append((a + i - size + 1, a + i))
                    items |= self.owners[self.holder(state, self.window)]
                end = self.ends[state]
                while end > 0:
                    need = self.short[end]
                    if size >= need:
                        found.append((a + i - need + 1, a + i))
                        items |= self.owners[end]
                    end = self.ends[self.fail[end]]
        return found, items


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _places(text: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """The code points (end exclusive) of word ranges."""
    out, want = [], iter(spans)
    span = next(want, None)
    begin = at = chars = 0
    for k, m in enumerate(WORD.finditer(text)):
        if span is None:
            break
        if k == span[0]:
            chars += len(text[at:m.start()].decode("utf-8", "replace"))
            begin, at = chars, m.start()
        if k == span[1]:
            chars += len(text[at:m.end()].decode("utf-8", "replace"))
            at = m.end()
            out.append({"first": span[0], "last": span[1], "start": begin, "end": chars})
            span = next(want, None)
    return out


def _finder(shared):
    @F.arrow_udf(FOUND)
    def find(text: pa.Array, before: pa.Array) -> pa.Array:
        automaton, out = shared.value, []
        for raw, old in zip(text_bytes(text), before.to_pylist()):
            low = raw.lower()
            codes = automaton.codes(low)
            ranges, items = automaton.hits(codes)
            if old:
                ranges += [(s["first"], s["last"]) for s in old["spans"]]
                items |= set(old["items"])
            spans = _merge(ranges)
            out.append({"n_words": len(codes), "n_hit": sum(b - a + 1 for a, b in spans), "items": sorted(items),
                        "spans": _places(low, spans)})
        return pa.array(out, type=before.type)

    # Marked so that a filter on the result does not make the texts be streamed a second time.
    return find.asNondeterministic()


def _blocks(benchmark: DataFrame, item_id: str, window: int, block_words: int) -> list[DataFrame]:
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col("text").cast("string").alias("text")).distinct()
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10ffff}]+")))).first()[0] or 0
    n = max(1, -(-words // block_words))
    return [items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def annotate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text",
             out: str = "found", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a column ``out``: words, hit words, items that occur and the merged hit spans."""
    spark, cur = docs.sparkSession, docs.withColumn(out, F.lit(None).cast(FOUND))
    blocks = _blocks(benchmark, item_id, window, block_words)
    for k, block in enumerate(blocks):
        # Bounded: a block holds about block_words words of the benchmark.
        rows = [(r["item"], WORD.findall((r["text"] or "").encode().lower())) for r in block.collect()]
        find = _finder(spark.sparkContext.broadcast(SuffixAutomaton(rows, window)))
        cur = cur.withColumn(out, find(F.col(text).cast("string"), F.col(out)))
        if k + 1 < len(blocks):
            cur = materialize(cur, "decontaminate-block")
    return cur


def cut(text: Column | str, spans: Column) -> Column:
    """The text without the given code point spans."""
    text = F.col(text) if isinstance(text, str) else text
    n = F.size(spans)
    kept = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(
        text,
        (F.when(i > 0, F.try_element_at(spans, i)["end"]).otherwise(F.lit(0)) + 1).cast("int"),
        (F.when(i < n, F.try_element_at(spans, i + 1)["start"]).otherwise(F.length(text))
         - F.when(i > 0, F.try_element_at(spans, i)["end"]).otherwise(F.lit(0))).cast("int")))
    return F.when(n > 0, F.array_join(kept, "")).otherwise(text)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_share: float = 0.5,
           min_span: int = 1) -> DataFrame:
    """``docs`` without benchmark passages: spans of ``min_span`` words or more are cut out, and a document
    with over ``max_share`` of its words hit is dropped. Clean texts stay as they are."""
    packed = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), "text")
    found = annotate(packed, benchmark, window)
    spans = F.filter("found.spans", lambda s: s["last"] - s["first"] + 1 >= min_span)
    kept = found.filter(F.col("found.n_hit") <= F.lit(max_share) * F.col("found.n_words")).select("row", "text", spans.alias("spans"))
    kept = kept.withColumn("cut", cut("text", F.col("spans")))
    changed = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("cut").cast("long")).otherwise(F.col("row").getField("n_chars"))
    return kept.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
