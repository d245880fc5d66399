"""Language-model scores from a weighted backoff automaton.

The automaton has one state per n-gram context seen in training. A state has an
arc for every word seen after it, weighted with the smoothed log10
probability, and a failure arc to its suffix context, weighted with the mass left
for unseen words; the root has an arc for every word. Smoothing is a
hierarchical Dirichlet prior, P(w|h) = (c(h,w) + mu P(w|h')) / (c(h) + mu) with
P(w) = (c(w)+1)/(N+V+1) at the root, so an unseen arc costs exactly mu/(c(h)+mu)
times the lower order and every state sums to one. A text is read once from
left to right, starting in the state of a text boundary; each token takes the
arc of the longest context that has one, adding the failure weights passed on the way.

The automaton grows with the corpus, so no task holds it whole. Texts are packed into
blocks (a written table). Each block sends its distinct n-grams and their training
counts to shards of the key space; a shard adds up the counts of all blocks and
answers every block with the totals of just the n-grams it asked about; a block then
has the arcs and failure arcs of its own tokens. N-grams are 62-bit hashes with
the order in the low bits.

Defined results: NULL and empty texts are the single end token; repeated rows count
as often as they occur; rows without id are scored and are in training; an
empty training part gives N = 0 and every token probability 1; an empty table gives an empty result. Only
``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_fold, text_buffer

ORDER = 2
MU = 50.0
BLOCK_BYTES = 8 << 20
SLAB_BYTES = 1 << 20
SHARD_TOKENS = 2_000_000
END = np.uint64(0x9E3779B97F4A7C15)
STEP, INVERSE = np.uint64(0x5851F42D4C957F2D), np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
# Space and bytes 9 to 13 part words; A-Z are lowered.
IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWERED = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint64)

BLOCKS = "block string, n_tokens long, ids binary, id_null binary, held binary, lens binary, texts binary"
ASKS = "block string, shard int, keys binary, n int, counts binary"
TOTALS = "block string, shard int, totals binary, n int, tokens long, words long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.concatenate((out[:1], np.full(n - 1, base, np.uint64))), out=out)
    return out


def _word_ends(space: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of every word; words do not run across texts."""
    ends_of = np.cumsum(lens)[lens > 0]
    begins_of = ends_of - lens[lens > 0]
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    first[begins_of] = ~space[begins_of]
    last[:-1] &= space[1:]
    last[ends_of - 1] = ~space[ends_of - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of every word: the difference of two prefix sums of byte times power, divided by the power
    at its start (all modulo 2^64), and then mixed. SLAB_BYTES at a time, so temporary arrays stay small."""
    out, lo = np.empty(len(starts), np.uint64), 0
    up, down = _powers(STEP, SLAB_BYTES), _powers(INVERSE, SLAB_BYTES)
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(stops, starts[lo] + SLAB_BYTES, "right")))
        a, b = int(starts[lo]), int(stops[hi - 1])
        if b - a > len(up):  # a single word longer than a slab
            up, down = _powers(STEP, b - a), _powers(INVERSE, b - a)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((LOWERED[data[a:b]] + np.uint64(1)) * up[:b - a])))
        s, e = starts[lo:hi] - a, stops[lo:hi] - a
        out[lo:hi] = _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def tokens(data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, tokens of every text); each text ends with the END token."""
    starts, stops = _word_ends(IS_SPACE[data], lens)
    ends_of = np.cumsum(lens)
    per = np.searchsorted(starts, ends_of) - np.searchsorted(starts, ends_of - lens) + 1
    out = np.empty(int(per.sum()), np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[np.cumsum(per) - 1] = True
    out[is_end], out[~is_end] = END, _hashes(data, starts, stops)
    return out, per


def ngrams(hashes: np.ndarray, per: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order, the key of the n-gram that ends at each token; a text starts after an END token."""
    begin = np.cumsum(per) - per
    tag = lambda x, k: (x & ~np.uint64(3)) | np.uint64(k)
    levels = [tag(_mix(hashes), 1)]
    for k in range(2, order + 1):
        before = np.empty_like(hashes)
        before[1:] = levels[-1][:-1]
        # Before a text stands one END; longer contexts than that do not exist at its first token.
        before[begin] = tag(_mix(np.array([END])), 1)[0] if k == 2 else np.uint64(k)
        levels.append(tag(_mix(before * np.uint64(0xD6E8FEB86659FD93) + hashes), k))
    return levels


def _pack(a: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: high planes of sorted differences and small counts are nearly all zero."""
    if not len(a):
        return b""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(b: bytes, n: int, kind) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(b, decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(kind)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.zeros(1, keys.dtype)))


def _unpack_sorted(b: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(b, n, np.uint64), dtype=np.uint64)


def _blocks(docs: DataFrame, fold: int, held: int) -> DataFrame:
    """Texts packed into blocks of about BLOCK_BYTES."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        nulls: list[np.ndarray] = []
        helds: list[np.ndarray] = []
        lens: list[np.ndarray] = []
        texts: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal made, size, ids, nulls, helds, lens, texts
            blob, all_lens = b"".join(texts), np.concatenate(lens)
            n = len(_word_ends(IS_SPACE[np.frombuffer(blob, np.uint8)], all_lens)[0]) + len(all_lens)
            row = {"block": f"{part}-{made}", "n_tokens": n, "ids": np.concatenate(ids).tobytes(),
                   "id_null": np.concatenate(nulls).tobytes(), "held": np.concatenate(helds).tobytes(),
                   "lens": all_lens.tobytes(), "texts": pa.compress(blob, codec="zstd", asbytes=True)}
            made, size, ids, nulls, helds, lens, texts = made + 1, 0, [], [], [], [], []
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            offsets, data = text_buffer(batch.column(2))
            lo = 0
            while lo < batch.num_rows:
                # As many rows as the block still holds, one at least.
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES - size, "right")) - 1)
                col = batch.column(0).slice(lo, hi - lo)
                ids.append(col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                nulls.append(col.is_null().to_numpy(zero_copy_only=False))
                helds.append(batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool))
                lens.append(np.diff(offsets[lo:hi + 1]))
                texts.append(data[offsets[lo]:offsets[hi]].tobytes())
                size += int(offsets[hi] - offsets[lo])
                lo = hi
                if size >= BLOCK_BYTES:
                    yield flush()
        if lens:
            yield flush()

    schema = pa.schema([("block", pa.string()), ("n_tokens", pa.int64()), *[(c, pa.binary()) for c in ("ids", "id_null", "held", "lens", "texts")]])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(id_fold("doc_id", fold) == held, F.lit(False)).alias("held"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pack, BLOCKS)


def _read(lens: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.frombuffer(lens, np.int64)
    n = int(sizes.sum())
    blob = pa.decompress(texts, decompressed_size=n, codec="zstd", asbytes=True) if n else b""
    return tokens(np.frombuffer(blob, np.uint8), sizes)


def _ask(blocks: DataFrame, order: int, shards: int) -> DataFrame:
    """Each block's distinct n-grams with their training counts, cut by shard of the key space."""
    schema = pa.schema([("block", pa.string()), ("shard", pa.int32()), ("keys", pa.binary()), ("n", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, per = _read(row["lens"], row["texts"])
                train = np.repeat(~np.frombuffer(row["held"], bool), per)
                keys, where = np.unique(np.concatenate(ngrams(hashes, per, order)), return_inverse=True)
                counts = np.bincount(where, np.tile(train, order), len(keys)).astype(np.uint32)
                cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
                yield pa.RecordBatch.from_pylist([
                    {"block": row["block"], "shard": s, "keys": _pack_sorted(keys[a:b]), "n": b - a, "counts": _pack(counts[a:b])}
                    for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if a < b], schema=schema)

    return blocks.select("block", "held", "lens", "texts").mapInArrow(run, ASKS)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the key space, so that a shard of sorted keys is a slice."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _add_up(asks: pd.DataFrame) -> pd.DataFrame:
    """One shard: totals of every asked n-gram, answered block by block; the first row has the shard's token counts."""
    asks = asks.sort_values("block")
    keys = [_unpack_sorted(b, n) for b, n in zip(asks["keys"], asks["n"])]
    counts = [_unpack(b, n, np.uint32) for b, n in zip(asks["counts"], asks["n"])]
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(where, np.concatenate(counts), len(distinct)).astype(np.uint64)
    words = totals[(distinct & np.uint64(3)) == 1]
    answers = np.split(totals[where], np.cumsum(asks["n"].to_numpy())[:-1])
    lead = np.arange(len(asks)) == 0
    return pd.DataFrame({"block": asks["block"].to_numpy(), "shard": asks["shard"].to_numpy(),
                         "totals": [_pack(a) for a in answers], "n": asks["n"].to_numpy(),
                         "tokens": np.where(lead, int(words.sum()), 0), "words": np.where(lead, int((words > 0).sum()), 0)})


def traverse(counts: list[np.ndarray], begin: np.ndarray, end_count: int, n: int, v: int, mu: float) -> np.ndarray:
    """log10 weight of the path of every token; ``counts[k]`` is the training count of the (k+1)-gram ending there.

    Orders are visited upwards: where the state of the next longer context exists, the
    token takes its arc, or its failure arc on top of the path found so far.
    """
    prob = (counts[0] + 1.0) / (n + v + 1.0)
    path = np.log10(prob)
    for k in range(1, len(counts)):
        context = np.empty_like(counts[k - 1])
        context[1:] = counts[k - 1][:-1]
        context[begin] = end_count if k == 1 else 0
        state = context > 0
        fail = mu / (context + mu)
        prob = np.where(state, (counts[k] + mu * prob) / (context + mu), prob)
        path = np.where(counts[k] > 0, np.log10(prob), path + np.where(state, np.log10(fail), 0.0))
    return path


def _sums(weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums per text in extended precision, so that long texts do not gather rounding errors."""
    return np.add.reduceat(weights.astype(np.longdouble), begin).astype(np.float64)


def lm_score(docs: DataFrame, order: int = ORDER, mu: float = MU, fold: int = 7, held: int = 2) -> DataFrame:
    """Score every text; texts whose id falls on ``held`` of ``fold`` are kept out of training."""
    spark = docs.sparkSession
    blocks = materialize(_blocks(docs, fold, held), "lm-blocks")
    n_tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(8, -(-n_tokens // SHARD_TOKENS))
    totals = materialize(_ask(blocks, order, shards).groupBy("shard").applyInPandas(_add_up, TOTALS), "lm-totals")
    n, v = (int(x or 0) for x in totals.agg(F.sum("tokens"), F.sum("words")).first())

    def score(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        frames = []
        answers = answers.sort_values("shard")
        total = np.concatenate([_unpack(b, m, np.uint64) for b, m in zip(answers["totals"], answers["n"])]).astype(np.float64)
        for row in block.to_dict("records"):
            hashes, per = _read(row["lens"], row["texts"])
            keys, where = np.unique(np.concatenate(ngrams(hashes, per, order)), return_inverse=True)
            counts = np.split(total[where], order)
            closing = np.cumsum(per) - 1
            begin = closing - per + 1
            path = traverse(counts, begin, int(counts[0][closing[0]]), n, v, mu)
            base = np.log10((counts[0] + 1.0) / (n + v + 1.0))
            frames.append(pd.DataFrame({
                "doc_id": pd.array(np.frombuffer(row["ids"], np.int64), dtype="Int64"),
                "held_out": np.frombuffer(row["held"], bool), "n_tokens": per.astype(np.int64),
                "n_known": np.add.reduceat((counts[0] > 0).astype(np.int64), begin), "train_tokens": np.int64(n),
                "base_score": _sums(base, begin), "score": _sums(path, begin)}))
            frames[-1].loc[np.frombuffer(row["id_null"], bool), "doc_id"] = pd.NA
        return pd.concat(frames)

    return blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(score, SCORES)
