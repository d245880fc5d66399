"""Token counts by a byte-level BPE vocabulary, compiled into two finite-state transducers.

The cutter is a deterministic transducer over character classes. It marks where the library's pre-tokenizer starts a piece: contractions, words,
numbers and symbol runs with an optional space before them, and white space, whose last character goes to the piece that follows. Marks are at most
one character late. A batch of texts is one stream with a separator between texts; it is cut into chunks of equal size, every chunk gets its
map from start state to end state, and the maps are composed by a parallel prefix scan, which gives each chunk its start state.

The counter is a deterministic transducer over the bytes of one piece, whose transitions are annotated with the number of tokens that they emit.
A BPE encoding is the one path of tokens in which any two neighbours are also the encoding of their own concatenation. So the last
token of every prefix is known from the last tokens of the prefixes before it, and a state holds, for each place where a token may still start: the bytes since then (a
node of the vocabulary's trie), the token before it, and how many tokens it is ahead of the least of them, which have been emitted. The states of a vocabulary are finite in number; those that texts meet are compiled when met
and start anew when they fill their table. No text is encoded by a library.

Texts are read in slabs of bounded size, and both transducers carry their state over a slab's end, so memory does not grow with the longest text or the longest piece.

Defined results: a NULL or empty text has no bytes and no tokens. A special token's string inside a text is that one token, and the text ends and starts anew around it, as in the library. Repeated rows count one by one; an empty
table gives an empty result. The result is a Column, so the table's columns cannot clash.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

CHUNK = 256             # characters of a chunk
SLAB = 1 << 18          # bytes read at once
TRANSITIONS = 1 << 19    # compiled transitions of the counter after which it starts anew
SLOTS = 4 * TRANSITIONS   # of their hash table; a slab adds SLAB transitions at most
HASH = -7046029254386353131

# Character classes. The letters of contractions have their own: s, t, m, d end one, e ends 're and 've, l both begins and ends 'll.
END, LETTER, SHORT, RV, EL, EE, DIGIT, SPACE, BLANK, APOSTROPHE, SYMBOL = range(11)
LETTERS = (LETTER, SHORT, RV, EL, EE)
# States of the cutter, by what is open: nothing, a run, white space of one or more characters (by its last one), an apostrophe that starts a piece, and it with a letter.
CLOSED, WORD, NUMBER, SYMBOLS, SPACE1, BLANK1, SPACES, BLANKS, QUOTE, QUOTE_RV, QUOTE_EL = range(11)
HERE, BEFORE = 1, 2     # a piece starts at this character, at the one before


def _cutter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by 11 * state + class."""
    first = {DIGIT: NUMBER, SPACE: SPACE1, BLANK: BLANK1, APOSTROPHE: QUOTE, SYMBOL: SYMBOLS} | dict.fromkeys(LETTERS, WORD)
    joins = {DIGIT: NUMBER, APOSTROPHE: SYMBOLS, SYMBOL: SYMBOLS} | dict.fromkeys(LETTERS, WORD)    # what a space before it belongs to
    white = {SPACE: SPACES, BLANK: BLANKS}
    stays = {(s, c): (t, 0) for s in (SPACE1, BLANK1, SPACES, BLANKS) for c, t in white.items()}
    stays |= {(WORD, c): (WORD, 0) for c in LETTERS} | {(NUMBER, DIGIT): (NUMBER, 0)} | {(SYMBOLS, c): (SYMBOLS, 0) for c in (APOSTROPHE, SYMBOL)}
    stays |= {(SPACE1, c): (t, 0) for c, t in joins.items()} | {(SPACES, c): (t, BEFORE) for c, t in joins.items()}
    stays |= {(BLANKS, c): (first[c], BEFORE | HERE) for c in joins}
    stays |= {(QUOTE, SHORT): (CLOSED, 0), (QUOTE, RV): (QUOTE_RV, 0), (QUOTE, EL): (QUOTE_EL, 0), (QUOTE, APOSTROPHE): (SYMBOLS, 0), (QUOTE, SYMBOL): (SYMBOLS, 0)}
    for s, ends in ((QUOTE_RV, EE), (QUOTE_EL, EL)):        # no contraction: the letter has started a word
        stays |= {(s, c): (WORD, BEFORE) if c in LETTERS else (first[c], BEFORE | HERE) for c in first} | {(s, ends): (CLOSED, 0), (s, END): (CLOSED, BEFORE)}
    step, mark = np.zeros((11, 11), np.uint8), np.zeros((11, 11), np.uint8)
    for s in range(11):
        for c in range(11):
            step[s, c], mark[s, c] = stays.get((s, c), (CLOSED, 0) if c == END else (first[c], HERE))
    return step.ravel(), mark.ravel()


STEP, MARK = _cutter()


def character_classes() -> np.ndarray:
    """Class of every code point; the last entry is the separator's."""
    import regex

    every = "".join(map(chr, range(0xD800))) + "\ud800" * 0x800 + "".join(map(chr, range(0xE000, sys.maxunicode + 1)))
    out = np.full(sys.maxunicode + 2, SYMBOL, np.uint8)
    for pattern, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\s+", BLANK)):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = cls
    for chars, cls in (("stmd", SHORT), ("rv", RV), ("l", EL), ("e", EE), (" ", SPACE), ("'", APOSTROPHE)):
        out[[ord(c) for c in chars]] = cls
    out[-1] = END
    return out


def piece_starts(classes: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Marks of every character of a stream that is entered in ``state``, and the state after it."""
    n = len(classes)
    chunks = -(-n // CHUNK)
    grid = np.full(chunks * CHUNK, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)      # one row per place in the chunk
    now = np.array([state], np.uint8)
    if chunks > 1:
        # state maps: all start states in step until they meet, then one state a chunk
        maps = np.tile(np.arange(11, dtype=np.uint8), (chunks, 1))
        one, apart = np.zeros(chunks, np.uint8), np.arange(chunks)
        for t in range(CHUNK):
            one = STEP[one * 11 + grid[t]]
            if len(apart):
                ends = maps[apart] = STEP[maps[apart] * 11 + grid[t, apart][:, None]]
                met = (ends == ends[:, :1]).all(axis=1)
                one[apart[met]] = ends[met, 0]
                apart = apart[~met]
        joined = np.setdiff1d(np.arange(chunks), apart)
        maps[joined] = one[joined, None]
        d = 1
        while d < chunks:       # inclusive scan: map i becomes map i after map i - d
            maps[d:] = np.take_along_axis(maps[d:], maps[:-d], axis=1)
            d *= 2
        now = np.concatenate([now, maps[:-1, state]])
    marks, after, last = np.empty_like(grid), state, n - 1 - (chunks - 1) * CHUNK
    for t in range(CHUNK):
        key = now * 11 + grid[t]
        marks[t], now = MARK[key], STEP[key]
        if t == last:
            after = int(now[-1])
    return marks.T.reshape(-1)[:n], after


class Vocabulary:
    """Merges, trie and single-token strings of a byte-level BPE file, as the counter needs them."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        cut = spec["pre_tokenizer"] or {}
        if (model["type"], cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) != ("BPE", "ByteLevel", False, True) or spec["normalizer"] or spec["post_processor"] or model["ignore_merges"]:
            raise ValueError("only byte-level BPE vocabularies without normalizer and post-processor are known")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take white space or need word ends are not known")
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        # byte-level files write each byte as a printable character: itself where it is printable, else the next one from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.merge, self.made = {}, {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids, new = (model["vocab"][a], model["vocab"][b]), model["vocab"][a + b]
            self.merge.setdefault(ids, (rank, new))
            self.made.setdefault(new, (rank, ids))
        # trie over the tokens that are their own encoding: no other can stand in an encoding
        self._is_whole: dict[int, bool] = {}
        self.child: dict[int, int] = {}
        self.token = [-1]
        for name, i in model["vocab"].items():
            raw = [char[c] for c in name]
            if (i in self.made or len(raw) == 1) and self._whole(i):
                node = 0
                for b in raw:
                    node = self.child.setdefault(node << 8 | b, len(self.token))
                    if node == len(self.token):
                        self.token.append(-1)
                self.token[node] = i
        self.inner = {key >> 8 for key in self.child}
        self._follows: dict[tuple[int, int], bool] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float, float]]:
        """Symbols that stand at one end of a token while it is merged: (symbol, rank that makes it, rank that takes it up)."""
        out, taken = [], float("inf")
        while True:
            rank, parts = self.made.get(token, (-1, None))
            out.append((token, rank, taken))
            if parts is None:
                return out
            token, taken = parts[side], rank

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may stand right after token a (-1: the start of the piece): no merge across their border comes to its turn.

        A merge of the symbols x and y at the border does if both are there at its rank; among equal merges the left one is first.
        """
        if a < 0:
            return True
        known = self._follows.get((a, b))
        if known is None:
            if len(self._follows) > 1 << 18:
                self._follows.clear()
            known = self._follows[a, b] = not any(self._across(a, b))
        return known

    def _across(self, a: int, b: int) -> Iterator[tuple[int, int]]:
        """The merges across the border of a and b that come to their turn."""
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while i < len(left) and j < len(right):
            (x, made_x, taken_x), (y, made_y, taken_y) = left[i], right[j]
            rank = self.merge.get((x, y), (-1,))[0]
            if max(made_x, made_y) < rank < taken_x and rank <= taken_y:
                yield x, y
            if made_x >= made_y:    # go back in time: the symbol made last is not there before
                i += 1
            else:
                j += 1

    def _whole(self, token: int) -> bool:
        """Whether a token is its own encoding: its parts are, and no other merge tears them."""
        if token not in self._is_whole:
            pair = self.made[token][1] if token in self.made else ()
            self._is_whole[token] = all(map(self._whole, pair)) and (not pair or all(m == pair for m in self._across(*pair)))
        return self._is_whole[token]


OPEN = ((0, -1, 0),)     # the start of a piece


class Counter:
    """The counting transducer, compiled as far as texts have met it.

    A state is the tuple of its open places: (trie node of the bytes since then, token before it, tokens ahead). The last place is the end of the bytes so
    far, so its tokens ahead are what is left to emit where a piece ends. Transitions stand in a hash table that is read for many pieces at once.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.number = {OPEN: 0}
        self.places = [OPEN]
        self.used = 0
        self.keys = np.full(SLOTS, -1, np.int64)    # state, byte
        self.to = np.zeros(SLOTS, np.int64)         # next state, tokens emitted

    def add(self, state: tuple) -> int:
        """Number of a state."""
        n = self.number.setdefault(state, len(self.places))
        if n == len(self.places):
            self.places.append(state)
        return n

    def compile(self, state: int, byte: int) -> tuple[tuple, int]:
        """The transition of one state by one byte: next state, tokens emitted."""
        v, open_places, last = self.vocabulary, [], None
        for node, before, ahead in self.places[state]:
            child = v.child.get(node << 8 | byte)
            if child is None:
                continue
            if child in v.inner:
                open_places.append((child, before, ahead))
            token = v.token[child]
            if last is None and token >= 0 and v.follows(before, token):
                last = (0, token, ahead + 1)
        open_places.append(last)
        least = min(p[2] for p in open_places)
        return tuple((n, b, a - least) for n, b, a in open_places), least

    def _slots(self, key: np.ndarray) -> np.ndarray:
        """Where each (state, byte) stands, or the free slot where it would."""
        slot = (key * HASH >> 20) & (SLOTS - 1)
        lost = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] >= 0))
        while len(lost):
            slot[lost] = (slot[lost] + 1) & (SLOTS - 1)
            at = self.keys[slot[lost]]
            lost = lost[(at != key[lost]) & (at >= 0)]
        return slot

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, tokens emitted) of many states, each by a byte of its own."""
        key = state << 8 | byte
        slot = self._slots(key)
        new = self.keys[slot] < 0
        if new.any():
            for k in np.unique(key[new]).tolist():
                to, emitted = self.compile(k >> 8, k & 255)
                at = (k * HASH >> 20) & (SLOTS - 1)
                while self.keys[at] >= 0:
                    at = (at + 1) & (SLOTS - 1)
                self.keys[at], self.to[at] = k, self.add(to) << 16 | emitted
                self.used += 1
            slot = self._slots(key)
        return self.to[slot] >> 16, self.to[slot] & 0xFFFF

    def run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: tuple) -> tuple[np.ndarray, tuple]:
        """Tokens of each piece data[start:end], and the state at the end of the last one, whose rest is not counted.

        The first piece is entered in the state ``first``; all others start anew.
        """
        if self.used > TRANSITIONS:
            self.clear()
        state, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        state[0] = self.add(first)
        order = np.argsort(start - end, kind="stable")      # longest first
        longest = (end - start)[order]
        for t in range(int(longest[0])):
            now = order[:np.searchsorted(-longest, -t, side="left")]
            state[now], emitted = self.step(state[now], data[start[now] + t])
            count[now] += emitted
        last = np.unique(state)
        rest = np.array([self.places[s][-1][2] for s in last.tolist()], np.int64)
        count[:-1] += rest[np.searchsorted(last, state[:-1])]
        return count, self.places[state[-1]]


def _parts(raw: bytes, special: list[str]) -> Iterator[bytes]:
    """A text in parts of at most SLAB bytes, cut between characters and outside special tokens."""
    a = 0
    while len(raw) - a > SLAB:
        e = a + SLAB
        while raw[e] & 0xC0 == 0x80:
            e -= 1
        for name in special:
            at = raw.find(name.encode(), max(a + 1, e - len(name.encode()) + 1), e + len(name.encode()) - 1)
            e = at if 0 < at < e else e
        yield raw[a:e]
        a = e
    yield raw[a:]


def _slabs(texts: list[bytes], special: list[str]) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Lists of (row, bytes without special tokens, whether a separator follows) of about SLAB bytes each."""
    pattern = re.compile(b"|".join(re.escape(name.encode()) for name in special)) if special else None
    held, size = [], 0
    for row, raw in enumerate(texts):
        for part in _parts(raw, special) if len(raw) > SLAB else (raw,):
            runs = pattern.split(part) if pattern else [part]
            held += [(row, run, i + 1 < len(runs)) for i, run in enumerate(runs)]
            size += len(part) + 1
            if size >= SLAB:
                yield held
                held, size = [], 0
        held.append((row, b"", True))
    if held:
        yield held


def count_tokens(texts: list[bytes], counter: Counter, classes: np.ndarray) -> np.ndarray:
    """Tokens of every text."""
    special = counter.vocabulary.special
    total = np.zeros(len(texts), np.int64)
    state, places, row = CLOSED, OPEN, 0
    kept_bytes, kept_mark, kept_row = b"", False, 0     # the last character is kept back: its mark may come with the next one
    for slab in _slabs(texts, special):
        runs = [run for _, run, _ in slab]
        data = np.frombuffer(b"".join(runs), np.uint8)
        begins = np.flatnonzero((data & 0xC0) != 0x80)                          # byte of every character
        ends = np.cumsum([len(run) for run in runs])                            # byte after every run
        rows = np.array([r for r, _, _ in slab])
        cut = np.array([c for _, _, c in slab])
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.searchsorted(begins, ends[cut])
        cls = np.insert(classes[codes], at, END)
        byte = np.insert(begins, at, ends[cut])
        if len(cls) == 0:
            continue
        marks, state = piece_starts(cls, state)
        # one stream: the character kept back, then this slab's
        here = np.concatenate([[kept_mark], (marks & HERE) > 0])
        here[:-1] |= (marks & BEFORE) > 0
        byte = np.concatenate([[0], byte + len(kept_bytes)])
        data = np.concatenate([np.frombuffer(kept_bytes, np.uint8), data])
        stop = int(byte[-1])                                                    # the last character waits
        starts = np.flatnonzero(here[:-1])
        owner = rows[np.searchsorted(ends - [len(run) for run in runs], byte[starts] - len(kept_bytes), side="right") - 1]
        owner[starts == 0] = kept_row
        edges = np.concatenate([[0], byte[starts], [stop]])
        count, places = counter.run(data, edges[:-1], edges[1:], places)
        owner = np.concatenate([[row], owner])
        np.add.at(total, owner, count)
        row = int(owner[-1])
        kept_bytes, kept_mark, kept_row = data[stop:].tobytes(), bool(here[-1]), int(rows[len(rows) - 1])
    if len(texts):
        total[row] += places[-1][2]
    if special:
        find = re.compile(b"|".join(re.escape(name.encode()) for name in special)).findall
        for i, raw in enumerate(texts):
            if any(name.encode() in raw for name in special):
                total[i] += len(find(raw))
    return total


def n_tokens(spark: SparkSession, text: str | Column, vocabulary: str) -> Column:
    """Tokens of every text by the byte-level BPE vocabulary in the file ``vocabulary``."""
    shared = spark.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())     # a file of one or two MB, read once

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter, classes = _compiled(shared.value)
        for batch in batches:
            yield pa.array(count_tokens(pc.fill_null(batch.cast(pa.large_binary()), b"").to_pylist(), counter, classes))

    return F.coalesce(count(F.col(text) if isinstance(text, str) else text), F.lit(0).cast("long"))


_READY: dict[int, tuple[Counter, np.ndarray]] = {}


def _compiled(text: str) -> tuple[Counter, np.ndarray]:
    """The transducers of a vocabulary, kept for the later tasks of a Python worker."""
    key = hash(text)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Counter(Vocabulary(text)), character_classes()
    return _READY[key]
