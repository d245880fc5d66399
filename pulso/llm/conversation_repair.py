"""Conversation structure repair: the cheapest edits that make a conversation alternate, found with a persistent audit.

A repaired conversation is an optional system row and then pairs of a user and an assistant row. A dynamic program reads the rows in turn order
and keeps, for each of four places in that grammar, the cheapest edits that lead there: Keep 0, Rerole 1, Delete 2, Insert 5, and 5 more for a truncated row that stays. Blank and duplicate
rows have to go. Among equal costs the audit (the edits' initials) that is least in ASCII wins.

Audits are never copied: an edit is a node that links to the edits before it, shared by all paths through it. A node holds its binary-lifting ancestors and the rolling hash of its
audit, so two audits are compared by searching their longest common prefix from far to near; equal hashes are verified letter by letter.
What all live paths share is settled: its rows are emitted and its nodes forgotten, so a conversation of any length streams through in bounded memory as long as its paths
meet. A row that cannot stay leaves no text behind, so where paths stay apart (a system row and then nothing but blanks), only their nodes add up.

Duplicates are found by a window over (conversation, role, text), which spreads a conversation over all tasks. The rest of the work on one conversation is in its order, and its digest is one SHA-256 chain,
so its rows pass through one task, as a sorted stream and never as a group in memory.

Defined results: rows are read by turn, NULL first, rows of one turn by role and then text. A NULL role or text is one space. Rows with a NULL conversation form a conversation of their own.
Roles with other initials than s, u, a cannot be kept. Repeated rows are duplicates. A conversation whose rows are all dropped has zeros, an empty audit and the hash of
the empty string; an empty table gives an empty result. Gaps beyond 64 bits saturate. Only the four named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BASE, MODULUS = 1_000_003, 2**61 - 1
SETTLE = 256            # rows after which shared edits are settled
FINE, BLANK, DUPLICATE, TRUNCATED, DROPPED = range(5)
START, SYSTEM, USER, PAIR = range(4)        # nothing yet, a system row, an open user row, complete pairs
KEEP, REROLE, DELETE, INSERT = "KRDI"
WHITE = " \t\n\x0b\x0c\r"
LONG = 2**63 - 1


class Audits:
    """Edit sequences as linked nodes; node 0 is the empty one."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]       # ancestors 1, 2, 4, ... edits before

    def add(self, node: int, letter: str) -> int:
        up, k = [node], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(tuple(up))
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % MODULUS)
        return len(self.up) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while (ahead := self.depth[node] - depth) > 0:
            node = self.up[node][ahead.bit_length() - 1]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def _fork(self, a: int, b: int, same: Callable[[int, int], bool]) -> tuple[int, int]:
        """First nodes at which two paths of one length differ."""
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return a, b

    def less(self, a: int, b: int) -> bool:
        """Whether audit a is before audit b in ASCII order."""
        short = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, short), self.ancestor(b, short)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        x, y = self._fork(x, y, self.same)
        return self.letter[x] < self.letter[y]

    def shared(self, nodes: list[int]) -> int:
        """The last node that all paths go through."""
        out = nodes[0]
        for node in nodes[1:]:
            depth = min(self.depth[out], self.depth[node])
            out, node = self.ancestor(out, depth), self.ancestor(node, depth)
            if out != node:
                out = self.up[self._fork(out, node, int.__eq__)[0]][0]
        return out

    def path(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def below(self, root: int, nodes: list[int]) -> tuple[Audits, list[int]]:
        """The paths from ``root`` to the nodes, as audits of their own."""
        held = set()
        for node in nodes:
            while node != root and node not in held:
                held.add(node)
                node = self.up[node][0]
        out, new = Audits(), {root: 0}
        for node in sorted(held):
            new[node] = out.add(new[self.up[node][0]], self.letter[node])
        return out, [new[n] for n in nodes]


class Repair:
    """The dynamic program over one conversation; ``emit`` gets (edit, role, text) of every settled edit."""

    def __init__(self, emit: Callable[[str, str, str], None]) -> None:
        self.emit = emit
        self.audits = Audits()
        self.live: dict[int, tuple[int, int]] = {START: (0, 0)}    # place: cost, node
        self.rows: list[tuple[str, str]] = []                       # not settled
        self.place = START                                          # after the settled edits

    def _best(self, ways: list[tuple[int, int, str]]) -> tuple[int, int]:
        """The cheapest of (cost, node, edit), the least audit among equals; an edit of "" is the node itself."""
        cost = min(w[0] for w in ways)
        nodes = [self.audits.add(node, edit) if edit else node for c, node, edit in ways if c == cost]
        best = nodes[0]
        for node in nodes[1:]:
            best = node if self.audits.less(node, best) else best
        return cost, best

    def _insert(self) -> None:
        for to, origins in ((USER, (START, SYSTEM, PAIR)), (PAIR, (USER,))):
            ways = [(self.live[p][0] + 5, self.live[p][1], INSERT) for p in origins if p in self.live]
            ways += [(*self.live[to], "")] if to in self.live else []
            if ways:
                self.live[to] = self._best(ways)

    def row(self, role: str, text: str, fault: int) -> None:
        self._insert()
        ways: dict[int, list[tuple[int, int, str]]] = {}
        for place, (cost, node) in self.live.items():
            ways.setdefault(place, []).append((cost + 2, node, DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            cost += 5 * (fault == TRUNCATED)
            to = PAIR if place == USER else USER
            if role[:1] == "ua"[place == USER]:
                ways.setdefault(to, []).append((cost, node, KEEP))
            else:
                ways.setdefault(to, []).append((cost + 1, node, REROLE))
            if place == START and role[:1] == "s":
                ways.setdefault(SYSTEM, []).append((cost, node, KEEP))
        self.live = {place: self._best(w) for place, w in ways.items()}
        if PAIR in self.live:       # what a pair can follow at less cost whatever comes
            least = self.live[PAIR][0]
            for place, more in ((START, 2), (SYSTEM, 0)):
                if place in self.live and self.live[place][0] > least + more:
                    del self.live[place]
        self.rows.append((role, "" if fault in (BLANK, DUPLICATE) else text))
        if len(self.rows) % SETTLE == 0:
            self.settle(self.audits.shared([node for _, node in self.live.values()]))

    def settle(self, node: int) -> None:
        """Emit the edits up to a node that all live paths go through, and forget them."""
        taken = 0
        for edit in self.audits.path(node):
            role, text = "", ""
            if edit != INSERT:
                role, text = self.rows[taken]
                taken += 1
            if edit != DELETE:
                to = PAIR if self.place == USER else SYSTEM if edit == KEEP and role[:1] == "s" else USER
                role = role if edit == KEEP else "assistant" if to == PAIR else "user"
                self.place = to
            self.emit(edit, role, text)
        del self.rows[:taken]
        places = list(self.live)
        self.audits, nodes = self.audits.below(node, [self.live[p][1] for p in places])
        self.live = {p: (self.live[p][0], n) for p, n in zip(places, nodes)}

    def end(self) -> int:
        """Settle everything; the cost."""
        self._insert()
        self.live = {START: self._best([(*self.live[p], "") for p in (START, PAIR) if p in self.live])}
        cost, node = self.live[START]
        self.settle(node)
        return cost


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): rows dropped, emptied, cut short, repeated or given another role, by the crc32 of ``conv_id:turn`` modulo 20."""
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
    gone = F.col("kind") == 0
    return rows.select("conv_id", "turn", F.when(~gone, F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))).alias("role"),
                       F.when(~gone, F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))).alias("text"),
                       gone.alias("dropped"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))).drop("col")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault) of every row of ``damage``."""
    order = F.col("turn").asc_nulls_first()
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(order))
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (F.when(F.col("dropped"), DROPPED).when(body == "", BLANK).when(nth > 1, DUPLICATE)
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(FINE))
    return rows.select("conv_id", "turn", "role", "text", fault.alias("fault"))


def _conversations(rows: DataFrame) -> DataFrame:
    """Rows by conversation and place, each conversation a run in one partition."""
    # of equal rows the one that is no duplicate stands first
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")] + [F.col("fault") == DUPLICATE]
    return faults(rows).repartition("conv_id").sortWithinPartitions(*order)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conversation, iterator over its rows); a run has to be read to its end before the next one."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    held = [next(rows, None)]

    def run(conv: object) -> Iterator[tuple]:
        while held[0] is not None and held[0][0] == conv:
            yield held[0][1:]
            held[0] = next(rows, None)

    while held[0] is not None:
        yield held[0][0], run(held[0][0])


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, step, edit, role, text): every edit of every conversation of ``damage``; deleted rows have an empty role and text."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, step long, edit string, role string, text string"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, run in _runs(batches):
            steps = 0

            def emit(edit: str, role: str, text: str) -> None:
                nonlocal steps
                steps += 1
                out.append((conv, steps, edit, *((role, text) if edit != DELETE else ("", ""))))

            repair = Repair(emit)
            for _, role, text, fault in run:
                if fault != DROPPED:
                    repair.row(role, text, fault)
                if len(out) >= 1000:
                    yield _batch(out, schema_names, types)
                    out.clear()
            repair.end()
        if out:
            yield _batch(out, schema_names, types)

    schema_names = ["conv_id", "step", "edit", "role", "text"]
    types = [_arrow(rows), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _conversations(rows).mapInArrow(stream, schema)


def _arrow(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv_id"].dataType)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def report(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row per conversation of ``damage``."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    names, types = ["conv_id", *COUNTS, "audit", "repaired_sha256"], [_arrow(rows), *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]

    def one(conv: object, run: Iterator[tuple]) -> tuple:
        audit, digest = bytearray(), hashlib.sha256()
        between = b""

        def emit(edit: str, role: str, text: str) -> None:
            nonlocal between
            audit.extend(edit.encode())
            if edit != DELETE:
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"

        repair = Repair(emit)
        seen, turns, illegal = [0] * 4, 0, 0
        first = last = before = None
        for turn, role, text, fault in run:
            if fault == DROPPED:
                continue
            seen[fault] += 1
            if turn is not None:
                first = turn if first is None else first
                turns += turn != last
                last = turn
            illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
            before = role[:1]
            repair.row(role, text, fault)
        gaps = 0 if first is None else min(last - first + 1 - turns, LONG)
        return conv, gaps, *seen[1:], illegal, repair.end(), audit.decode(), digest.hexdigest()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, run in _runs(batches):
            out.append(one(conv, run))
            if len(out) >= 1000:
                yield _batch(out, names, types)
                out = []
        if out:
            yield _batch(out, names, types)

    return _conversations(rows).mapInArrow(stream, schema)
