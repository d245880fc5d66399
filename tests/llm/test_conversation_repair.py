from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from pulso.llm import conversation_repair as cr
from pulso.llm.oracles import OP13_SQL

GRAMMAR = re.compile("(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def _damaged(rows):
    """{conv: rows after damage in order}, from (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept = out.setdefault(conv, [])
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _cheapest(rows, faults):
    """All edit sequences, tried one by one: at most two inserts in a row can be worth their cost."""
    inserts = [((), 0)] + [(r, 5 * len(r)) for n in (1, 2) for r in product(("user", "assistant"), repeat=n)]
    best = None
    choices = [[("D", None, 2)] if f in ("blank", "duplicate") else
               [("D", None, 2), ("K", role, 5 * (f == "truncated"))] + [("R", to, 1 + 5 * (f == "truncated")) for to in ("user", "assistant")]
               for (_, role, _), f in zip(rows, faults)]
    for edits in product(*choices):
        if best and sum(e[2] for e in edits) > best[0]:
            continue
        for gaps in product(inserts, repeat=len(rows) + 1):
            cost = sum(e[2] for e in edits) + sum(g[1] for g in gaps)
            if best and cost > best[0]:
                continue
            audit, lines = "", []
            for i, (ins, _) in enumerate(gaps):
                audit += "I" * len(ins)
                lines += [(r, "") for r in ins]
                if i < len(rows):
                    audit += edits[i][0]
                    if edits[i][0] != "D":
                        lines.append((edits[i][1], rows[i][2]))
            if GRAMMAR.fullmatch("".join(r[:1] for r, _ in lines)) and all(r for r, _ in lines) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def _brute(rows):
    out = {}
    for conv, kept in _damaged(rows).items():
        faults = _faults(kept)
        cost, audit, lines = _cheapest(kept, faults)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, fault int, dropped string, kind string"


def _rows(seed, convs, most=4):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, most)):
            rows.append((None if c == 7 else c, rng.choice([t, t, t, t, t * 3, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]),
                         rng.choice(["One.", "Two!", "Three? \n", "cut", "", None, " \t", "One.", "é.", " "])))
    return rows


def _df(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", "y") for r in rows], SCHEMA)


def test_matches_brute_force(spark):
    rows = _rows(1, 60, most=3)
    got = {r[0]: tuple(r)[1:] for r in cr.report(cr.damage(_df(spark, rows))).collect()}
    assert got == _brute(rows)


@pytest.mark.parametrize("every", [1, 3])
def test_settling_changes_nothing(spark, monkeypatch, every):
    rows = _rows(2, 25, most=3)
    for conv, kept in _damaged(rows).items():
        faults = _faults(kept)
        cost, audit, lines = _cheapest(kept, faults)
        monkeypatch.setattr(cr, "SETTLE", every)
        out = []
        repair = cr.Repair(lambda e, r, t: out.append((e, r, t)))   # noqa: B023
        for (_, role, text), f in zip(kept, faults):
            repair.row(role, text, ["", "blank", "duplicate", "truncated"].index(f))
        assert (repair.end(), "".join(e for e, _, _ in out), [(r, t) for e, r, t in out if e != "D"]) == (cost, audit, lines)


def test_equals_sql_on_long_conversations(spark, duck):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b!", "c", "", f"{t}.", f"{c}{t}?"])) for c in range(6) for t in range(700)]
    df = _df(spark, rows)
    con = duck.cursor()
    given = df.select("conv_id", "turn", "role", "text").toPandas()
    con.register("conversations", given)
    got = {r[0]: tuple(r)[1:] for r in cr.report(cr.damage(df)).collect()}
    assert got == {r[0]: r[1:] for r in con.execute(OP13_SQL).fetchall()}


def test_a_long_conversation_settles(spark):
    repair = cr.Repair(lambda *x: None)
    most = 0
    for i in range(20000):
        repair.row("user" if i % 2 == 0 else "assistant", f"{i}.", cr.FINE if i % 7 else cr.DUPLICATE)
        most = max(most, len(repair.audits.up))
    assert most < 12 * cr.SETTLE and len(repair.rows) < 2 * cr.SETTLE


def test_audits_compare_as_strings_even_when_all_hashes_collide(monkeypatch):
    rng = random.Random(3)
    for modulus in (2**61 - 1, 1, 5):
        monkeypatch.setattr(cr, "MODULUS", modulus)
        a = cr.Audits()
        nodes = [0]
        children = {}
        for _ in range(400):
            parent, letter = rng.choice(nodes[-30:]), rng.choice("DIKR")
            if (parent, letter) not in children:
                children[parent, letter] = a.add(parent, letter)
                nodes.append(children[parent, letter])
        for _ in range(3000):
            x, y = rng.choice(nodes), rng.choice(nodes)
            assert a.less(x, y) == (a.path(x) < a.path(y))
            shared = a.path(a.shared([x, y]))
            assert a.path(x).startswith(shared) and a.path(y).startswith(shared)
            n = len(shared)
            assert a.path(x)[n:n + 1] != a.path(y)[n:n + 1] or not a.path(x)[n:]


def test_repaired_rows_spell_the_digest(spark):
    rows = _rows(5, 40, most=9)
    damaged = cr.damage(_df(spark, rows))
    steps = {}
    for r in cr.repaired(damaged).orderBy("conv_id", "step").collect():
        steps.setdefault(r["conv_id"], []).append(r)
    for r in cr.report(damaged).collect():
        mine = steps.get(r["conv_id"], [])
        assert "".join(s["edit"] for s in mine) == r["audit"]
        text = "\n".join(f"{s['role']}:{s['text']}" for s in mine if s["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_all_rows_dropped_empty_table_and_far_turns(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    far = [t for t in (2**63 - 1, -(2**63), 2**63 - 2, -(2**63) + 1) if zlib.crc32(f"9:{t}".encode()) % 20]
    rows = [(5, gone, "user", "x."), *((9, t, "user", f"{t}.") for t in far)]
    got = {r["conv_id"]: r for r in cr.report(cr.damage(_df(spark, rows))).collect()}
    assert tuple(got[5])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[9]["gaps"] == min(max(far) - min(far) + 1 - len(far), 2**63 - 1)
    assert cr.report(cr.damage(_df(spark, []))).collect() == []
