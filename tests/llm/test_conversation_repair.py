"""Operator 12 against a plain dynamic program over strings."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from eventlens.llm import conversation_repair as C

SPACES = " \t\n\v\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        d = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACES)
        out.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """(cost, letters, repaired rows) by the best prefix of each state."""
    step = {0: 2, 1: 2, 2: 3, 3: 2}
    said = lambda s: "assistant" if step[s] == 3 else "user"

    def better(best, s, new):
        if s not in best or new[:2] < best[s][:2]:
            best[s] = new
            return True

    def inserts(best):
        while any([better(best, step[s], (c + 3, a + "I", r + [(said(s), "")])) for s, (c, a, r) in list(best.items())]):
            pass
        return best

    best = {0: (0, "", [])}
    for (_, _, role, text), fault in zip(rows, kinds):
        new = {}
        for s, (c, a, r) in inserts(best).items():
            better(new, s, (c + 4, a + "D", r))
            if fault in ("", "t"):
                stay = c + 3 * (fault == "t")
                better(new, step[s], (stay + 3, a + "R", r + [(said(s), text)]))
                to = 1 if s == 0 and role[:1] == "s" else step[s] if role[:1] == said(s)[0] else None
                if to is not None:
                    better(new, to, (stay, a + "K", r + [(role, text)]))
        best = new
    best = inserts(best)
    return min(best[s] for s in (0, 3) if s in best)


def brute(rows, ids):
    out = []
    for i in ids:
        own = sorted((r for r in rows if r[0] == i), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        kinds = faults(own)
        turns = {r[1] for r in own} - {None}
        pairs = [(a[2][:1] + b[2][:1]) for a, b in zip(own, own[1:])]
        cost, audit, kept = cheapest(own, kinds)
        out.append((i, max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("b"), kinds.count("d"), kinds.count("t"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(rows, ids):
    audit, edited = C.repair(rows, ids)
    sha = {r.conv_id: r.repaired_sha256 for r in C.hashes(edited).collect()}
    assert len(sha) == C.hashes(edited).count()
    none = hashlib.sha256(b"").hexdigest()
    return sorted(((r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sha.get(r.conv_id, none))
                   for r in audit.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, at string, segment string, path string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "s", "p") for r in rows], SCHEMA).repartition(4)


def some_rows(seed, n_conv=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n_conv):
        for turn in range(rng.randint(1, 12)):
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 3, None, -turn]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "why", "é 漢?", " ", "", None, "Fine. \n", "🙂", f"own {turn}."])))
    return rows


def test_repair(spark):
    rows = some_rows(1)
    ids = sorted({r[0] for r in rows}, key=repr)
    df = frame(spark, rows)
    spread = damaged(rows)
    assert result(C.damage(df), df) == brute(spread, ids)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert result(df, df) == brute(clean, ids)


@pytest.mark.parametrize("base", [C._BASE, 1, 0])  # 1 and 0: hashes that collide
def test_long_conversation_in_small_segments(spark, monkeypatch, base):
    rng = random.Random(base % 97)
    rows = [(5, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"t {t}.", f"t {t}", "again.", ""])) for t in range(700)]
    rows += [(6, t, "user", f"only users {t}.") for t in range(150)] + [(7, 1, "system", "alone.")]
    table = C.placed(frame(spark, rows), 3).withColumn("segment", C.F.shiftright("at", 4))
    monkeypatch.setattr(C, "_BASE", base)
    got = [r for b in _local(table) for r in b]
    expected = {r[0]: r for r in brute(rows, [5, 6, 7])}
    assert {r[0] for r in got} == {5, 6, 7}
    for r in got:
        assert r[:8] == expected[r[0]][:8]


def _local(table):
    """Segments solved and linked in this process, so that hashes can be bent."""
    rows = sorted(table.select("conv_id", "segment", "at", "class", "turn").collect(), key=lambda r: (r.conv_id, r["at"]))
    groups = {}
    for r in rows:
        groups.setdefault((r.conv_id, r.segment), []).append(r)
    now = {}
    for (conv, _), own in sorted(groups.items()):
        c = now.setdefault(conv, C.Conversation(conv))
        classes = "".join(r["class"] for r in own)
        turns = [r.turn for r in own]
        c.add({"classes": classes, "first": own[0]["at"], "low": min(turns), "high": max(turns), "turns": len(set(turns)),
               "transfers": [dict(zip(("before", "after", "cost", "edits"), t)) for t in C.transfers(classes)]})
    yield [c.result() for c in now.values()]


def test_hot_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2 if t % 50 else 1], f"t {t}.") for t in range(3000)] + [(c, 0, "user", "Hi.") for c in range(2, 40)]
    df = frame(spark, rows)
    assert result(df, df) == brute(rows, sorted({r[0] for r in rows}))


def test_no_rows(spark):
    none = frame(spark, some_rows(1)).limit(0)
    assert result(none, none) == []
    df = frame(spark, [(1, None, None, None), (2, 0, "system", "x.")])
    assert result(df.limit(0), df) == brute([], [1, 2])
    assert result(df, df) == brute([(1, None, " ", " "), (2, 0, "system", "x.")], [1, 2])


def test_prefixes_compare_as_strings():
    for base in (C._BASE, 1):
        p = C.Prefixes()
        nodes = {0: ""}
        rng = random.Random(4)
        for _ in range(120):
            node = rng.choice(list(nodes))
            piece = "".join(rng.choice("DIK") for _ in range(rng.randint(1, 4)))
            nodes[p.add(node, piece)] = nodes[node] + piece
        old, C._BASE = C._BASE, base
        try:
            q = C.Prefixes()
            q.parent, q.piece, q.depth, q.up = p.parent, p.piece, p.depth, p.up
            q.hash = [q.extended(0, nodes[n]) for n in range(len(nodes))]
            for a, b in product(nodes, nodes):
                same = next((i for i, (x, y) in enumerate(zip(nodes[a], nodes[b])) if x != y), min(len(nodes[a]), len(nodes[b])))
                if base != 1:
                    assert q.common(a, b) == same and q.before(a, b) == (nodes[a] < nodes[b])
                else:
                    assert q.verified(a, b, min(len(nodes[a]), len(nodes[b]))) == same
        finally:
            C._BASE = old
