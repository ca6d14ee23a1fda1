"""Operator 13 against brute force."""

import pytest

from eventlens.llm import line_dedup

SPACES = " \t\n\v\f\r"


def brute(rows, min_chars=10):
    docs = list(dict.fromkeys((i, t or "") for i, t in rows))
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    order = {d: n for n, d in enumerate(sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)))}
    seen = {}
    for d in docs:
        for line in d[1].split("\n"):
            seen.setdefault(key(line), set()).add(order[d])
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [n for n, line in enumerate(lines) if len(key(line)) >= min_chars and min(seen[key(line)]) < order[(i, t or "")]]
        out.append((i, len(lines), gone, "\n".join(line for n, line in enumerate(lines) if n not in gone)))
    return sorted(out, key=repr)


def result(df, **kw):
    return sorted(((r.doc_id, r.n_lines, list(r.dropped), r.kept_text) for r in line_dedup.remove_repeats(df, **kw).collect()), key=repr)


LONG = "\n".join(f"line number {k} of a long text" for k in range(30000))
ROWS = [
    (1, "A common first line\nown line of one"), (2, "  a COMMON first line\t\r\nown line of two\n"), (2, "  a COMMON first line\t\r\nown line of two\n"),
    (3, "short\n\nshort"), (4, "short"), (5, None), (6, ""), (7, "\n\n"), (8, "twice in here only\ntwice in here only"),
    (9, "äöüäöüäöü"), (10, "äöüäöüäöü"), (11, "äöüäöüäöüß"), (12, "äöüäöüäöüß"), (13, "  äöüäöüäöüß"),
    (None, "A common first line"), (14, LONG), (15, "top\n" + LONG), (16, "a common first line"), (17, "x\nA common first line\nx"),
    (18, "🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂"), (19, "🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂\n🙂🙂🙂🙂🙂🙂🙂🙂🙂"), (20, "🙂🙂🙂🙂🙂🙂🙂🙂🙂"),
]
SCHEMA = "doc_id long, text string, key string, gone string, segment string, h string"


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_line_dedup(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
    docs = spark.createDataFrame([(*r, "k", "g", "s", "h") for r in ROWS], SCHEMA).repartition(5)
    assert result(docs) == brute(ROWS)
    assert result(docs, min_chars=1) == brute(ROWS, 1)


def test_small_flushes_and_full_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FLUSH", 3)
    monkeypatch.setattr(line_dedup, "BITS", 1)
    docs = spark.createDataFrame([r[:2] for r in ROWS], "doc_id long, text string").repartition(3)
    assert result(docs) == brute(ROWS)


def test_one_line_in_most_documents(spark):
    rows = [(i, f"line of document {i}\nthe same licence line\n" + "\n".join(f"part {j} of {i // 3} has it" for j in range(3))) for i in range(1500)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_no_documents(odd_docs, no_docs, odd_rows):
    assert line_dedup.remove_repeats(no_docs).count() == 0
    twice = [(i, t) for i, t in odd_rows if i != 16]  # rows of one id are ordered by a hash
    assert result(odd_docs.where("doc_id is null or doc_id <> 16")) == brute(twice)


def test_filters():
    import numpy as np
    h = np.random.default_rng(1).integers(0, 1 << 63, 4000, dtype=np.uint64)
    words = np.zeros(1024, np.uint64)
    line_dedup._add(words, h[:2000])
    assert line_dedup.holds(words, h[:2000]).all() and line_dedup.holds(words, h[2000:]).mean() < 0.02
    few = np.zeros(1024, np.uint64)
    line_dedup._add(few, h[:20])
    small = line_dedup._folded(few)
    assert len(small) < 20 and line_dedup.holds(small, h[:20]).all()
