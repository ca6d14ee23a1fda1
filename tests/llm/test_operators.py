"""The ten operators on odd rows, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlens.llm import (arrays, chat, components, decontaminate, fingerprint, minhash, packing, pii, quality, shard,
                           substring_dedup, suffix_dedup)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def first_id(i):
    return -(1 << 63) if i is None else i


# ---- 1

def shingles(text, n):
    w = WORD.findall(low(text))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def test_near_duplicates(odd_docs, odd_rows):
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in
                    minhash.near_duplicates(odd_docs, 3, 85, 100).collect()))
    sets = [shingles(t, 3) for _, t in odd_rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    expected = []
    for k, (i, _) in enumerate(odd_rows):
        own = [odd_rows[j][0] for j in range(len(sets)) if root(j) == root(k) and odd_rows[j][0] is not None]
        expected.append((i is None, i or 0, len(sets[k]), (min(own) if own else None) if sets[k] else i))
    assert found == sorted(expected, key=lambda r: (r[0], r[1], r[2], r[3]))


def test_keep_one_leaves_one_row_of_each_group(odd_docs, no_docs):
    kept = minhash.keep_one(odd_docs, 3, 85, 100)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and 7 in ids and 8 not in ids
    assert ids.count(16) == 2 and 4 in ids and 5 in ids
    assert minhash.keep_one(no_docs).count() == 0 and minhash.near_duplicates(no_docs).count() == 0


def test_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 4)
    words = [f"v{k}" for k in range(80)]
    rows = [(i, " ".join(words[:i % 20] + [f"edit{i}"] + words[i % 20 + 1:])) for i in range(40)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85, 100).collect()
    assert {r.component_id for r in got} == {0}


def test_odd_sketch_counts_differing_samples():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 32, (120, 1), dtype=np.uint32)
    b = a.copy()
    b[:12] += 1
    x = np.bitwise_count(minhash.odd_sketches(a) ^ minhash.odd_sketches(b)).sum()
    assert 12 <= x <= 24 and x <= minhash.sketch_limit(0.85, 120, minhash.SKETCH_BITS)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (200, 201), (200, 201)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(31)}, **{100 + k: 100 for k in range(40)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 2

@pytest.mark.parametrize("width,check", [(20, 0), (3, 4)])
def test_repeated_windows(odd_docs, odd_rows, width, check):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text)
                 for r in substring_dedup.remove_repeats(odd_docs, width, check).collect())
    distinct = sorted(set(odd_rows), key=lambda r: first_id(r[0]))
    seen, out = {}, {}
    for i, t in distinct:
        if i == 16:
            continue
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if seen.setdefault(tuple(w[p:p + width]), (i, p)) != (i, p):
                gone[p:p + width] = [True] * width
        out[i, t] = (i is None, i or 0, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    assert [r for r in got if r[1] != 16] == sorted(out[r] for r in odd_rows if r[0] != 16)


def test_repeated_rows_are_one_document(spark):
    text = [" ".join(f"{c}{k}" for k in range(30)) for c in "abc"]
    rows = [(5, text[0]), (4, text[1]), (5, text[0]), (6, text[0] + " end"), (7, text[2]), (7, text[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id, r.kept_text) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == [(4, text[1]), (5, text[0]), (5, text[0]), (6, "end"), (7, text[2]), (7, text[2])]


def test_rows_of_one_id_keep_the_first_by_text_hash(spark):
    same = " ".join(f"s{k}" for k in range(25))
    for rows in ([(1, same + " x"), (1, same + " y")], [(1, same + " y"), (1, same + " x")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        first = docs.orderBy(F.shiftright(F.xxhash64("text"), 32).cast("int")).first().text
        got = sorted(r.kept_text for r in substring_dedup.remove_repeats(docs).collect())
        assert got == sorted([first, "y" if first.endswith("x") else "x"])


def test_windows_of_a_hot_phrase_meet_in_many_buckets(spark, monkeypatch):
    phrase = " ".join(f"licence{k}" for k in range(18))
    rows = [(k, f"a{k} b{k} c{k} {phrase} d{k} e{k} f{k}") for k in range(400)] + [(900, f"c7 {phrase} d7 z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = substring_dedup._blocks(substring_dedup.keyed(docs), 20, 0, 8)
    n = [r.n for r in blocks.groupBy("bucket").agg(F.sum(F.length("hashes") / 8).alias("n")).collect()]
    assert len(n) == 8 and max(n) < sum(n) / 4
    got = sorted(map(str, substring_dedup.remove_repeats(docs).collect()))
    assert [r.kept_text for r in substring_dedup.remove_repeats(docs).where("doc_id = 900").collect()] == ["z"]
    monkeypatch.setattr(substring_dedup, "hot_minimizers", lambda *a: np.zeros(0, np.uint64))
    assert sorted(map(str, substring_dedup.remove_repeats(docs).collect())) == got
    together = [r.n for r in substring_dedup._blocks(substring_dedup.keyed(docs), 20, 0, 8).groupBy("bucket")
                .agg(F.sum(F.length("hashes") / 8).alias("n")).collect()]
    assert max(together) > sum(together) / 3


def test_repeated_windows_of_no_rows(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0


# ---- 3

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def fine(kind, m):
        digits = [int(c) for c in m if c.isascii() and c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            twice = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
        return kind != "phone" or 10 <= len(digits) <= 15
    spans = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if fine(k, m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


TRICKY = ["a@b@c.d.e_f@g.h é x@a.b_c@d.e", "1.2.3.4.5.6.7.8 0001.2.3.255 256.1.1.1", "🙂 378282246310005, 4111-1111 1111 1111",
          "+1234567890123456 +12 345 +1 (017) 555-7713.", "a" * 30000 + " " + "1." * 3000, "a.b.c@d.e" * 500, "4111 1111 1111 1111 " * 50]


def test_base_entities(spark, odd_docs, odd_rows):
    rows = spark.createDataFrame(list(enumerate(TRICKY, 100)), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    got = sorted((r.doc_id or 0, r.b) for r in pii.entities(rows).select("doc_id", pii.listed(F.col("base")).alias("b")).collect())
    assert got == sorted([(i, base_spans(t)) for i, t in enumerate(TRICKY, 100)] + [(i or 0, base_spans(t)) for i, t in odd_rows])


def test_text_full_of_personal_data(spark):
    """Thousands of entities in one text: the work grows with the text."""
    text = " ".join(f"word u{k}@ex.org say {k}7{k}33 at 10.0.{k % 256}.{k % 300}" for k in range(3000))
    found = pii.entities(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    got = found.select(F.size("base").alias("n"), pii.listed(F.col("base")).alias("b")).first()
    assert got.n > 5000 and got.b == base_spans(text)


def test_patterns_of_seeds_find_unseen_identifiers(spark, no_docs):
    rows = [(k, f"my badge number is +1 (017) 555-77{k}3 ok") for k in range(5)]
    rows += [(10, "my badge number is QX-99812 ok"), (11, "page number 99812 ok"), (12, "my badge number is 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.entities(docs).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    assert got[10] == "phone:19:27" and got[11] == got[12] == "" and got[0] == "phone:19:36"
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()}[10] == "my badge number is [PHONE] ok"
    assert pii.entities(no_docs).count() == 0 and pii.redact(no_docs).columns == no_docs.columns


def test_seeds_without_digits_and_identifiers_in_groups(spark):
    names = ["jane.doe", "ann", "bob-b", "carla"]
    rows = [(k, f"please write to {n}@example.org soon") for k, n in enumerate(names)]
    rows += [(10 + k, f"dial me at +1 (017) 555-77{k}3 ok") for k in range(4)] + [(20 + k, f"paid with card {c} ok") for k, c in enumerate(
        ["4111 1111 1111 1111", "5500 0000 0000 0004", "378282246310005"])]
    rows += [(30, "please write to user99812 soon"), (31, "dial me at 555 123 4567, ok"), (32, "dial me at (555) 123 - 4567 ok"),
             (33, "paid with card 4111 1111 1111 1112 ok"), (34, "page 555 123 4567 ok"), (35, "dial me at 555\n123 4567"),
             (36, "see a@b.org,d@e.org and 1 2"), (37, "dial me at " + "12345 " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.entities(docs).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    assert got[30] == "email:16:25" and got[31] == "phone:11:24" and got[32] == "phone:11:27" and got[33] == "card:15:34"
    assert got[34] == got[35] == "" and got[36] == "email:4:11,email:12:19" and got[37] == "phone:11:28"
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()}[32] == "dial me at [PHONE] ok"


def test_redaction_keeps_rows_and_columns(odd_docs):
    out = pii.redact(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[13] == "mail [EMAIL] or [PHONE], card [CARD], ip [IP] and 10.0.0.256" and text[4] is None


# ---- 4

def test_chat_folds_events_and_reads_back(spark):
    rows = [(1, 1, "message", 1, "user", "hi"), (1, 2, "delta", 2, "assistant", "a"), (1, 3, "delta", 2, None, "b"),
            (1, 4, "message", 3, "user", "q"), (1, 5, "regenerate", 2, "assistant", ""),
            (1, 6, "delta", 2, None, "zz### </turn>\\b: \\h"), (1, 7, "edit", 1, None, "hello"), (2, None, None, None, None, None),
            (3, 1, "message", 1, "us: er", "### ###### \n</turn>\n</turn>")]
    events = spark.createDataFrame(rows, "conv_id long, seq long, op string, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.render(events)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "hello"), ("assistant", "zz### </turn>\\b: \\h")]
    assert got[1].loss_text == "zz### </turn>\\b: \\h" and got[2].n_turns == 1 and got[2].loss_text == ""
    assert [tuple(t) for t in got[3].turns] == [("us: er", "### ###### \n</turn>\n</turn>")]
    assert chat.render(events.limit(0)).count() == 0


def test_chat_keeps_repeated_rows_as_turns(spark):
    rows = [(5, 0, "user", "a"), (5, 0, "user", "a"), (5, None, "assistant", None), (None, 1, "assistant", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.render(chat.conversation_events(table))).collect()}
    assert got == {5: [("assistant", ""), ("user", "a"), ("user", "a")], None: [("assistant", "b")]}


def folded(events):
    """Event log -> {conv_id: [(role, text)]}, one event at a time."""
    out = {}
    for e in sorted(events, key=lambda e: (repr(e.conv_id), e.seq)):
        turns = out.setdefault(e.conv_id, {})
        if e.op == "regenerate":
            for t in [t for t in turns if t >= e.turn]:
                del turns[t]
        role, text = turns.get(e.turn, (None, ""))
        turns[e.turn] = (e.role if e.role is not None else role, text + e.text if e.op == "delta" else e.text)
    return {c: [(r or "", x) for _, (r, x) in sorted(t.items())] for c, t in out.items()}


def test_derived_log_folds_back_to_the_table(spark):
    texts = ["", None, "short", "x" * 23, "y" * 24, "Ünï 🙂 " * 50, "\\### Assistant: </turn> ok", "long text " * 2000]
    rows = [(c, t, ("user", "assistant", "system", "assistant", None)[(c + t) % 5], texts[(c * 3 + t) % len(texts)], "x", "y")
            for c in range(12) for t in range(c)] + [(None, 0, "assistant", "of no conversation", "x", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string, op string")
    events = chat.conversation_events(table)
    log = events.collect()
    assert {e.op for e in log} == {"message", "delta", "edit", "regenerate"}
    expected = {}
    for c, t, role, text, *_ in sorted(rows, key=lambda r: (repr(r[0]), r[1])):
        expected.setdefault(c, []).append((role or "", text or ""))
    assert folded(log) == expected
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.render(events)).collect()}
    assert got == expected
    # without any one of its rules the fold gives other turns
    plain = lambda op: events.withColumn("op", F.when(F.col("op") == op, "message").otherwise(F.col("op")))
    for off in (plain("delta"), plain("regenerate"), events.where("op <> 'edit'")):
        assert {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.render(off)).collect()} != expected


# ---- 5

def test_edits_and_likeness(odd_docs, odd_rows, no_docs):
    rows = sorted(odd_rows, key=lambda r: first_id(r[0]))
    got = fingerprint.fingerprint_edits(odd_docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for k, (i, t) in enumerate(rows):
        if i in (None, 2, 16) or rows[(k + 1) % len(rows)][0] in (None, 2, 16):
            continue
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 4] + n[:len(t) // 4]
        assert (by[i].n_chars, by[i].edited) == (len(t), edited)
        assert (by[i].fingerprint == by[i].edited_fingerprint) == (t == edited)
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1.0 and by[10].near_edited > 0.5
    assert fingerprint.fingerprint_edits(no_docs).count() == 0


def test_span_hashes_and_common_extensions():
    a = b"the quick brown fox jumps|the quick brown cat jumps"
    p = fingerprint.Prefixes(np.frombuffer(a, np.uint8))
    i, j = np.array([0, 20]), np.array([26, 46])
    assert p.spans(i[:1], i[:1] + 16).tolist() == p.spans(j[:1], j[:1] + 16).tolist()
    assert p.common_extension(i, j, np.array([25, 5])).tolist() == [16, 5]


# ---- 6

def test_contamination(spark, odd_docs, odd_rows, no_docs):
    item = " ".join(f"w{k}x" for k in range(20, 40))
    items = [(1, item.upper()), (1, item), (2, "One"), (3, None), (4, "..."), (None, "ünï ÇÖDÉ"), (21, "tok5q5 tok6q6, tok7q7")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = word.findall(low(t))
        for p in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[p:p + 13]), set()).add("" if i is None else str(i))
    expected = []
    for i, t in odd_rows:
        w, names = word.findall(low(t)), set()
        hit = [0] * len(w)
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in windows:
                    hit[p:p + n] = [1] * n
                    names |= windows[tuple(w[p:p + n])]
        expected.append((i or 0, len(w), sum(hit), sorted(names), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    got = [(r.doc_id or 0, r.n_words, sum(h.end - h.start for h in r.hits), r["items"], r.contaminated)
           for r in decontaminate.contamination(odd_docs, bench).collect()]
    assert sorted(got) == sorted(expected)
    clean = decontaminate.clean(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == sum(not r[4] for r in expected)
    assert decontaminate.clean(odd_docs, bench.limit(0)).count() == len(odd_rows)
    assert decontaminate.contamination(no_docs, bench).count() == 0
    left = {r.doc_id: r.text for r in decontaminate.without_hits(odd_docs, bench).collect()}
    assert left[7] == "" and left[9] == "two" and left[5] == ""


def test_many_benchmark_blocks_give_the_same(odd_docs, spark, monkeypatch):
    rows = [(k, f"w{k}x w{k + 1}x") for k in range(30)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    one = sorted(map(str, decontaminate.contamination(odd_docs, bench).collect()))
    kept = sorted(map(str, decontaminate.clean(odd_docs, bench).collect()))
    cut = sorted(map(str, decontaminate.without_hits(odd_docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 64)
    groups, each = decontaminate.block_groups(bench, 13)
    assert groups >= 3 and sum(len(g) for g in each) >= 5
    assert sorted(map(str, decontaminate.contamination(odd_docs, bench).collect())) == one
    assert sorted(map(str, decontaminate.clean(odd_docs, bench).collect())) == kept
    assert sorted(map(str, decontaminate.without_hits(odd_docs, bench).collect())) == cut


def test_clean_keeps_clashing_columns(spark):
    rows = [(1, "a b c", "t", [1], "h"), (1, "a b c", "t", [1], "h"), (2, "one two three four", "t", None, "h"), (None, None, None, [2], "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string, items array<int>, `n.words` string")
    bench = spark.createDataFrame([(1, "two three", "x", "y")], "item_id long, text string, item string, block string")
    assert sorted(map(str, decontaminate.clean(docs, bench).collect())) == sorted(map(str, docs.where("doc_id is null or doc_id = 1").collect()))
    assert [r.text for r in decontaminate.without_hits(docs, bench).where("doc_id = 2").collect()] == ["one four"]


def test_a_worker_keeps_windows_of_one_group(monkeypatch):
    class Shared:
        value = (["i"], ["some words here"])
    monkeypatch.setattr(decontaminate, "_BUILT", {})
    blocks = [decontaminate._Block(Shared(), 13) for _ in range(5)]
    first = blocks[0].windows()
    assert blocks[0].windows() is first
    for b in blocks:
        b.windows()
    assert len(decontaminate._BUILT) == decontaminate.GROUP


# ---- 7

def test_quality_is_learnt_and_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows]) > 0.95


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (10, 0), (None, 1), (2, None)], "doc_id long, quality int")
    w = quality.fit(odd_docs, labels)
    got = quality.score(odd_docs, w).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.accepted(odd_docs, w, 0.0).columns == odd_docs.columns
    flat = quality.fit(odd_docs, labels.limit(0))
    assert {r.score for r in quality.score(odd_docs, flat).collect()} == {0.5}
    assert quality.score(no_docs, w).count() == 0 and quality.fit(no_docs, labels).any() == False  # noqa: E712


def test_a_small_share_of_labels_is_still_drawn(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    with pytest.raises(ValueError):
        quality.fit(docs, labels, max_rows=0)
    # as many labels as would make the share less than 2**-20
    many = spark.range(8_000_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    every = many.select("doc_id", F.lit("good").alias("text"))
    assert quality.fit(every, many, max_rows=5).any()


def test_repeated_labelled_rows_are_learnt_once(spark):
    docs = spark.createDataFrame([(k, f"text {k} good" if k % 2 else f"bad {k} words") for k in range(40)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    again = docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id < 9"))
    assert (quality.fit(again, labels) == quality.fit(docs, labels)).all()


# ---- 8

@pytest.mark.parametrize("n", [1, 2, 3, 17, 100, 1000])
def test_permutation(spark, n):
    assert sorted(r[0] for r in spark.range(n).select(shard.permuted(F.col("id"), n, 5)).collect()) == list(range(n))


def test_shards(odd_docs, odd_rows, no_docs):
    got = shard.shards(odd_docs, 4).collect()
    assert sorted((r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    slots = [sorted(r.slot for r in got if r.shard == s) for s in range(4)]
    assert all(s == list(range(len(s))) for s in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1
    assert sorted(map(tuple, shard.shards(odd_docs.repartition(5), 4).select("doc_id", "text_crc32", "shard", "slot").where("doc_id is not null and doc_id <> 2").collect())) == \
        sorted((r.doc_id, r.text_crc32, r.shard, r.slot) for r in got if r.doc_id not in (None, 2))
    assert shard.shards(no_docs).count() == 0


# ---- 9

@pytest.mark.parametrize("width", [50, 30])
def test_bytes_repeated_from_smaller_documents(odd_docs, odd_rows, width):
    rows = [r for r in odd_rows]
    seen = {}
    for i, t in sorted(set(rows), key=lambda r: first_id(r[0])):
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            seen.setdefault(b[p:p + width], first_id(i))
    expected = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if seen[b[p:p + width]] < first_id(i):
                gone[p:p + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        expected.append((i or 0, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = [(r.doc_id or 0, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in suffix_dedup.remove_repeats(odd_docs, width).collect()]
    assert sorted(got) == sorted(expected)


def test_suffix_dedup_of_no_rows(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_prefix_intervals_and_maximal_repeats():
    texts = [b"xabcabd", b"yabcabe", b"zabc"]
    groups = {(n, tuple(sorted(zip(t.tolist(), o.tolist())))) for n, t, o in suffix_dedup.maximal_repeats(texts, np.full(3, -1), 3)}
    assert groups == {(3, ((0, 1), (1, 1), (2, 1))), (5, ((0, 1), (1, 1)))}


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(2)
    for letters, n in ((b"ab", 40), (b"a", 30), (b"\0a", 60), (b"abcdefgh", 90)):
        texts = [bytes(rng.choice(list(letters), rng.integers(0, n)).astype(np.uint8)) for _ in range(12)] + [b"", letters * 9, letters * 9]
        text, offset, lcp = suffix_dedup.suffix_array(texts, 3)
        got = [texts[t][o:] for t, o in zip(text, offset)]
        assert got == sorted(got) and len(got) == sum(max(0, len(t) - 2) for t in texts)
        for i in range(1, len(got)):
            same = next((k for k, (x, y) in enumerate(zip(got[i - 1], got[i])) if x != y), min(len(got[i - 1]), len(got[i])))
            assert lcp[i] == same


def plain_groups(texts, before, width):
    """{(length, places): left extensions differ} by looking at every string."""
    where = {}
    for t, x in enumerate(texts):
        for o in range(len(x)):
            for e in range(o + width, len(x) + 1):
                where.setdefault(x[o:e], []).append((t, o))
    out = {}
    for s, places in where.items():
        after = [texts[t][o + len(s)] if o + len(s) < len(texts[t]) else None for t, o in places]
        if len(places) < 2 or (None not in after and len(set(after)) == 1):
            continue
        left = {texts[t][o - 1] if o else before[t] for t, o in places}
        differ = len(left) > 1 or suffix_dedup.DIFFER in left
        if differ or any(o == 0 for _, o in places):
            out[(len(s), tuple(sorted(places)))] = differ
    return out


def test_repeat_groups_against_all_strings():
    rng = np.random.default_rng(8)
    for trial in range(30):
        texts = [bytes(rng.choice(list(b"ab"), rng.integers(1, 12)).astype(np.uint8)) for _ in range(4)] + [b"abba"]
        for before in ([-1] * 5, [81] * 5, [81, 81, 82, -1, 81], rng.integers(97, 99, 5).tolist()):
            found = {(n, tuple(sorted(zip(t.tolist(), o.tolist())))): d for n, t, o, d in suffix_dedup.repeat_groups(texts, before, 3)}
            assert found == plain_groups(texts, before, 3)
            most = {(n, tuple(sorted(zip(t.tolist(), o.tolist())))) for n, t, o in suffix_dedup.maximal_repeats(texts, before, 3)}
            assert most == {k for k, d in found.items() if d}


def test_one_byte_in_front_of_a_common_start_is_no_maximal_repeat():
    texts = [b"commonstart1", b"commonstart2", b"commonstart3"]
    assert len(list(suffix_dedup.maximal_repeats(texts, [-1] * 3, 5))) == 1
    assert list(suffix_dedup.maximal_repeats(texts, [ord("Q")] * 3, 5)) == []
    assert [g[3] for g in suffix_dedup.repeat_groups(texts, [ord("Q")] * 3, 5)] == [False]


def test_spans_of_chunks_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = ["alpha ", "beta ", "gamma ", "delta and ", "x"]
    rows = [(int(rng.integers(0, 60)), "".join(rng.choice(words, 60))) for _ in range(90)]
    rows += [(100 + k, rows[k][1][:150] + rows[k + 1][1][100:]) for k in range(60)]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 50)
    seen = {}
    for i, t in sorted(rows):
        for p in range(len(t) - 49):
            seen.setdefault(t[p:p + 50], i)
    expected = []
    for i, t in rows:
        gone = [False] * len(t)
        for p in range(len(t) - 49):
            if seen[t[p:p + 50]] < i:
                gone[p:p + 50] = [True] * 50
        expected.append((i, "".join(x for x, g in zip(t, gone) if not g)))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, bytes(r.kept).decode()) for r in got) == sorted(expected)


def test_hot_minimizers_travel_singly(spark, monkeypatch):
    passage = "The same passage is in each of these documents, with other words on both sides. " * 2
    rows = [(k, f"{k * 7919} {passage}{k * 104729} and more") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = sorted(map(str, suffix_dedup.remove_repeats(docs).collect()))
    every = suffix_dedup.segments(np.frombuffer(passage.encode(), np.uint8), np.array([0, len(passage)]), 50)[0]
    monkeypatch.setattr(suffix_dedup, "hot_minimizers", lambda *a: np.unique(every))
    assert sorted(map(str, suffix_dedup.remove_repeats(docs).collect())) == plain


# ---- 10

def test_packing_is_whole_and_tight(odd_docs, odd_rows, no_docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    rows = packing.pack(odd_docs, capacity=256, windows=8).collect()
    docs = {}
    for r in rows:
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for i, t in odd_rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        pieces = sorted(docs[i, len(ids)], key=lambda r: r.start)
        if i != 2:
            assert [x for r in pieces for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == np.cumsum([0] + [n for _, n in w[:-1]]).tolist() and sum(n for _, n in w) <= 256
    assert packing.pack(no_docs).count() == 0


def test_full_windows_of_long_documents_are_not_held(spark):
    text = " ".join(f"word{k % 50}" for k in range(3000))
    docs = spark.createDataFrame([(k, text) for k in range(40)], "doc_id long, text string").coalesce(1)
    rows = docs.mapInArrow(lambda bs: packing._pack(None, 64, 16, packing.END_ID)(bs), packing.FIELDS).collect()
    docs_of = {}
    for r in rows:
        docs_of.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for parts in docs_of.values():
        parts.sort()
        assert [s for s, _, _ in parts] == np.cumsum([0] + [n for _, n, _ in parts[:-1]]).tolist() and sum(n for _, n, _ in parts) == parts[0][2]
    windows = {}
    for r in rows:
        windows[r.sequence_id] = windows.get(r.sequence_id, 0) + r.length
    assert len(docs_of) == 40 and max(windows.values()) <= 64
    sizes = docs.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in packing._pack(None, 64, 16, packing.END_ID)(bs)), "n long")
    assert max(r.n for r in sizes.collect()) <= 100


def test_units_keep_the_tokenizer_s_ids():
    from tokenizers import Tokenizer
    path = packing.public_tokenizer()
    tokenizer, tokens = Tokenizer.from_file(path), packing.WordTokens(path)
    texts = ["it's don't I'LL x'sy 's ''s", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> c|>d", "é é ́a á!", "“hi”, naïve—yes! x×y 5é5",
             "1234abc567 $$$a%%%B ##", "\x00a\x1fb \x7f", "a b c ­", "ÀÉÎ Straße, ñandú.", "漢字 🙂🙂x", "İstanbul ΣΑΣ ς", "", " ", "ﬁne ½ ² ªº"]
    for _ in range(2):  # the second time from memory
        for i, j, buf, off in arrays.pieces(pa.array(texts)):
            ids, bounds = tokens(buf, off)
            for r in range(i, j):
                assert ids[bounds[r - i]:bounds[r - i + 1]].tolist() == tokenizer.encode(texts[r], add_special_tokens=False).ids


def test_differencing_balances():
    sizes = np.random.default_rng(1).integers(1, 200, 300)
    load, windows = packing.differencing(sizes, 16)
    assert sorted(k for w in windows for k in w) == list(range(300))
    assert sorted(sum(sizes[k] for k in w) for w in windows) == sorted(load.tolist()) and load.max() - load.min() <= 2


def test_blocks_of_very_short_texts_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 2000)
    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    n = 30000
    batch = pa.record_batch({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array([None, "", "a"] * (n // 3))})
    out = list(packing._pack(None, 512, 512, 2)([batch]))
    rows = [r for b in out for r in b.to_pylist()]
    assert max(b.num_rows for b in out) <= 4000 and sorted(r["doc_id"] for r in rows) == list(range(n))
    load = {}
    for r in rows:
        load[r["sequence_id"]] = load.get(r["sequence_id"], 0) + r["length"]
    assert max(load.values()) <= 512 and sum(load.values()) > 0.97 * 512 * len(load)



def test_quality_weights_against_a_plain_loop():
    """Ftrl and scores against the formulas, one coordinate at a time."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["good", "text", "buy", "now", "Read", "more", "x1", "漢字"], rng.integers(0, 30))) for _ in range(60)]
    labels = [int("good" in t) for t in texts]
    buf, off = arrays.text_buffer(pa.array(texts))
    kinds = quality.features(buf, off)
    rows = []
    for r, y in enumerate(labels):
        x = {1 << quality.BITS: 1.0}
        for idx, bounds in kinds:
            own = idx[bounds[r]:bounds[r + 1]].tolist()
            for i in own:
                x[i] = x.get(i, 0.0) + quality.SCALE / len(own)
        rows.append((x, y))
    model, z, n = quality.Ftrl((1 << quality.BITS) + 1), {}, {}

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        if abs(zi) <= quality.L1:
            return 0.0
        return -(zi - (quality.L1 if zi > 0 else -quality.L1)) / ((quality.BETA + ni ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(3):
        for x, y in rows:
            at = np.array(sorted(x))
            model.learn(at, np.array([x[i] for i in sorted(x)]), y)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / quality.ALPHA
                z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
    learnt = model.weights()
    assert np.allclose(learnt[sorted(z)], [weight(i) for i in sorted(z)], atol=1e-9) and np.count_nonzero(learnt) > 5
    plain = [1 / (1 + np.exp(-sum(weight(i) * v for i, v in x.items()))) for x, _ in rows]
    assert np.allclose(quality.scores(pa.array(texts), learnt), plain, atol=1e-9)
    assert np.mean([(p >= 0.5) == y for p, (_, y) in zip(plain, rows)]) > 0.9
