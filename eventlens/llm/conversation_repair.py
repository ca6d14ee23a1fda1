"""Operator 12: cheapest repair of conversations, with an audit of its edits.

Rows of a conversation, by turn, are edited until their role initials read
``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert
of an empty user or assistant text 3; a truncated row that is not deleted adds
3; blank rows and duplicates must be deleted.  The audit is the initials of the
cheapest edits in order; among equal costs the ASCII-least one.  It says which
role every R and I stands for, since the initials alternate.

The dynamic program goes over the four states of the pattern.  Edit prefixes are
linked nodes that share their parents (:class:`Prefixes`): each has binary-lifting
ancestors and a rolling hash of its letters.  Two prefixes of one cost are
compared at the end of their longest common prefix, found by binary search on
hashes; equal hashes are verified on the letters.

A conversation may hold a third of all rows, so it is cut into segments of at
most ``2**SEGMENT_BITS`` rows of the range-partitioned table.  A segment gives
the cheapest edits for each state before and after it; a conversation's task
then links one piece a segment, with the same program and nodes.  Rows meet
their edits by row number, each at its own place.

Cases.  Null role or text: one space.  Null turns: before the others.  Equal
turns: by role, then text.  Rows of a null conv_id are one conversation.  A role
counts by its first character; an empty one fits no place.  No rows: none.
Extra columns are ignored.  A text is held by its row only; one conversation's
classes and audit (a few bytes a row) are held by one task, and its repaired
texts pass through the task that hashes them, in order, as SHA-256 asks.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlens.llm import arrays as A
from eventlens.llm.spill import shuffle_parts, written

SEGMENT_BITS = 10
#: class strings of so many rows are remembered by a worker
SHORT = 32
BLANKS = " \t\n\v\f\r"
#: costs of the edits, and of a truncated row that stays
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: a row's class is chr(65 + initial + 4 * fault)
INITIALS, FAULTS = "sua", ("", "truncated", "blank", "duplicate")
#: states: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {(0, 1), (1, 2), (2, 1)}
_MOD, _BASE = (1 << 61) - 1, 0x1D0F4C9A2B73


class Prefixes:
    """Edit prefixes: node 0 is empty, every other its parent and a piece."""

    def __init__(self):
        self.parent, self.piece, self.depth, self.hash, self.up = [0], [""], [0], [0], [[0]]

    def add(self, node: int, piece: str) -> int:
        new, ups, j = len(self.parent), [node], 0
        while ups[j]:  # the 2**(j + 1)-th ancestor
            above = self.up[ups[j]]
            ups.append(above[j] if j < len(above) else 0)
            j += 1
        self.parent.append(node)
        self.piece.append(piece)
        self.depth.append(self.depth[node] + len(piece))
        self.hash.append(self.extended(self.hash[node], piece))
        self.up.append(ups)
        return new

    @staticmethod
    def extended(h: int, piece: str) -> int:
        for c in piece:
            h = (h * _BASE + ord(c)) % _MOD
        return h

    def holder(self, node: int, n: int) -> int:
        """The ancestor in whose piece the n-th letter lies."""
        for j in range(len(self.up[node]) - 1, -1, -1):
            if j < len(self.up[node]) and self.depth[self.up[node][j]] >= n > 0:
                node = self.up[node][j]
        return node if n else 0

    def hash_of(self, node: int, n: int) -> int:
        """Hash of the first n letters."""
        node = self.holder(node, n)
        above = self.parent[node]
        return self.extended(self.hash[above], self.piece[node][:n - self.depth[above]])

    def letter(self, node: int, n: int) -> str:
        node = self.holder(node, n + 1)
        return self.piece[node][n - self.depth[self.parent[node]]]

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        low, high = 0, min(self.depth[a], self.depth[b])
        while low < high:
            mid = (low + high + 1) // 2
            if self.hash_of(a, mid) == self.hash_of(b, mid):
                low = mid
            else:
                high = mid - 1
        return self.verified(a, b, low)

    def verified(self, a: int, b: int, n: int) -> int:
        """``n``, or less where letters differ whose hashes are equal."""
        x, y, left, right = self.holder(a, n), self.holder(b, n), [], []
        while x != y:
            if self.depth[x] >= self.depth[y]:
                left.append(self.piece[x])
                x = self.parent[x]
            else:
                right.append(self.piece[y])
                y = self.parent[y]
        at = self.depth[x]
        if at >= n:
            return n
        s, t = "".join(reversed(left))[:n - at], "".join(reversed(right))[:n - at]
        return n if s == t else at + next(i for i, (p, q) in enumerate(zip(s, t)) if p != q)

    def before(self, a: int, b: int) -> bool:
        """Whether a's letters are ASCII-less than b's."""
        n = self.common(a, b)
        if n == self.depth[a] or n == self.depth[b]:
            return self.depth[a] < self.depth[b]
        return self.letter(a, n) < self.letter(b, n)

    def text(self, node: int) -> str:
        return "".join(reversed([self.piece[n] for n in self.line(node)]))

    def line(self, node: int):
        """The node and its ancestors, without the empty one."""
        while node:
            yield node
            node = self.parent[node]


def _offer(prefixes, best, state, cost, node, piece):
    """Take the longer prefix for ``state`` if it is cheaper, or as cheap and
    ASCII-less; whether it was taken."""
    old = best.get(state)
    if old is not None and cost > old[0]:
        return False
    new = prefixes.add(node, piece)
    if old is not None and cost == old[0] and not prefixes.before(new, old[1]):
        return False
    best[state] = (cost, new)
    return True


def _inserted(prefixes, best):
    """``best`` with any inserts before the next row."""
    best, todo = dict(best), sorted(best, key=lambda s: best[s][0])
    while todo:
        state = todo.pop(0)
        cost, node = best[state]
        if _offer(prefixes, best, NEXT[state], cost + INSERT, node, "I"):
            todo.append(NEXT[state])
    return best


def _after_row(prefixes, best, kind):
    initial, fault = kind % 4, kind // 4
    out = {}
    for state, (cost, node) in _inserted(prefixes, best).items():
        _offer(prefixes, out, state, cost + DELETE, node, "D")
        if fault < 2:
            stay = cost + TRUNCATED * fault
            _offer(prefixes, out, NEXT[state], stay + REROLE, node, "R")
            if state == START and initial == 0:
                _offer(prefixes, out, SYSTEM, stay, node, "K")
            elif initial == (2 if state == USER else 1):
                _offer(prefixes, out, NEXT[state], stay, node, "K")
    return out


def transfers(classes: str) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) over a run of rows."""
    found = []
    for start in range(4):
        prefixes = Prefixes()
        best = {start: (0, 0)}
        for c in classes:
            best = _after_row(prefixes, best, ord(c) - 65)
        found += [(start, end, cost, prefixes.text(node)) for end, (cost, node) in sorted(best.items())]
    return found


_remembered = functools.lru_cache(maxsize=1 << 14)(transfers)


class Conversation:
    """Links a conversation's segments, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.prefixes, self.best, self.about = conv_id, Prefixes(), {START: (0, 0)}, {}
        self.faults, self.illegal, self.last = [0, 0, 0, 0], 0, None
        self.low = self.high = None
        self.turns, self.end, self.tidy = 0, 0, 64

    def add(self, row):
        classes = row["classes"]
        if classes:
            kinds = [ord(c) - 65 for c in classes]
            for kind in kinds:
                self.faults[kind // 4] += 1
                if self.last is not None and (self.last, kind % 4) not in LEGAL:
                    self.illegal += 1
                self.last = kind % 4
            if row["low"] is not None:
                self.turns += row["turns"] - (self.high == row["low"])
                self.low = row["low"] if self.low is None else self.low
                self.high = row["high"]
            out = {}
            for t in row["transfers"]:
                if t["before"] in self.best:
                    cost, node = self.best[t["before"]]
                    if _offer(self.prefixes, out, t["after"], cost + t["cost"], node, t["edits"]):
                        self.about[out[t["after"]][1]] = (row["first"], t["before"], classes)
            self.best = out
            if len(self.about) >= self.tidy:
                live = {n for _, node in out.values() for n in self.prefixes.line(node)}
                self.about = {n: v for n, v in self.about.items() if n in live}
                self.tidy = max(64, 2 * len(self.about))
            self.end = row["first"] + len(classes)

    def result(self):
        best = _inserted(self.prefixes, self.best)
        node = None
        for state in (START, ASSISTANT):
            if state in best and (node is None or best[state][0] < cost or (
                    best[state][0] == cost and self.prefixes.before(best[state][1], node))):
                cost, node = best[state]
        path, state = [], START
        for n in reversed(list(self.prefixes.line(node))):
            first, before, classes = self.about.get(n, (self.end, None, ""))
            path.append({"first": first, "before": state if before is None else before, "classes": classes, "edits": self.prefixes.piece[n]})
            state = _end_state(path[-1])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.faults[2], self.faults[3], self.faults[1], self.illegal, cost, self.prefixes.text(node), path)


def _walk(part):
    """(row, edit, state after) of a piece of edits; inserts come before a row."""
    state, row = part["before"], 0
    for edit in part["edits"]:
        if edit != "D":
            state = SYSTEM if edit == "K" and state == START and (ord(part["classes"][row]) - 65) % 4 == 0 else NEXT[state]
        yield row, edit, state
        row += edit != "I"


def _end_state(part):
    state = part["before"]
    for _, _, state in _walk(part):
        pass
    return state


PART = "struct<first: long, before: int, classes: string, edits: string>"
TRANSFER = "struct<before: int, after: int, cost: long, edits: string>"
AUDIT = ("conv_id {0}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
         f"path array<{PART}>")
_PART = pa.struct([("first", pa.int64()), ("before", pa.int32()), ("classes", pa.string()), ("edits", pa.string())])
_TRANSFER = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])


def _solve(batches):
    """Adds each segment's transfers."""
    for batch in batches:
        found = [[dict(zip(("before", "after", "cost", "edits"), t)) for t in (_remembered if len(c) <= SHORT else transfers)(c)]
                 for c in A.column(batch, "classes").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(_TRANSFER))],
                                         names=[*batch.schema.names, "transfers"])


def _link(batches):
    """Segments by conversation and place -> one audit a conversation."""
    now, done = None, []

    def out():
        columns = list(zip(*done))
        kinds = [id_type, *[pa.int64()] * 6, pa.string(), pa.list_(_PART)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "path"])

    for batch in batches:
        id_type = A.column(batch, "conv_id").type
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now.conv_id:
                if now is not None:
                    done.append(now.result())
                if len(done) >= 500:
                    yield out()
                    done = []
                now = Conversation(row["conv_id"])
            now.add(row)
    if now is not None:
        done.append(now.result())
        yield out()


def _steps(batches):
    """Pieces of edits -> one row for each edit: the row it edits (none for an
    insert), its place, and the role that it sets."""
    for batch in batches:
        ids = A.column(batch, "conv_id")
        owner, at, row_at, sub, op, role = [], [], [], [], [], []
        for k, part in enumerate(A.column(batch, "part").to_pylist()):
            for n, (row, edit, state) in enumerate(_walk(part)):
                owner.append(k)
                at.append(part["first"] + row)
                row_at.append(None if edit == "I" else part["first"] + row)
                sub.append(n)
                op.append(edit)
                role.append(("assistant" if state == ASSISTANT else "user") if edit in "IR" else None)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(owner, pa.int64())), pa.array(at, pa.int64()), pa.array(row_at, pa.int64()), pa.array(sub, pa.int32()),
             pa.array(op, pa.string()), pa.array(role, pa.string())], names=["conv_id", "at", "row_at", "sub", "op", "new_role"])


def _hash_rows(batches):
    """Repaired rows in order -> SHA-256 of ``role:text``, joined by \\n."""
    begun, conv_id, h, ids, digests = False, None, None, [], []
    for batch in batches:
        kind = A.column(batch, "conv_id").type
        for one, role, text in zip(*(A.column(batch, c).to_pylist() for c in ("conv_id", "role", "text"))):
            if not begun or one != conv_id:
                if begun:
                    ids.append(conv_id)
                    digests.append(h.hexdigest())
                begun, conv_id, h = True, one, hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(f"{role}:{text}".encode())
        if len(ids) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests)], names=["conv_id", "repaired_sha256"])
            ids, digests = [], []
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([*ids, conv_id], kind), pa.array([*digests, h.hexdigest()])],
                                         names=["conv_id", "repaired_sha256"])


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows damaged by crc32(``conv_id:turn``) % 20:
    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it,
    4 sets the role user.  Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"),
                             (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("_d")).where("_d <> 0")
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    d = d.withColumn("text", text).withColumn("role", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")))
    return d.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.when(F.col("_d") == 3, 2).otherwise(1)))).drop("col")


def placed(rows: DataFrame, parts: int) -> DataFrame:
    """Rows by (conv_id, turn, role, text) with their number ``at``, segment and
    class, written."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    body = F.rtrim("text", F.lit(BLANKS))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn")) > 1
    fault = F.when(body == "", 2).when(again, 3).when(~F.substring(body, -1, 1).isin(".", "!", "?"), 1).otherwise(0)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) + 4 * fault
    rows = rows.withColumn("class", F.char(F.lit(65) + code))
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("segment", F.shiftright("at", SEGMENT_BITS)), "turns")


def audits(table: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """``placed`` rows -> one row for each conversation of ``ids``: counts, cost,
    audit, and its edits by segment (``path``)."""
    kind = table.schema["conv_id"].dataType.simpleString()
    segments = table.groupBy("conv_id", "segment").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "class"))), lambda x: x["class"]), "").alias("classes"),
        F.min("at").alias("first"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"))
    columns = "conv_id {}, segment long, classes string, first long, low long, high long, turns long".format(kind)
    solved = segments.mapInArrow(_solve, f"{columns}, transfers array<{TRANSFER}>")
    every = ids.select("conv_id").distinct().withColumns({"segment": F.lit(-1).cast("long"), "classes": F.lit("")})
    linked = solved.unionByName(every, allowMissingColumns=True).repartition(parts, "conv_id").sortWithinPartitions("conv_id", "segment")
    return written(linked.mapInArrow(_link, AUDIT.format(kind)), "audits")


def edits(table: DataFrame, audit: DataFrame) -> DataFrame:
    """conv_id, at, sub, op, role, text: the edits in order (at, sub); rows that
    stay have their repaired role and text, deleted ones (``D``) their own."""
    kind = table.schema["conv_id"].dataType.simpleString()
    steps = audit.select("conv_id", F.explode("path").alias("part")).mapInArrow(
        _steps, f"conv_id {kind}, at long, row_at long, sub int, op string, new_role string")
    rows = table.select(F.col("at").alias("row_at"), "role", "text")
    inserted = steps.where("op = 'I'").select("conv_id", "at", "sub", "op", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return steps.where("op <> 'I'").join(rows, "row_at").select(
        "conv_id", "at", "sub", "op", F.coalesce("new_role", "role").alias("role"), "text").unionByName(inserted)


def repair(rows: DataFrame, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(audits, edits) of ``rows`` (conv_id, turn, role, text); ``ids`` has the
    conversations to report on (default: those of the rows)."""
    parts = shuffle_parts(rows)
    table = placed(rows, parts)
    audit = audits(table, rows if ids is None else ids, parts)
    return audit, edits(table, audit)


def hashes(edited: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the conversations that keep a row."""
    kind = edited.schema["conv_id"].dataType.simpleString()
    kept = edited.where("op <> 'D'").select("conv_id", "at", "sub", "role", "text")
    kept = kept.repartition(shuffle_parts(edited), "conv_id").sortWithinPartitions("conv_id", "at", "sub")
    return kept.mapInArrow(_hash_rows, f"conv_id {kind}, repaired_sha256 string")
