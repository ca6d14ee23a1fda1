"""Operator 10: packing token sequences by Karmarkar-Karp differencing.

Each task tokenises its documents and packs them in blocks of about ``WINDOWS``
windows; no row moves.  A document of more than a window gives full windows of
its own and a rest.  The rests of a block are dealt to ``m`` windows, ``m`` the
least number that could hold them, by multiway differencing: the two partial
partitions with the largest imbalance merge, the heavy windows of one with the
light windows of the other, until one partition is left.  Its windows are nearly
equal; if one is above capacity, ``m`` rises by one and the block is dealt anew.

Words repeat, so a worker remembers the ids of the words (cut into letters and
others) it has met.  The tokenizer drops white space and cuts words there too,
so a text's ids are its units' ids in order.

``sequence_id`` is the task's partition number times 2**32 plus a counter; it is
unique, and a task that runs again gives the same ids for the same rows.

Cases.  Null or empty text: only the end id.  Repeated rows are documents of
their own.  Null doc_id: packed as any other.  No rows give no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

import heapq
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A

CAPACITY, WINDOWS, END_ID = 4096, 512, 2
#: places for units whose ids a worker remembers, and the most ids it keeps
SLOT_BITS = 21
SLOTS, MOST_IDS = 1 << SLOT_BITS, 16 << 20
_state: dict = {}


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: bytes that decide whether a word may be cut: letters, others
_KIND = np.full(256, 2, np.uint8)
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[[32, 9, 10, 11, 12, 13]] = 0


def units(buf, off):
    """Cuts words between letters and other characters: (bytes with small
    letters, starts, ends, first unit of each text).

    The tokenizer itself cuts there and lower-cases, and equal units then meet
    more often.  Words with an apostrophe (contractions), ``<`` (special
    tokens) or characters beyond Latin-1 letters are left whole and as they
    are.
    """
    starts, ends, first = A.find_words(buf, off, A.SPACED)
    if not len(starts):
        return buf, starts, ends, first
    led = np.zeros(len(buf), bool)
    led[1:] = buf[:-1] == 0xC3
    odd = (buf == 0x27) | (buf == 0x3C) | ((buf >= 0x80) & (buf != 0xC3) & ~led) | (led & ((buf == 0x97) | (buf == 0xB7)))
    whole = np.diff(np.r_[0, np.cumsum(odd)][np.stack([starts, ends], 1)], axis=1).ravel() > 0
    step = np.zeros(len(buf) + 1, np.int8)
    step[starts[whole]] += 1
    step[ends[whole]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8) > 0
    kind = _KIND[buf]
    kind[inside] = 1
    new = np.zeros(len(buf) + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=new[1:-1])
    new[starts] = True
    starts = np.flatnonzero(new[:-1] & (kind > 0))
    new[ends] = True
    cuts = np.flatnonzero(new)
    return np.where(inside, buf, A.LOWER[buf]), starts, cuts[np.searchsorted(cuts, starts, "right")], np.searchsorted(starts, off)


class WordTokens:
    """Token ids of texts by way of the ids of their units.

    Ids of units met before are remembered in a table of ``SLOTS`` places by
    64-bit hash; a later unit takes the place of an earlier one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        vocabulary = tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.reset()

    def reset(self):
        self.hash = np.zeros(SLOTS, np.uint64)
        self.at = np.zeros(SLOTS, np.int64)
        self.count = np.zeros(SLOTS, np.int32)
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0

    def tokenise(self, texts):
        """(ids in a row, ids per text).  Texts of letters alone are one
        pre-token each, so they are joined, and the ids that end a word tell
        them apart again."""
        joined = [" ".join(texts[k:k + 256]) for k in range(0, len(texts), 256)]
        flat = np.array([t for e in self.encode(joined, add_special_tokens=False) for t in e.ids], np.uint32)
        stop = np.flatnonzero(self.ends_word[flat]) + 1
        if len(stop) == len(texts):
            return flat, np.diff(stop, prepend=0)
        ids = [e.ids for e in self.encode(texts, add_special_tokens=False)]
        return np.array([t for x in ids for t in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def learn(self, buf, starts, ends, h):
        """Tokenises the distinct units among these."""
        _, first = np.unique(h, return_index=True)
        raw = buf.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        plain = np.array([t.isalpha() for t in texts])
        order = np.argsort(~plain, kind="stable")
        first, k = first[order], int(plain.sum())
        texts = [texts[i] for i in order.tolist()]
        parts = [self.tokenise(texts[:k])] if k else []
        if k < len(texts):
            ids = [e.ids for e in self.encode(texts[k:], add_special_tokens=False)]
            parts.append((np.array([t for x in ids for t in x], np.uint32), np.array([len(x) for x in ids], np.int64)))
        flat, count = (np.concatenate(c) for c in zip(*parts))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros(max(len(self.ids), len(flat)), np.uint32)]
        self.ids[self.used:self.used + len(flat)] = flat
        at = self.used + np.cumsum(count) - count
        self.used += len(flat)
        order = np.argsort(h[first])
        return h[first][order], at[order], count[order]

    def __call__(self, buf, off):
        """(ids of all texts, n + 1 bounds), without end ids."""
        buf, starts, ends, first = units(buf, off)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if self.used > MOST_IDS:
            self.reset()
        h = A.word_hashes(buf, starts, ends) | A.U(1)
        slot = (h >> A.U(64 - SLOT_BITS)).astype(np.int64)
        at, count = self.at[slot], self.count[slot].astype(np.int64)
        miss = np.flatnonzero(self.hash[slot] != h)
        if len(miss):
            known, new_at, new_count = self.learn(buf, starts[miss], ends[miss], h[miss])
            k = np.searchsorted(known, h[miss])
            at[miss], count[miss] = new_at[k], new_count[k]
            self.hash[slot[miss]], self.at[slot[miss]], self.count[slot[miss]] = h[miss], at[miss], count[miss]
        return self.ids[A.ranges(at, count)], np.r_[0, np.cumsum(count)][first]


def differencing(sizes, m: int):
    """Karmarkar-Karp for ``m`` windows: (loads, item numbers per window)."""
    n = len(sizes)
    left, right = [], []  # inner nodes of the merged windows; items are 0 .. n - 1
    # a partial partition holds its loads in falling order, without empty windows
    heap = [(-int(s), k, np.array([s]), np.array([k])) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, la, na = heapq.heappop(heap)
        _, _, lb, nb = heapq.heappop(heap)
        shared = len(la) + len(lb) - m
        if shared <= 0:
            load, node = np.concatenate([la, lb]), np.concatenate([na, nb])
        else:
            # the lightest windows of one take the heaviest of the other, in turn
            ka, kb = len(la) - shared, len(lb) - shared
            load = np.concatenate([la[:ka], la[ka:] + lb[kb:][::-1], lb[:kb]])
            node = np.concatenate([na[:ka], np.arange(n + len(left), n + len(left) + shared), nb[:kb]])
            left.extend(na[ka:].tolist())
            right.extend(nb[kb:][::-1].tolist())
        order = np.argsort(-load, kind="stable")
        load, node = load[order], node[order]
        spread = load[0] - (load[-1] if len(load) == m else 0)
        heapq.heappush(heap, (-int(spread), turn, load, node))
        turn += 1
    _, _, load, node = heap[0]
    windows = []
    for root in node.tolist():
        items, todo = [], [root]
        while todo:
            x = todo.pop()
            if x < n:
                items.append(x)
            else:
                todo += [left[x - n], right[x - n]]
        windows.append(items)
    return load, windows


def balanced(sizes, capacity: int):
    """Windows of near-equal load that all fit ``capacity``."""
    m = max(1, -(-int(sum(sizes)) // capacity))
    while True:
        load, windows = differencing(sizes, m)
        if load.max() <= capacity:
            return windows
        m += 1


#: pieces that a block holds before it looks for its end, at twice as many it ends
PIECES = 1 << 15
FIELDS = "doc_id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _pack(path, capacity: int, windows: int, end_id: int):
    def block(rests, counter):
        """rests: (doc_id, start, ids, doc_tokens) -> rows, next counter."""
        rows = []
        for group in balanced([len(r[2]) for r in rests], capacity):
            at = 0
            for k in sorted(group):
                doc_id, start, ids, total = rests[k]
                rows.append((doc_id, start, ids.tobytes(), len(ids), total, counter, at))
                at += len(ids)
            counter += bool(group)
        return rows, counter

    def run(batches):
        where = path or public_tokenizer()
        if _state.get("path") != where:
            _state.update(path=where, tokens=WordTokens(where))
        tokens = _state["tokens"]
        counter = TaskContext.get().partitionId() << 32
        # a document's full windows go out at once, its rest is held for a block
        held, size, full = [], 0, []
        for batch in batches:
            doc_ids = A.column(batch, "doc_id").to_pylist()
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                ids, bounds = tokens(buf, off)
                for r in range(j - i):
                    own = np.append(ids[bounds[r]:bounds[r + 1]], np.uint32(end_id)).astype("<u4")
                    total, start = len(own), 0
                    while total - start >= capacity:
                        full.append((doc_ids[i + r], start, own[start:start + capacity].tobytes(), capacity, total, counter, 0))
                        counter, start = counter + 1, start + capacity
                        if len(full) >= windows:
                            yield A.batch_of(SCHEMA, list(zip(*full)))
                            full = []
                    if start < total:
                        held.append((doc_ids[i + r], start, own[start:].copy(), total))
                        size += total - start
                    # a block ends where its windows would have some room each, and one of
                    # many small pieces where its last window is nearly full
                    many = len(held) >= PIECES and (-size % capacity <= capacity // 64 or len(held) >= 2 * PIECES)
                    if many or size >= (windows - 1) * capacity and (size % capacity < capacity // 2 or size >= (windows + 1) * capacity):
                        rows, counter = block(held, counter)
                        held, size = [], 0
                        yield A.batch_of(SCHEMA, list(zip(*rows)))
        if full:
            yield A.batch_of(SCHEMA, list(zip(*full)))
        if held:
            rows, counter = block(held, counter)
            yield A.batch_of(SCHEMA, list(zip(*rows)))
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, windows: int = WINDOWS,
         end_id: int = END_ID) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per piece: doc_id, start, ids
    (little-endian 32-bit), length, doc_tokens, sequence_id, offset.

    ``tokenizer``: path of the vocabulary on the workers (null: the installed
    public one)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _pack(tokenizer, capacity, windows, end_id), FIELDS)
