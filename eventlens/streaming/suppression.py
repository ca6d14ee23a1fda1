"""The state of streaming suppression (ST06/R10), for
``transformWithStateInPandas``.

A key's alerts of one micro-batch come in chunks of Spark's Arrow batch size.
One chunk is judged as it is.  Of a key with more, the chunks are spooled to the
key's map state (one RocksDB entry a chunk) and only their distinct times stay
in memory, 8 bytes each; then the spooled chunks are read back one at a time."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor


def micros(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


def kept_times(times: np.ndarray, last: int | None, gap: int) -> list[int]:
    """Of ascending ``times`` those that are kept: the first one ``gap`` or more
    after the one kept before, which is ``last`` at the start."""
    kept = []
    while True:
        k = 0 if last is None else int(np.searchsorted(times, last + gap))
        if k >= len(times):
            return kept
        last = int(times[k])
        kept.append(last)


class Suppress(StatefulProcessor):
    """``last_kept`` and ``seen`` (the wall clock of the key's last batch) of a
    key; a timer clears them when the key was idle for ``idle_ms`` and the
    watermark is a window past the last kept alert.  A time-to-live alone would
    forget keys while a slow replay is still inside their window."""

    def __init__(self, gap_us: int, idle_ms: int):
        self.gap_us, self.idle_ms = gap_us, idle_ms

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("last", "last_kept long, seen long")
        self.spool = handle.getMapState("spool", "chunk int", "rows binary")

    def _chunks(self, n):
        for k in range(n):
            yield k, pd.read_feather(io.BytesIO(self.spool.getValue((k,))[0]))

    def _spool(self, k, rows):
        out = io.BytesIO()
        rows.reset_index(drop=True).to_feather(out)
        self.spool.updateValue((k,), (out.getvalue(),))

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        there = self.state.exists()
        last = self.state.get()[0] if there else None
        only, n, times = None, 0, []
        for chunk in rows:
            chunk = chunk[["ts", "alert"]]
            times.append(np.unique(micros(chunk["ts"].dropna())))
            if n == 0:
                only = chunk.reset_index(drop=True)
            else:
                if only is not None:
                    self._spool(0, only)
                    only = None
                self._spool(n, chunk)
            n += 1
        kept = kept_times(np.unique(np.concatenate(times)), last, self.gap_us)
        read = (lambda: [(0, only)]) if only is not None else (lambda: self._chunks(n))
        # of the alerts at a kept time the least is the kept one
        at = np.array(kept, "int64")
        first = {}
        for k, chunk in read():
            hit = np.flatnonzero(np.isin(micros(chunk["ts"]), at) & chunk["ts"].notna().to_numpy())
            for t, alert, i in zip(micros(chunk["ts"])[hit].tolist(), chunk["alert"].to_numpy()[hit], hit.tolist()):
                if t not in first or (alert, k, i) < first[t]:
                    first[t] = (alert, k, i)
        chosen = {}
        for _, k, i in first.values():
            chosen.setdefault(k, []).append(i)
        for k, chunk in read():
            ok = chunk["ts"].isna().to_numpy()
            ok[chosen.get(k, [])] = True
            yield pd.DataFrame({"alert_key": [key[0]] * len(chunk), "ts": chunk["ts"], "alert": chunk["alert"], "kept": ok})
        if only is None:
            self.spool.clear()
        if kept or there:
            self.state.update((kept[-1] if kept else last, now))
        if kept and not there:  # one timer a key
            self.handle.registerTimer(now + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            last, seen = self.state.get()
            now = timerValues.getCurrentProcessingTimeInMs()
            if seen + self.idle_ms > now:
                self.handle.registerTimer(seen + self.idle_ms)
            elif timerValues.getCurrentWatermarkInMs() < (last + self.gap_us) // 1000:
                self.handle.registerTimer(now + self.idle_ms)
            else:
                self.state.clear()
        return iter([])

    def close(self):
        pass


class SuppressKeys(Suppress):
    """``Suppress`` for groups of many keys: the alerts of a group's keys are
    judged together, and what is kept of the keys (``last_kept`` and ``seen`` each)
    is one list, read and written once a batch.  A call of the state, a timer and a
    frame for every key cost more than the judging.  The group's timer is that of
    its earliest key, and drops the keys whose own timer would clear them."""

    def init(self, handle):
        self.handle = handle
        self.state = handle.getListState("keys", "alert_key string, last_kept long, seen long")
        self.spool = handle.getMapState("spool", "chunk int", "rows binary")

    def _known(self):
        return {k: (last, seen) for k, last, seen in self.state.get()} if self.state.exists() else {}

    def _add_times(self, chunk, times):
        """The distinct times of each key of ``chunk`` to ``times``."""
        codes, names = pd.factorize(chunk["alert_key"], use_na_sentinel=False)
        there = chunk["ts"].notna().to_numpy()
        at = micros(chunk["ts"])[there]
        codes = codes[there]
        order = np.lexsort((at, codes))
        codes, at = codes[order], at[order]
        ends = np.flatnonzero(np.diff(codes)) + 1
        for code, part in zip(codes[np.concatenate(([0], ends))] if len(codes) else [], np.split(at, ends)):
            times.setdefault(_name(names[code]), []).append(np.unique(part))
        for name in names:  # a key without times was seen, too
            times.setdefault(_name(name), [])

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        known = self._known()
        had = bool(known)
        only, n, times = None, 0, {}
        for chunk in rows:
            chunk = chunk[["alert_key", "ts", "alert"]]
            self._add_times(chunk, times)
            if n == 0:
                only = chunk.reset_index(drop=True)
            else:
                if only is not None:
                    self._spool(0, only)
                    only = None
                self._spool(n, chunk)
            n += 1
        at = set()
        for name, parts in times.items():
            last = known[name][0] if name in known else None
            kept = kept_times(np.unique(np.concatenate(parts)), last, self.gap_us) if parts else []
            at.update((name, t) for t in kept)
            if kept or name in known:
                known[name] = (kept[-1] if kept else last, now)
        read = (lambda: [(0, only)]) if only is not None else (lambda: self._chunks(n))
        # of the alerts of a key at a kept time the least is the kept one
        first = {}
        for k, chunk in read():
            there = chunk["ts"].notna().to_numpy()
            for i, (name, t, alert) in enumerate(zip(chunk["alert_key"].to_numpy(), micros(chunk["ts"]).tolist(), chunk["alert"].to_numpy())):
                hit = (_name(name), t)
                if there[i] and hit in at and (hit not in first or (alert, k, i) < first[hit]):
                    first[hit] = (alert, k, i)
        chosen = {}
        for _, k, i in first.values():
            chosen.setdefault(k, []).append(i)
        for k, chunk in read():
            ok = chunk["ts"].isna().to_numpy()
            ok[chosen.get(k, [])] = True
            yield pd.DataFrame({"alert_key": chunk["alert_key"], "ts": chunk["ts"], "alert": chunk["alert"], "kept": ok})
        if only is None:
            self.spool.clear()
        if known:
            self.state.put([(name, last, seen) for name, (last, seen) in known.items()])
            if not had:  # one timer a group
                self.handle.registerTimer(now + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, mark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        left, then = [], []
        for name, (last, seen) in self._known().items():
            if seen + self.idle_ms > now:
                then.append(seen + self.idle_ms)
            elif mark < (last + self.gap_us) // 1000:
                then.append(now + self.idle_ms)
            else:
                continue
            left.append((name, last, seen))
        if left:
            self.state.put(left)
            self.handle.registerTimer(min(then))
        else:
            self.state.clear()
        return iter([])


def _name(key):
    """A key as it is in the state (a missing one is None in every frame)."""
    return key if isinstance(key, str) else None
