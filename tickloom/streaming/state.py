"""Per-ticker state of the stateful steps.

``EnrichTicks`` keeps recent ticks as one value: those of the longest span, and at least the
rows a z-score looks back on. Each micro-batch of a ticker is enriched as arrays.
``ScoreAnomalies`` holds a ticker's forest until the next one is due (``CutAnomalies`` leaves
fitting and scoring to other tasks), ``AsOf`` the newest value of each second until no article
can ask for it any more.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions import iforest
from tickloom.operators import anomaly

STATE = "ts_us bigint, seq bigint, price double, size bigint"
_RECENT = pa.schema([("ts_us", pa.int64()), ("seq", pa.int64()), ("price", pa.float64()), ("size", pa.int64())])
METRICS = (
    "vwap_1min double, vwap_5min double, avg_price_5min double, trade_count_60s bigint, "
    "volume_zscore double, momentum double"
)
OUTPUT = "ticker string, ts timestamp, " + STATE + ", " + METRICS

SHORT_US, LONG_US = 60_000_000, 300_000_000
ROWS = 19
#: Prices are summed as whole numbers of this part, as in the batch form.
PRICE_UNIT = 10**8
#: Rows whose look-back is laid out at once, and sizes whose squares fit 64 bits.
_BLOCK, _SAFE = 1 << 16, 10**8


def _pack(rows: pd.DataFrame, kinds: pa.Schema) -> bytes:
    """Rows as one value; a state server that gets them singly takes ten times as long as the work on them."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, kinds) as out:
        out.write_table(pa.Table.from_pandas(rows[kinds.names], kinds, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _prior_z(size: np.ndarray) -> np.ndarray:
    """Each size against mean and sample deviation of the ``ROWS`` before it.

    Sums are of whole numbers, taken from the oldest size in view, so nothing cancels
    where sizes are large and close.
    """
    out = np.empty(len(size))
    padded = np.concatenate([np.zeros(ROWS, np.int64), size])
    views = np.lib.stride_tricks.sliding_window_view(padded, ROWS)
    for a in range(0, len(size), _BLOCK):
        i = np.arange(a, min(a + _BLOCK, len(size)))
        n = np.minimum(i, ROWS)
        base = size[i - n]
        off = np.where(np.arange(ROWS) >= (ROWS - n)[:, None], views[i] - base[:, None], 0)
        now = size[i] - base
        if max(np.abs(off).max(), np.abs(now).max()) > _SAFE:
            off, now, n = off.astype(object), now.astype(object), n.astype(object)
        s = off.sum(axis=1)
        above = (n * now - s).astype(float)
        spread = (n * (off * off).sum(axis=1) - s * s).astype(float)
        n = n.astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            z = above / n / np.sqrt(spread / (n * (n - 1.0)))
        out[i] = np.where(n == 0, 0.0, np.where(spread == 0, np.sign(above), z))
    return out


def enrich_rows(t: pd.DataFrame) -> pd.DataFrame:
    """Add the live metrics to one ticker's ticks (finite prices), given in time order.

    Prices are summed as Python integers, so results do not depend on the micro-batches.
    """
    ts = t["ts_us"].to_numpy()
    price, size = t["price"].to_numpy(dtype=float), t["size"].to_numpy(dtype=np.int64)
    whole = np.array([round(p * PRICE_UNIT) for p in price.tolist()], dtype=object)
    volume = size.astype(object)
    end = np.searchsorted(ts, ts, side="right")

    def trailing(values: np.ndarray, span: int) -> np.ndarray:
        start = np.searchsorted(ts, ts - span, side="left")
        c = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        return c[end] - c[start]

    def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        b = b.astype(float)
        return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)

    def mean(values: np.ndarray, weights: np.ndarray, span: int) -> np.ndarray:
        # True division of integers gives the nearest double.
        return ratio((trailing(values, span) / PRICE_UNIT).astype(float), trailing(weights, span))

    one = np.ones(len(t), np.int64)
    before = np.concatenate([[0.0], price[:-1]])
    change = ratio(price - before, before) * 100.0
    return t.assign(
        vwap_1min=mean(whole * volume, volume, SHORT_US),
        vwap_5min=mean(whole * volume, volume, LONG_US),
        avg_price_5min=mean(whole, one, LONG_US),
        trade_count_60s=trailing(one, SHORT_US),
        volume_zscore=_prior_z(size),
        momentum=np.where(before > 0, change, 0.0),
    )


class EnrichTicks(StatefulProcessor):
    """Enriches a ticker's new ticks from its recent ones."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._recent = handle.getValueState("recent", "rows binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old = self._recent.get()
        new = pd.concat(list(rows), ignore_index=True)
        both = new[_RECENT.names].assign(_new=True)
        if old is not None:
            both = pd.concat([_unpack(old[0]).assign(_new=False), both], ignore_index=True)
        both = both.sort_values(["ts_us", "seq"], ignore_index=True)
        keep = (both["ts_us"] >= both["ts_us"].iloc[-1] - LONG_US) | (both.index >= len(both) - ROWS - 1)
        self._recent.update((_pack(both[keep], _RECENT),))
        out = enrich_rows(both)
        out = out[out["_new"]].drop(columns="_new")
        out.insert(0, "ticker", key[0])
        out.insert(1, "ts", pd.to_datetime(out["ts_us"], unit="us"))
        yield out

    def close(self) -> None:
        pass


#: Feature rows that are scored apart from a ticker's other rows, with the forest they start
#: with or the rows that one is fitted on; ``slot`` deals pieces out.
PIECE = (
    "ticker string, slot bigint, seen bigint, rows binary, earlier binary, "
    "version bigint, psi int, offset bigint, feature binary, threshold binary, value binary"
)


def _packed(held) -> tuple:
    """A forest as it is kept."""
    if held is None:
        return (None,) * 6
    version, arrays, psi, offset = held
    return version, psi, offset, *(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpacked(kept, trees: int):
    """Version, arrays, sample size and cut-off of a kept forest."""
    version, psi, offset, *arrays = kept
    kinds = (np.int32, np.float64, np.int64)
    shaped = tuple(np.frombuffer(a, k).reshape(trees, -1) for a, k in zip(arrays, kinds, strict=True))
    return int(version), shaped, int(psi), int(offset)


def score_rows(ticker: str, seen: int, rows: pd.DataFrame, earlier: np.ndarray, held, forest: anomaly.Forest) -> pd.DataFrame:
    """Score ``rows``, those after the first ``seen``, with the forest ``held`` and those that
    become due up to the last row; they are fitted on ``earlier`` and ``rows``."""
    f = forest
    x = rows[list(f.features)].to_numpy(dtype=float)
    rows = rows.assign(ticker=ticker, ordinal=np.arange(seen + 1, seen + len(rows) + 1, dtype=np.int64))
    parts, at = [], 0
    while at < len(rows):
        version, start = divmod(seen + at, f.interval)
        if start == 0 and version and version * f.interval >= f.warmup and (held is None or held[0] < version):
            model, psi, offset = anomaly.fitted(np.concatenate([earlier, x[:at]])[-f.window :], ticker, version, f)
            held = version, model, psi, offset
        end = min(len(rows), (version + 1) * f.interval - seen)
        if held is None:
            parts.append(rows.iloc[at:end].assign(version=version, **anomaly.WARMING))
        else:
            valid, arrays, psi, offset = held
            raw = iforest.score(x[at:end], *arrays, psi)
            parts.append(rows.iloc[at:end].assign(version=valid, **anomaly.verdicts(raw, offset)))
        at = end
    return pd.concat(parts, ignore_index=True)[[c.split()[0] for c in anomaly.scored_schema(f).split(", ")]]


class ScoreAnomalies(StatefulProcessor):
    """Scores a ticker's feature rows with the forest it holds, refitting only when one is due.

    State: how many events there were, the rows the next forest trains on (a micro-batch's new
    ones are appended as one value; the list is only read, and cut to the window, at a refit)
    and the forest. Rows are numbered as they come; within a micro-batch in time order.

    A micro-batch is cut into pieces: the rows of the held forest, blocks of ``block``
    versions that begin and end in it, and the rows of the last forest due, which is the one
    fitted here and held. Each forest is fitted once, wherever its piece is scored.
    """

    def __init__(self, forest: anomaly.Forest):
        self.forest = forest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "n bigint")
        self._rows = handle.getListState("rows", "features binary")
        self._held = handle.getValueState(
            "forest", "version bigint, psi int, offset bigint, feature binary, threshold binary, value binary"
        )

    def _pieces(self, ticker: str, rows: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Rows seen before, rows, earlier rows to train on, and the forest held, for each piece."""
        f, names = self.forest, list(self.forest.features)
        new = pd.concat(list(rows), ignore_index=True).sort_values(["ts_us", "seq"], ignore_index=True)
        x = new[names].to_numpy(dtype=float)
        seen = self._seen.get()
        seen = 0 if seen is None else int(seen[0])
        kept = self._held.get()
        held = None if kept is None else _unpacked(kept, f.trees)
        none = np.empty((0, len(names)))
        first, last = seen // f.interval + 1, (seen + len(new)) // f.interval  # versions due
        if last < first or last * f.interval < f.warmup:
            yield seen, new, none, held
            self._rows.appendList([(x.tobytes(),)])
        else:
            earlier = [np.frombuffer(r[0], float).reshape(-1, len(names)) for r in self._rows.get()]
            both = np.concatenate([*earlier, x])
            before = len(both) - len(x)
            cuts = [*range(first, last, f.block), last]
            yield seen, new.iloc[: first * f.interval - seen], none, held
            for v, end in zip(cuts, cuts[1:], strict=False):
                a, b = v * f.interval - seen, end * f.interval - seen
                yield v * f.interval, new.iloc[a:b], both[: before + a][-f.window :], None
            at = last * f.interval - seen
            model, psi, offset = anomaly.fitted(both[: before + at][-f.window :], ticker, last, f)
            held = last, model, psi, offset
            self._held.update(_packed(held))
            if at < len(new):
                yield last * f.interval, new.iloc[at:], none, held
            self._rows.put([(both[-f.window :].tobytes(),)])
        self._seen.update((seen + len(new),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for piece in self._pieces(key[0], rows):
            yield score_rows(key[0], *piece, self.forest)

    def close(self) -> None:
        pass


class CutAnomalies(ScoreAnomalies):
    """The same state; pieces are sent on as ``PIECE`` rows, so that other tasks fit and score them."""

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        kinds = pa.schema([("ts_us", pa.int64()), ("seq", pa.int64()), *((c, pa.float64()) for c in self.forest.features)])
        span = self.forest.block * self.forest.interval
        for seen, part, earlier, held in self._pieces(key[0], rows):
            slot = zlib.crc32(str(key[0]).encode()) + seen // span
            row = (key[0], slot, seen, _pack(part, kinds), earlier.tobytes(), *_packed(held))
            made = pd.DataFrame([row], columns=[c.split()[0] for c in PIECE.split(", ")])
            yield made.astype({"version": "Int64", "psi": "Int32", "offset": "Int64"})


def score_pieces(forest: anomaly.Forest) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The verdicts on ``PIECE`` rows, one piece after the other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p in batch.itertuples(index=False):
                rows = _unpack(p.rows)
                earlier = np.frombuffer(p.earlier, float).reshape(-1, len(forest.features))
                held = None if p.feature is None else _unpacked((p.version, p.psi, p.offset, p.feature, p.threshold, p.value), forest.trees)
                yield score_rows(p.ticker, int(p.seen), rows, earlier, held, forest)

    return run


class AsOf(StatefulProcessor):
    """Articles with the newest value of their ticker, sent out once the watermark is past them.

    State: the newest value of each step of time, and the articles that wait, packed step by
    step. A value counts from the end of its step on, an article's time is cut down to the
    step, so nothing later than an article enters. Steps that no article can reach any more
    are removed. State is read once a micro-batch, and the earliest article that waits has
    the only timer, so the work does not grow with articles times steps.
    """

    OUT = "id bigint, ticker string, ts_us bigint, value double"

    def __init__(self, tolerance_us: int, step_us: int):
        self.tolerance_us, self.step_us = tolerance_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._newest = handle.getMapState("newest", "slot bigint", "at bigint, seq bigint, value double")
        self._waiting = handle.getMapState("waiting", "slot bigint", "articles binary")

    def _values(self) -> dict[int, tuple]:
        return {k[0]: tuple(v) for k, v in self._newest.iterator()}

    def _articles(self) -> dict[int, np.ndarray]:
        """Time and id of the articles that wait, in that order, by step."""
        return {k[0]: np.frombuffer(v[0], np.int64).reshape(-1, 2) for k, v in self._waiting.iterator()}

    @staticmethod
    def _earliest(articles: dict[int, np.ndarray]) -> int | None:
        return int(articles[min(articles)][0, 0]) if articles else None

    def _wake(self, at: int) -> None:
        self._handle.registerTimer(-(-at // 1000))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held, waiting = self._values(), self._articles()
        kept, first, changed, news = set(held), self._earliest(waiting), set(), []
        for part in rows:
            ticks = part[~part["is_news"]].sort_values(["at", "seq"])
            slots = -(-ticks["at"] // self.step_us)
            last = ticks[~slots.duplicated(keep="last")]
            for slot, at, seq, value in zip(slots[last.index], last["at"], last["seq"], last["value"], strict=True):
                if slot not in held or held[slot][:2] < (at, seq):
                    held[int(slot)] = (int(at), int(seq), None if pd.isna(value) else float(value))
                    changed.add(int(slot))
            news.append(part.loc[part["is_news"], ["at", "id"]].to_numpy(dtype=np.int64))
        new = np.unique(np.concatenate(news), axis=0)
        slots, start = np.unique(new[:, 0] // self.step_us, return_index=True)
        for slot, pairs in zip(slots.tolist(), np.split(new, start[1:]), strict=True) if len(new) else ():
            if slot in waiting:
                pairs = np.unique(np.concatenate([waiting[slot], pairs]), axis=0)
            waiting[slot] = pairs
            self._waiting.updateValue((slot,), (pairs.tobytes(),))
        earliest = self._earliest(waiting)
        if earliest is not None and (first is None or earliest < first):
            self._wake(earliest)
        gone = self._forget(held, earliest, timerValues.getCurrentWatermarkInMs() * 1000, kept)
        for slot in changed - gone:
            self._newest.updateValue((slot,), held[slot])
        yield self._rows([], key[0], [], [])

    def _forget(self, held: dict[int, tuple], earliest: int | None, mark: int, kept: set[int]) -> set[int]:
        """Steps that no article can reach, neither one that waits nor one to come; those that
        are ``kept`` as state are removed."""
        oldest = mark if earliest is None else min(mark, earliest)
        first = (oldest - self.tolerance_us) // self.step_us - 1
        gone = {slot for slot in held if slot < first}
        for slot in gone & kept:
            self._newest.removeKey((slot,))
        return gone

    @staticmethod
    def _rows(ids, ticker: str, at, value) -> pd.DataFrame:
        out = pd.DataFrame({"id": ids, "ticker": ticker, "ts_us": at, "value": value})
        return out.astype({"id": "int64", "ticker": "object", "ts_us": "int64", "value": "float64"})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = self._articles()
        due = sorted(slot for slot in waiting if waiting[slot][0, 0] <= mark)
        if not due:
            yield self._rows([], key[0], [], [])
            return
        ready = []
        for slot in due:
            pairs = waiting.pop(slot)
            ready.append(pairs[pairs[:, 0] <= mark])
            if len(later := pairs[len(ready[-1]) :]):
                waiting[slot] = later
                self._waiting.updateValue((slot,), (later.tobytes(),))
            else:
                self._waiting.removeKey((slot,))
        at, ids = np.concatenate(ready).T
        held = self._values()
        slots = np.array(sorted(held), np.int64)
        newest = np.array([held[s][0] for s in slots.tolist()] + [0], np.int64)
        values = np.array([held[s][2] for s in slots.tolist()] + [None], float)
        n = np.searchsorted(slots, at // self.step_us, side="right") - 1  # -1: none, the added place
        near = (n >= 0) & (at - newest[n] <= self.tolerance_us)
        yield self._rows(ids, key[0], at, np.where(near, values[n], np.nan))
        earliest = self._earliest(waiting)
        if earliest is not None:
            self._wake(earliest)
        self._forget(held, earliest, mark, set(held))

    def close(self) -> None:
        pass
