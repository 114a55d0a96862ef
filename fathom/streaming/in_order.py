"""Keyed streaming state over rows in event-time order.

Rows of a key arrive in any order of files and batches.  They wait as state
until the watermark has passed them and are then handed on in the order of
(event time, id), so what comes out is what one pass over the ordered rows
gives, whatever the files and the batch size, as long as no row is later than
the watermark allows.  ``InOrder`` keeps the waiting rows; what a key does
with them, and the state it keeps, is a subclass:

* ``LastN``: bin counts of the last N values, changed by one value in and one
  out;
* ``RateLimit``: the allowed times of the trailing window;
* ``OnlineLinear``: a linear model, moved by one gradient step for each batch
  of rows.

Waiting rows are kept packed, some thousand to an entry of the state, those of
a busy key by day; a day's rows at a time are sorted and passed on as arrays,
so a key with most of the rows costs neither a call for each of them nor the
memory for all.  A key's days are taken one after the other, as the order
demands; all else is done before the shuffle.  A busy monitor is keyed by a shard (source, model)
too.  The state store is RocksDB's (``ROCKS``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fathom.functions.hashing import bucket
from fathom.session import ensure_checkpoint_dir
from fathom.streaming.monitor import run_available_now

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore.providerClass"


SLICE_US = 86_400_000_000       # time span of the rows that are sorted together
AT_ONCE = 50_000                # rows that are passed on together
PACK = 200_000                  # rows of a key that are held before they are stored
SMALL = 1000                    # rows that are stored as one entry whatever their times


class InOrder(StatefulProcessor):
    """Rows (ts_us, id, *values) of a key, passed on in order once the watermark is past them.

    A row whose first value is NULL only moves the time on."""

    values: tuple[tuple[str, str], ...] = ()        # name and type of what a row carries
    state = ""                                      # schema of what a key remembers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.few = handle.getListState("few", "rows binary")        # an empty entry: there are rows in ``waiting`` too
        self.waiting = handle.getMapState("waiting", "first long, last long, part long", "rows binary")
        self.kept = handle.getValueState("kept", self.state)

    def width(self, name: str) -> int:
        """Entries of an array value."""
        return 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, size, first = [], 0, None
        for chunk in rows:
            chunk = chunk[chunk[self.values[0][0]].notna()]
            if len(chunk):
                held.append(self._arrays(chunk))
                size += len(chunk)
                earliest = int(held[-1][0].min())
                first = earliest if first is None else min(first, earliest)
            if size >= PACK:
                self._store(_joined(held))
                held, size = [], 0
        if held:
            self._store(_joined(held))
        if first is not None:
            self._wake(first, timerValues)
        return iter(())

    def _arrays(self, chunk: pd.DataFrame) -> list[np.ndarray]:
        cols = [chunk[c].to_numpy().astype(np.int64) for c in ("ts_us", "id")]
        for name, kind in self.values:
            v = chunk[name].to_numpy()
            cols.append(v.astype(np.int64) if kind in ("int", "long") else
                        np.stack([np.asarray(a, dtype=float) for a in v]) if kind.startswith("array") else v.astype(float))
        return cols

    def _store(self, cols: list[np.ndarray]) -> None:
        if len(cols[0]) <= SMALL:
            self.few.appendValue((_packed(cols),))
            return
        part = cols[0] // SLICE_US
        order = np.argsort(part, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            mine = [c[at] for c in cols]
            self.waiting.updateValue((int(mine[0].min()), int(mine[0].max()), uuid.uuid4().int >> 66), (_packed(mine),))
        self.few.appendValue((b"",))

    def _unpacked(self, raw: bytes) -> list[np.ndarray]:
        widths = [1, 1, *(self.width(n) for n, _ in self.values)]
        n, at, cols = len(raw) // 8 // sum(widths), 0, []
        for i, w in enumerate(widths):
            kind = np.int64 if i < 2 or self.values[i - 2][1] in ("int", "long") else np.float64
            col = np.frombuffer(raw, dtype=kind, count=n * w, offset=at)
            cols.append(col.reshape(n, w) if i >= 2 and self.values[i - 2][1].startswith("array") else col)
            at += 8 * n * w
        return cols

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        few = [bytes(r[0]) for r in self.few.get()] if self.few.exists() else []
        heads = sorted(tuple(h) for h in self.waiting.keys()) if b"" in few else []
        parts = [self._unpacked(r) for r in few if r]
        carry = _joined(parts) if parts else None
        due = [h for h in heads if h[0] <= passed]
        later = heads[len(due)][0] if len(due) < len(heads) else None
        first = None if carry is None else int(carry[0].min())
        if due or (first is not None and first <= passed):
            at = 0
            kept = self.start(self.kept.get() if self.kept.exists() else None)
            while at < len(due) or carry is not None:
                # the earliest day of what is in hand and of what is stored, all that is left where nothing is stored
                starts = ([due[at][0]] if at < len(due) else []) + ([int(carry[0].min())] if carry is not None else [])
                end = passed if at == len(due) else min(passed, (min(starts) // SLICE_US + 1) * SLICE_US - 1)
                if min(starts) > passed:
                    break
                parts = [carry] if carry is not None else []
                while at < len(due) and due[at][0] <= end:
                    parts.append(self._unpacked(self.waiting.getValue(due[at])[0]))
                    self.waiting.removeKey(due[at])
                    at += 1
                cols = _joined(parts)
                now = cols[0] <= end
                carry = None if now.all() else [c[~now] for c in cols]
                cols = [c[now] for c in cols]
                order = np.lexsort((cols[1], cols[0]))
                for i in range(0, len(order), AT_ONCE):
                    out = self.pass_on(key[0], kept, *[c[order[i:i + AT_ONCE]] for c in cols])
                    if len(out):
                        yield out
            self.few.clear()
            if later is not None:
                self.few.appendValue((b"",))
            first = None
            if carry is not None:
                self._store(carry)
                first = int(carry[0].min())
            self.kept.update(self.end(kept))
        later = min((t for t in (first, later) if t is not None), default=None)
        if later is not None:
            self._wake(later, timerValues)

    def _wake(self, ts_us: int, timerValues) -> None:
        """Be called when the watermark has passed the time."""
        self.handle.registerTimer(max(ts_us // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))

    def start(self, kept: tuple | None) -> dict:
        """What a key remembers, in the form that ``pass_on`` changes."""
        raise NotImplementedError

    def end(self, kept: dict) -> tuple:
        """The same as a row of ``state``."""
        raise NotImplementedError

    def pass_on(self, key, kept: dict, ts: np.ndarray, ids: np.ndarray, *values: np.ndarray) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _packed(cols: list[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(c).tobytes() for c in cols)


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return parts[0] if len(parts) == 1 else [np.concatenate(c) for c in zip(*parts)]


class LastN(InOrder):
    """Bin counts of a key's last ``n`` values (bin -1: no bin), put out at each value from ``n // 2`` values on."""

    values, state = (("bin", "int"),), "tail array<int>"
    out = "id long, n_window int, counts array<int>"

    def __init__(self, n: int, bins: int):
        self.n, self.bins = n, bins

    def start(self, kept):
        return {"tail": np.array(list(kept[0]) if kept else [], dtype=np.int64)}

    def end(self, kept):
        return (kept["tail"].tolist(),)

    def pass_on(self, key, kept, ts, ids, bins):
        known = np.concatenate([kept["tail"], bins])
        seen = np.zeros((len(known) + 1, self.bins), dtype=np.int32)
        np.cumsum(known[:, None] == np.arange(self.bins), axis=0, out=seen[1:])
        to = np.arange(len(known) - len(bins), len(known)) + 1
        size = np.minimum(to, self.n)
        counts, kept["tail"] = seen[to] - seen[to - size], known[-self.n:]
        full = size >= self.n // 2
        return pd.DataFrame({"key": [key] * int(full.sum()), "id": ids[full], "n_window": size[full].astype(np.int32),
                             "counts": list(counts[full])})


class RateLimit(InOrder):
    """Whether fewer than ``limit`` allowed events of the key lie in the
    trailing ``window_us``; rejected events do not count."""

    values, state = (("present", "int"),), "allowed array<long>"
    out = "id long, allowed boolean, in_window int"

    def __init__(self, limit: int, window_us: int):
        self.limit, self.window_us = limit, window_us

    def start(self, kept):
        return {"allowed": list(kept[0]) if kept else []}

    def end(self, kept):
        return (kept["allowed"],)

    def pass_on(self, key, kept, ts, ids, _):
        recent, allowed, inside = kept["allowed"], [], []
        for t in ts.tolist():
            recent = [a for a in recent if a > t - self.window_us]
            allowed.append(len(recent) < self.limit)
            if allowed[-1]:
                recent.append(t)
            inside.append(len(recent))
        kept["allowed"] = recent
        return pd.DataFrame({"key": [key] * len(ids), "id": ids, "allowed": allowed, "in_window": np.array(inside, dtype=np.int32)})


class OnlineLinear(InOrder):
    """Least squares by gradient steps: one for each batch of ``size`` rows
    (x, y) in order, w <- w - rate / step^decay (mean gradient + l2 w), the
    first coefficient (of a 1 before x) without penalty.  The rows of an
    unfinished batch wait for the next ones."""

    values, state = (("x", "array<double>"), ("y", "double")), "weights array<double>, step long, rows array<array<double>>"
    out = "id long, step long, weights array<double>"

    def __init__(self, n_features: int, size: int = 20, rate: float = 0.01, decay: float = 0.25, l2: float = 1e-4):
        self.n_features, self.size, self.rate, self.decay, self.l2 = n_features, size, rate, decay, l2

    def width(self, name):
        return self.n_features if name == "x" else 1

    def start(self, kept):
        w, step, rows = kept or ([0.0] * (self.n_features + 1), 0, [])
        return {"w": np.array(list(w), dtype=float), "step": step,
                "rows": np.array([list(r) for r in rows], dtype=float).reshape(-1, self.n_features + 2)}

    def end(self, kept):
        return kept["w"].tolist(), kept["step"], kept["rows"].tolist()

    def pass_on(self, key, kept, ts, ids, x, y):
        waited = len(kept["rows"])
        z = np.concatenate([kept["rows"], np.column_stack([np.ones(len(y)), x, y])])
        m = len(z) // self.size
        batches, kept["rows"] = z[:m * self.size].reshape(m, self.size, self.n_features + 2), z[m * self.size:]
        grams = np.einsum("mki,mkj->mij", batches[:, :, :-1], batches) / self.size
        w, step, penalised = kept["w"], kept["step"], np.r_[0.0, np.ones(self.n_features)] * self.l2
        weights = []
        for g in grams:
            step += 1
            w = w - self.rate / step ** self.decay * (g[:, :-1] @ w - g[:, -1] + penalised * w)
            weights.append(w)
        kept["w"], first = w, kept["step"] + 1
        kept["step"] = step
        last = ids[np.arange(1, m + 1) * self.size - 1 - waited]
        return pd.DataFrame({"key": [key] * m, "id": last, "step": np.arange(first, first + m, dtype=np.int64), "weights": weights})


def in_order(stream: DataFrame, processor: InOrder, lateness: str = "1 hour") -> DataFrame:
    """The processor's rows (key, ...) for a stream of (key, id, event_time, values)."""
    names = [n for n, _ in processor.values]
    rows = stream.withWatermark("event_time", lateness) \
        .select("key", "id", *names, "event_time", F.unix_micros("event_time").alias("ts_us"))
    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=f"key {stream.schema['key'].dataType.simpleString()}, {processor.out}",
        outputMode="append", timeMode="EventTime")


@contextmanager
def rocks_store(spark: SparkSession):
    """The state store these queries need, for the time of a run."""
    had = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if had is None else spark.conf.set(_STORE, had)


def replayed(rows: DataFrame, processor: InOrder, files: int = 8, per_batch: int = 3, lateness: str = "60 days") -> DataFrame:
    """Rows (key, id, event_time, values) of a table as a stream over
    ``files`` files, dealt by a hash of the id, read back from its sink.

    A file's rows are spread over the whole time, so the lateness allowed is
    the whole time too.  After the last file a row without a value, far ahead
    in time, moves the watermark past all rows."""
    spark = rows.sparkSession
    root = f"{ensure_checkpoint_dir(spark)}/streams/in-order-{uuid.uuid4().hex[:8]}"
    dealt = bucket(F.col("id").cast("string"), "files", files)
    rows.withColumn("__f", dealt).repartition(files, "__f").drop("__f").write.parquet(f"{root}/in")
    written = spark.read.parquet(f"{root}/in")
    kinds, end = {f.name: f.dataType for f in written.schema}, F.max("event_time")
    with rocks_store(spark):
        for closing in (False, True):
            if closing:
                last = written.agg(end.alias("event_time")).where("event_time IS NOT NULL").select(
                    *[(F.col(n) + F.expr(f"INTERVAL {lateness}") + F.expr("INTERVAL 1 DAY") if n == "event_time" else
                       F.lit(0 if n == "id" else None).cast(k)).alias(n) for n, k in kinds.items()])
                last.write.mode("append").parquet(f"{root}/in")
            s = spark.readStream.schema(written.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{root}/in")
            out = run_available_now(in_order(s, processor, lateness), "in-order", base=root)
    return out
