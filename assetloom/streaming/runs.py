"""The open-run state machine as a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from assetloom.operators.events import (
    ASSET_FAILED,
    MATERIALIZED,
    PLANNED,
    RUN_ENDS,
    RUN_START,
    STEP_FAILURE,
    STEP_START,
    STEP_SUCCESS,
)

OUTPUT = "run_id string, asset string, end_id bigint, end_ts timestamp, end_type string, message string"
MESSAGE = "planned for the run, which ended before it was materialized"
IDLE, IDLE_MESSAGE = "IDLE", "planned for the run, which has been silent since"
SPANS = ("kind string, run_id string, run_no bigint, step_key string, span_no bigint, started timestamp, "
         "finished timestamp, outcome string, n_starts bigint")
# Fixed value: the provider Spark's arbitrary stateful operators need.
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Not taken from the session, as a stream that goes on from its checkpoint needs the same.
BUCKETS, SHARDS = 128, 8


class _Bucket(StatefulProcessor):
    """State of all runs of a bucket as two packed frames: ``runs``, a row per run with the last event seen and when the
    run counts as silent, and ``open``, what is open in them by row number of the run. Per batch a bucket with new events
    is read and written once, whatever its runs, and all its events are played together. One timer a bucket, at the
    earliest of these times, reports the runs silent by then and forgets them."""

    RUNS: pa.Schema
    OPEN: pa.Schema

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", "timer_at bigint, runs binary, open binary")

    def _load(self) -> tuple[int, pd.DataFrame, pd.DataFrame]:
        timer_at, *packed = self.state.get() or (-1, None, None)
        return timer_at, *(_unpacked(x, schema) for x, schema in zip(packed, (self.RUNS, self.OPEN)))

    def _store(self, timer_at: int, runs: pd.DataFrame, open_: pd.DataFrame) -> None:
        first = int(runs["idle_at"].min()) if len(runs) else -1
        if timer_at < 0 or not 0 <= timer_at <= first:  # a timer that is too early finds nothing and is set anew
            if timer_at >= 0:
                self.handle.deleteTimer(timer_at)
            if first >= 0:
                self.handle.registerTimer(first)
            timer_at = first
        if len(runs):
            self.state.update((timer_at, _packed(runs, self.RUNS), _packed(open_, self.OPEN)))
        else:
            self.state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        timer_at, runs, open_ = self._load()
        events = pd.concat(frames, ignore_index=True)
        events = events[events["event_id"].notna()].astype({"event_id": "int64", "ts": "datetime64[us]"})
        run, names = pd.factorize(pd.concat([runs["run_id"], events["run_id"]], ignore_index=True), use_na_sentinel=False)
        n_known = len(runs)
        runs = runs.reindex(range(len(names))).assign(run_id=[None if pd.isna(x) else x for x in names])
        runs = runs.astype({c: "int64" for c in ("event_id", "idle_at")} if n_known == len(names) else {})
        runs["event_id"] = runs["event_id"].fillna(-1).astype("int64")
        runs["idle_at"] = runs["idle_at"].fillna(-1).astype("int64")
        events = events.drop(columns="run_id").assign(run=run[n_known:])
        events = events[events["event_id"].to_numpy() > runs["event_id"].to_numpy()[events["run"]]]  # others were played before
        events = events.drop_duplicates(["run", "event_id"], keep="last")
        events = self._used(events.sort_values(["run", "event_id"], ignore_index=True), n_known)
        if not len(events):
            return
        out, runs, open_ = self._play(events, runs, open_)
        latest = events.groupby("run").agg(event_id=("event_id", "max"), ts=("ts", "max"))
        at = latest.index.to_numpy()
        now = latest["ts"].fillna(pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms"))
        now = now.astype("datetime64[ms]").astype("int64").to_numpy()
        held = runs["idle_at"].to_numpy()[at]
        runs.loc[at, "event_id"] = latest["event_id"].to_numpy()
        runs.loc[at, "idle_at"] = np.where(now + self.idle_ms <= held, held, now + self.idle_ms * 3 // 2)  # seldom moves
        if "ts" in runs:
            runs.loc[at, "ts"] = latest["ts"].to_numpy()
        known = runs["event_id"].to_numpy() >= 0
        self._store(timer_at, runs[known], open_.assign(run=(np.cumsum(known) - 1)[open_["run"].to_numpy(np.int64)]))
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, runs, open_ = self._load()
        upto = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        live = runs["idle_at"].to_numpy() >= upto
        stays = live[open_["run"].to_numpy()]
        out = self._silent(runs[~live], open_[~stays].join(runs, on="run", rsuffix="_of_run"))
        rest = open_[stays]
        self._store(-1, runs[live], rest.assign(run=(np.cumsum(live) - 1)[rest["run"].to_numpy()]))
        if len(out):
            yield out

    def _used(self, events: pd.DataFrame, n_known: int) -> pd.DataFrame:
        """The events that matter; runs numbered below ``n_known`` have state."""
        return events

    def _play(self, events, runs, open_) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
        """What comes out for events in order of run and id, and the new state."""
        raise NotImplementedError

    def _silent(self, runs: pd.DataFrame, open_: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> bytes:
    table = pa.Table.from_pandas(frame, schema, preserve_index=False).replace_schema_metadata()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(packed: bytes | None, schema: pa.Schema) -> pd.DataFrame:
    return (schema.empty_table() if packed is None else pa.ipc.open_stream(packed).read_all()).to_pandas()


class _Ends:
    """The ends among events in order of run and id, numbered over all runs. What comes before an end of its run, and
    after the one before, has the end's number."""

    def __init__(self, run: np.ndarray, is_end: np.ndarray):
        self.run, self.is_end = run, is_end
        self.before = np.concatenate([[0], np.cumsum(is_end)])
        self.run_of_end = run[is_end]

    def numbers(self) -> np.ndarray:
        """Of each event the number of the next end."""
        return self.before[:-1]

    def first(self, run: np.ndarray) -> np.ndarray:
        """The number that a run begins with."""
        return self.before[np.searchsorted(self.run, run)]

    def ended(self, run: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether that end is there and one of that run."""
        found = np.zeros(len(run), bool)
        there = number < len(self.run_of_end)
        found[there] = self.run_of_end[number[there]] == run[there]
        return found


class PendingAssets(_Bucket):
    """``open`` holds the assets still planned. A run's closing event reports them and clears them; for a run silent for
    ``idle_ms`` of event time the timer reports them, with the last event's id and time. A run without planned assets
    has no state before its first asset event."""

    RUNS = pa.schema([("run_id", pa.string()), ("event_id", pa.int64()), ("idle_at", pa.int64()), ("ts", pa.timestamp("us"))])
    OPEN = pa.schema([("run", pa.int64()), ("asset", pa.string())])

    def __init__(self, closing: Sequence[str], failing: Sequence[str], idle_ms: int):
        super().__init__(idle_ms)
        self.closing, self.failing = tuple(closing), tuple(failing)

    def _used(self, events, n_known):
        of_assets = events.loc[~events["event_type"].isin(self.closing), "run"].unique()
        return events[(events["run"] < n_known) | events["run"].isin(of_assets)].reset_index(drop=True)

    def _play(self, events, runs, open_):
        ends = _Ends(events["run"].to_numpy(), events["event_type"].isin(self.closing).to_numpy())
        new = events.assign(number=ends.numbers(), planned=events["event_type"] == PLANNED)[~ends.is_end]
        held = open_.assign(number=ends.first(open_["run"].to_numpy()), planned=True)
        columns = ["run", "number", "asset"]
        last = pd.concat([held[[*columns, "planned"]], new[[*columns, "planned"]]], ignore_index=True)
        last = last.drop_duplicates(columns, keep="last")
        last = last[last["planned"].astype(bool)]
        run, number = last["run"].to_numpy(np.int64), last["number"].to_numpy(np.int64)
        ended = ends.ended(run, number)
        end = events[ends.is_end].reset_index(drop=True).loc[number[ended]]
        out = pd.DataFrame({"run_id": runs["run_id"].to_numpy()[run[ended]], "asset": last["asset"].to_numpy()[ended],
                            "end_id": end["event_id"].to_numpy(), "end_ts": end["ts"].to_numpy(),
                            "end_type": end["event_type"].to_numpy(), "message": MESSAGE})
        return out[out["end_type"].isin(self.failing)], runs, last.loc[~ended, ["run", "asset"]]

    def _silent(self, runs, open_):
        return pd.DataFrame({"run_id": open_["run_id"], "asset": open_["asset"], "end_id": open_["event_id"],
                             "end_ts": open_["ts"], "end_type": IDLE, "message": IDLE_MESSAGE})


class RunSpans(_Bucket):
    """``runs`` also holds the number of the run's ends and when it started, ``open`` the steps seen since its last end
    (when started, how often, spans closed). A finish closes the step's span, the end of the run all that are open and
    the run; for a run silent for ``idle_ms`` of event time the timer reports what is open as idle."""

    RUNS = pa.schema([("run_id", pa.string()), ("event_id", pa.int64()), ("idle_at", pa.int64()), ("run_no", pa.int64()),
                      ("started", pa.timestamp("us"))])
    OPEN = pa.schema([("run", pa.int64()), ("step_key", pa.string()), ("started", pa.timestamp("us")),
                      ("n_starts", pa.int64()), ("span_no", pa.int64())])

    def _play(self, events, runs, open_):
        ends = _Ends(events["run"].to_numpy(), events["event_type"].isin(RUN_ENDS).to_numpy())
        runs = runs.assign(run_no=runs["run_no"].fillna(0).astype("int64"))
        events = events.assign(number=ends.numbers())
        begun = pd.DataFrame({"run": np.arange(len(runs)), "ts": runs["started"]})
        begun["number"] = ends.first(begun["run"].to_numpy())
        run_no = lambda run, number: runs["run_no"].to_numpy()[run] + number - begun["number"].to_numpy()[run]
        names = runs["run_id"].to_numpy()

        starts = events.loc[events["event_type"] == RUN_START, ["run", "ts", "number"]]
        begun_all = pd.concat([begun, starts], ignore_index=True).groupby(["run", "number"], as_index=False)["ts"].min()
        ended = ends.ended(begun_all["run"].to_numpy(), begun_all["number"].to_numpy())
        closed = events[ends.is_end & (events["shard"] == 0).to_numpy()].merge(
            begun_all[ended], "left", ["run", "number"], suffixes=("", "_started"))
        run, number = closed["run"].to_numpy(), closed["number"].to_numpy()
        out = [_spans("run", names[run], run_no(run, number), None, None, closed["ts_started"], closed["ts"],
                      closed["event_type"], None)]

        steps = events[~ends.is_end & (events["event_type"] != RUN_START).to_numpy()]
        done = (steps["event_type"] != STEP_START).to_numpy()
        steps = pd.DataFrame({
            "run": steps["run"], "number": steps["number"], "step_key": steps["step_key"], "done": done,
            "started": steps["ts"].mask(done), "n": (~done).astype("int64"), "base": 0, "ts": steps["ts"],
            "event_type": steps["event_type"]})
        held = pd.DataFrame({
            "run": open_["run"], "number": ends.first(open_["run"].to_numpy()), "step_key": open_["step_key"], "done": False,
            "started": open_["started"], "n": open_["n_starts"], "base": open_["span_no"], "ts": pd.NaT, "event_type": None})
        steps = steps if not len(held) else pd.concat([held.astype({"ts": "datetime64[us]"}), steps], ignore_index=True)
        by_step = steps.groupby(["run", "number", "step_key"], dropna=False, sort=False)
        steps = steps.assign(step=by_step.ngroup(), span_no=by_step["base"].transform("max") + by_step["done"].cumsum() -
                             steps["done"].astype("int64"))
        spans = steps.groupby(["step", "span_no"], sort=False).agg(started=("started", "min"), n=("n", "sum"))
        finished = steps[steps["done"].astype(bool)].drop(columns=["started", "n"]).join(spans, on=["step", "span_no"])
        run, number = finished["run"].to_numpy(), finished["number"].to_numpy()
        out.append(_spans("step", names[run], run_no(run, number), finished["step_key"], finished["span_no"],
                          finished["started"], finished["ts"], finished["event_type"], finished["n"]))

        last = steps.drop(columns=["started", "n"]).drop_duplicates("step", keep="last")
        last = last.assign(span_no=last["span_no"] + last["done"].astype("int64")).join(spans, on=["step", "span_no"])
        last = last.assign(n=last["n"].fillna(0).astype("int64"))
        run, number = last["run"].to_numpy(np.int64), last["number"].to_numpy(np.int64)
        over = ends.ended(run, number)
        left = over & (last["n"] > 0).to_numpy()
        some = last[left]
        out.append(_spans("step", names[run[left]], run_no(run[left], number[left]), some["step_key"], some["span_no"],
                          some["started"], None, None, some["n"]))
        open_ = last.loc[~over, ["run", "step_key", "started", "n", "span_no"]].rename(columns={"n": "n_starts"})

        runs["run_no"] += np.bincount(ends.run_of_end, minlength=len(runs))
        still = begun_all[~ended].set_index("run")["ts"].reindex(range(len(runs)))
        return _joined(out), runs.assign(started=still.to_numpy("datetime64[us]")), open_

    def _silent(self, runs, open_):
        steps, begun = open_[open_["n_starts"] > 0], runs[runs["started"].notna()]
        return _joined([
            _spans("step", steps["run_id"], steps["run_no"], steps["step_key"], steps["span_no"], steps["started"], None,
                   IDLE, steps["n_starts"]),
            _spans("run", begun["run_id"], begun["run_no"], None, None, begun["started"], None, IDLE, None)])


def _joined(frames: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat([f for f in frames if len(f)] or frames[:1], ignore_index=True)


def _spans(kind: str, run_id, *columns) -> pd.DataFrame:
    names = [c.split()[0] for c in SPANS.split(", ")]
    values = [x.to_numpy() if isinstance(x, pd.Series) else x for x in (run_id, *columns)]
    frame = pd.DataFrame(dict(zip(names, (kind, *values))), index=range(len(run_id)))
    times = {c: frame[c].astype("datetime64[us]") for c in ("started", "finished")}
    whole = {c: frame[c].astype("Int64") for c in ("run_no", "span_no", "n_starts")}
    return frame.assign(**times, **whole)


def _bucket(shard: str, buckets: int):
    """The bucket of a run's shard; shards of a run lie in different ones."""
    return F.pmod(F.pmod(F.xxhash64("run_id"), F.lit(buckets)) + F.col(shard), F.lit(buckets)).cast("int").alias("bucket")


def span_stream(log: DataFrame, idle: str = "7 days", late: str = "1 day", shards: int = 1,
                buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``operators.events.step_spans`` and ``run_spans`` (``kind`` tells them apart) for events that
    arrive in id order per run: a span comes out when it ends, or as ``IDLE`` when its run has been silent for
    ``idle`` to half as long again. With ``shards`` a run's steps are split into so many states, to each of which its
    ends go, for runs that hold a large part of the events; each state then judges by its own events whether the run
    is silent. Runs are dealt to ``buckets``, whose states are read and written whole: more of them suit more cores and
    more open runs than some millions. Shards and buckets stay as they are as long as the checkpoint is used."""
    shards = min(shards, buckets)
    kind = F.col("event_type")
    rows = log.withWatermark("ts", late).where(kind.isin(RUN_START, STEP_START, STEP_SUCCESS, STEP_FAILURE, *RUN_ENDS))
    own = F.array(F.pmod(F.xxhash64("step_key"), F.lit(shards)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    place = F.when(kind.isin(*RUN_ENDS), every).when(kind == RUN_START, F.array(F.lit(0))).otherwise(own)
    rows = rows.select("run_id", "event_id", "ts", "step_key", "event_type", F.explode(place).alias("shard"))
    return rows.select("*", _bucket("shard", buckets)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=RunSpans(int(pd.Timedelta(idle).total_seconds() * 1000)), outputStructType=SPANS,
        outputMode="append", timeMode="EventTime")


def missing_as_failed_stream(log: DataFrame, closing: Sequence[str] = RUN_ENDS, failing: Sequence[str] | None = None,
                             idle: str = "7 days", late: str = "1 day", shards: int = SHARDS,
                             buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``operators.events.missing_as_failed`` for events that arrive in id order
    per run. The session uses the RocksDB state store (``STATE_PROVIDER``).

    State is bounded by event time: rows later than ``late`` are left out (``late.split_late`` keeps and counts
    them), and of a run silent for ``idle`` to half as long again the assets still planned come out as ``IDLE``.
    Time moves on with the events used here, as Spark filters the others out first.
    A run is split by asset into ``shards`` states and its closing events go to each, so one run that holds most of
    the events is worked on by many tasks. Runs are dealt to ``buckets``, as in ``span_stream``.
    """
    failing, shards = tuple(closing if failing is None else failing), min(shards, buckets)
    kind = F.col("event_type")
    rows = log.withWatermark("ts", late).where(kind.isin(PLANNED, MATERIALIZED, ASSET_FAILED, *closing))
    own = F.array(F.pmod(F.xxhash64("asset"), F.lit(shards)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    rows = rows.select("run_id", "event_id", "ts", "asset", "event_type",
                       F.explode(F.when(kind.isin(*closing), every).otherwise(own)).alias("shard"))
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    return rows.select("*", _bucket("shard", buckets)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=PendingAssets(closing, failing, idle_ms), outputStructType=OUTPUT,
        outputMode="append", timeMode="EventTime",
    )
