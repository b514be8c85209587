"""Limits that adapt, and crawls that end, as state of a stream.

Two stateful processors over `transformWithState`, with timers of event time:

- `AdaptiveLimits`, by host: requests and their outcomes go in, the host's rate,
  failures, penalty and statistics come out.  Durations are a list of the last
  AVERAGED seconds; a penalty lapses by a timer, which sends a row.
- `CrawlStates`, by URL: events go in, the state comes out.  A crawl that no event
  ends within `patience` goes back to pending by a timer; a URL to which nothing
  happens for FORGOTTEN seconds leaves the state, which so stays bounded.

The rules are functions of (state, event), `adapted` and `moved`, which the
processors and `limits_of`, the same over a finished log, share: a stream and a
batch give equal rows.  All times are those of the events.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Seconds over which durations are averaged, slow and quick means, and what they and errors do to a rate.
AVERAGED = 300.0
SLOW, QUICK = 5.0, 1.0
SLOWER, QUICKER, ERRING, TOLERATED = 0.8, 1.1, 0.7, 0.1
#: A step moves the rate by a tenth at most.
STEP = 0.1
PENALTY, LONGEST_PENALTY = 30.0, 300.0
RECENT = 60.0
FORGOTTEN = 30 * 86_400.0

LIMITS = "host string, at double, rate double, requests long, errors long, failures long, penalty_until double, in_penalty boolean, recent_rate double"
COLUMNS = [c.split()[0] for c in LIMITS.split(", ")]
START = {"rate": 1.0, "requests": 0, "errors": 0, "failures": 0, "penalty_until": 0.0, "last": 0.0}


def limited(rate: float, target: float, measured: float) -> float:
    """rate moved towards target by a tenth at most, up if more than the measured rate is wanted, else down."""
    return min(target, rate * (1 + STEP)) if target > measured else max(target, rate * (1 - STEP))


def adapted(state: dict, recent: list[tuple[float, float]], at: float, seconds: float, ok: bool) -> tuple[dict, list[tuple[float, float]]]:
    """(state, durations of the last AVERAGED seconds) of a host after a response at a time."""
    recent = [(t, s) for t, s in recent if at - t < AVERAGED] + [(at, seconds)]
    new = state | {"requests": state["requests"] + 1, "errors": state["errors"] + (not ok), "last": at}
    measured = sum(at - t < RECENT for t, _ in recent) / RECENT
    mean = sum(s for _, s in recent) / len(recent)
    if mean > SLOW or mean < QUICK:
        new["rate"] = limited(new["rate"], new["rate"] * (SLOWER if mean > SLOW else QUICKER), measured)
    if ok:
        new["failures"] = max(0, new["failures"] - 1)
    if new["errors"] > TOLERATED * new["requests"]:
        new["rate"] = limited(new["rate"], new["rate"] * ERRING, measured)
        if not ok:
            new["failures"] += 1
            new["penalty_until"] = at + min(LONGEST_PENALTY, PENALTY * 2 ** new["failures"])
    return new, recent


def shown(host: str, state: dict, recent: list[tuple[float, float]], at: float) -> tuple:
    """A row of LIMITS."""
    return (
        host, at, round(state["rate"], 9), state["requests"], state["errors"], state["failures"], state["penalty_until"],
        at < state["penalty_until"], sum(at - t < RECENT for t, _ in recent) / RECENT,
    )


def _seconds(at: pd.Timestamp) -> float:
    return at.value / 1e9


def in_order(batches: Iterator[pd.DataFrame], *by: str) -> Iterator[tuple]:
    rows = list(batches)
    return pd.concat(rows).sort_values(list(by), kind="stable").itertuples() if rows else iter(())


class AdaptiveLimits(StatefulProcessor):
    """See adapted()."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.limits = handle.getValueState("limits", "rate double, requests long, errors long, failures long, penalty_until double, last double")
        self.durations = handle.getListState("durations", "at double, seconds double")

    def _state(self) -> dict:
        return dict(zip(START, self.limits.get(), strict=True)) if self.limits.exists() else dict(START)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state = self._state()
        recent = [(float(t), float(s)) for t, s in self.durations.get()] if self.durations.exists() else []
        for r in in_order(rows, "at"):
            state, recent = adapted(state, recent, _seconds(r.at), float(r.seconds), bool(r.ok))
        self.limits.update(tuple(state.values()))
        self.durations.put(recent)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if state["penalty_until"] > state["last"]:
            self.handle.registerTimer(int(state["penalty_until"] * 1000) + 1)
        yield pd.DataFrame([shown(key[0], state, recent, state["last"])], columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """The penalty has lapsed: the host is shown without it."""
        state = self._state()
        at = max(state["penalty_until"], state["last"])
        recent = [(float(t), float(s)) for t, s in self.durations.get() if at - float(t) < AVERAGED] if self.durations.exists() else []
        if recent:
            self.durations.put(recent)
        else:
            self.durations.clear()
        yield pd.DataFrame([shown(key[0], state, recent, at)], columns=COLUMNS)

    def close(self) -> None:
        pass


def adaptive_limits(responses: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Stream of responses(host, at, seconds, ok) to LIMITS rows: after each micro-batch, and when a penalty lapses."""
    timed = responses.select("host", "at", "seconds", "ok").withWatermark("at", delay)
    return timed.groupBy("host").transformWithStateInPandas(AdaptiveLimits(), LIMITS, "Append", "EventTime")


def limits_of(responses: DataFrame) -> DataFrame:
    """LIMITS of every host at the end of a finished log, one host's rows in time order after another's; only the state is held."""
    rows = responses.select("host", "at", "seconds", "ok").repartition("host").sortWithinPartitions("host", "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, state, recent, begun = None, dict(START), [], False
        for batch in batches:
            out = []
            for r in batch.itertuples():
                if not begun or r.host != host:
                    if begun:
                        out.append(shown(host, state, recent, state["last"]))
                    host, state, recent, begun = r.host, dict(START), [], True
                state, recent = adapted(state, recent, _seconds(r.at), float(r.seconds), bool(r.ok))
            yield pd.DataFrame(out, columns=COLUMNS)
        if begun:
            yield pd.DataFrame([shown(host, state, recent, state["last"])], columns=COLUMNS)

    return rows.mapInPandas(run, LIMITS)


URL_STATES = "url_id string, crawl_status string, crawl_attempts int, last_at timestamp, error_message string"
URL_COLUMNS = [c.split()[0] for c in URL_STATES.split(", ")]


def moved(state: tuple, status: str, error: str | None, at: datetime) -> tuple:
    """(status, attempts, last time, message) of a URL after an event."""
    _, attempts, last, message = state
    ended = status in ("completed", "crawled", "error")
    return status, attempts + (status == "crawling"), at if ended else last, error if status == "error" and error else message


class CrawlStates(StatefulProcessor):
    """See moved()."""

    def __init__(self, patience: float):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "status string, attempts int, last timestamp, message string")

    def _wake(self, at: datetime, seconds: float) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(((at - datetime(1970, 1, 1)).total_seconds() + seconds) * 1000))

    def _row(self, key: tuple, state: tuple) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *state)], columns=URL_COLUMNS).astype({"last_at": "datetime64[ns]"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state, at = tuple(self.state.get()) if self.state.exists() else ("pending", 0, None, None), None
        for r in in_order(rows, "at"):
            at = r.at.to_pydatetime()
            state = moved(state, r.status, r.error, at)
        self.state.update(state)
        if at is not None:
            self._wake(at, self.patience if state[0] == "crawling" else FORGOTTEN)
        yield self._row(key, state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """A crawl that nothing ended: the URL waits again, its attempt counted."""
        state = tuple(self.state.get())
        if state[0] == "crawling":
            state = ("pending", *state[1:])
            self.state.update(state)
            self._wake(datetime.fromtimestamp(expiredTimerInfo.getExpiryTimeInMs() / 1000, UTC).replace(tzinfo=None), FORGOTTEN)
            yield self._row(key, state)
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def crawl_states(events: DataFrame, patience: float = 600.0, delay: str = "1 minute") -> DataFrame:
    """Stream of events(url_id, status, error, at) to URL_STATES rows: after each micro-batch, and when a crawl is given up.

    The state store must be RocksDB (see `needed`)."""
    timed = events.select("url_id", "status", "error", "at").withWatermark("at", delay)
    return timed.groupBy("url_id").transformWithStateInPandas(CrawlStates(patience), URL_STATES, "Append", "EventTime")


#: The setting that transformWithState needs.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def needed(spark) -> None:
    spark.conf.set(*PROVIDER)


def penalties(limits: DataFrame) -> DataFrame:
    """Hosts with a penalty, of the latest row of each: how long it lasts, failures, share of errors."""
    latest = limits.groupBy("host").agg(F.max_by(F.struct(*COLUMNS[1:]), "at").alias("l")).select("host", "l.*")
    return latest.where("in_penalty").select("host", "failures", (F.col("penalty_until") - F.col("at")).alias("penalty_left"), (F.col("errors") / F.col("requests")).alias("error_share"))
