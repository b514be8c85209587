"""Rate limiting and retry as deterministic functions of event time, and over DataFrames.

State lives per host.  `limit_requests` replays a request log; the same state
object drives the streaming operator in `streaming.queue`.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.sources.work import checkpointed

#: Parts of host names that are asked less often, and how much.
CAREFUL = ((("google", "amazon", "microsoft"), 2.0), (("news", "blog", "wiki"), 1.5))


@dataclass
class Rate:
    per_second: float = 1.0
    burst: int = 5
    adaptive: bool = True
    min_delay: float = 0.5
    max_delay: float = 10.0
    jitter: float = 0.0  # share of the wait that is added


@dataclass
class Host:
    last: float = float("-inf")
    requests: int = 0
    failures: int = 0
    penalty_until: float = float("-inf")
    responses: int = 0
    errors: int = 0


@dataclass
class Limiter:
    """Token bucket with spacing, penalties and adaptation by host. Times are seconds."""

    rate: Rate = field(default_factory=Rate)
    now: float = 0.0
    tokens: float | None = None
    hosts: dict[str, Host] = field(default_factory=dict)
    recent: deque = field(default_factory=lambda: deque(maxlen=100))
    durations: deque = field(default_factory=lambda: deque(maxlen=100))

    def interval(self, host: str) -> float:
        factor = next((f for parts, f in CAREFUL if any(p in host.lower() for p in parts)), 1.0)
        known = self.hosts.get(host)
        return (factor * (1 + 0.5 * known.failures) if known else 1.0) / self.rate.per_second

    def acquire(self, now: float, host: str | None = None) -> float:
        """Seconds to wait; 0 is permission. No token is taken while the bucket holds less than one."""
        have = self.rate.burst if self.tokens is None else min(self.rate.burst, self.tokens + (now - self.now) * self.rate.per_second)
        self.tokens, self.now = have, now
        if have < 1:
            wait = min(max((1 - have) / self.rate.per_second, self.rate.min_delay), self.rate.max_delay)
            return wait * (1 + self.rate.jitter)
        self.tokens -= 1
        self.recent.append(now)
        if not host:
            return 0.0
        state = self.hosts.setdefault(host, Host())
        if now < state.penalty_until:
            return state.penalty_until - now
        if now - state.last < (gap := self.interval(host)):
            return gap - (now - state.last)
        state.last, state.requests = now, state.requests + 1
        return 0.0

    def current_rate(self, now: float) -> float:
        return sum(now - t < 60 for t in self.recent) / 60

    def adjust(self, target: float, now: float) -> None:
        if self.rate.adaptive:
            limit = min if target > self.current_rate(now) else max
            self.rate.per_second = limit(target, self.rate.per_second * (1.1 if limit is min else 0.9))

    def success(self, host: str) -> None:
        if host in self.hosts:
            self.hosts[host].failures = max(0, self.hosts[host].failures - 1)

    def failure(self, host: str, now: float, severe: bool = False) -> None:
        state = self.hosts.setdefault(host, Host())
        state.failures += 1
        if severe:
            state.penalty_until = now + min(300.0, 30.0 * 2**state.failures)

    def respond(self, host: str, now: float, seconds: float, ok: bool) -> None:
        """Record a response and adapt: slow ones and errors lower the rate, quick ones raise it."""
        self.durations.append((now, seconds))
        state = self.hosts.setdefault(host, Host())
        state.responses, state.errors = state.responses + 1, state.errors + (not ok)
        if not self.rate.adaptive:
            return
        window = [s for t, s in self.durations if now - t < 300]
        mean = sum(window) / len(window)
        if mean > 5 or mean < 1:
            self.adjust(self.rate.per_second * (0.8 if mean > 5 else 1.1), now)
        if state.errors > 0.1 * state.responses:
            self.adjust(self.rate.per_second * 0.7, now)
            self.failure(host, now, severe=True)


def limit_requests(log: DataFrame, rate: Rate | None = None) -> DataFrame:
    """log(host, ts, request_id) with `wait`: each host's requests replayed in time order by a limiter of its own.

    Hosts are independent groups; a group's rows stream through in sorted batches, only the state is held."""
    settings = rate or Rate()
    # one partition may hold many hosts; rows of a host are neighbours in time order
    spread = log.select("host", "request_id", F.col("ts").cast("double").alias("at")).repartition("host").sortWithinPartitions("host", "at", "request_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, limiter = None, None
        for batch in batches:
            waits = []
            for h, at in zip(batch["host"], batch["at"], strict=True):
                if limiter is None or h != host:
                    host, limiter = h, Limiter(Rate(**vars(settings)))
                waits.append(limiter.acquire(at, h))
            yield batch.assign(wait=waits)[["host", "request_id", "wait"]]

    kinds = dict(log.dtypes)
    return spread.mapInPandas(run, f"host {kinds['host']}, request_id {kinds['request_id']}, wait double")


def release_times(requests: DataFrame, gap: Column, host: str = "host", at: str = "at", order: str = "request_id") -> DataFrame:
    """requests with `release`: when each may be sent, `gap` after the one before it of its host, in order of (at, order).

    at and gap are whole numbers of one unit, gap one a host.  release(i) = max(at(i), release(i - 1) + gap)
    = i * gap + max over j <= i of (at(j) - j * gap), and maxima and counts of consecutive parts add up.  So
    rows are ranged by (host, at, order), a host with a third of all rows over many tasks; each part is
    scanned by itself, and only a row for each part of a host is brought together to carry on from."""
    n, best, part = (f"_{x}_{uuid.uuid4().hex}" for x in ("n", "best", "part"))
    ranged = checkpointed(requests.withColumn("_gap", gap.cast("long")).repartitionByRange(F.col(host), F.col(at), F.col(order)).withColumn(part, F.spark_partition_id()))
    inside = Window.partitionBy(part, host).orderBy(at, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = ranged.withColumn(n, F.count(F.lit(1)).over(inside)).withColumn(best, F.max(F.col(at) - F.col(n) * F.col("_gap")).over(inside))
    parts = ranged.select(part, host, at, order, "_gap").withColumn(n, F.count(F.lit(1)).over(inside)).groupBy(part, host, "_gap").agg(F.max(n).alias("_rows"), F.max(F.col(at) - F.col(n) * F.col("_gap")).alias("_most"))
    earlier = Window.partitionBy(host).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    placed = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    carried = placed.withColumn("_carry", F.max(F.col("_most") - F.col("_before") * F.col("_gap")).over(earlier)).select(F.col(part), F.col(host).alias("_host"), "_before", "_carry")
    joined = scanned.join(carried, (scanned[part] == carried[part]) & scanned[host].eqNullSafe(F.col("_host"))).drop(carried[part])
    release = (F.col("_before") + F.col(n)) * F.col("_gap") + F.greatest(F.col("_carry"), F.col(best) - F.col("_before") * F.col("_gap"))
    return joined.withColumn("release", release).drop(n, best, part, "_gap", "_host", "_before", "_carry")


def host_stats(log: DataFrame, now: Column, window: int = 60) -> DataFrame:
    """log(host, ts, ok): requests, failures, seconds since the last one, rate over the last `window` seconds."""
    age = now.cast("double") - F.col("ts").cast("double")
    return log.groupBy("host").agg(F.count(F.lit(1)).alias("request_count"), F.count(F.when(~F.col("ok"), 1)).alias("failure_count"), F.min(age).alias("last_request_ago"), (F.count(F.when(age < window, 1)) / window).alias("current_rate"))


#: Why a request is tried again, and by how much the delay then grows.
RETRY_FACTOR = {"rate_limited": 2.0, "server_error": 1.5, "network_error": 1.0, "timeout": 1.0, "temporary_failure": 1.0}


@dataclass(frozen=True)
class Retry:
    max_retries: int = 3
    base: float = 1.0
    longest: float = 60.0
    growth: float = 2.0
    strategy: str = "exponential"
    jitter: float = 0.0  # -1 to 1, in tenths of the delay


def retry_delay(attempt: int, reason: str | None = None, policy: Retry | None = None) -> float:
    """Seconds before attempt + 1; at least 0.1."""
    p = policy or Retry()
    grown = p.base * {"exponential": p.growth**attempt, "linear": attempt + 1}.get(p.strategy, 1)
    return max(0.1, min(grown, p.longest) * (1 + 0.1 * p.jitter) * RETRY_FACTOR.get(reason or "", 1.0))


def retry_reason(error: Exception) -> str:
    status = getattr(error, "status_code", None)
    if status == 429:
        return "rate_limited"
    if status is not None and 500 <= status < 600:
        return "server_error"
    return "timeout" if isinstance(error, TimeoutError) else "network_error" if isinstance(error, ConnectionError | OSError) else "temporary_failure"


def should_retry(error: Exception, attempt: int, policy: Retry | None = None) -> bool:
    if attempt >= (policy or Retry()).max_retries:
        return False
    status = getattr(error, "status_code", None)
    return isinstance(error, ConnectionError | TimeoutError | OSError) or (status is not None and (status == 429 or 500 <= status < 600))


def call_with_retry(call, policy: Retry | None = None, sleep=None, log: list | None = None):
    """call() until it succeeds or may not be tried again; log gets (attempt, outcome)."""
    import time

    attempt, events = 0, [] if log is None else log
    while True:
        try:
            result = call()
            events.append((attempt, "success"))
            return result
        except Exception as error:
            if not should_retry(error, attempt, policy):
                events.append((attempt, "failure"))
                raise
            events.append((attempt, "retry"))
            (sleep or time.sleep)(retry_delay(attempt, retry_reason(error), policy))
            attempt += 1


def retry_schedule(attempts: DataFrame, policy: Retry | None = None) -> DataFrame:
    """attempts(attempt, reason) with `delay`, as an expression."""
    p = policy or Retry()
    n = F.col("attempt")
    grown = {"exponential": p.base * F.pow(F.lit(p.growth), n), "linear": p.base * (n + 1)}.get(p.strategy, F.lit(p.base))
    factor = F.coalesce(F.create_map(*(F.lit(x) for kv in RETRY_FACTOR.items() for x in kv))[F.col("reason")], F.lit(1.0))
    return attempts.withColumn("delay", F.greatest(F.lit(0.1), F.least(grown, F.lit(p.longest)) * (1 + 0.1 * p.jitter) * factor))


def retry_stats(events: DataFrame) -> DataFrame:
    """events(func, outcome): attempts, retries, successes and failures of each function."""
    return events.groupBy("func").agg(F.count(F.lit(1)).alias("total_attempts"), *(F.count(F.when(F.col("outcome") == o, 1)).alias(c) for o, c in (("retry", "total_retries"), ("success", "success_count"), ("failure", "failure_count"))))
