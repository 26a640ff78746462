"""Calls of single requests from within a task: a bounded window of calls in flight.

A task reads requests only as fast as calls end, whatever its batches hold, and
hands results on as they come, so its memory is that of the window.  Calls that
raise are tried again after a pause that doubles; a call that takes too long is
given up and its place is free again.
"""

from __future__ import annotations

import heapq
import queue
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from typing import Any

import pandas as pd

TOKENS = ("input_tokens", "output_tokens", "reasoning_tokens", "total_tokens")
COLUMNS = ["key", "text", "error", *TOKENS]


class Bucket:
    """Tokens that come at a rate, up to a second's worth (one at least); without a rate there is always one."""

    def __init__(self, rate: float | None, now: Callable[[], float] = time.monotonic):
        self.rate, self.now = rate, now
        self.size = max(1.0, rate or 1.0)
        self.held, self.at = self.size, now()

    def wait(self) -> float:
        """Take a token and return 0, or the seconds until there is one."""
        if not self.rate:
            return 0.0
        now = self.now()
        self.held, self.at = min(self.size, self.held + (now - self.at) * self.rate), now
        if self.held < 1:
            return (1 - self.held) / self.rate
        self.held -= 1
        return 0.0


@dataclass(frozen=True)
class Calls:
    """A backend that calls call(prompt, settings) for each request and gets a dict of text and token counts.

    At most `workers` calls are in flight over all tasks and `rate` calls a second
    begin; `retries` more tries follow one that raises or takes over `timeout`
    seconds, the first after `pause` seconds.  What the last try raises is an error
    row.  Threads of calls that were given up go on until the call returns; there
    are never more of those than workers.
    """

    call: Callable[[str, dict], dict]
    workers: int = 16
    retries: int = 3
    timeout: float = 600.0
    rate: float | None = None
    pause: float = 0.5
    #: Results in a frame.
    rows: int = 256
    settings: dict = field(default_factory=dict)

    def configured(self, model: str, settings: dict) -> Calls:
        """The same calls under a stage's settings."""
        own = {name: settings[key] for key, name in (("num_workers", "workers"), ("num_retries", "retries"), ("request_timeout", "timeout")) if settings.get(key) is not None}
        return replace(self, **own, settings={"model": model, **settings})

    def share(self, tasks: int) -> Calls:
        """The part of one of so many tasks."""
        return replace(self, workers=max(1, self.workers // tasks), rate=self.rate and self.rate / tasks)

    def run(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _Window(self).run(frames)


class _Window:
    """The calls in flight of one task."""

    def __init__(self, of: Calls):
        self.of, self.jobs, self.results = of, queue.SimpleQueue(), queue.SimpleQueue()
        self.flying: dict[int, tuple[Any, str, int, float]] = {}  # by number: key, prompt, tries before, time to give up
        self.again: list[tuple[float, int, Any, str, int]] = []  # waiting for another try, by time
        self.number, self.stuck, self.bucket = 0, set(), Bucket(of.rate)

    def _work(self) -> None:
        while (job := self.jobs.get()) is not None:
            number, prompt = job
            try:
                out, error = dict(self.of.call(prompt, self.of.settings)), None
            except Exception as e:  # noqa: BLE001  one failed call must not lose the others
                out, error = {}, f"{type(e).__name__}: {e}"[:500]
            self.results.put((number, out, error))

    def _begin(self, key: Any, prompt: str, tries: int) -> None:
        self.number += 1
        self.flying[self.number] = (key, prompt, tries, time.monotonic() + self.of.timeout)
        self.jobs.put((self.number, prompt))

    def _failed(self, key: Any, prompt: str, tries: int, error: str) -> dict | None:
        """The error row after the last try; before, the request waits for another."""
        if tries >= self.of.retries:
            return {"key": key, "error": error}
        self.number += 1
        heapq.heappush(self.again, (time.monotonic() + self.of.pause * 2**tries, self.number, key, prompt, tries + 1))
        return None

    def _fill(self, requests: Iterator[tuple[Any, str]], more: bool) -> tuple[bool, float]:
        """Begin calls while there is room; whether requests may be left, and the seconds until another call could begin."""
        while len(self.flying) < self.of.workers:
            due = self.again and self.again[0][0] <= time.monotonic()
            if not due and (not more or len(self.flying) + len(self.again) >= self.of.workers):
                return more, max(0.0, self.again[0][0] - time.monotonic()) if self.again else self.of.timeout
            if wait := self.bucket.wait():
                return more, wait
            if due:
                _, _, key, prompt, tries = heapq.heappop(self.again)
                self._begin(key, prompt, tries)
            elif (request := next(requests, None)) is None:
                more = False
            else:
                self._begin(*request, 0)
        return more, self.of.timeout

    def _ended(self, wait: float) -> list[dict]:
        """Rows of calls that ended or were given up, after at most so many seconds."""
        if self.flying:
            wait = min(wait, max(0.0, min(f[3] for f in self.flying.values()) - time.monotonic()))
        out = []
        try:
            number, got, error = self.results.get(timeout=max(wait, 0.001))
            if number in self.stuck:
                self.stuck.discard(number)
            elif number in self.flying:
                key, prompt, tries, _ = self.flying.pop(number)
                out.append({"key": key, **got} if error is None else self._failed(key, prompt, tries, error))
        except queue.Empty:
            pass
        now = time.monotonic()
        for number in [n for n, f in self.flying.items() if f[3] <= now]:
            key, prompt, tries, _ = self.flying.pop(number)
            if len(self.stuck) < self.of.workers:  # another thread takes the place of the one that hangs
                threading.Thread(target=self._work, daemon=True).start()
            self.stuck.add(number)
            out.append(self._failed(key, prompt, tries, f"TimeoutError: no answer in {self.of.timeout:g} seconds"))
        return [r for r in out if r]

    def run(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        requests = (pair for f in frames for pair in zip(f["key"], f["prompt"], strict=True))
        for _ in range(self.of.workers):
            threading.Thread(target=self._work, daemon=True).start()
        held, more = [], True
        try:
            while True:
                more, wait = self._fill(requests, more)
                if not more and not self.flying and not self.again:
                    break
                held += self._ended(wait)
                if len(held) >= self.of.rows:
                    yield self._frame(held)
                    held = []
            if held:
                yield self._frame(held)
        finally:
            for _ in range(2 * self.of.workers):
                self.jobs.put(None)

    @staticmethod
    def _frame(rows: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=COLUMNS)
        texts = {c: out[c].astype(object).where(out[c].notna(), None) for c in ("text", "error")}
        return out.assign(**texts).astype({t: "Int64" for t in TOKENS})
