"""The window of calls: concurrency, back-pressure, retries, time limits, rate."""

import threading
import time

import pandas as pd

from lexiloom.operators.calls import Bucket, Calls


def frames(n, size, seen=None):
    for at in range(0, n, size):
        if seen is not None:
            seen.append(at)
        keys = [f"k{i}" for i in range(at, min(n, at + size))]
        yield pd.DataFrame({"key": keys, "prompt": [f"p {k}" for k in keys], "attempt": 1})


class Model:
    """Counts the calls in flight."""

    def __init__(self, seconds=0.01):
        self.seconds, self.lock, self.now, self.most, self.n = seconds, threading.Lock(), 0, 0, 0

    def __call__(self, prompt, settings):
        with self.lock:
            self.now, self.n = self.now + 1, self.n + 1
            self.most = max(self.most, self.now)
        time.sleep(self.seconds)
        with self.lock:
            self.now -= 1
        return {"text": prompt.upper(), "input_tokens": 2, "output_tokens": 3, "reasoning_tokens": 0, "total_tokens": 5}


def test_window_is_full_over_frames_and_bounded():
    model = Model()
    began = time.monotonic()
    out = pd.concat(list(Calls(model, workers=8, rows=10).run(frames(200, 3))))
    took = time.monotonic() - began
    assert sorted(out["key"]) == sorted(f"k{i}" for i in range(200)) and (out["text"] == "P " + out["key"].str.upper()).all()
    assert model.most == 8 and took < 200 * 0.01  # frames of 3 rows do not narrow the window


def test_requests_are_read_as_calls_end():
    model, seen = Model(0.005), []
    results = Calls(model, workers=4, rows=1).run(frames(1000, 10, seen))
    for _ in range(20):
        next(results)
    assert len(seen) * 10 <= 20 + 4 + 10 and model.n <= 20 + 4 + 1
    results.close()


def test_order_is_free():
    slow = lambda prompt, settings: time.sleep(0.3 if prompt == "p k0" else 0.0) or {"text": prompt}
    out = pd.concat(list(Calls(slow, workers=2).run(frames(20, 20))))
    assert out["key"].tolist()[-1] == "k0" and len(out) == 20 and out["input_tokens"].isna().all()


def test_retries_then_an_error_row():
    tries = {}

    def flaky(prompt, settings):
        tries[prompt] = tries.get(prompt, 0) + 1
        if prompt == "p k1" or tries[prompt] < 2:
            raise RuntimeError("busy")
        return {"text": "fine"}

    out = pd.concat(list(Calls(flaky, workers=3, retries=2, pause=0.01).run(frames(5, 2)))).set_index("key")
    assert tries["p k1"] == 3 and tries["p k0"] == 2
    assert out.loc["k1", "error"] == "RuntimeError: busy" and out.drop("k1")["error"].isna().all() and len(out) == 5


def test_time_limit_frees_the_place():
    hang = threading.Event()

    def model(prompt, settings):
        if prompt in ("p k0", "p k1"):
            hang.wait(20)
        return {"text": "fine"}

    began = time.monotonic()
    out = pd.concat(list(Calls(model, workers=2, retries=0, timeout=0.2).run(frames(30, 30)))).set_index("key")
    hang.set()
    assert time.monotonic() - began < 5 and out["text"].notna().sum() == 28 and out.loc["k0", "error"].startswith("TimeoutError")


def test_rate():
    clock = [0.0]
    bucket = Bucket(2.0, lambda: clock[0])
    assert [bucket.wait(), bucket.wait()] == [0.0, 0.0] and bucket.wait() == 0.5
    clock[0] = 0.5
    assert bucket.wait() == 0.0 and bucket.wait() > 0
    began = time.monotonic()
    list(Calls(Model(0), workers=8, rate=20.0).run(frames(30, 30)))
    assert 0.4 < time.monotonic() - began < 3


def test_settings_and_shares():
    seen = {}
    calls = Calls(lambda prompt, settings: seen.update(settings) or {"text": "x"}).configured("m", {"num_workers": 9, "num_retries": 1, "request_timeout": 5, "temperature": 0.7})
    assert (calls.workers, calls.retries, calls.timeout) == (9, 1, 5) and calls.share(4).workers == 2 and calls.share(20).workers == 1
    list(calls.run(frames(1, 1)))
    assert seen["model"] == "m" and seen["temperature"] == 0.7
    assert list(calls.run(iter([]))) == []
