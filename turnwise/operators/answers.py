"""Requests to a service from inside tasks: a log of answers, pace, retries, one client a task."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

# Requests are dealt by hash to so many parts of the log, whatever the number of tasks.
BUCKETS = 1024


@dataclass(frozen=True)
class PerTask:
    """A service whose client is made once in each task by ``make``."""

    make: Callable[[], Callable[[dict], dict]]


class BucketLog:
    """The answers to the requests of one bucket, in a folder that all tasks can open.

    Every answer is a line that is written as soon as it is there. A task that runs again
    reads what earlier ones wrote, also half-way ones; a line that was cut off does not count.
    """

    def __init__(self, root: str, bucket: int):
        from pyarrow import fs

        self.files, folder = fs.FileSystem.from_uri(root)
        self.folder, self.out, self.lock = f"{folder}/{bucket:04d}", None, threading.Lock()

    def read(self) -> dict[str, list]:
        from pyarrow import fs

        known = {}
        for file in self.files.get_file_info(fs.FileSelector(self.folder, allow_not_found=True)):
            with self.files.open_input_stream(file.path) as stream:
                for line in stream.read().splitlines():
                    try:
                        key, answer = json.loads(line)
                    except ValueError:
                        continue
                    known[key] = answer
        return known

    def add(self, key: str, answer: list) -> None:
        line = (json.dumps([key, answer]) + "\n").encode()
        with self.lock:
            if self.out is None:
                self.files.create_dir(self.folder, recursive=True)
                self.out = self.files.open_output_stream(f"{self.folder}/{uuid.uuid4().hex}")
            self.out.write(line)
            self.out.flush()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


class Pace:
    """At most so many requests a second, evenly spaced, over all threads of a task."""

    def __init__(self, per_second: float | None):
        self.gap, self.next, self.lock = 1 / per_second if per_second else 0.0, 0.0, threading.Lock()

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            self.next = max(now, self.next) + self.gap
            pause = self.next - self.gap - now
        if pause > 0:
            time.sleep(pause)


def ask_patiently(ask: Callable[[dict], dict], row: dict, pace: Pace, retries: int, backoff: float) -> dict:
    """The answer, asked again after a failure; pauses double, beginning with ``backoff`` seconds."""
    for attempt in range(retries + 1):
        pace.wait()
        try:
            return ask(row)
        except Exception:
            if attempt == retries:
                raise
            time.sleep(backoff * 2**attempt)
    raise AssertionError("not reached")
