"""Claims on units of work, shared by applications through files.

Whoever creates a unit's next attempt file owns the unit; creation is exclusive.
The owner keeps the file's time fresh while it works.  A claim whose file has not
been touched for ``lease`` seconds belongs to an application that died, and the
next attempt may be taken.
"""

from __future__ import annotations

import hashlib
import threading
import time

from pyspark.sql import SparkSession

from basketlens.sources.commits import create_exclusive, file_system

LEASE_SECONDS = 180.0


class Claims:
    def __init__(self, spark: SparkSession, path: str, lease: float = LEASE_SECONDS):
        self.spark, self.path, self.lease = spark, path, lease
        self._held: set[str] = set()
        self._lock = threading.Lock()
        self._stop = threading.Event()
        self._beat = threading.Thread(target=self._keep_fresh, daemon=True)

    def __enter__(self) -> Claims:
        self._beat.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._beat.join()

    def take(self, unit: str) -> str | None:
        """The claim's file, or None while somebody else holds the unit."""
        folder = f"{self.path}/{hashlib.sha1(unit.encode()).hexdigest()[:20]}"
        fs, jpath = file_system(self.spark, folder)
        attempts = {int(s.getPath().getName()): s.getModificationTime() / 1000
                    for s in (fs.listStatus(jpath) if fs.exists(jpath) else []) if s.getPath().getName().isdigit()}
        last = max(attempts, default=-1)
        if last >= 0 and time.time() - attempts[last] < self.lease:
            return None
        file = f"{folder}/{last + 1}"
        if not create_exclusive(self.spark, file, unit):
            return None
        with self._lock:
            self._held.add(file)
        return file

    def drop(self, file: str, done: bool) -> None:
        """Stop holding a claim.  The file of work that is done stays (the result
        shows it); one of failed work goes, so that the unit can be taken again."""
        with self._lock:
            self._held.discard(file)
        if not done:
            fs, jpath = file_system(self.spark, file)
            fs.delete(jpath, False)

    def _keep_fresh(self) -> None:
        while not self._stop.wait(self.lease / 4):
            with self._lock:
                held = list(self._held)
            for file in held:
                fs, jpath = file_system(self.spark, file)
                if fs.exists(jpath):
                    fs.setTimes(jpath, int(time.time() * 1000), -1)
