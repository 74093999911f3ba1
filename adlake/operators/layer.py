"""Lazy name -> DataFrame mapping for a layer."""

from __future__ import annotations

import threading


class LazyLayer(dict):
    """name -> DataFrame mapping that builds each table on first access.

    Safe to read from several threads: each name is built once, under its own
    lock (layers depend on each other acyclically, so per-name locks cannot
    deadlock).
    """

    def __init__(self, build, names):
        super().__init__()
        self._build, self._names = build, tuple(names)
        self._guard = threading.Lock()
        self._locks: dict[str, threading.Lock] = {}

    def __contains__(self, key) -> bool:
        return key in self._names or dict.__contains__(self, key)

    def __missing__(self, key):
        if key not in self._names:
            raise KeyError(key)
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if dict.__contains__(self, key):
                return dict.__getitem__(self, key)
            df = self._build(key)
            self[key] = df
            return df

    def names(self):
        return self._names


def prefetch(layer, names, workers: int = 8) -> None:
    """Build several tables' plans concurrently (driver-side analysis overlaps)."""
    from concurrent.futures import ThreadPoolExecutor

    todo = [n for n in names if not dict.__contains__(layer, n)]
    if len(todo) > 1:
        with ThreadPoolExecutor(max_workers=min(workers, len(todo))) as pool:
            list(pool.map(lambda n: layer[n], todo))
