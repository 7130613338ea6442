"""Thread-safe, compute-once attributes for per-session plan objects."""

from __future__ import annotations

import threading

LOCK = threading.RLock()


class once:
    """Like ``functools.cached_property``, but computed at most once even when
    several threads ask at the same time (landing writes must not race)."""

    def __init__(self, fn):
        self.fn = fn
        self.name = fn.__name__
        self.__doc__ = fn.__doc__

    def __set_name__(self, owner, name):
        self.name = name

    def __get__(self, obj, owner=None):
        if obj is None:
            return self
        if self.name in obj.__dict__:
            return obj.__dict__[self.name]
        with LOCK:
            if self.name not in obj.__dict__:
                obj.__dict__[self.name] = self.fn(obj)
        return obj.__dict__[self.name]
