"""Helpers that run inside Spark tasks. The module travels with the tasks by
value, so it imports nothing of the package."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle


def worker_state(key, make):
    """``make()`` once per Python worker, kept for its later tasks of the
    same kind; a task of another kind frees it, so caches of several
    operators never add up. Code that is shipped by value has fresh globals
    in every task, so the state lives in a module object of its own."""
    module = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state"))
    if getattr(module, "key", None) != key:
        module.state = None
        module.key, module.state = key, make()
    return module.state


def slices(batches, rows: int = 512):
    """Record batches cut to at most ``rows`` rows, which bounds what a task
    holds as Python objects."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
