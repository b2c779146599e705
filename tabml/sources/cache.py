"""Tables that a query reads several times, held as long as its result.

``held`` persists a table. Inside ``releasing`` (every registered query is) the
table is noted under the result; when the result is gone and no other result
holds the same plan, the table is released at the next call of this module.
Nothing is called from the garbage collector itself, which may run inside
another call to Spark.
"""

from __future__ import annotations

import functools
import weakref
from collections import Counter, deque
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_scope: ContextVar[list | None] = ContextVar("held", default=None)
_count: Counter = Counter()
_gone: deque = deque()


def held(df: DataFrame) -> DataFrame:
    """``df`` persisted in memory, spilling to disk; lost blocks are computed again."""
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    frames = _scope.get()
    if frames is not None:
        key = (id(df.sparkSession._jsparkSession), df.semanticHash())
        _count[key] += 1
        frames.append((key, out))
    return out


def release() -> int:
    """Unpersist the tables whose results are gone; returns how many."""
    n = 0
    while _gone:
        key, df = _gone.popleft()
        _count[key] -= 1
        if _count[key] <= 0:
            del _count[key]
            if not df.sparkSession.sparkContext._jsc.sc().isStopped():
                df.unpersist()
                n += 1
    return n


def releasing(query):
    """A query whose held tables go when its result does."""
    @functools.wraps(query)
    def run(spark, sf_dir):
        release()
        token = _scope.set([])
        try:
            out = query(spark, sf_dir)
            frames = _scope.get()
        except BaseException:
            _gone.extend(_scope.get())
            raise
        finally:
            _scope.reset(token)
        if frames:
            weakref.finalize(out, _gone.extend, frames).atexit = False
        return out
    return run
