"""Keep a set of named streaming queries alive."""

from __future__ import annotations

from collections.abc import Callable, Iterable

# Fixed value: text of the one source-metrics failure that is safe to restart after.
_TRANSIENT_MARKS = ("Cannot invoke", "Option.get")


def is_transient(error: Exception) -> bool:
    text = str(error)
    return all(mark in text for mark in _TRANSIENT_MARKS)


def supervise(streams, starters: dict[str, Callable[[], object]], poll_seconds: int = 30,
              transient: Callable[[Exception], bool] = is_transient,
              max_restarts: int | None = None) -> int:
    """Start the named queries, wait, and restart those that die of a transient error.

    ``streams`` is ``spark.streams``.  Any other error is raised, with the remaining queries
    stopped.  Returns the number of restarts once no query is active any more.
    """
    restarts = 0
    _start_missing(streams, starters, starters)
    while True:
        try:
            streams.awaitAnyTermination(poll_seconds)
            if not any(q.isActive for q in streams.active):
                return restarts
            # A query that ended cleanly would make every later wait return at once.
            streams.resetTerminated()
        except Exception as error:
            if not transient(error) or (max_restarts is not None and restarts >= max_restarts):
                for q in streams.active:
                    q.stop()
                raise
            streams.resetTerminated()
            restarts += _start_missing(streams, starters, starters)


def _start_missing(streams, starters: dict[str, Callable[[], object]],
                   names: Iterable[str]) -> int:
    alive = {q.name for q in streams.active if q.isActive}
    missing = [n for n in names if n not in alive]
    for name in missing:
        starters[name]()
    return len(missing)
