"""Several streams run apart from each other, each with its own retries and a record of every session."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Session:
    """One attempt to run a stream; times in microseconds, ``error`` null if it ended well."""

    stream: str
    session: str
    attempt: int
    started_us: int
    ended_us: int
    state: str
    error: str | None


SESSION = "stream string, session string, attempt int, started_us bigint, ended_us bigint, state string, error string"


def run(name: str, start: Callable[[], StreamingQuery], most_attempts: int = 3, wait: Callable[[int], float] = lambda n: min(60.0, 2.0 ** (n - 1)), drain_seconds: float | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time) -> list[Session]:
    """Run one stream to its end; after a failure it is started again from its checkpoint, up to ``most_attempts`` times.

    With ``drain_seconds`` a query that hasn't ended by then is stopped: DRAINED, its offsets are kept.
    """
    out = []
    for attempt in range(1, most_attempts + 1):
        began, state, error = clock(), "CLOSED", None
        try:
            query = start()
            ended = query.awaitTermination(drain_seconds) if drain_seconds is not None else (query.awaitTermination(), True)[1]
            if not ended:
                query.stop()
                state = "DRAINED"
        except Exception as e:
            state, error = "FAILED", f"{type(e).__name__}: {e}"[:500]
        out.append(Session(name, uuid.uuid4().hex, attempt, int(began * 1e6), int(clock() * 1e6), state, error))
        if state != "FAILED":
            break
        if attempt < most_attempts:
            sleep(wait(attempt))
    return out


def run_all(spark: SparkSession, streams: Mapping[str, Callable[[], StreamingQuery]], **options: object) -> DataFrame:
    """The sessions of all streams, run side by side; one that fails for good leaves the others alone."""
    found: dict[str, list[Session]] = {}

    def one(name: str) -> None:
        found[name] = run(name, streams[name], **options)

    threads = [threading.Thread(target=one, args=(name,), daemon=True) for name in streams]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return spark.createDataFrame([tuple(asdict(s).values()) for name in streams for s in found.get(name, [])], SESSION)
