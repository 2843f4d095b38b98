"""Keep a streaming query running across failures."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

RESTART_DELAY_SECONDS = 10.0


def run_until_done(
    start: Callable[[], StreamingQuery], delay: float = RESTART_DELAY_SECONDS, max_restarts: int | None = None
) -> int:
    """Start a query and start it again from its checkpoint whenever it fails; gives the restarts.

    Ends when the query ends by itself or is stopped. With ``max_restarts`` the last failure is raised.
    """
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException:
            if max_restarts is not None and restarts >= max_restarts:
                raise
            restarts += 1
            time.sleep(delay)
