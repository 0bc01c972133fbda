"""Delivery of messages to a sink that answers one by one, many of them in flight at a time.

Each partition sends its rows on an event loop of its own: a bounded number at
once, each with a time limit and a bounded number of attempts, with growing
pauses between them. What came of each message is a row; those that failed to
the end are the dead letters. Delivery is at least once, as a task whose
executor is lost sends its messages again: the receiver knows them by their id.
"""

from __future__ import annotations

import asyncio
from collections.abc import Awaitable, Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from playerflow.session import written

Send = Callable[[dict], Awaitable[None]]


def deliver_each(
    messages: DataFrame, connect: Callable[[], Send], key: str = "dedup_id",
    in_flight: int = 100, timeout_s: float = 1.0, attempts: int = 3, pause_s: float = 0.05,
) -> DataFrame:
    """``key``, delivered, attempts and error (the last one, null without) of each message, as a written table.

    ``connect`` runs once per partition, on the executor, and gives the coroutine function
    that sends one row; it must give way while it waits, or its time limit cannot end it.
    """

    async def one(send: Send, gate: asyncio.Semaphore, row: dict) -> tuple:
        async with gate:
            error = None
            for attempt in range(1, attempts + 1):
                try:
                    await asyncio.wait_for(send(row), timeout_s)
                    return row[key], True, attempt, error
                except Exception as failed:
                    error = type(failed).__name__
                if attempt < attempts:
                    await asyncio.sleep(pause_s * 2 ** (attempt - 1))
            return row[key], False, attempts, error

    async def many(send: Send, rows: list[dict]) -> list[tuple]:
        gate = asyncio.Semaphore(in_flight)
        return await asyncio.gather(*[one(send, gate, row) for row in rows])

    def part(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with asyncio.Runner() as loop:
            send = connect()
            for chunk in chunks:
                yield pd.DataFrame(loop.run(many(send, chunk.to_dict("records"))), columns=[key, "delivered", "attempts", "error"])

    kind = messages.schema[key].dataType.simpleString()
    # written, so that reading the outcome twice does not send twice
    return written(messages.mapInPandas(part, f"{key} {kind}, delivered boolean, attempts int, error string"), "delivery")


def dead_letters(messages: DataFrame, outcome: DataFrame, key: str = "dedup_id") -> DataFrame:
    """The messages that failed to the end, with the number of attempts and the last error."""
    return messages.join(outcome.filter("NOT delivered").select(key, "attempts", "error"), key)
