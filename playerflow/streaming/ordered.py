"""Keyed processing in event-time order, on the engine's own state store.

Rows of a key wait in list state until the watermark has passed them, and are
then handed to a fold one after the other, in the order of their time and
number; how they were spread over micro-batches does not matter. Rows that come
behind the watermark are not merged but told apart as late.

Each call to the store or to a timer costs far more than a row's fold, so keys
are dealt by hash into ``BUCKETS`` buckets, which share those calls. A bucket has
one timer, at the earliest thing to do for any of its keys: a waiting row, or the
moment at which the fold wants to be woken. A micro-batch so reads only buckets
that have rows in it or whose timer is due. Each key has its own state, time and order.

A fold is a small object with plain data as state (anything that JSON holds):
``step(state, us, seq, row)`` and ``tick(state, us)`` give the new state (None
forgets the key) and the rows to emit, ``wake(state)`` the next moment or None.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

State = Any
Rows = list[dict]

#: Fixed for good, as it is part of what a checkpoint holds.
BUCKETS = 8192


class Fold:
    def step(self, state: State, us: int, seq: int, row: dict) -> tuple[State, Rows]:
        raise NotImplementedError

    def wake(self, state: State) -> int | None:
        return None

    def tick(self, state: State, us: int) -> tuple[State, Rows]:
        return state, []


class InOrder(StatefulProcessor):
    """The keys of one bucket, each named by a text, with its own rows and state."""

    def __init__(self, fold: Fold, columns: Sequence[str]):
        self.fold, self.columns = fold, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # each element holds the rows of one batch: a list of key, us, seq and row
        self.waiting = handle.getListState("waiting", "rows string")
        self.state = handle.getListState("state", "key string, state string, wake bigint")
        self.alarm = handle.getValueState("alarm", "ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed, first = timerValues.getCurrentWatermarkInMs() * 1000, None
        for chunk in rows:
            fresh, late = [], []
            for name, us, seq, row in chunk[["key", "us", "seq", "row"]].itertuples(index=False, name=None):
                (late if us < passed else fresh).append((name, int(us), int(seq), row))
            if fresh:
                self.waiting.appendValue((json.dumps(fresh),))
                earliest = min(map(itemgetter(1), fresh))
                first = earliest if first is None else min(first, earliest)
            yield self._frame([(name, us, seq, True, row) for name, us, seq, row in late])
        if first is not None:
            self._set_alarm(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.alarm.clear()
        due, later = {}, []
        for (rows,) in self.waiting.get():
            for name, us, seq, row in json.loads(rows):
                due.setdefault(name, []).append((us, seq, row)) if us < passed else later.append((name, us, seq, row))
        states = {name: (state, wake) for name, state, wake in self.state.get()}
        for name, (_, wake) in states.items():
            if wake is not None and wake < passed:
                due.setdefault(name, [])
        out = []
        for name, rows in due.items():
            state = json.loads(states[name][0]) if name in states else None
            for us, seq, row in sorted(rows):
                state = self._ticks(state, us, out, name)
                state, made = self.fold.step(state, us, seq, json.loads(row))
                out += [(name, us, seq, False, json.dumps(m)) for m in made]
            state = self._ticks(state, passed, out, name)
            if state is None:
                states.pop(name, None)
            else:
                states[name] = (json.dumps(state), self.fold.wake(state))
        if any(due.values()):
            self.waiting.put([(json.dumps(later),)]) if later else self.waiting.clear()
        if due:
            self.state.put([(name, *kept) for name, kept in states.items()]) if states else self.state.clear()
        moments = [us for _, us, _, _ in later] + [wake for _, wake in states.values() if wake is not None]
        if moments:
            self._set_alarm(min(moments))
        yield self._frame(out)

    def _ticks(self, state: State, until: int, out: list, name: str) -> State:
        """Wakes the fold for all its moments before ``until``."""
        while state is not None and (moment := self.fold.wake(state)) is not None and moment < until:
            state, made = self.fold.tick(state, moment)
            out += [(name, moment, -1, False, json.dumps(m)) for m in made]
        return state

    def _set_alarm(self, us: int) -> None:
        """Moves the bucket's only timer forward, to the first watermark that has passed ``us``."""
        ms = us // 1000 + 1
        if self.alarm.exists():
            (before,) = self.alarm.get()
            if before <= ms:
                return
            self.handle.deleteTimer(before)
        self.handle.registerTimer(ms)
        self.alarm.update((ms,))

    def _frame(self, rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns)

    def close(self) -> None:
        pass


def in_order(stream: DataFrame, keys: Sequence[str], fold: Fold, out: str, columns: Sequence[str], delay: str | None = "0 seconds", time: str = "ts", seq: str = "seq") -> DataFrame:
    """keys, us, seq, late, and the fields of ``out`` (null for late rows); ``columns`` are what the fold sees of a row.

    With ``delay`` None the stream has its watermarks already.
    """
    marked = stream.withColumn(time, F.col(time).cast("timestamp"))
    marked = marked.withWatermark(time, delay) if delay is not None else marked
    # a computed time carries no watermark, so late rows reach the processor and are not dropped before
    rows = marked.select(
        F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("bucket"), F.to_json(F.struct(*keys)).alias("key"),
        F.unix_micros(time).alias("us"), F.col(seq).cast("bigint").alias("seq"), F.to_json(F.struct(*columns)).alias("row"))
    names = ["key", "us", "seq", "late", "out"]
    told = rows.groupBy("bucket").transformWithStateInPandas(InOrder(fold, names), "key string, us bigint, seq bigint, late boolean, out string", "Append", "EventTime")
    told = told.withColumn("__key", F.from_json("key", key_types(stream, keys))).withColumn("__out", F.from_json(F.when(~F.col("late"), F.col("out")), out))
    return told.select("__key.*", "us", "seq", "late", "__out.*")


def key_types(rows: DataFrame, keys: Sequence[str]) -> str:
    """The keys of a frame and their types, as a schema."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)


class Changes(Fold):
    """The last known value of each field; a row is told if it is the first or changes one of them."""

    def __init__(self, fields: Sequence[str]):
        self.fields = list(fields)

    def step(self, state, us, seq, row):
        merged = {f: row[f] if row.get(f) is not None else (state or {}).get(f) for f in self.fields}
        return merged, [] if merged == state else [merged]


class Merged(Changes):
    """The same values, told at every row."""

    def step(self, state, us, seq, row):
        merged, _ = super().step(state, us, seq, row)
        return merged, [merged]


class Forgetting(Fold):
    """A state with the time of its key's last row, which is forgotten ``days`` after it; kept for good with None."""

    def __init__(self, days: int | None = None):
        self.span = None if days is None else days * 86_400_000_000

    def wake(self, state):
        return None if self.span is None else state["us"] + self.span + 1

    def tick(self, state, us):
        return None, []


class BothSides(Forgetting):
    """The latest row of each side of a key, told whenever one side comes and both are known."""

    def __init__(self, sides: Sequence[str], days: int | None = None):
        super().__init__(days)
        self.sides = list(sides)

    def step(self, state, us, seq, row):
        known = {s: row[s] if row.get(s) is not None else (state or {}).get(s) for s in self.sides}
        return {**known, "us": us}, [known] if all(v is not None for v in known.values()) else []


class WatchedBets(Forgetting):
    """``placed`` on a bet's first sports bet before any wager, ``result`` once both sides are known."""

    def step(self, state, us, seq, row):
        before = state or {"sport": None, "settlement": None, "wagered": False}
        now = {k: row[k] if row.get(k) is not None else before[k] for k in ("sport", "settlement")}
        told = {"championship_id": (now["sport"] or {}).get("championship_id"), "bet_won_lost": None, "result_date": None}
        out = []
        if row.get("sport") is not None and before["sport"] is None and not before["wagered"]:
            out.append({**told, "kind": "placed"})
        if all(now.values()) and not (before["sport"] and before["settlement"]):
            settled = now["settlement"]
            out.append({**told, "kind": "result", "bet_won_lost": "lost" if settled.get("lost") else "won", "result_date": settled["wager_at"][:10]})
        return {**now, "wagered": before["wagered"] or row["is_wager"], "us": us}, out


class HoldUntilProfile(Fold):
    """Actions wait for the key's first profile row; what it releases is no longer held."""

    def step(self, state, us, seq, row):
        state = state or {"opened": False, "held": []}
        if not row["is_profile"]:
            if state["opened"]:
                return state, [{"action": seq, "released_by": seq}]
            state["held"].append(seq)
            return state, []
        released = [{"action": a, "released_by": seq} for a in state["held"]]
        return {"opened": True, "held": []}, released


class Upserts(Fold):
    """The table of a changelog: a row replaces the key's row, one marked ``deleted`` removes it.

    Each change of the table is told: ``op`` is insert, update or delete. A delete of
    a key that is not there changes nothing. A removed key leaves no state behind.
    """

    def step(self, state, us, seq, row):
        if row.get("deleted"):
            return None, [] if state is None else [{"op": "delete"}]
        return {**row, "seq": seq}, [{**row, "op": "insert" if state is None else "update"}]


def table_of(spark: SparkSession, checkpoint: str, keys: str, schema: str) -> DataFrame:
    """The folds' states after the last committed batch, read from the state store of a job of ``in_order``; ``keys`` as of ``key_types``."""
    stored = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "state").load()
    return stored.select(F.from_json("list_element.key", keys).alias("__key"), F.from_json("list_element.state", schema).alias("__row")).select("__key.*", "__row.*")


class Numbered(Fold):
    """How many rows of the key have come, and the number of the last one."""

    def step(self, state, us, seq, row):
        n, last = (state["n"] + 1, state["seq"]) if state else (1, None)
        return {"n": n, "seq": seq}, [{"n": n, "previous": last}]


class Dispatched(Fold):
    """The topic of each row and its number among the key's rows of all topics."""

    def step(self, state, us, seq, row):
        n = (state or 0) + 1
        return n, [{"topic": row["topic"], "n": n}]


class BetRetention(Fold):
    """A player's bets, cleared two days after registration, first bet or first result, and never filled again.

    Rows have ``reg_us``, ``bet_us`` and ``result_us``, each of which may be missing. When the list is
    cleared, the number of bets in it is told.
    """

    def __init__(self, days: int = 2):
        self.span = days * 86_400_000_000

    def step(self, state, us, seq, row):
        state = state or {"bets": [], "first": None, "cleared": False}
        if state["cleared"]:
            return state, []
        known = [x for x in (state["first"], row.get("reg_us"), row.get("bet_us"), row.get("result_us")) if x is not None]
        state["first"] = min(known) if known else None
        if row.get("bet_us") is not None:
            state["bets"].append(seq)
        return self.tick(state, us)

    def wake(self, state):
        return None if state["cleared"] or state["first"] is None else state["first"] + self.span + 1

    def tick(self, state, us):
        moment = self.wake(state)
        if moment is None or us < moment:
            return state, []
        return {"bets": [], "first": None, "cleared": True}, [{"kept": len(state["bets"])}]


# Comparators of the rules, current against base.
_COMPARE = {"more": lambda a, b: a > b, "less": lambda a, b: a < b, "equal": lambda a, b: a == b, "moreOrEqual": lambda a, b: a >= b, "lessOrEqual": lambda a, b: a <= b}


class LiveRequests(Fold):
    """Deposit rules against deposits, both as they come; a request ends when it fires or expires.

    Rows are requests (``request``: accept_uri, expires_us, expected, and rules with symbol, times,
    threshold, from_s, to_s) or deposits (``deposit``: second, cents, amount). Each rule keeps its
    count, sum and whether one deposit met it, so a deposit is looked at once. Deposits are kept
    for ``history_days``, for requests that are still to come; a window must not begin earlier.
    """

    def __init__(self, history_days: int = 62):
        self.history = history_days * 86_400

    def step(self, state, us, seq, row):
        state = state or {"deposits": [], "requests": {}}
        if row.get("deposit"):
            deposit = row["deposit"]
            state["deposits"].append(deposit)
            for request in state["requests"].values():
                self._add(request["rules"], deposit)
        else:
            request = row["request"]
            rules = [{**r, "n": 0, "cents": 0, "hit": False} for r in request["rules"]]
            for deposit in state["deposits"]:
                self._add(rules, deposit)
            state["requests"][str(seq)] = {**request, "rules": rules}
        fired = [i for i, r in state["requests"].items() if sum(map(self._met, r["rules"])) == r["expected"]]
        out = [{"request_id": int(i), "accept_uri": state["requests"].pop(i)["accept_uri"], "expired": False} for i in fired]
        return self._without_old(state, us), out

    @staticmethod
    def _add(rules, deposit):
        for r in rules:
            if r["from_s"] <= deposit["second"] <= r["to_s"]:
                r["n"] += 1
                r["cents"] += deposit["cents"]
                r["hit"] = r["hit"] or (r.get("times") is None and r.get("threshold") is not None and _COMPARE[r["symbol"]](deposit["amount"], r["threshold"]))

    @staticmethod
    def _met(rule):
        """A window without deposits never satisfies."""
        if rule["n"] == 0 or rule.get("times") is None:
            return rule["hit"]
        compare = _COMPARE[rule["symbol"]]
        return compare(rule["n"], rule["times"]) and (rule.get("threshold") is None or compare(rule["cents"] / 100, rule["threshold"]))

    def _without_old(self, state, us):
        oldest = us // 1_000_000 - self.history
        deposits = state["deposits"]
        if deposits and deposits[0]["second"] < oldest:
            state["deposits"] = [d for d in deposits if d["second"] >= oldest]
        return state

    def wake(self, state):
        """After the next expiry; without requests when the last deposit is too old for any."""
        moments = [r["expires_us"] + 1 for r in state["requests"].values()]
        if not moments and state["deposits"]:
            moments = [(max(d["second"] for d in state["deposits"]) + self.history + 1) * 1_000_000]
        return min(moments, default=None)

    def tick(self, state, us):
        gone = [i for i, r in state["requests"].items() if r["expires_us"] < us]
        out = [{"request_id": int(i), "accept_uri": state["requests"].pop(i)["accept_uri"], "expired": True} for i in gone]
        state = self._without_old(state, us)
        return (state if state["requests"] or state["deposits"] else None), out
