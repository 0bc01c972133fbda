"""Deposit rules over time windows.

A rule asks for count, sum, or a single matching deposit of one player inside
``[from, to]``. Deposits are rolled up at four grains (day, hour, minute,
second), and each window is cut into the whole buckets that cover it exactly:
days inside, hours towards the ends, then minutes, then seconds. A window of at
most 31 days needs at most about 320 buckets, however many deposits lie in it,
and the join key ``(player, grain, bucket)`` spreads a player over many tasks.
All players take this one way, so the answer does not depend on their size.
A window is first cut into its days, and only days with deposits are covered.

Rules and buckets multiply after they are read or shuffled, which no size
estimate knows of, so their joins are merges and never broadcast.

Thresholds of single deposits are compared with the exact amounts, sums are
money with two decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerflow.functions.text import starts_with_ci
from playerflow.functions.times import TTL_MONTHS, TTL_SECONDS, add_ttl, parse_whole_second
from playerflow.session import written

GRAINS = (86400, 3600, 60, 1)
MAX_DAYS = 30
PLAYER = ("player_id",)

# Comparator names and their short forms.
SYMBOLS = {"less": "less", "<": "less", "more": "more", ">": "more", "equal": "equal", "moreOrEqual": "moreOrEqual", "lessOrEqual": "lessOrEqual"}
URI_PATTERN = r"^(https?|ftp|file|jar|mailto):\S+$"


def valid_deposits(df: DataFrame, kind="transaction_type", status="transaction_status", time="dt", ident="transaction_id", amount="amount") -> DataFrame:
    """Completed deposits with an id, an amount and a readable time, which becomes ``second``."""
    second = F.unix_seconds(parse_whole_second(F.col(time)))
    return (
        df.filter(starts_with_ci(F.col(kind), "deposit-") & starts_with_ci(F.col(status), "complete"))
        .filter(F.col("player_id").isNotNull() & F.col(ident).isNotNull() & F.col(amount).isNotNull())
        .withColumn("second", second)
        .filter(F.col("second").isNotNull())
    )


def compare(symbol: Column, base: Column, current: Column, legacy_less: bool = False) -> Column:
    """``current`` against ``base``. ``legacy_less`` reads ``less`` as greater than."""
    less = current > base if legacy_less else current < base
    return (
        F.when(symbol == "more", current > base)
        .when(symbol == "less", less)
        .when(symbol == "equal", current == base)
        .when(symbol == "moreOrEqual", current >= base)
        .when(symbol == "lessOrEqual", current <= base)
        .otherwise(F.lit(False))
    )


def judged(requests: DataFrame) -> DataFrame:
    """Requests with expires_at, expected (the number of rules) and the reason for which one is rejected, else null.

    A missing ``from`` is the request time, a missing ``to`` that time plus the ttl; the rules have both.
    """
    expiry = add_ttl(F.col("requested_at"), F.col("ttl"), F.col("ttl_unit"))
    rows = requests.withColumn("expires_at", expiry).withColumn("expected", F.size("rules"))
    start = lambda r: F.coalesce(r["from_ts"], F.col("requested_at"))
    end = lambda r: F.coalesce(r["to_ts"], F.col("expires_at"))
    days = lambda r: F.floor((F.unix_micros(end(r)) - F.unix_micros(start(r))) / F.lit(86_400_000_000))
    units = [*TTL_MONTHS, *TTL_SECONDS]
    reason = (
        F.when(~F.coalesce(F.upper("ttl_unit").isin(units), F.lit(False)), "unit")
        .when(~F.coalesce(F.col("accept_uri").rlike(URI_PATTERN), F.lit(False)), "uri")
        .when(F.exists("rules", lambda r: start(r) > end(r)), "window")
        .when(F.exists("rules", lambda r: days(r) > MAX_DAYS), "too_long")
    )
    symbols = F.create_map(*[F.lit(x) for pair in SYMBOLS.items() for x in pair])
    filled = F.transform("rules", lambda r: F.struct(
        r["kind"].alias("kind"), symbols[r["symbol"]].alias("symbol"), r["times"].alias("times"), r["amount"].alias("amount"),
        start(r).alias("from_ts"), end(r).alias("to_ts"), r["sports"].alias("sports")))
    return rows.withColumn("reason", reason).withColumn("rules", filled)


def normalise(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests to one row per rule, and the rejected requests with a reason.

    Columns: request_id, player_id, accept_uri, requested_at, ttl,
    ttl_unit, rules (array of kind, symbol, times, amount, from_ts, to_ts, sports).
    """
    rows = judged(requests)
    accepted = rows.filter(F.col("reason").isNull()).select(
        "request_id", "player_id", "accept_uri", "requested_at", "expires_at", "expected", F.posexplode("rules").alias("rule_no", "r")
    )
    return accepted.select(*[c for c in accepted.columns if c != "r"], "r.*"), rows.filter(F.col("reason").isNotNull()).select("request_id", "reason")


def live_rows(requests: DataFrame, deposits: DataFrame, time: str = "ts", seq: str = "seq") -> DataFrame:
    """Accepted requests and valid deposits as rows of one stream: player_id, ts, seq, request, deposit.

    Requests have request_id and requested_at; a request without rules, or with a rule of another kind, never fires.
    """
    rule = lambda r: F.struct(
        r["symbol"].alias("symbol"), r["times"].alias("times"), r["amount"].cast("double").alias("threshold"),
        F.unix_seconds(r["from_ts"]).alias("from_s"), F.unix_seconds(r["to_ts"]).alias("to_s"))
    request = F.struct("accept_uri", F.unix_micros("expires_at").alias("expires_us"), "expected", F.transform(F.filter("rules", lambda r: r["kind"] == "deposit"), rule).alias("rules"))
    deposit = F.struct("second", F.col("amount").cast("double").alias("amount"), (F.col("amount").cast("decimal(18,2)") * 100).cast("bigint").alias("cents"))
    asked = judged(requests).filter(F.col("reason").isNull() & (F.col("expected") > 0))
    asked = asked.select("player_id", F.col("requested_at").alias("ts"), F.col("request_id").cast("bigint").alias("seq"), request.alias("request"))
    paid = deposits.select("player_id", F.col(time).cast("timestamp").alias("ts"), F.col(seq).cast("bigint").alias("seq"), deposit.alias("deposit"))
    return asked.unionByName(paid, allowMissingColumns=True)


ANY_LEVEL = "any"
RULE = ("request_id", "rule_no")


def _level(amount: Column) -> Column:
    """The exact amount as text; minus zero is zero."""
    return (amount.cast("double") + F.lit(0.0)).cast("string")


def rollups(deposits: DataFrame, keys: Sequence[str], exact: DataFrame | None = None) -> DataFrame:
    """Count, sum, smallest and largest amount per key, bucket and grain.

    One aggregation with partial sums before its shuffle. The level is ``any``;
    the amounts that ``exact`` names (distinct keys and level) have cells of
    their own besides, as extremes cannot decide ``equal``.
    """
    rows = deposits.select(*keys, "second", "amount")
    levels = F.array(F.lit(ANY_LEVEL))
    if exact is not None:
        rows = rows.withColumn("level", _level(F.col("amount"))).join(exact.withColumn("__named", F.lit(True)).hint("merge"), [*keys, "level"], "left")
        levels = F.when(F.col("__named"), F.array(F.lit(ANY_LEVEL), F.col("level"))).otherwise(levels)
    bucket = lambda grain: F.floor(F.col("second") / F.lit(grain)) * F.lit(grain)
    cells = F.array(*[F.struct(F.lit(grain).alias("grain"), bucket(grain).alias("bucket")) for grain in GRAINS])
    rows = rows.select(*keys, "second", "amount", F.explode(levels).alias("level")).select(*keys, "amount", "level", F.explode(cells).alias("c"))
    return rows.groupBy(*keys, "c.grain", "c.bucket", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("total"),
        F.min("amount").alias("low"), F.max("amount").alias("high"),
    )


def cover(rules: DataFrame) -> DataFrame:
    """One row per rule and whole bucket of its window, both ends inclusive at whole seconds."""
    a, b = F.unix_seconds("from_ts"), F.unix_seconds("to_ts") + F.lit(1)
    up = lambda x, g: F.ceil(x / F.lit(g)) * F.lit(g)
    down = lambda x, g: F.floor(x / F.lit(g)) * F.lit(g)

    def steps(first, stop, grain):
        filled = F.sequence(first, stop - F.lit(grain), F.lit(grain).cast("bigint"))
        return F.when(first < stop, filled).otherwise(F.array().cast("array<bigint>"))

    def cells(starts, grain):
        return F.transform(starts, lambda s: F.struct(F.lit(grain).alias("grain"), s.alias("bucket")))

    first, stop = up(a, GRAINS[0]), down(b, GRAINS[0])
    parts = [cells(steps(first, stop, GRAINS[0]), GRAINS[0])]
    for outer, grain in zip(GRAINS, GRAINS[1:]):
        first, stop = up(a, grain), down(b, grain)
        turn = F.least(up(a, outer), stop)  # all that is left of a window inside one outer bucket lies before it
        left, right = steps(first, turn, grain), steps(F.greatest(down(b, outer), turn), stop, grain)
        parts.append(cells(F.concat(left, right), grain))
    return rules.select("*", F.explode(F.concat(*parts)).alias("__b")).select("*", "__b.grain", "__b.bucket").drop("__b")


def _on_days(rules: DataFrame, rolled: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per rule and day of its window on which there are deposits, with the window's part of that day.

    A window without an end stays without one on its first day, of which ``cover`` takes the rest.
    """
    day = GRAINS[0]
    midnight = lambda c: F.floor(F.unix_seconds(c) / F.lit(day)) * F.lit(day)
    until = F.coalesce("to_ts", "from_ts")
    days = F.when(F.unix_seconds("from_ts") <= F.unix_seconds(until), F.sequence(midnight("from_ts"), midnight(until), F.lit(day).cast("bigint")))
    there = rolled.filter(F.col("grain") == day).select(*on, F.col("bucket").alias("__day"))
    rows = rules.withColumn("__day", F.explode(days)).join(there.hint("merge"), [*on, "__day"], "left_semi")
    start, end = F.timestamp_seconds("__day"), F.timestamp_seconds(F.col("__day") + F.lit(day - 1))
    return rows.withColumn("from_ts", F.greatest("from_ts", start)).withColumn("to_ts", F.when(F.col("to_ts").isNotNull(), F.least("to_ts", end))).select(*rules.columns)


def _covered(rules: DataFrame, rolled: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per rule and bucket with deposits inside its window."""
    # A rule becomes many buckets: rules are dealt first, however small their table looks.
    parts = int(rules.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cover(_on_days(rules.repartition(parts, *RULE), rolled, on)).join(rolled.hint("merge"), [*on, "grain", "bucket"])


def _may_match(legacy_less: bool) -> Column:
    """Whether some deposit of a bucket meets the threshold: its extremes decide."""
    largest = F.col("symbol").isin("more", "moreOrEqual")
    if legacy_less:
        largest = largest | (F.col("symbol") == "less")
    return compare(F.col("symbol"), F.col("threshold"), F.when(largest, F.col("high")).otherwise(F.col("low")), legacy_less)


# A bucket and its grain as one number that sorts by bucket: a primitive minimum aggregates by hash.
_PACK = 1_000_000


def _pack() -> Column:
    return F.col("bucket") * F.lit(_PACK) + F.col("grain")


def _unpacked(hit: str) -> list[Column]:
    return [
        F.floor(F.col(hit) / F.lit(_PACK)).cast("bigint").alias("bucket"), F.pmod(F.col(hit), F.lit(_PACK)).cast("int").alias("grain")
    ]


def _first_matching_second(hits: DataFrame, rolled: DataFrame, keys, legacy_less: bool) -> DataFrame:
    """Narrow each rule's earliest matching bucket to a second; a step looks at 60 children at most."""
    carried = [*RULE, *keys, "symbol", "threshold", "level"]
    best = hits
    for outer, grain in zip(GRAINS, GRAINS[1:]):
        # Each bucket under its parent; those that are finer already stay as they are.
        parent = F.struct(F.lit(outer).alias("grain"), (F.floor(F.col("bucket") / F.lit(outer)) * F.lit(outer)).alias("bucket"))
        places = F.array_compact(F.array(F.struct("grain", "bucket"), F.when(F.col("grain") == grain, parent)))
        children = rolled.filter(F.col("grain") <= grain).select(*keys, "level", "low", "high", _pack().alias("child"), F.explode(places).alias("p"))
        children = children.select(*keys, "level", "p.*", "low", "high", "child")
        best = (
            best.join(children.hint("merge"), [*keys, "level", "grain", "bucket"]).filter(_may_match(legacy_less))
            .groupBy(*carried).agg(F.min("child").alias("hit"))
            .select(*carried, *_unpacked("hit"))
        )
    return best.select(*carried, F.col("bucket").alias("second"))


def summarise(
    rules: DataFrame, deposits: DataFrame, legacy_less: bool = False, order: str = "transaction_id", keys: Sequence[str] = PLAYER,
) -> DataFrame:
    """Per rule with deposits in its window: their count, sum, and the first one that meets the threshold.

    ``rules`` needs symbol, times, threshold and the window, ``deposits`` the
    second, the amount and ``order``.
    """
    lean = rules.select(*dict.fromkeys([*RULE, *keys, "symbol", "times", "threshold", "from_ts", "to_ts"]))
    # Every rule looks at all amounts; a single ``equal`` rule also at the one it names.
    one_amount = F.col("times").isNull() & (F.col("symbol") == "equal")
    levels = F.array_compact(F.array(F.lit(ANY_LEVEL), F.when(one_amount, _level(F.col("threshold")))))
    named = lean.filter(one_amount).select(*keys, _level(F.col("threshold")).alias("level")).distinct()
    # Both tables are read several times below, so each is written once.
    rolled = written(rollups(deposits, keys, named), "rollups")
    cells = _covered(lean.withColumn("level", F.explode(levels)), rolled, [*keys, "level"])
    carried = [*RULE, *keys, "symbol", "threshold", "level"]
    decisive = F.col("times").isNull() & ((F.col("symbol") != "equal") | (F.col("level") != ANY_LEVEL))
    summed = cells.groupBy(*carried, "times").agg(
        F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"),
        F.min(F.when(decisive & _may_match(legacy_less), _pack())).alias("hit"),
    )
    totals = written(summed, "rule-totals")
    hits = totals.filter(F.col("hit").isNotNull()).select(*carried, *_unpacked("hit"))
    seconds = written(_first_matching_second(hits, rolled, keys, legacy_less), "rule-seconds")
    # Few seconds decide a rule: only their deposits are grouped.
    decisive_deposits = deposits.join(seconds.select(*keys, "second").distinct().hint("merge"), [*keys, "second"], "left_semi")
    distinct = decisive_deposits.groupBy(*keys, "second", "amount").agg(F.min(order).alias("__first"))
    first = (
        seconds.join(distinct.hint("merge"), [*keys, "second"])
        .filter(compare(F.col("symbol"), F.col("threshold"), F.col("amount"), legacy_less))
        .groupBy(*RULE).agg(F.min_by("amount", F.struct("__first", "amount")).alias("first_amount"))
    )
    return totals.filter(F.col("level") == ANY_LEVEL).select(*RULE, "n", "total").join(first.hint("merge"), list(RULE), "left")


def window_totals(rules: DataFrame, rolled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count and sum per rule from rolled-up rows, which may be finer than ``keys``."""
    cells = _covered(rules.select(*RULE, *keys, "from_ts", "to_ts"), rolled, keys)
    return cells.groupBy(*RULE).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def with_threshold(rules: DataFrame) -> DataFrame:
    return rules.withColumn("threshold", F.col("amount").cast("double")).drop("amount")


def evaluate(rules: DataFrame, deposits: DataFrame, legacy_less: bool = False) -> DataFrame:
    """Requests whose satisfied deposit rules number as many as all their rules.

    A rule with ``times`` compares the in-window count and, if it names an
    amount, the sum. A rule without needs one deposit that satisfies it alone.
    A window without deposits never satisfies. The amount reported is that of
    the first such single rule.
    """
    # Windows, named amounts and texts each read the rules.
    parsed = written(with_threshold(rules.filter(F.col("kind") == "deposit")), "rules")
    texts = parsed.select(*RULE, "player_id", "accept_uri", "expected", "symbol", "times", "threshold")
    facts = summarise(parsed, deposits, legacy_less).join(texts.hint("merge"), list(RULE))
    total_met = F.col("threshold").isNull() | compare(F.col("symbol"), F.col("threshold"), F.col("total"), legacy_less)
    counted = compare(F.col("symbol"), F.col("times"), F.col("n"), legacy_less) & total_met
    single = F.col("times").isNull()
    met = F.when(single, F.col("first_amount").isNotNull()).otherwise(counted)
    paid = F.when(single, F.col("first_amount"))
    return (
        facts.filter(met)
        .groupBy("request_id", "player_id", "accept_uri", "expected")
        .agg(F.count(F.lit(1)).alias("met"), F.min_by(paid, F.when(paid.isNotNull(), F.col("rule_no"))).alias("amount"))
        .filter(F.col("met") == F.col("expected"))
        .select("request_id", "player_id", "accept_uri", "amount")
    )


def wagered(rules: DataFrame, bets: DataFrame) -> DataFrame:
    """Count and sum of in-window wagers per rule, optionally of the listed sports only.

    ``bets`` needs player_id, sport_id, second and amount. They are rolled up
    once per player and sport; rules without sports add the sports up.
    """
    rolled = written(rollups(bets, (*PLAYER, "sport_id")), "wager-rollups")
    listed = F.size("sports") > 0
    per_sport = rules.filter(listed).withColumn("sport_id", F.explode(F.array_distinct("sports")))
    some = window_totals(per_sport, rolled, (*PLAYER, "sport_id"))
    anything = window_totals(rules.filter(~listed), rolled, PLAYER)
    return anything.unionByName(some).select(*RULE, "n", F.col("total").cast("double").alias("total"))


def expired(requests: DataFrame, now: Column) -> DataFrame:
    """Past ``from`` plus ttl, or without a ``from``."""
    until = add_ttl(F.col("requested_at"), F.col("ttl"), F.col("ttl_unit"))
    return requests.filter(F.coalesce(now > until, F.lit(True)))


def retire(requests: DataFrame, *done: DataFrame) -> DataFrame:
    """Active requests without the fired and the expired ones."""
    gone = None
    for df in done:
        ids = df.select("request_id")
        gone = ids if gone is None else gone.unionByName(ids)
    return requests.join(gone.hint("merge"), "request_id", "left_anti")
