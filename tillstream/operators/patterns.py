"""Event patterns per key in event-time order (batch forms).

Strict contiguity means the next event of the same key in (time, tie-break) order; "within d"
means a gap smaller than d.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.times import epoch_micros, local_day, micros
from tillstream.operators.aggregates import oldest
from tillstream.operators.joins import interval_join
from tillstream.operators.ordered import HotKeys, SplitPolicy, following, position, previous, running, with_ordered


def _gap(later: str, earlier: str) -> Column:
    return epoch_micros(F.col(later)) - epoch_micros(F.col(earlier))


def correct_new_flag(df: DataFrame, key: str, flag: str, ts: str, ties: Sequence[str],
                     policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Keep flag ``1`` on the first flagged row of a device only; later ones become ``0``."""
    flagged = F.when(F.col(flag) == "1", 1).otherwise(0).cast("long")
    out = with_ordered(df, [key], ts, ties, policy, hot, _flagged=running("sum", flagged))
    first = (F.col(flag) == "1") & (F.col("_flagged") > 1)
    return out.withColumn(flag, F.when(first, "0").otherwise(F.col(flag))).drop("_flagged")


def first_of_day(df: DataFrame, key: str, ts: str, ties: Sequence[str], zone: str = "UTC") -> DataFrame:
    """The first row of each device and local day."""
    dated = df.withColumn("visit_date", local_day(F.col(ts), zone))
    return oldest(dated, [key, "visit_date"], [ts, *ties])


def bounces(df: DataFrame, key: str, entry: Column, ts: str, ties: Sequence[str], within: timedelta,
            policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Entry pages followed by another entry page, or by nothing within the time."""
    out = with_ordered(df.withColumn("_entry", entry), [key], ts, ties, policy, hot,
                       _next_ts=following(F.col(ts)), _next_entry=following(F.col("_entry")))
    alone = F.col("_next_ts").isNull() | (_gap("_next_ts", ts) >= micros(within))
    return out.where(F.col("_entry") & (alone | F.col("_next_entry"))).drop("_entry", "_next_ts", "_next_entry")


def login_alerts(df: DataFrame, key: str, kind: str, ts: str, ties: Sequence[str], within: timedelta,
                 once_per_run: bool = True, policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Two failures in a row at most ``within`` apart, no success between them.

    A run of failures is reported once, at its first such pair, unless ``once_per_run`` is off.
    ``within`` is exclusive; a rule on whole seconds passes one second more.
    """
    rows = df.where(F.col(kind).isin("fail", "success"))
    success = F.when(F.col(kind) == "success", 1).otherwise(0).cast("long")
    out = with_ordered(rows, [key], ts, ties, policy, hot, run=running("sum", success),
                       first_ts=previous(F.col(ts)), _prev=previous(F.col(kind)))
    hits = out.where((F.col(kind) == "fail") & (F.col("_prev") == "fail")
                     & (_gap(ts, "first_ts") < micros(within)))
    hits = hits.select(key, "run", "first_ts", F.col(ts).alias("second_ts"), *ties)
    if once_per_run:
        hits = oldest(hits, [key, "run"], ["second_ts", *ties])
    return hits.drop(*ties)


def _failures(df: DataFrame, key: str, kind: str, ts: str, tie: str, policy: SplitPolicy | None, hot: HotKeys | None) -> DataFrame:
    """Failures with their run (a number per key that grows with each success) and position in the key."""
    rows = df.where(F.col(kind).isin("fail", "success"))
    success = F.when(F.col(kind) == "success", 1).otherwise(0).cast("long")
    return with_ordered(rows, [key], ts, [tie], policy, hot,
                        run=running("sum", success), pos=position()).where(F.col(kind) == "fail")


def failure_sequences(df: DataFrame, key: str, kind: str, ts: str, tie: str, within: timedelta,
                      policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Every sequence of two or more failures in a row that starts and ends within the time.

    One row each, with the positions of its first and last failure; all positions between are
    its members, which ``sequence_members`` gives. Starts meet possible ends through time slots
    inside the run, so only rows close in time are compared.
    """
    fails = _failures(df, key, kind, ts, tie, policy, hot)
    head = fails.select(F.col(key), "run", F.col("pos").alias("first_pos"), F.col(ts).alias("start_ts"))
    tail = fails.select(F.col(key).alias("_key"), F.col("run").alias("_run"), F.col("pos").alias("last_pos"),
                        F.col(ts).alias("end_ts"))
    within_us = timedelta(microseconds=micros(within) - 1)
    pairs = interval_join(head, tail, {key: "_key", "run": "_run"}, "start_ts", "end_ts",
                          timedelta(0), within_us, hot=True).where(F.col("last_pos") > F.col("first_pos"))
    # Nothing but failures stands between two failures of a run.
    return pairs.select(key, "first_pos", "last_pos", "start_ts", "end_ts", (F.col("last_pos") - F.col("first_pos") + 1).alias("fails"))


def sequence_members(sequences: DataFrame, df: DataFrame, key: str, kind: str, ts: str, tie: str,
                     policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> DataFrame:
    """One row per member of each sequence: its positions and the member's ``tie`` value."""
    at = sequences.select(key, "first_pos", "last_pos", F.explode(F.sequence("first_pos", "last_pos")).alias("_at"))
    fails = _failures(df, key, kind, ts, tie, policy, hot).select(F.col(key).alias("_key"), F.col("pos").alias("_pos"), tie)
    return at.join(fails, (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_pos"))).drop("_key", "_at", "_pos")


def next_is(df: DataFrame, key: str, kind: str, first: str, second: str, ts: str, ties: Sequence[str],
            within: timedelta, policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> tuple[DataFrame, DataFrame]:
    """``first`` directly followed by ``second`` within the time: (matched, timed out).

    A ``first`` event with another next event within the time belongs to neither.
    """
    out = with_ordered(df, [key], ts, ties, policy, hot, next_ts=following(F.col(ts)),
                       _next=following(F.col(kind))).where(F.col(kind) == first)
    expired = F.col("next_ts").isNull() | (_gap("next_ts", ts) >= micros(within))
    matched = out.where(~expired & (F.col("_next") == second)).drop("_next")
    return matched, out.where(expired).drop("_next", "next_ts")


def watch_payments(df: DataFrame, key: str, kind: str, ts: str, rule: timedelta,
                   timer: timedelta) -> DataFrame:
    """State of each order with at most one ``create`` and one ``pay`` event.

    Paid within ``rule``: normal; later: late. Events further than ``timer`` apart expire one by
    one: the creation is cancelled and the payment has no order. One row per outcome.
    """
    def at(event: str) -> Column:
        return F.min(F.when(F.col(kind) == event, epoch_micros(F.col(ts))))

    both = df.groupBy(key).agg(at("create").alias("_c"), at("pay").alias("_p"))
    gap = F.col("_p") - F.col("_c")
    met = F.when(gap <= micros(rule), F.array(F.lit("normal"))).otherwise(F.array(F.lit("late")))
    apart = F.array(F.lit("cancelled"), F.lit("pay_only"))
    outcome = (F.when(F.col("_p").isNull(), F.array(F.lit("cancelled")))
               .when(F.col("_c").isNull(), F.array(F.lit("pay_only")))
               .when(F.abs(gap) > micros(timer), apart).otherwise(met))
    return both.select(key, F.explode(outcome).alias("outcome"))


def click_rank(df: DataFrame, user: str, ad: str, ts: str, ties: Sequence[str], zone: str = "UTC",
               policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Position of each click among the clicks of its user, advert and local day."""
    dated = df.withColumn("click_date", local_day(F.col(ts), zone))
    return with_ordered(dated, [user, ad, "click_date"], ts, ties, policy, hot, nth=position())


def blacklist(df: DataFrame, user: str, ad: str, ts: str, ties: Sequence[str], limit: int,
              zone: str = "UTC", policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clicks below the daily limit, one alert per user, advert and day at the limit, the rest."""
    ranked = click_rank(df, user, ad, ts, ties, zone, policy, hot)
    nth = F.col("nth")
    return ranked.where(nth < limit), ranked.where(nth == limit), ranked.where(nth > limit)
