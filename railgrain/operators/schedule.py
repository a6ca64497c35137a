"""Which trains run on which day, and the day's timetable.

Tables: schedules ``(train_uid, date_runs_from, date_runs_to, days_run, stp_indicator)``; stops
``(train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, scheduled_arrival,
scheduled_departure[, scheduled_pass, platform])``; stations ``(tiploc_code, station_name,
_3_alpha_code, ...)``.  Extra columns are ignored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["train_uid", "date_runs_from", "stp_indicator"]
TIMES = ("scheduled_arrival", "scheduled_departure", "scheduled_pass", "platform")
#: Days in one word of a calendar.
_WORD = 64


def _words(days: list[dt.date]) -> list[tuple[dt.date, int]]:
    """The stretches of 64 days, counted from the first day, that hold an asked day: first day and the asked days as bits."""
    held: dict[int, int] = {}
    for d in days:
        block, bit = divmod((d - days[0]).days, _WORD)
        held[block] = held.get(block, 0) | 1 << bit
    return [(days[0] + dt.timedelta(days=_WORD * block), bits) for block, bits in sorted(held.items())]


def _signed(bits: int) -> int:
    return bits - (1 << _WORD) if bits >> (_WORD - 1) else bits


def _running_bits(start: dt.date, asked: int) -> Column:
    """The asked days of one stretch on which a schedule's own pattern runs."""
    weekdays = [sum(1 << i for i in range(_WORD) if asked >> i & 1 and (start.weekday() + i) % 7 == w) for w in range(7)]
    pattern = reduce(Column.bitwiseOR, (
        F.when(F.element_at("days_run", w + 1), F.lit(_signed(bits))).otherwise(F.lit(0)).cast("long")
        for w, bits in enumerate(weekdays)))
    every = F.lit(-1).cast("long")
    first, last = F.datediff("date_runs_from", F.lit(start)), F.datediff("date_runs_to", F.lit(start))
    begun = F.when(first >= _WORD, 0).otherwise(F.call_function("shiftleft", every, F.greatest(first, F.lit(0))))
    open_ = F.when(last < 0, 0).otherwise(F.call_function(
        "shiftrightunsigned", every, F.greatest(F.lit(_WORD - 1) - last, F.lit(0))))
    return pattern.bitwiseAND(begun).bitwiseAND(open_)


def service_calendar(schedules: DataFrame, dates: Iterable[dt.date]) -> DataFrame:
    """The schedules in force on any of the dates, one row each: the key and ``days``, the asked dates it is in force on as bits.

    Bit i of word j stands for the date i days after the first of the j-th stretch of 64 days that holds an asked date, counted
    from the first date; ``calendar_dates`` turns bits into dates.  Of a train's schedules that run on a date the ones with the
    lowest indicator are in force: blank sorts before C, C before N, O and P, so a short-term change hides the permanent schedule
    on the days that it runs, and on no others.  Schedules with the same indicator are all kept.  Without dates there are no rows.

    A row stays a row however many dates are asked for.  A train's days under one indicator are a hash aggregate (bitwise or), so
    a train with very many schedules is reduced before it is shuffled; what is gathered of a train is one entry for each
    indicator.  The join back has its own exchange on both sides, which adaptive execution may split.
    """
    days = sorted(set(dates))
    words = _words(days) if days else []
    own = [f"w{i}" for i in range(len(words))]
    if not words:
        return schedules.select(*KEY, F.array().cast("array<bigint>").alias("days")).limit(0)
    running = schedules.filter(
        (F.col("date_runs_from") <= F.lit(days[-1])) & (F.col("date_runs_to") >= F.lit(days[0]))
    ).select(*KEY, F.ascii("stp_indicator").alias("rank"), *(_running_bits(*w).alias(n) for w, n in zip(words, own, strict=True)))
    running = running.filter(_any(own))
    by_rank = running.groupBy("train_uid", "rank").agg(*(F.bit_or(n).alias(n) for n in own))
    trains = by_rank.groupBy("train_uid").agg(F.collect_list(F.struct("rank", *own)).alias("ranks"))
    each = trains.select("train_uid", "ranks", F.explode("ranks").alias("one"))

    def hidden(word: str) -> Column:
        lower = F.filter("ranks", lambda r: r["rank"] < F.col("one.rank"))
        return F.aggregate(lower, F.lit(0).cast("long"), lambda bits, r: bits.bitwiseOR(r[word]))

    free = each.select("train_uid", "one.rank", *(F.bitwise_not(hidden(n)).alias(f"free_{n}") for n in own))
    held = running.join(free, ["train_uid", "rank"])
    held = held.select(*KEY, *(F.col(n).bitwiseAND(F.col(f"free_{n}")).alias(n) for n in own)).filter(_any(own))
    return held.select(*KEY, F.array(*own).alias("days"))


def _any(words: list[str]) -> Column:
    return reduce(Column.bitwiseOR, map(F.col, words)) != 0


def _asked(dates: Iterable[dt.date]) -> Column:
    """The dates with the word and the bit that stand for them in a calendar of the same dates; a constant."""
    days = sorted(set(dates))
    return F.array(*[F.struct(F.lit(d).alias("date"), F.lit(j).alias("word"), F.lit(_signed(1 << i)).cast("long").alias("bit"))
                     for j, (start, bits) in enumerate(_words(days)) for i in range(_WORD) if bits >> i & 1
                     for d in [start + dt.timedelta(days=i)]])


def calendar_dates(days: Column | str, dates: Iterable[dt.date]) -> Column:
    """The dates whose bits are set, as an array; ``dates`` are those that the calendar was made for, one at least."""
    days = F.col(days) if isinstance(days, str) else days
    on = F.filter(_asked(dates), lambda d: F.get(days, d["word"]).bitwiseAND(d["bit"]) != 0)
    return F.transform(on, lambda d: d["date"])


def _runs_on(day: Column) -> Column:
    return (day.between(F.col("date_runs_from"), F.col("date_runs_to"))
            & F.element_at("days_run", F.weekday(day) + 1))


def schedules_on(schedules: DataFrame, dates: Iterable[dt.date]) -> DataFrame:
    """Schedules in force on each date: of a train's candidates the ones with the lowest indicator.

    Blank sorts before C, C before N, O and P, so a short-term change hides the permanent schedule.
    Candidates with the same indicator are all kept.  The lowest indicator is a hash aggregate, so a train
    with very many schedules is reduced before it is shuffled; the join back to the candidates has
    its own exchange on both sides, which adaptive execution may split.
    """
    days = sorted(set(dates))
    wanted = F.filter(F.array(*[F.lit(d) for d in days]), _runs_on)
    running = schedules.filter(
        (F.col("date_runs_from") <= F.lit(days[-1])) & (F.col("date_runs_to") >= F.lit(days[0]))
    ).select(*KEY, F.ascii("stp_indicator").alias("rank"), F.explode(wanted).alias("service_date"))
    top = running.groupBy("train_uid", "service_date").agg(F.min("rank").alias("rank"))
    return running.join(top, ["train_uid", "service_date", "rank"]).select("service_date", *KEY)


def train_timetable(requests: DataFrame, schedules: DataFrame, stops: DataFrame, stations: DataFrame,
                    ordered: bool = False) -> DataFrame:
    """Stops of one train on one date, for many requests ``(train_uid, timetable_date)`` at a time.

    Only one schedule is taken: lowest indicator, then latest start.  Unlike the day's timetable this
    follows the train past midnight.
    """
    asked = requests.select("train_uid", "timetable_date").distinct()
    candidates = schedules.select(*KEY, "date_runs_to", "days_run").join(asked, "train_uid").filter(
        _runs_on(F.col("timetable_date")))
    latest = F.datediff(F.lit("1900-01-01").cast("date"), "date_runs_from")
    chosen = candidates.groupBy("train_uid", "timetable_date").agg(
        F.min(F.struct("stp_indicator", latest.alias("age"), "date_runs_from")).alias("s")
    ).select("train_uid", "timetable_date", "s.stp_indicator", "s.date_runs_from")
    named = stations.select(F.col("tiploc_code").alias("location"), "station_name")
    shown = ["loc_order", "xmidnight", "location", "scheduled_arrival", "scheduled_departure",
             *[c for c in TIMES[2:] if c in stops.columns]]
    found = stops.select(*KEY, *shown).join(chosen, KEY).distinct().join(named, "location", "left").select(
        "timetable_date", "train_uid", "stp_indicator", "loc_order", "xmidnight", "location",
        "station_name", *shown[3:])
    return found.orderBy("timetable_date", "train_uid", "loc_order") if ordered else found


def full_timetable(schedules: DataFrame, stops: DataFrame, dates: Iterable[dt.date],
                   crs_stations: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """Every stop made on each date.

    That is the stops before midnight of the trains of that date and the stops after midnight of the
    trains of the day before.  Which half a service contributes to which date is part of the join key, so
    stops are read and joined once for all dates and no row is joined only to be dropped.

    With ``crs_stations`` a stop's location starts with a 3-letter code, which stands for each station that
    has it: unknown codes drop out, shared ones multiply.
    """
    days = set(dates)
    day, night = dt.timedelta(days=1), {d - dt.timedelta(days=1) for d in days}
    service = F.col("service_date")
    halves = F.filter(F.array(
        F.struct(F.lit(False).alias("xmidnight"),
                 F.when(service.isin(*days), service).alias("timetable_date")),
        F.struct(F.lit(True).alias("xmidnight"),
                 F.when(service.isin(*night), F.date_add(service, day.days)).alias("timetable_date")),
    ), lambda half: half["timetable_date"].isNotNull())
    serving = schedules_on(schedules, days | night).select(*KEY, F.inline(halves))
    extra = [c for c in TIMES[2:] if c in stops.columns]
    shown = ["loc_order", "location", "scheduled_arrival", "scheduled_departure", *extra]
    found = stops.select(*KEY, "xmidnight", *shown).join(serving, [*KEY, "xmidnight"])
    if crs_stations is not None:
        codes = crs_stations.select(F.col("_3_alpha_code").alias("code"), "tiploc_code")
        found = found.withColumn("code", F.substring("location", 1, 3)).drop("location").join(
            codes, "code").withColumnRenamed("tiploc_code", "location")
    found = found.select("timetable_date", "train_uid", "stp_indicator", "loc_order", "xmidnight",
                         *shown[1:])
    return found.orderBy("timetable_date", "train_uid", "loc_order") if ordered else found


def day_timetable(standard: tuple[DataFrame, DataFrame], ztrain: tuple[DataFrame, DataFrame],
                  stations: DataFrame, dates: Iterable[dt.date]) -> DataFrame:
    """Both timetables together; each argument is a pair of schedules and stops."""
    days = list(dates)
    return full_timetable(*standard, days).unionByName(
        full_timetable(*ztrain, days, crs_stations=stations))
