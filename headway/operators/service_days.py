"""Days on which services run: validity intervals with weekdays, minus removed dates, plus added ones, as one bit a date.

A service keeps its dates as ``service_bits``, a struct of the number of its first day and 64-bit words. Asking for a
date tests one bit, so neither calls nor connections are multiplied by dates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv

ADDED, REMOVED = 1, 2
_WORD = 64
# Every seventh bit of a word from each of the first seven on, as signed numbers.
_WEEKLY_FROM = [m - (1 << _WORD) if m >> (_WORD - 1) else m for m in (sum(1 << k for k in range(n, _WORD, 7)) for n in range(7))]


def day_number(date: Column) -> Column:
    return F.datediff(date.cast("date"), F.lit("1970-01-01").cast("date"))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _weekly(rest: int) -> Column:
    """The word of a service's weekdays whose first day leaves ``rest`` when divided by seven."""
    # Day 0 was a Thursday, which is the fourth weekday.
    each = [(_WEEKLY_FROM[(k - 3 - rest) % 7], d) for k, d in enumerate(fv.DAYS)]
    return reduce(Column.bitwiseOR, [F.when(F.col(d), F.lit(word)).otherwise(F.lit(0)).cast("bigint") for word, d in each])


def service_days(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """``service_id`` and ``service_bits`` of every service that runs at all.

    ``calendar(service_id, monday..sunday, start_date, end_date)`` may hold several intervals of a service, and
    ``exceptions(service_id, date, exception_type)`` services without any. A date both removed and added is added.
    Null weekdays count as false; rows without an interval or a date, and intervals that end before they begin, add nothing.
    Everything of a service is in one row before the bits are set: a few intervals and its exception dates.
    """
    intervals = calendar.select("service_id", F.struct(day_number(F.col("start_date")).alias("first"), day_number(F.col("end_date")).alias("last"),
                                                       F.array(*[_weekly(r) for r in range(7)]).alias("weekly")).alias("interval"))
    intervals = intervals.where(F.col("interval.first") <= F.col("interval.last"))
    number = day_number(F.col("date"))
    dates = exceptions.where(F.col("date").isNotNull()).select("service_id", *[
        F.when(F.col("exception_type") == kind, number).alias(name) for kind, name in ((ADDED, "added"), (REMOVED, "removed"))])
    parts = intervals.select("service_id", "interval", *[F.lit(None).cast("int").alias(c) for c in ("added", "removed")]).unionByName(
        dates.withColumn("interval", F.lit(None).cast(intervals.schema["interval"].dataType)))
    parts = parts.where(F.col("service_id").isNotNull())
    rows = parts.groupBy("service_id").agg(*[F.collect_set(c).alias(c) for c in ("interval", "added", "removed")])
    first = F.least(F.array_min(F.transform("interval", lambda i: i["first"])), F.array_min("added"))
    last = F.greatest(F.array_max(F.transform("interval", lambda i: i["last"])), F.array_max("added"))
    rows = rows.withColumns({"first": first, "last": last}).where(F.col("first").isNotNull())

    def word(w: Column) -> Column:
        begin = F.col("first") + w * _WORD

        def usual(i: Column) -> Column:
            low, high = F.greatest(i["first"] - begin, F.lit(0)), F.least(i["last"] - begin, F.lit(_WORD - 1))
            every = F.lit(-1).cast("bigint")
            span = F.call_function("shiftleft", every, low).bitwiseAND(F.call_function("shiftrightunsigned", every, _WORD - 1 - high))
            return F.when((low < _WORD) & (high >= 0), F.get(i["weekly"], F.pmod(begin, F.lit(7))).bitwiseAND(span)).otherwise(F.lit(0).cast("bigint"))

        def of(days: str) -> Column:
            inside = F.filter(days, lambda d: d.between(begin, begin + (_WORD - 1)))
            return F.aggregate(inside, F.lit(0).cast("bigint"), lambda bits, d: bits.bitwiseOR(_bit(d - begin)))

        weekly = F.aggregate("interval", F.lit(0).cast("bigint"), lambda bits, i: bits.bitwiseOR(usual(i)))
        return weekly.bitwiseAND(F.bitwise_not(of("removed"))).bitwiseOR(of("added"))

    words = F.transform(F.sequence(F.lit(0), F.floor((F.col("last") - F.col("first")) / _WORD).cast("int")), word)
    made = rows.select("service_id", F.struct(F.col("first"), words.alias("words")).alias("service_bits"))
    return made.where(F.exists("service_bits.words", lambda w: w != 0))


def runs_on(bits: str, day: Column) -> Column:
    """Whether the day of this number is set; false outside of the words."""
    place = day - F.col(f"{bits}.first")
    word = F.get(F.col(f"{bits}.words"), F.floor(place / _WORD).cast("int"))
    return F.coalesce((place >= 0) & (word.bitwiseAND(_bit(F.pmod(place, F.lit(_WORD)))) != 0), F.lit(False))


def dates_of(bits: str) -> Column:
    """All days of a service as an array of dates, for reports."""
    words = F.col(f"{bits}.words")
    places = F.sequence(F.lit(0), F.size(words) * _WORD - 1)
    is_set = lambda n: F.get(words, F.floor(n / _WORD).cast("int")).bitwiseAND(_bit(n % _WORD)) != 0
    return F.transform(F.filter(places, is_set), lambda n: F.date_add(F.lit("1970-01-01").cast("date"), n + F.col(f"{bits}.first")))


def date_totals(bits: str) -> dict[str, Column]:
    """Number, first, last and sum (as day numbers) of the days of a service, by word: no day is looked at by itself."""
    words, first = F.col(f"{bits}.words"), F.col(f"{bits}.first")

    def total(value) -> Column:
        return F.aggregate(F.transform(words, value), F.lit(0).cast("bigint"), lambda a, v: a + v)

    def places(w: Column) -> Column:
        # The sum of the places of the set bits: those with bit k in their number count 2 to the k each.
        masks = [sum(1 << n for n in range(_WORD) if n >> k & 1) for k in range(6)]
        signed = [m - (1 << _WORD) if m >> (_WORD - 1) else m for m in masks]
        return sum((F.bit_count(w.bitwiseAND(F.lit(m))) * (1 << k) for k, m in enumerate(signed)), F.lit(0))

    def ends(place) -> Column:
        return F.transform(words, lambda w, i: F.when(w != 0, first + i * _WORD + place(F.bin(w))))

    def date(number: Column) -> Column:
        return F.date_add(F.lit("1970-01-01").cast("date"), number)

    return {
        "n_days": total(lambda w: F.bit_count(w).cast("bigint")),
        "first_date": date(F.array_min(ends(lambda digits: F.instr(F.reverse(digits), "1") - 1))),
        "last_date": date(F.array_max(ends(lambda digits: F.length(digits) - 1))),
        "day_sum": total(lambda w, i: (F.bit_count(w) * (first + i * _WORD) + places(w)).cast("bigint")),
    }


def with_service_days(stop_times: DataFrame, services: DataFrame) -> DataFrame:
    """Calls of the services that run at all, with their ``service_bits``: for searches by date."""
    return stop_times.join(services, "service_id")
