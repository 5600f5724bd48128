"""Event time, day and calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import _col

SECONDS_LIMIT = 100_000_000_000  # below this an epoch number counts seconds
DAY_MS = 86_400_000

# Last day (month*100+day) of each zodiac sign, in year order.
ZODIAC = [
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"),
    (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"),
    (1231, "摩羯座"),
]
# First hour after each part of the day.
DAY_PARTS = [(6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上"), (24, "夜间")]


def epoch_ms(ts, limit: int = SECONDS_LIMIT) -> Column:
    """Epoch milliseconds of a number that may count seconds."""
    t = _col(ts).cast("long")
    return F.when(t < limit, t * 1000).otherwise(t)


def text_epoch_ms(ts, fallback) -> Column:
    """Epoch milliseconds of a number in text: up to ten whole digits are seconds."""
    t = _col(ts)
    seconds = F.length(F.regexp_replace(t, r"\.\d+", "")) <= 10
    number = t.try_cast("double")
    value = F.when(seconds, (number * 1000).cast("long")).otherwise(number.cast("long"))
    return F.when(t.isNull() | (t == ""), _col(fallback)).otherwise(value)


def event_time(ts) -> Column:
    return F.timestamp_millis(epoch_ms(ts))


def millis(ts) -> Column:
    """Epoch milliseconds of a timestamp with or without time zone."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def day_text(ts, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_col(ts), pattern)


def second_text(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def ms_day(ms) -> Column:
    return day_text(F.timestamp_millis(_col(ms)))


def ms_second(ms) -> Column:
    return second_text(F.timestamp_millis(_col(ms)))


def hour_key(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:00:00")


def day_bucket(ts, pattern: str = "yyyyMMdd") -> Column:
    """File bucket of a JSON time field; unreadable times go to ``error_bucket``."""
    number = _col(ts).try_cast("long")
    day = F.date_format(F.timestamp_millis(epoch_ms(number, 10_000_000_000)), pattern)
    return F.coalesce(F.concat(F.lit("day="), day), F.lit("error_bucket"))


def first_match(value: Column, limits, below=True) -> Column:
    chain = None
    for limit, label in limits:
        test = value < limit if below else value <= limit
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def zodiac_sign(birthday) -> Column:
    b = _col(birthday)
    return first_match(F.month(b) * 100 + F.day(b), ZODIAC, below=False)


def age_on(birthday, as_of) -> Column:
    return F.floor(F.months_between(_col(as_of), _col(birthday)) / 12).cast("long")


def decade(birthday) -> Column:
    return (F.floor(F.year(_col(birthday)) / 10) * 10).cast("long")


def epoch_day_date(days) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), _col(days).cast("int"))


def day_part(ts) -> Column:
    return first_match(F.hour(_col(ts)), DAY_PARTS)


def calendar_features(df: DataFrame, birthday: str, as_of) -> DataFrame:
    """Age on a given day, birth decade and zodiac sign."""
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return df.withColumns({
        "age": age_on(birthday, as_of), "decade": decade(birthday), "zodiac_sign": zodiac_sign(birthday),
    })


def slot_counts(hour: Column) -> dict[str, Column]:
    """Counting aggregates for the four daily time slots."""
    def between(low, high):
        return F.count_if((hour >= low) & (hour < high))
    return {"morning_6_12": between(6, 12), "afternoon_12_18": between(12, 18),
            "evening_18_24": between(18, 24), "night_0_6": between(0, 6)}


def primary_slot() -> Column:
    """Name of the fullest slot; the earlier slot wins a tie, in the order of the day."""
    slots = [("morning", "morning_6_12"), ("afternoon", "afternoon_12_18"),
             ("evening", "evening_18_24"), ("night", "night_0_6")]
    best = F.greatest(*[F.col(c) for _, c in slots])
    return F.coalesce(*[F.when(F.col(c) == best, F.lit(name)) for name, c in slots])


def time_slots(df: DataFrame, key: str, ts) -> DataFrame:
    """Four slot counts and the main slot per key."""
    hour = F.hour(_col(ts))
    return df.groupBy(key).agg(*[c.alias(n) for n, c in slot_counts(hour).items()]).withColumn(
        "primary_time_slot", primary_slot())


def day_numbers(first: str, last: str) -> Column:
    """All days of a range as yyyyMMdd numbers."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMMdd").cast("int"))
