"""Streams with state of their own: sessions, cumulating windows, paths, profiles, routing.

Every operator takes a streaming DataFrame and returns one. Those on event time need
``event_time`` under a watermark (``jobs.with_event_time``); they hold rows until the watermark
has passed them, so the result is that of the batch form whatever the order of arrival, and rows
behind the watermark are left out (``late`` keeps and counts them). State lives in the RocksDB
store, is bounded as each operator says, and continues from the checkpoint after a restart.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marketlens.functions.calendar import DAY_MS
from marketlens.functions.columns import row_key
from marketlens.operators.ordered import MINUTE_MS
from marketlens.operators.skew import chunk_of
from marketlens.plans.behaviour import ARROW, level_of, path_events, primary_slot, tags_of, with_ms
from marketlens.session import STREAM_SETTINGS

EVENT, PROCESSING, NO_CLOCK = "EventTime", "ProcessingTime", "None"


def stateful(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: T.StructType | str, clock: str = EVENT, mode: str = "append") -> DataFrame:
    """Rows of each key given to a processor; its state needs the RocksDB store."""
    for name, value in STREAM_SETTINGS.items():
        df.sparkSession.conf.set(name, value)
    return df.groupBy(*keys).transformWithState(processor, schema, mode, clock)


def fields_of(df: DataFrame, names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def utc_days(df: DataFrame) -> bool:
    """Whether the session's days are those that windows of a day are cut by."""
    return df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


class Waiting(StatefulProcessor):
    """Rows that wait in a list until the watermark has reached their ``due`` time.

    One timer for each key stands at the earliest due time. ``ripe`` gets the rows that are due,
    by due time and then by the fields of ``order``; it yields output rows. Rows with null order
    fields come first.
    """

    def __init__(self, fields: list[T.StructField], due: str, order: list[str]):
        self.schema, self.due = T.StructType(fields), [f.name for f in fields].index(due)
        self.order = [[f.name for f in fields].index(c) for c in [due, *order]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.timer = handle.getValueState("timer", "ms long")

    def wake_at(self, ms: int) -> None:
        now = self.timer.get()
        if now is None or ms < now[0]:
            if now is not None:
                self.handle.deleteTimer(now[0])
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [tuple(r[n] for n in self.schema.names) for r in rows]
        self.waiting.appendList(new)
        self.wake_at(min(r[self.due] for r in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = [tuple(r) for r in self.waiting.get()]
        ripe = sorted((r for r in held if r[self.due] <= passed), key=lambda r: [(r[k] is not None, r[k]) for k in self.order])
        rest = [r for r in held if r[self.due] > passed]
        self.timer.clear()
        self.waiting.clear()
        if rest:
            self.waiting.put(rest)
            self.wake_at(min(r[self.due] for r in rest))
        yield from self.ripe(key, ripe, passed, bool(rest))

    def ripe(self, key, rows: list[tuple], passed: int, more: bool) -> Iterator[Row]:
        raise NotImplementedError

    def close(self) -> None:
        pass


# ---- sessions ------------------------------------------------------------------------
class Restarts(Waiting):
    """Session restarts of one user and day; the state is the start of the running session."""

    def __init__(self, limit: int):
        super().__init__([T.StructField("ms", T.LongType())], "ms", [])
        self.limit = limit

    def init(self, handle):
        super().init(handle)
        self.session = handle.getValueState("session", "start long, last long")

    def ripe(self, key, rows, passed, more):
        start, last = self.session.get() or (None, None)
        for (ms,) in rows:
            if start is None:
                start = ms
            elif ms > start + self.limit:
                start = ms
                yield Row(user_id=key[0], stat_date=key[1], session_start=ms)
        last = max([ms for (ms,) in rows], default=last)
        over = last + DAY_MS + 3_600_000  # no day is longer, so none of its rows can come any more
        if passed >= over and not more:
            self.session.clear()
            return
        self.session.update((start, last))
        if not more:
            self.wake_at(over)


def session_restarts(log: DataFrame, minutes: int = 30) -> DataFrame:
    """``behaviour.session_restarts`` on a stream: (user_id, stat_date, session_start).

    Times at which a user's session begins anew, more than ``minutes`` after the running
    session's start. Where days are those of UTC, a user's day is a window that is emitted when the
    watermark passes its end; its state is the day's times. In other zones the state for each user
    and day is the start, and the times the watermark has not passed; it is dropped a day after
    the last event.
    """
    times = path_events(log).select("user_id", "stat_date", "ms", "event_time")
    if utc_days(log):
        days = times.groupBy(F.window("event_time", "1 day").alias("w"), "user_id", "stat_date").agg(F.array_sort(F.collect_list("ms")).alias("_times"))
        none = F.struct(F.element_at("_times", 1).alias("start"), F.array().cast("array<long>").alias("found"))
        begun = F.aggregate("_times", none, lambda s, ms: F.when(ms > s["start"] + minutes * 60_000, F.struct(
            ms.alias("start"), F.concat(s["found"], F.array(ms)).alias("found"))).otherwise(s), lambda s: s["found"])
        return days.select("user_id", "stat_date", F.explode(begun).alias("session_start"))
    return stateful(times, ["user_id", "stat_date"], Restarts(minutes * 60_000), "user_id long, stat_date string, session_start long")


# ---- cumulating windows --------------------------------------------------------------
class Cumulate(StatefulProcessor):
    """Running totals of one day and key; a timer at the end of each step emits and carries on.

    Input rows are sums or single distinct values of one finished step.
    """

    def __init__(self, step: int, keys: list[str], sums: list[T.StructField], distinct: list[str]):
        self.step, self.steps, self.keys, self.sums, self.distinct = step, DAY_MS // step, keys, sums, distinct

    def init(self, handle):
        self.handle = handle
        self.total = handle.getValueState("total", T.StructType([
            T.StructField("next_step", T.LongType()), *self.sums, *[T.StructField(n, T.LongType()) for n in self.distinct]]))
        self.seen = handle.getMapState("seen", "which int, value string", "step long")

    def _rows(self, key, state: list, until: int) -> Iterator[Row]:
        """The totals of all steps before ``until`` that are not out yet."""
        day, bucket = key[0], key[1]
        while state[0] < until:
            yield Row(window_start=day, window_end=day + (state[0] + 1) * self.step, _bucket=bucket, **dict(zip(self.keys, key[2:], strict=True)),
                      **dict(zip([*[f.name for f in self.sums], *self.distinct], state[1:], strict=True)))
            state[0] += 1

    def _carry_on(self, key, state: list, passed: int) -> Iterator[Row]:
        """Emit the steps that the watermark has passed; wait for the next, or end the day."""
        yield from self._rows(key, state, min(self.steps, (passed - key[0]) // self.step))
        if state[0] >= self.steps:
            self.total.clear()
            self.seen.clear()
        else:
            self.total.update(tuple(state))
            self.handle.registerTimer(key[0] + (state[0] + 1) * self.step)

    def handleInputRows(self, key, rows, timerValues):
        steps: dict[int, list] = {}
        for r in rows:
            steps.setdefault(r["_step"], []).append(r)
        held = self.total.get()
        state = list(held) if held is not None else [min(steps), *[None] * len(self.sums), *[0] * len(self.distinct)]
        for step in sorted(steps):
            yield from self._rows(key, state, step)
            for r in steps[step]:
                if r["_which"] < 0:
                    for k, f in enumerate(self.sums, 1):
                        if r[f.name] is not None:
                            state[k] = r[f.name] if state[k] is None else state[k] + r[f.name]
                elif not self.seen.containsKey((r["_which"], r["_value"])):
                    self.seen.updateValue((r["_which"], r["_value"]), (step,))
                    state[1 + len(self.sums) + r["_which"]] += 1
        yield from self._carry_on(key, state, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.total.get()
        if held is not None:
            yield from self._carry_on(key, list(held), timerValues.getCurrentWatermarkInMs())

    def close(self):
        pass


def cumulate(df: DataFrame, step: int, sums: dict[str, Column], keys: list[str] | None = None, distinct: dict[str, str] | None = None, buckets: int = 16) -> DataFrame:
    """``windows.cumulate`` on a stream: day windows that grow by ``step`` milliseconds.

    Returns parts: (window_start, window_end, keys, sums, distinct counts, _bucket); ``cumulated``
    adds them up in a micro-batch, where all parts of a window arrive together.

    Rows are summed per step before they meet their key's state, so a hot key is a few rows for
    each step. Distinct values are dealt to ``buckets``; the state holds a day's values, running
    totals and one timer, and goes at the day's end. ``step`` must divide the day.
    """
    keys, distinct = keys or [], distinct or {}
    if DAY_MS % step:
        raise ValueError("the step must divide the day")
    values = {f"_value{k}": F.col(c).cast("string") for k, c in enumerate(distinct.values())}
    finished = df.withColumns(values).groupBy(F.window("event_time", f"{step} milliseconds").alias("w"), *keys, *values).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()])
    start = F.unix_millis("w.start")
    day = (F.floor(start / DAY_MS) * DAY_MS).cast("long")
    none = [F.lit(None).cast(finished.schema[n].dataType).alias(n) for n in sums]
    rows = [F.struct(F.lit(-1).alias("_which"), F.lit(None).cast("string").alias("_value"), *sums)]
    rows += [F.struct(F.lit(k).alias("_which"), F.col(v).alias("_value"), *none) for k, v in enumerate(values)]
    dealt = finished.select(day.alias("_day"), F.floor((start - day) / step).cast("long").alias("_step"), *keys, F.explode(F.array(*rows)).alias("r")).select(
        "_day", "_step", *keys, "r.*").where("_which < 0 or _value is not null").withColumn(
        "_bucket", F.when(F.col("_which") < 0, 0).otherwise(F.pmod(F.xxhash64("_which", "_value"), F.lit(buckets))).cast("int"))
    out = T.StructType([
        T.StructField("window_start", T.LongType()), T.StructField("window_end", T.LongType()), T.StructField("_bucket", T.IntegerType()),
        *fields_of(finished, [*keys, *sums]), *[T.StructField(n, T.LongType()) for n in distinct]])
    return stateful(dealt, ["_day", "_bucket", *keys], Cumulate(step, keys, fields_of(finished, list(sums)), list(distinct)), out)


def cumulated(parts: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Whole windows from the parts of one micro-batch of ``cumulate``."""
    return parts.groupBy("window_start", "window_end", *keys).agg(*[F.sum(n).alias(n) for n in names])


# ---- running counts ------------------------------------------------------------------
def places(df: DataFrame, keys: list[str], ms: str, tie: str, width: int = MINUTE_MS) -> DataFrame:
    """Each row with its place among the rows of its key and slice of ``width`` milliseconds.

    ``ms`` is the event time in milliseconds. Emitted when the watermark has passed the slice,
    whole slices at a time. The state of a key's slices, lists of their rows, is spread over tasks,
    so a hot key is no single task; ``late.running_count_sink`` adds the counts of the slices before.
    """
    own = [ms, tie, *[c for c in df.columns if c not in ("event_time", ms, tie)]]
    slices = df.groupBy(F.window("event_time", f"{width} milliseconds").alias("w"), *keys).agg(F.array_sort(F.collect_list(F.struct(*own))).alias("_rows"))
    placed = slices.select("w", F.posexplode("_rows").alias("_at", "_row"))
    return placed.select(*[f"_row.{c}" for c in df.columns if c != "event_time"], chunk_of(F.unix_millis("w.start"), width).alias("_chunk"),
                         (F.col("_at") + 1).cast("long").alias("_place"))


# ---- last value of an interval -------------------------------------------------------
class LastValue(StatefulProcessor):
    """The last row of each window of one key, by the clock of the machine."""

    def __init__(self, fields: list[T.StructField], ms: str, tie: str, size: int):
        self.schema, self.ms, self.tie, self.size = T.StructType(fields), ms, tie, size

    def init(self, handle):
        self.handle = handle
        self.last = handle.getMapState("last", "window_start long", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        start = timerValues.getCurrentProcessingTimeInMs() // self.size * self.size
        found = max(rows, key=lambda r: (r[self.ms], r[self.tie]))  # a later arrival counts whatever is held
        self.last.updateValue((start,), tuple(found[n] for n in self.schema.names))
        self.handle.registerTimer(start + self.size)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size
        held = self.last.getValue((start,))
        if held is not None:
            self.last.removeKey((start,))
            yield Row(window_start=start, **dict(zip(self.schema.names, held, strict=True)))

    def close(self):
        pass


def last_per_interval(df: DataFrame, key: str, ms: str, tie: str, size: int, clock: str = EVENT) -> DataFrame:
    """``windows.last_per_interval`` on a stream: the last row of each key and window.

    With ``clock=EVENT`` a window is cut by ``ms``, which is the event time in milliseconds, and
    ends with the watermark, so rows that arrive late but before it count; each task takes the
    last of its rows before they are shuffled. With ``clock=PROCESSING`` it is cut by the machine's
    clock and the row that arrived last counts (of one micro-batch the latest by ``ms`` and
    ``tie``). State: one row for each open window.
    """
    own = fields_of(df, [c for c in df.columns if c != "event_time"])
    if clock == EVENT:
        found = df.groupBy(F.window("event_time", f"{size} milliseconds").alias("w"), key).agg(
            F.max_by(F.struct(*[F.col(f.name) for f in own]), F.struct(ms, tie)).alias("_row"))
        return found.select(F.unix_millis("w.start").alias("window_start"), "_row.*")
    return stateful(df, [key], LastValue(own, ms, tie, size), T.StructType([T.StructField("window_start", T.LongType()), *own]), clock)


# ---- rising rows and first visits, with expiry ---------------------------------------
class Rising(StatefulProcessor):
    def __init__(self, names: list[str], ts: str, tie: str, ttl: int | None):
        self.names, self.ts, self.tie, self.ttl = names, ts, tie, ttl

    def init(self, handle):
        self.top = handle.getValueState("top", "ts long", self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        held = self.top.get()
        top = before = held[0] if held is not None else None
        for r in sorted((r for r in rows if r[self.ts] is not None), key=lambda r: (r[self.ts], r[self.tie])):
            if top is None or r[self.ts] > top:
                top = r[self.ts]
                yield Row(**{n: r[n] for n in self.names})
        if top != before:
            self.top.update((top,))

    def close(self):
        pass


def keep_rising(df: DataFrame, key: str, ts: str, tie: str, ttl: int | None = None) -> DataFrame:
    """``ordered.keep_rising`` on a stream: rows whose ``ts`` is above all that came before for the key.

    Rows of one micro-batch come together and are taken by rising ``ts``, then ``tie``. A key is
    forgotten ``ttl`` milliseconds after its last kept row (None: never), and the next row is kept
    whatever its time. State: one number for each key. Rows without a time are left out.
    """
    own = [c for c in df.columns if c != "event_time"]
    return stateful(df.select(*own), [key], Rising(own, ts, tie, ttl), T.StructType(fields_of(df, own)), PROCESSING if ttl else NO_CLOCK)


class FirstVisit(StatefulProcessor):
    def __init__(self, names: list[str], ttl: int | None):
        self.names, self.ttl = names, ttl

    def init(self, handle):
        self.first = handle.getValueState("first", "day string", self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        held = self.first.get()
        day = held[0] if held is not None else None
        for r in sorted(rows, key=lambda r: (r["ts"], r["log_id"])):
            if day is None:
                day = r["_day"] if r["is_new"] == "1" else r["_day_before"]
                self.first.update((day,))
            stale = r["is_new"] == "1" and r["_day"] != day
            yield Row(**{n: "0" if n == "is_new" and stale else r[n] for n in self.names})

    def close(self):
        pass


def repair_is_new(visits: DataFrame, ttl: int | None = None) -> DataFrame:
    """``pagelog.repair_is_new`` on a stream of (log_id, mid, is_new, ts).

    The first row of a device to arrive (of one micro-batch the earliest) sets the day on which
    the device counts as new. A device is forgotten ``ttl`` milliseconds after that (None:
    never). State: one day for each device.
    """
    names = ["log_id", "mid", "is_new", "ts"]
    day = lambda ms: F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")
    dated = visits.where("ts is not null").select(*names, day(F.col("ts")).alias("_day"), day(F.col("ts") - DAY_MS).alias("_day_before"))
    return stateful(dated, ["mid"], FirstVisit(names, ttl), T.StructType(fields_of(dated, names)), PROCESSING if ttl else NO_CLOCK)


# ---- daily paths ---------------------------------------------------------------------
def user_type(rule: str, days: int, paid: int, bought: bool) -> str:
    if rule == "v1107":
        return "高价值用户" if paid and bought else "观望用户" if paid or bought else "普通用户"
    if paid and bought:
        return "高价值用户"
    if days >= 3 and not paid:
        return "观望用户"
    return "新用户首单" if bought and not days else "普通用户"


class PastDays(StatefulProcessor):
    """The user type of whole days of one user, by the days before; days come in their order."""

    def __init__(self, rule: str):
        self.rule = rule

    def init(self, handle):
        self.past = handle.getValueState("past", "days long, paid long")

    def handleInputRows(self, key, rows, timerValues):
        days, paid = self.past.get() or (0, 0)
        for r in sorted(rows, key=lambda r: r["analysis_date"]):
            yield Row(**r.asDict(), user_type=user_type(self.rule, days, paid, r["bought"]))
            days, paid = days + 1, paid + r["bought"]
        self.past.update((days, paid))

    def close(self):
        pass


class DailyPaths(Waiting):
    """Paths of one user's days; the state is the days before and how many of them paid."""

    def __init__(self, part_size: int, rule: str):
        text, number = T.StringType(), T.LongType()
        super().__init__([T.StructField("analysis_date", text), T.StructField("ms", number), T.StructField("log_id", number),
                          T.StructField("log_type", text), T.StructField("_due", number)], "_due", ["ms", "log_id"])
        self.part_size, self.rule = part_size, rule

    def init(self, handle):
        super().init(handle)
        self.past = handle.getValueState("past", "days long, paid long")

    def ripe(self, key, rows, passed, more):
        days, paid = self.past.get() or (0, 0)
        while rows:
            date = rows[0][0]
            size = next((n for n, r in enumerate(rows) if r[0] != date), len(rows))
            own, rows = rows[:size], rows[size:]
            bought = any(r[3] == "payment" for r in own)
            for part in range(0, size, self.part_size):
                yield Row(
                    user_id=key[0], analysis_date=date, part=part // self.part_size, path_sequence=ARROW.join(r[3] for r in own[part : part + self.part_size]),
                    conversion_status="已转化" if bought else "未转化", event_count=size, total_duration=(own[-1][1] - own[0][1]) // 1000,
                    user_type=user_type(self.rule, days, paid, bought))
            days, paid = days + 1, paid + bought
        self.past.update((days, paid))


PATH_ROW = ("user_id long, analysis_date string, part long, path_sequence string, conversion_status string, "
            "event_count long, total_duration long, user_type string")


def user_paths(log: DataFrame, rule: str = "v1107", part_size: int = 1000) -> DataFrame:
    """``behaviour.user_paths`` on a stream: a user's day is emitted when the watermark passes its end.

    State for each user: the pages of days that are not over, which then go, and two numbers on
    the earlier days, which stay. Where days are those of UTC, a day is a window, and its user's
    state is asked once for all days that end together.
    """
    if rule not in ("v1107", "v1106"):
        raise ValueError(f"unknown rule {rule!r}")
    rows = path_events(log).withColumnRenamed("stat_date", "analysis_date")
    if utc_days(log):
        pages = F.array_sort(F.collect_list(F.struct("ms", "log_id", "log_type")))
        days = rows.groupBy(F.window("event_time", "1 day").alias("w"), "user_id", "analysis_date").agg(pages.alias("p"))
        size, names = F.size("p"), F.col("p.log_type")
        whole = days.select(
            "user_id", "analysis_date", size.cast("long").alias("event_count"), F.array_contains(names, "payment").alias("bought"),
            F.floor((F.element_at("p", -1)["ms"] - F.element_at("p", 1)["ms"]) / 1000).cast("long").alias("total_duration"),
            F.transform(F.sequence(F.lit(1), size, F.lit(part_size)), lambda k: F.array_join(F.slice(names, k, part_size), ARROW)).alias("parts"))
        typed = stateful(whole, ["user_id"], PastDays(rule), T.StructType([*whole.schema.fields, T.StructField("user_type", T.StringType())]), NO_CLOCK)
        return typed.select("user_id", "analysis_date", F.posexplode("parts").alias("_part", "path_sequence"), "bought", "event_count", "total_duration", "user_type").select(
            "user_id", "analysis_date", F.col("_part").cast("long").alias("part"), "path_sequence",
            F.when(F.col("bought"), "已转化").otherwise("未转化").alias("conversion_status"), "event_count", "total_duration", "user_type")
    due = F.unix_millis(F.date_add(F.to_date("analysis_date"), 1).cast("timestamp"))
    held = rows.select("user_id", "analysis_date", "ms", "log_id", "log_type", due.alias("_due"), "event_time")
    return stateful(held, ["user_id"], DailyPaths(part_size, rule), PATH_ROW)


# ---- profiles ------------------------------------------------------------------------
SLOTS = ["morning_6_12", "afternoon_12_18", "evening_18_24", "night_0_6"]
PROFILE_ROW = (
    "user_id long, login_days_count long, login_dates string, search_days string, purchase_days string, browse_days string, "
    + ", ".join(f"{s} long" for s in SLOTS)
    + ", top_search_keywords string, order_count long, browsed_products_count long, search_keyword_count long, "
      "brand string, plat string, platv string, network_types string, events long")


class Profile(StatefulProcessor):
    """Everything a user's profile is made of, in maps: days, words, orders, products, networks.

    The maps are one value, which a micro-batch asks for and writes once: the profile needs all
    of them whenever rows of the user come.
    """

    FLAGS, THINGS = ("searched", "bought", "browsed"), ("word", "order", "product", "net")

    def __init__(self, keywords: int):
        self.keywords = keywords

    def init(self, handle):
        text, number = T.StringType(), T.LongType()
        self.held = handle.getValueState("held", T.StructType([
            *[T.StructField(s, number) for s in (*SLOTS, "events", "ms", "log_id")], *[T.StructField(c, text) for c in ("brand", "plat", "platv")],
            T.StructField("days", T.MapType(text, T.IntegerType())), *[T.StructField(c, T.MapType(text, number)) for c in self.THINGS]]))

    def handleInputRows(self, key, rows, timerValues):
        held = self.held.get()
        base = list(held[:10]) if held is not None else [0] * 5 + [None] * 5
        days, *found = (dict(m) for m in held[10:]) if held is not None else ({} for _ in range(5))
        things = dict(zip(self.THINGS, found, strict=True))
        for r in rows:
            kind = r["log_type"]
            searched = kind == "search" and r["keyword"] is not None
            bought = kind == "payment" or (kind == "order_confirm" and r["order_id"] is not None)
            browsed = kind in ("product_detail", "product_list")
            days[r["stat_date"]] = days.get(r["stat_date"], 0) | sum(1 << n for n, flag in enumerate((searched, bought, browsed)) if flag)
            base[(r["_hour"] // 6 - 1) % 4] += 1
            base[4] += 1
            if base[5] is None or (r["ms"], r["log_id"]) < (base[5], base[6]):
                base[5:] = r["ms"], r["log_id"], r["brand"], r["plat"], r["platv"]
            for name, thing, counts in (("word", r["keyword"], searched and not r["_blank"]), ("order", r["order_id"], bought),
                                        ("product", r["product_id"], browsed), ("net", r["net"], True)):
                if counts and thing is not None:
                    things[name][str(thing)] = things[name].get(str(thing), 0) + 1
        self.held.update((*base, days, *things.values()))
        yield self._profile(key[0], base, days, things)

    def _profile(self, user: int, base: list, days: dict[str, int], things: dict[str, dict[str, int]]) -> Row:
        best = sorted(things["word"].items(), key=lambda w: (-w[1], w[0].encode()))[: self.keywords]
        listed = [",".join(d for d, flags in sorted(days.items()) if flags >> n & 1) for n in range(len(self.FLAGS))]
        return Row(
            user_id=user, login_days_count=len(days), login_dates=",".join(sorted(days)), search_days=listed[0], purchase_days=listed[1],
            browse_days=listed[2], **dict(zip(SLOTS, base[:4], strict=True)), top_search_keywords=",".join(w for w, _ in best),
            order_count=len(things["order"]), browsed_products_count=len(things["product"]), search_keyword_count=len(things["word"]),
            brand=base[7], plat=base[8], platv=base[9], network_types=",".join(f"{w}={n}" for w, n in sorted(things["net"].items())), events=base[4])

    def close(self):
        pass


def user_profiles(log: DataFrame, keywords: int = 10) -> DataFrame:
    """``behaviour.user_profiles`` on a stream, in update mode: a user's profile after every
    micro-batch that has rows of the user, with ``events``, the number of rows so far.

    The row with the most events is the present profile, whatever the order of arrival. State
    for each user: one value with an entry for each different day, word, order, product and network.
    """
    rows = with_ms(log.where("user_id is not null and log_type is not null and ts is not null"))
    held = rows.select(
        "user_id", "stat_date", "log_type", "keyword", F.col("order_id").cast("string"), F.col("product_id").cast("string"), "net", "ms", "log_id",
        "brand", "plat", "platv", F.hour(F.timestamp_millis("ms")).alias("_hour"), (F.trim("keyword") == "").alias("_blank"))
    built = stateful(held, ["user_id"], Profile(keywords), PROFILE_ROW, NO_CLOCK, "update")
    named = built.withColumn("primary_time_slot", primary_slot())
    return named.withColumns({"user_tags": F.array_join(tags_of(), ","), "user_level": level_of()})


LOG_PROFILE_ROW = ("uid string, pv long, os string, ch string, md string, ba string, last_search string, ts_ms long, part long, search_item string")


class LogProfile(StatefulProcessor):
    """Views, device values and search words of one user."""

    KINDS = ("os", "ch", "md", "ba")

    def __init__(self, part_size: int):
        self.part_size = part_size

    def init(self, handle):
        # One value, which a micro-batch asks for and writes once.
        self.held = handle.getValueState("held", "pv long, ts long, searched long, last_search string, "
                                         + ", ".join(f"{k} array<string>" for k in self.KINDS) + ", words map<string, long>")

    def handleInputRows(self, key, rows, timerValues):
        pv, ts, searched, last, *found, words = self.held.get() or (0, None, None, None, *[()] * len(self.KINDS), {})
        values, words = {k: set(v) for k, v in zip(self.KINDS, found, strict=True)}, dict(words)
        for r in rows:
            pv += 1
            ts = max((t for t in (ts, r["ts"]) if t is not None), default=None)
            for kind in self.KINDS:
                if r[kind] is not None:
                    values[kind].add(r[kind])
            word = r["search_item"]
            if word is not None and r["ts"] is not None:
                if searched is None or (r["ts"], word) > (searched, last):
                    searched, last = r["ts"], word
                words[word] = min(r["ts"], words.get(word, r["ts"]))
        self.held.update((pv, ts, searched, last, *(sorted(v) for v in values.values()), words))
        listed = [w for _, w in sorted((first, w) for w, first in words.items())]
        for part in range(0, max(1, len(listed)), self.part_size):
            yield Row(uid=key[0], pv=pv, **{k: ",".join(sorted(v)) for k, v in values.items()}, last_search=last, ts_ms=ts,
                      part=part // self.part_size, search_item=",".join(listed[part : part + self.part_size]))

    def close(self):
        pass


def user_log_profile(pages: DataFrame, part_size: int = 1000) -> DataFrame:
    """``labels.user_log_profile`` on a stream of reshaped page-log rows without repeats
    (``jobs.first_per_payload``), in update mode: a user's profile whenever rows of the user come.

    The row with the largest ``pv`` is the present one. State for each user: one value with an
    entry for each different device value and search word.
    """
    return stateful(pages.drop("event_time"), ["uid"], LogProfile(part_size), LOG_PROFILE_ROW, NO_CLOCK, "update")


# ---- snapshot phase ------------------------------------------------------------------
class SnapshotPhase(StatefulProcessor):
    """Marks the end of one table's first full read, once."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle):
        self.handle = handle
        self.phase = handle.getValueState("phase", "done boolean, rows long, timer long")

    def handleInputRows(self, key, rows, timerValues):
        done, count, timer = self.phase.get() or (False, 0, None)
        if done:
            return
        new = list(rows)
        count += sum(r["n"] for r in new if not r["live"])
        if timer is not None:
            self.handle.deleteTimer(timer)
        if any(r["live"] for r in new):
            self.phase.update((True, count, None))
            yield Row(db=key[0], table=key[1], snapshot_rows=count, reason="live")
        else:
            # The batch's own time is its start; rows that are worked on later have come since.
            timer = max(timerValues.getCurrentProcessingTimeInMs(), time.time_ns() // 1_000_000) + self.idle
            self.handle.registerTimer(timer)
            self.phase.update((False, count, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        done, count, timer = self.phase.get() or (True, 0, None)
        if not done and timer == expiredTimerInfo.getExpiryTimeInMs():
            self.phase.update((True, count, None))
            yield Row(db=key[0], table=key[1], snapshot_rows=count, reason="idle")

    def close(self):
        pass


def snapshot_marks(changes: DataFrame, idle: int = 15_000) -> DataFrame:
    """One row for each table when its first full read is over: (db, table, snapshot_rows, reason).

    It is over with the first live change of the table, or when no row of it has come for
    ``idle`` milliseconds. The rows themselves pass by (``changes.snapshot_rows``); here each
    task counts its rows per table first, so a large table is a few rows to its state.
    """
    def counted(batches):
        for rows in batches:
            yield rows.groupby(["db", "table", "live"], dropna=False).size().rename("n").reset_index()

    live = ~F.coalesce((F.col("op") == "r") | (F.col("snapshot") == "true"), F.lit(False))
    counts = changes.select("db", "table", live.alias("live")).mapInPandas(counted, "db string, table string, live boolean, n long")
    return stateful(counts, ["db", "table"], SnapshotPhase(idle), "db string, table string, snapshot_rows long, reason string", PROCESSING)


# ---- change routing ------------------------------------------------------------------
class Routing(StatefulProcessor):
    """The route of one source table; changes wait until it is known."""

    def __init__(self, ttl: int | None):
        self.ttl = ttl

    def init(self, handle):
        self.route = handle.getValueState("route", "sink_table string, sink_row_key string, op string, ts_ms long")
        self.waiting = handle.getListState("waiting", "payload string, ts_ms long", self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        entries, new = [], []
        for r in rows:
            if r["is_config"]:
                entries.append((r["sink_table"], r["sink_row_key"], r["op"], r["ts_ms"]))
            else:
                new.append((r["payload"], r["ts_ms"]))
        route = self.route.get()
        latest = max(entries, key=lambda e: e[3], default=None)
        if latest is not None and (route is None or latest[3] >= route[3]):
            route = latest
            self.route.update(route)
        if route is None:
            if new:
                self.waiting.appendList(new)
            return
        held = [tuple(x) for x in self.waiting.get()] if entries else []
        self.waiting.clear()
        if route[2] != "d":
            for payload, ts in [*held, *new]:
                yield Row(sink_table=route[0], sink_row_key=route[1], payload=payload, ts_ms=ts)

    def close(self):
        pass


def route_changes(changes: DataFrame, config: DataFrame, parts: int = 16, ttl: int | None = None) -> DataFrame:
    """``joins.route_changes`` on two streams: (sink_table, row_key, payload, ts_ms).

    Each change goes where its table's newest entry says when it arrives; entries of one
    micro-batch count before its changes. Changes of a table without an entry wait for one, at
    most ``ttl`` milliseconds (None: without end); those of a deleted entry are dropped. A table's
    changes are dealt to ``parts`` states, and each entry goes to all of them.
    """
    entries = config.select(
        F.col("source_table").alias("table"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("is_config"),
        "sink_table", "sink_row_key", "op", F.lit(None).cast("string").alias("payload"), "ts_ms")
    empty = F.lit(None).cast("string")
    live = changes.where("not (op <=> 'd') and after is not null").select(
        "table", F.pmod(F.xxhash64("after"), F.lit(parts)).cast("int").alias("part"), F.lit(False).alias("is_config"),
        empty.alias("sink_table"), empty.alias("sink_row_key"), "op", F.col("after").alias("payload"), "ts_ms")
    routed = stateful(entries.unionByName(live), ["table", "part"], Routing(ttl), "sink_table string, sink_row_key string, payload string, ts_ms long", PROCESSING if ttl else NO_CLOCK)
    key = F.expr("get_json_object(payload, concat('$.', sink_row_key))")
    return routed.select("sink_table", row_key(key).alias("row_key"), "payload", "ts_ms")
