"""Room conflicts, free slots and task assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import materialize

def room_conflicts(bookings: DataFrame, room: str = "room_id", start: str = "start", end: str = "end") -> DataFrame:
    """Add ``conflicts``: how many other bookings of the room overlap each one.

    Overlaps are counted, not listed: those of a booking are the ones that
    start before its end, less the ones that end by its start, less itself.
    Both are running totals over the distinct times of a room, so rows that
    share a time are combined before anything is ordered, and the order is
    kept per room and day. Points and totals are scratch tables, each made once and read twice. Bookings that do not end after they start have a
    null count and hinder nobody.
    """
    valid = F.col(start) < F.col(end)
    times = bookings.where(valid).select(
        room,
        F.explode(
            F.array(
                F.struct(F.col(start).alias("t"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
                F.struct(F.col(end).alias("t"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
            )
        ).alias("_point"),
    )
    points = materialize(
        times.groupBy(room, F.col("_point.t").alias("_t"))
        .agg(F.sum("_point.starts").alias("_starts"), F.sum("_point.ends").alias("_ends"))
        .withColumn("_day", F.to_date("_t")),
        "room-points",
    )
    earlier_days = Window.partitionBy(room).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        points.groupBy(room, "_day")
        .agg(F.sum("_starts").alias("_s"), F.sum("_ends").alias("_e"))
        .select(
            room,
            "_day",
            F.coalesce(F.sum("_s").over(earlier_days), F.lit(0)).alias("_starts_before_day"),
            F.coalesce(F.sum("_e").over(earlier_days), F.lit(0)).alias("_ends_before_day"),
        )
    )
    in_day = Window.partitionBy(room, "_day").orderBy("_t")
    before = in_day.rowsBetween(Window.unboundedPreceding, -1)
    through = in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = materialize(
        points.join(days, [room, "_day"]).select(
            room,
            "_t",
            (F.col("_starts_before_day") + F.coalesce(F.sum("_starts").over(before), F.lit(0))).alias("_started"),
            (F.col("_ends_before_day") + F.sum("_ends").over(through)).alias("_ended"),
        ),
        "room-totals",
    )
    at_end = totals.select(room, F.col("_t").alias(end), "_started")
    at_start = totals.select(room, F.col("_t").alias(start), "_ended")
    return (
        bookings.join(at_end, [room, end], "left")
        .join(at_start, [room, start], "left")
        .select(*bookings.columns, F.when(valid, F.col("_started") - F.col("_ended") - 1).alias("conflicts"))
    )


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def conflicting_bookings(
    wanted: DataFrame, bookings: DataFrame, bucket: str = "1 hour", key: str = "id", room: str = "room_id", start: str = "start", end: str = "end"
) -> DataFrame:
    """``key, other, room, overlap_start, overlap_end``: which bookings collide with each of the ``wanted`` ones.

    Both sides stand in every time bucket that they meet and join on room and bucket; a pair is told by the first bucket that both meet,
    so it comes out once and no rooms' bookings are paired beyond a bucket. The work is that of the buckets and of the result; a
    ``bucket`` near the usual length of a booking keeps both small. A booking never collides with its own ``key``, in either table. Those that
    do not end after they start, or lack a room or a time, hinder nobody. An empty table gives no rows.
    """
    width = f"timestampdiff(MICROSECOND, {_EPOCH}, {_EPOCH} + INTERVAL {bucket})"
    since = lambda name: f"timestampdiff(MICROSECOND, {_EPOCH}, cast(`{name}` as timestamp_ntz))"

    def bucketed(df: DataFrame, side: str) -> DataFrame:
        valid = df.where((F.col(start) < F.col(end)) & F.col(room).isNotNull())
        first, last = F.expr(f"floor({since(start)} / {width})"), F.expr(f"floor(({since(end)} - 1) / {width})")
        named = valid.select(F.col(key).alias(f"{side}_key"), F.col(room).alias("_room"), F.col(start).alias(f"{side}_start"), F.col(end).alias(f"{side}_end"), first.alias(f"{side}_first"), last.alias("_last"))
        return named.withColumn("_bucket", F.explode(F.sequence(f"{side}_first", "_last"))).drop("_last")

    met = bucketed(wanted, "_a").join(bucketed(bookings, "_b"), ["_room", "_bucket"])
    overlap = (F.col("_a_start") < F.col("_b_end")) & (F.col("_b_start") < F.col("_a_end")) & ~F.col("_a_key").eqNullSafe(F.col("_b_key"))
    once = F.col("_bucket") == F.greatest("_a_first", "_b_first")
    return met.where(overlap & once).select(
        F.col("_a_key").alias(key),
        F.col("_b_key").alias("other"),
        F.col("_room").alias(room),
        F.greatest("_a_start", "_b_start").alias("overlap_start"),
        F.least("_a_end", "_b_end").alias("overlap_end"),
    )


def room_queue(bookings: DataFrame, room: str = "room_id", start: str = "start", end: str = "end") -> DataFrame:
    """``room, start, bookings, busy_until``: when each start time finds its room still taken.

    ``busy_until`` is the latest end among bookings that started before; null
    if the room is free. Rows are the distinct start times of a room. The
    running maximum is taken within a day and carried over from the days
    before.
    """
    starts = (
        bookings.where(F.col(start) < F.col(end))
        .groupBy(room, start)
        .agg(F.count(F.lit(1)).alias("bookings"), F.max(end).alias("_end"))
        .withColumn("_day", F.to_date(start))
    )
    earlier_days = Window.partitionBy(room).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        starts.groupBy(room, "_day")
        .agg(F.max("_end").alias("_day_end"))
        .select(room, "_day", F.max("_day_end").over(earlier_days).alias("_carried"))
    )
    before = Window.partitionBy(room, "_day").orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.greatest(F.col("_carried"), F.max("_end").over(before))
    return (
        starts.join(days, [room, "_day"])
        .withColumn("_taken", taken)
        .select(room, start, "bookings", F.when(F.col("_taken") > F.col(start), F.col("_taken")).alias("busy_until"))
    )


def _clock(day: Column, minutes: int) -> Column:
    return day.cast("timestamp_ntz") + F.expr(f"INTERVAL '{minutes}' MINUTE")


def free_slots(
    bookings: DataFrame,
    open_minute: int = 8 * 60,
    close_minute: int = 17 * 60,
    slot_minutes: int = 30,
    calendar: DataFrame | None = None,
    dentist: str = "dentist_id",
    start: str = "start",
    end: str = "end",
) -> DataFrame:
    """``dentist, day, start, end, is_available``: gaps of at least one slot in opening hours.

    Days are those of the bookings, plus the ``dentist, day`` rows of
    ``calendar``. Bookings over midnight count on each of their days. Bookings
    that start together are combined before the window, whose groups are one
    dentist's distinct start times of one day.
    """
    days = bookings.where(F.col(start) < F.col(end)).select(
        dentist,
        F.explode(F.sequence(F.to_date(start), F.to_date(end), F.expr("INTERVAL 1 DAY"))).alias("day"),
        F.col(start).alias("_s"),
        F.col(end).alias("_e"),
    )
    opens, closes = _clock(F.col("day"), open_minute), _clock(F.col("day"), close_minute)
    # A booking of no length at opening time stands for the day itself.
    spans = F.array(
        F.struct(opens.alias("s"), opens.alias("e")),
        F.struct(
            F.least(F.greatest("_s", opens), closes).alias("s"), F.least(F.greatest("_e", opens), closes).alias("e")
        ),
    )
    busy = days.select(dentist, "day", F.explode(spans).alias("_span"))
    if calendar is not None:
        busy = busy.unionByName(
            calendar.select(dentist, "day", F.struct(opens.alias("s"), opens.alias("e")).alias("_span"))
        )
    merged = busy.groupBy(dentist, "day", F.col("_span.s").alias("_s")).agg(F.max("_span.e").alias("_e"))
    order = Window.partitionBy(dentist, "day").orderBy("_s")
    return (
        merged.select(
            dentist,
            "day",
            F.max("_e").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(start),
            F.coalesce(F.lead("_s").over(order), closes).alias(end),
        )
        .where(F.col(end) >= F.col(start) + F.expr(f"INTERVAL '{slot_minutes}' MINUTE"))
        .withColumn("is_available", F.lit(True))
    )


def assign_by_expertise(tasks: DataFrame, staff: DataFrame, most_sets: int = 1000) -> DataFrame:
    """Add ``assigned_to`` and ``candidates`` to tasks with ``required_expertise``.

    ``staff`` has ``name, expertise`` and, where names repeat, ``id``; without it a name and its set of skills are a
    person. A candidate covers every required skill, and anyone covers none; the one with the fewest skills is taken, by name,
    then id among equals. Tasks nobody covers, and those whose requirements are null, have a null assignment.

    The division runs over the distinct requirement sets. Up to ``most_sets`` of them, their answers return to the tasks as a map
    literal inside the row, without a shuffle; beyond that size by an equi-join.
    """
    person = F.col("id").cast("string") if "id" in staff.columns else F.concat_ws("\x1f", F.array_sort(F.array_distinct("expertise")))
    staff = staff.select("name", F.coalesce(person, F.lit("")).alias("_id"), F.array_compact(F.array_distinct("expertise")).alias("expertise"))
    staff = staff.distinct()
    need = F.array_sort(F.array_compact(F.array_distinct("required_expertise")))
    needed = tasks.select(need.alias("_need")).where("_need is not null").distinct()
    skills = staff.select("name", "_id", F.size("expertise").alias("_skills"), F.explode("expertise").alias("_skill"))
    hits = (
        needed.select("_need", F.explode("_need").alias("_skill"))
        .join(skills, "_skill")
        .groupBy("_need", "name", "_id", "_skills")
        .agg(F.count(F.lit(1)).alias("_hits"))
        .where(F.col("_hits") == F.size("_need"))
    )
    anyone = needed.where(F.size("_need") == 0).join(staff.select("name", "_id", F.size("expertise").alias("_skills")).withColumn("_none", F.lit(0)),
                                                      F.size("_need") == F.col("_none"))
    covered = (
        hits.select("_need", "name", "_id", "_skills")
        .unionByName(anyone.select("_need", "name", "_id", "_skills"))
        .groupBy("_need")
        .agg(F.min(F.struct("_skills", "name", "_id")).alias("_best"), F.count(F.lit(1)).alias("_candidates"))
        .select("_need", F.col("_best.name").alias("_name"), "_candidates")
    )
    answers = covered.limit(most_sets + 1).collect()
    if len(answers) > most_sets:
        answered = tasks.withColumn("_need", need).join(covered, "_need", "left")
    else:
        text = lambda skills: F.to_json(skills)
        pairs = [part for row in answers for part in (text(F.array(*[F.lit(s) for s in row["_need"]]).cast("array<string>")),
                                                       F.struct(F.lit(row["_name"]).alias("_name"), F.lit(row["_candidates"]).alias("_candidates")))]
        if pairs:
            answered = tasks.withColumn("_answer", F.try_element_at(F.create_map(*pairs), text(need))).select("*", "_answer.*")
        else:
            answered = tasks.select("*", F.lit(None).cast("string").alias("_name"), F.lit(None).cast("bigint").alias("_candidates"))
    return answered.select(
        *tasks.columns, F.col("_name").alias("assigned_to"), F.coalesce("_candidates", F.lit(0).cast("bigint")).alias("candidates")
    )


def referral_tasks(plans: DataFrame, task: str, required: Sequence[str], referrals: str = "specialist_referrals") -> DataFrame:
    """One ``task`` that needs the skills ``required`` per referral of a plan, with the plan's columns; a plan without referrals has none."""
    return plans.withColumn("referral", F.explode(referrals)).withColumns(
        {"task": F.lit(task), "required_expertise": F.array(*[F.lit(skill) for skill in required]).cast("array<string>")}
    )
