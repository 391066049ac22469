"""Workflow states, scheduling against brute force, assignments and plans."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import care, scheduling, workflow

DAY = dt.datetime(2025, 3, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def test_routes_and_marks(spark):
    rows = spark.createDataFrame([(s,) for s in workflow.WORKFLOW_STATUSES], "status string")
    routed = {r["status"]: r["next_stage"] for r in workflow.route_by_status(rows).collect()}
    assert routed == {
        "CheckedIn": "InsuranceVerified", "InsuranceVerified": "AssessmentCompleted",
        "AssessmentCompleted": "TreatmentCompleted", "TreatmentCompleted": "FollowUpScheduled",
        "FollowUpScheduled": None, "Completed": None, "Cancelled": None,
    }
    assert workflow.rejected(rows).count() == 3
    places = {r["status"]: r["o"] for r in rows.select("status", workflow.status_ordinal("status").alias("o")).collect()}
    assert places == {s: i for i, s in enumerate(workflow.WORKFLOW_STATUSES)}
    appointment = spark.createDataFrame([("a", "p")], "id string, patient_id string")
    state = workflow.check_in(appointment)
    for stage in list(workflow.STAGE_TIMES)[1:]:
        state = workflow.mark_stage(state, stage)
    row = state.first()
    assert row["status"] == "FollowUpScheduled" and all(row[c] is not None for c in workflow.STAGE_TIMES.values())


def events(spark, rows):
    return spark.createDataFrame(
        [(a, "p", s, at(m)) for a, s, m in rows],
        "appointment_id string, patient_id string, status string, event_time timestamp_ntz",
    )


def refused(spark_rows):
    notes = {}
    for r in workflow.workflow_refusals(spark_rows).collect():
        notes.setdefault(r["appointment_id"], []).extend([r["note"]] * r["reports"])
    return {key: sorted(found) for key, found in notes.items()}


def test_states_from_events(spark):
    stages = list(workflow.STAGE_TIMES)
    rows = [("full", s, i) for i, s in enumerate(stages)]
    rows += [("gap", stages[0], 0), ("gap", stages[2], 5)]
    rows += [("early", stages[0], 5), ("early", stages[1], 1)]
    rows += [("lost", stages[3], 1)]
    random.Random(1).shuffle(rows)
    table = events(spark, rows)
    found = {r["appointment_id"]: r for r in workflow.workflow_states(table).collect()}
    assert found["full"]["status"] == "FollowUpScheduled" and found["full"]["refused"] == 0
    assert found["gap"]["status"] == "CheckedIn" and found["gap"]["refused"] == 1
    assert found["early"]["insurance_verified_at"] is None and found["early"]["status"] == "CheckedIn"
    assert found["lost"]["status"] is None and found["lost"]["metadata"] == {"events": "1"}
    assert refused(table) == {"gap": ["rejected AssessmentCompleted"], "early": [f"rejected {stages[1]}"], "lost": [f"rejected {stages[3]}"]}


def test_later_legal_reports_count_and_all_reports_are_told(spark):
    stages = list(workflow.STAGE_TIMES)
    rows = [("again", stages[1], 1), ("again", stages[0], 2), ("again", stages[1], 3)]
    rows += [("done", s, i) for i, s in enumerate(stages)] + [("done", "Completed", 9), ("done", "Cancelled", 10), ("done", stages[0], 11)]
    rows += [("off", stages[0], 0), ("off", "Cancelled", 1), ("off", stages[1], 2)]
    rows += [("odd", "Asleep", 0), ("odd", None, 1), ("odd", stages[0], 2), ("odd", stages[0], 3), ("odd", "Completed", 4)]
    rows += [(None, stages[0], 0), (None, stages[1], 0), ("never", "Cancelled", 1), ("never", "Cancelled", 1)]
    random.Random(2).shuffle(rows)
    untimed = events(spark, [("odd", stages[1], 0)]).withColumn("event_time", F.lit(None).cast("timestamp_ntz"))
    table = events(spark, rows).unionByName(untimed)
    found = {r["appointment_id"]: r for r in workflow.workflow_states(table).collect()}
    assert found["again"]["status"] == stages[1] and found["again"]["insurance_verified_at"] == at(3)
    assert found["done"]["status"] == "Completed" and found["off"]["status"] == "Cancelled" and found["odd"]["status"] == stages[0]
    assert found[None]["status"] == stages[1] and (found["never"]["status"], found["never"]["patient_id"]) == ("Cancelled", "p")
    notes = refused(table)
    assert notes["again"] == [f"rejected {stages[1]}"] and notes["done"] == ["rejected Cancelled", "rejected CheckedIn"]
    assert notes["off"] == [f"rejected {stages[1]}"] and len(notes["odd"]) == 5 and notes["never"] == ["rejected Cancelled"]
    assert {key: r["refused"] for key, r in found.items() if r["refused"]} == {key: len(found) for key, found in notes.items()}


def walk(reports):
    """One appointment, report by report."""
    place, times, patient, status, notes = -1, {}, None, None, []
    order = lambda r: (r[1] is None, r[1] or 0, workflow.WORKFLOW_STATUSES.index(r[0]) if r[0] in workflow.WORKFLOW_STATUSES else 99, r[2])
    for name, time, who in sorted(reports, key=order):
        at = workflow.WORKFLOW_STATUSES.index(name) if name in workflow.WORKFLOW_STATUSES else 99
        if time is not None and place < 5 and (at == 6 or at == place + 1 and at < 6):
            patient = who if status is None else patient
            place, status = at, name
            times[name] = time
        else:
            notes.append(f"rejected {name}")
    return patient, status, [times.get(stage) for stage in workflow.STAGE_TIMES], sorted(notes)


def test_dealt_out_appointments_are_walked_alike(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None, *map(str, range(900))][: rng.choice([3, 903])]), "p", rng.choice([*workflow.WORKFLOW_STATUSES[:6], None]), at(rng.randrange(90))) for _ in range(4000)]
    table = spark.createDataFrame(rows, "appointment_id string, patient_id string, status string, event_time timestamp_ntz")
    listed = lambda: sorted(map(str, workflow.workflow_states(table).collect()))
    together = listed()
    monkeypatch.setattr(workflow, "HOT_LEAST", 0)
    assert listed() == together


def test_a_walk_shuffles_states_and_reports_once(spark):
    rows = [(str(i), "p", status, at(minute)) for i in range(600) for minute, status in enumerate(["CheckedIn", "Asleep"])]
    table = spark.createDataFrame(rows, "appointment_id string, patient_id string, status string, event_time timestamp_ntz")
    refused = workflow.workflow_refusals(table)
    plan = refused._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 + 6 and "BroadcastHashJoin" not in plan
    assert refused.count() == 600


def test_states_are_those_of_a_walk_with_a_hot_appointment(spark):
    rng = random.Random(4)
    rows = []
    for a in ["hot"] * 1500 + [str(i) for i in range(300) for _ in range(rng.randint(1, 12))]:
        status = rng.choices([*workflow.WORKFLOW_STATUSES, "Asleep"], [6, 6, 6, 6, 6, 3, 0 if a == "hot" and rng.random() > 0.01 else 1, 1])[0]
        rows.append((a, str(rng.randrange(5)), status, None if rng.random() < 0.03 else at(rng.randrange(2000 if a == "hot" else 40))))
    table = spark.createDataFrame(rows, "appointment_id string, patient_id string, status string, event_time timestamp_ntz").repartition(7)
    want = {}
    for a, who, status, time in rows:
        want.setdefault(a, []).append((status, time, who))
    want = {a: walk([(s, t and (t - DAY).total_seconds(), w) for s, t, w in reports]) for a, reports in want.items()}
    notes = refused(table)
    found = workflow.workflow_states(table).collect()
    assert len(found) == len(want)
    for r in found:
        times = [r[name] and (r[name] - DAY).total_seconds() for name in workflow.STAGE_TIMES.values()]
        got = (r["patient_id"], r["status"], times, notes.get(r["appointment_id"], []))
        assert got == want[r["appointment_id"]], r["appointment_id"]


def test_states_tell_every_refusal_in_order(spark):
    stages = list(workflow.STAGE_TIMES)
    rows = [("a", stages[0], 0), ("a", "Cancelled", 9), ("a", stages[0], 5), ("a", stages[0], 5), ("a", stages[2], 3), ("a", "Asleep", 3), ("b", stages[0], 1)]
    untimed = events(spark, [("a", None, 0), ("a", stages[1], 0)]).withColumn("event_time", F.lit(None).cast("timestamp_ntz"))
    found = {r["appointment_id"]: r for r in workflow.workflow_states(events(spark, rows).unionByName(untimed)).collect()}
    told = [stages[2], "Asleep", stages[0], stages[0], stages[1], "nothing"]
    assert found["a"]["notes"] == [f"rejected {status}" for status in told] and found["a"]["refused"] == 6
    assert found["b"]["notes"] == [] and found["b"]["refused"] == 0


def test_an_appointment_of_a_million_reports(spark):
    stages = F.array(*[F.lit(s) for s in ("CheckedIn", "InsuranceVerified", "AssessmentCompleted", "Asleep")])
    many = spark.range(1_000_000).select(
        F.lit("one").alias("appointment_id"), F.lit("p").alias("patient_id"), F.element_at(stages, (F.col("id") % 4 + 1).cast("int")).alias("status"),
        (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_time"),
    )
    row = workflow.workflow_states(many).first()
    assert (row["status"], row["refused"], row["metadata"]["events"]) == ("AssessmentCompleted", 999_997, "1000000")
    assert workflow.workflow_refusals(many).agg(F.sum("reports")).first()[0] == 999_997


def test_lookup_and_first(spark):
    states = spark.createDataFrame([("a", "CheckedIn")], "id string, status string")
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    assert {tuple(r) for r in workflow.status_lookup(states, ids, "id").collect()} == {("a", "CheckedIn"), ("b", "NOT_FOUND")}
    rows = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early"), ("m", 5, "only")], "k string, t int, v string")
    assert {(r["k"], r["v"]) for r in workflow.register_first(rows, "k", ["t"]).collect()} == {("k", "early"), ("m", "only")}


@pytest.fixture(scope="module")
def booked(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        start = at(rng.choice([60, rng.randrange(0, 3 * 1440)]))
        rows.append((i, rng.choice("AAAB"), start, start + dt.timedelta(minutes=rng.choice([15, 45, 90, 1500]))))
    rows.append((400, "A", at(10), at(10)))
    rows.append((401, "B", at(70), at(20)))
    frame = spark.createDataFrame(rows, "id int, room_id string, start timestamp_ntz, end timestamp_ntz")
    return rows, frame.withColumn("dentist_id", F.col("room_id"))


def test_conflicts_against_brute_force(booked):
    rows, frame = booked
    good = [r for r in rows if r[2] < r[3]]
    expected = {r[0]: None for r in rows}
    for a in good:
        expected[a[0]] = sum(1 for b in good if b[0] != a[0] and b[1] == a[1] and a[2] < b[3] and b[2] < a[3])
    assert {r["id"]: r["conflicts"] for r in scheduling.room_conflicts(frame).collect()} == expected


def test_queue_against_brute_force(booked):
    rows, frame = booked
    good = [r for r in rows if r[2] < r[3]]
    expected = {}
    for _, room, start, _ in good:
        ends = [b[3] for b in good if b[1] == room and b[2] < start and b[3] > start]
        expected[room, start] = (sum(1 for b in good if (b[1], b[2]) == (room, start)), max(ends, default=None))
    found = {(r["room_id"], r["start"]): (r["bookings"], r["busy_until"]) for r in scheduling.room_queue(frame).collect()}
    assert found == expected


def test_free_slots_against_brute_force(spark, booked):
    rows, frame = booked
    calendar = spark.createDataFrame([("A", dt.date(2025, 4, 1)), ("B", dt.date(2025, 3, 1))], "dentist_id string, day date")
    days = {("A", dt.date(2025, 4, 1))}
    good = [r for r in rows if r[2] < r[3]]
    for _, room, start, end in good:
        day = start.date()
        while day <= end.date():
            days.add((room, day))
            day += dt.timedelta(days=1)
    expected = set()
    for room, day in days:
        opens = dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=8)
        minutes = [
            not any(b[1] == room and b[2] <= opens + dt.timedelta(minutes=m) < b[3] for b in good) for m in range(540)
        ]
        m = 0
        while m < 540:
            if not minutes[m]:
                m += 1
                continue
            end = m
            while end < 540 and minutes[end]:
                end += 1
            if end - m >= 30:
                expected.add((room, day, opens + dt.timedelta(minutes=m), opens + dt.timedelta(minutes=end)))
            m = end
    found = {(r["dentist_id"], r["day"], r["start"], r["end"]) for r in scheduling.free_slots(frame, calendar=calendar).collect()}
    assert found == expected


def test_assignments(spark):
    skilled = "name string, expertise array<string>"
    staff = spark.createDataFrame([("Kim", ["cut", "sew", "press"]), ("Lou", ["sew", "pack"]), ("Max", ["press", "pack"])], skilled)
    tasks = [("hem", ["sew"]), ("suit", ["cut", "press"]), ("parcel", ["pack", "pack"]), ("shoe", ["sew", "glue"])]
    found = scheduling.assign_by_expertise(spark.createDataFrame(tasks, "name string, required_expertise array<string>"), staff).collect()
    assert {r["name"]: (r["assigned_to"], r["candidates"]) for r in found} == {"hem": ("Lou", 2), "suit": ("Kim", 1), "parcel": ("Lou", 2), "shoe": (None, 0)}


def test_plans(spark):
    bodies = spark.createDataFrame(
        [("a", '{"preferred_treatment_approach": "Minimally invasive", "comfort_priorities": ["Pain management", "Home care"],'
               ' "scheduling_needs": "Afternoon appointments", "interested_in_research": true}'), ("b", "{}")],
        "id string, body string",
    ).select("id", F.from_json("body", care.PREFERENCES_SCHEMA).alias("preferences"))
    plans = care.care_plan(bodies).select(
        "id", "treatment_plan", care.research_participation("preferences.interested_in_research").alias("research")
    )
    found = {r["id"]: r for r in plans.collect()}
    assert found["a"]["treatment_plan"]["comfort_measures"] == ["Pain management", "Home care"]
    assert found["a"]["research"]["opt_out_protocol"] == "Available at any time"
    assert found["b"]["treatment_plan"]["primary_treatment"] is None
    assert found["b"]["research"]["participation"] == "None - patient preference"
    exams = spark.sql(
        "SELECT 1 AS id, named_struct('restorative_needs', CAST(NULL AS ARRAY<STRING>), 'referral_needs', array('endodontics', 'x'),"
        " 'priority_treatments', array('p')) AS examination"
    )
    plan = care.treatment_plan(exams)
    row = plan.first()["treatment_plan"]
    assert row["restorative_care"] == [] and row["priority_procedures"] == ["p"] and row["estimated_timeline"] == "12 months"
    tasks = scheduling.referral_tasks(plan.select("id", "treatment_plan.specialist_referrals"), "visit", ["x"]).collect()
    assert [t["referral"] for t in tasks] == ["endodontics", "x"] and tasks[0]["specialist_referrals"] == ["endodontics", "x"]


@pytest.mark.parametrize("most_sets", [0, 1000])
def test_staff_of_one_name_and_tasks_without_requirements(spark, most_sets):
    staff = spark.createDataFrame([("Ann", ["a"]), ("Ann", ["b"]), ("Ann", ["a"]), ("Bob", ["a", "b", "c"])], "name string, expertise array<string>")
    tasks = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, []), (4, ["z"]), (5, None)], "t int, required_expertise array<string>")
    got = {r["t"]: (r["assigned_to"], r["candidates"]) for r in scheduling.assign_by_expertise(tasks, staff, most_sets).collect()}
    assert got == {1: ("Bob", 1), 2: ("Ann", 2), 3: ("Ann", 3), 4: (None, 0), 5: (None, 0)}
    by_id = staff.withColumn("id", F.monotonically_increasing_id())
    assert {r["t"]: r["candidates"] for r in scheduling.assign_by_expertise(tasks, by_id, most_sets).collect()} == {1: 1, 2: 3, 3: 4, 4: 0, 5: 0}


@pytest.mark.parametrize("bucket", ["1 hour", "7 minutes", "30 days"])
def test_conflicting_bookings_are_those_of_all_pairs(spark, bucket):
    rng = random.Random(8)
    rows = [(i, rng.choice("ab"), at(s := rng.randrange(3000)), at(s + rng.choice([-5, 0, 1, 20, 45, 60, 61, 900]))) for i in range(150)]
    rows += [(900, "a", at(-5000), at(90_000)), (901, None, at(0), at(9)), (902, "a", None, at(9)), (903, "b", at(60), at(120)), (904, "b", at(120), at(180)), (None, "b", at(60), at(61))]
    table = spark.createDataFrame(rows, "id int, room_id string, start timestamp_ntz, end timestamp_ntz").withColumn("other", F.lit("clash"))
    wanted = table.where("id % 3 = 0 or id is null")
    valid = [r for r in rows if r[1] and r[2] and r[2] < r[3]]
    want = {
        (a[0], b[0], a[1], max(a[2], b[2]), min(a[3], b[3]))
        for a in valid if a[0] is None or a[0] % 3 == 0 for b in valid
        if a[1] == b[1] and a[2] < b[3] and b[2] < a[3] and a[0] != b[0]
    }
    got = [tuple(r) for r in scheduling.conflicting_bookings(wanted, table, bucket).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200
    assert scheduling.conflicting_bookings(wanted.limit(0), table).count() == 0
