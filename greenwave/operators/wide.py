"""The wide event table: every event with the state its signal, phase and detector were in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.ordered import never_null

# fixed controller event codes
DETECTOR_CODES = range(81, 89)
PED_PHASE_CODES = range(21, 25)
SPLIT_CODES = range(134, 150)
ACTUAL_SPLIT_CODES = range(300, 316)
PED_WAIT_CODES = range(612, 652)
PHASE_PARAM_CODES = [*range(0, 25), *range(41, 50), 151]
SIGNAL_STATES = {"Ring": 31, "CoordPattern": 131, "CycleLength": 132, "ActualCycleLength": 316,
                 "ActualNaturalCycleLength": 317, "CycleOffset": 133, "ActualCycleOffset": 318,
                 "CoordState": 150, "FlashStatus": 173}
DROPPED = (43, 44)
DROPPED_AFTER_PAIRING = (81, 89)
# codes whose effect can last into the next day
STATE_CODES = [0, 1, 8, 10, 31, 131, 132, 133, 150, 173, 182, 183, 184, 316, 317, 318,
               *range(83, 89), *SPLIT_CODES, *PED_WAIT_CODES]
OUTPUT = ("Timestamp SignalID EventCode EventParam date Ring CycleStart CoordPattern CoordState CycleLength "
          "ActualCycleLength ActualNaturalCycleLength CycleOffset ActualCycleOffset FlashStatus PowerFailure Phase "
          "PhaseStart Interval TermType ProgrammedSplit RecordedSplit Detector DetectorFault DetectorOff "
          "DetectorDuration PedInput PedWait PedInputOff PedInputDuration PedPhase PedIndication").split()


def event_phase(code: Column, param: Column, detector_phase: Column) -> Column:
    """The phase an event is about, from its code or its parameter."""
    return (F.when(code.isin(*DETECTOR_CODES), detector_phase)
            .when(code.isin(*SPLIT_CODES), code - 133)
            .when(code.isin(*ACTUAL_SPLIT_CODES), code - 299)
            .when(code.isin(*PED_WAIT_CODES), code - 611)
            .when(code.isin(*PHASE_PARAM_CODES), param))


def map_detectors(events: DataFrame, config: DataFrame) -> DataFrame:
    """Events with the detector, its phase, and the clock moved by its travel time from the stop bar."""
    keys = ["SignalID", "Detector"] + (["date"] if "date" in config.columns else [])
    conf = config.select(*keys, "CallPhase", "TimeFromStopBar")
    is_det = F.col("EventCode").isin(*DETECTOR_CODES)
    rows = events.withColumn("Detector", F.when(is_det, F.col("EventParam")))
    rows = rows.join(conf, keys, "left")
    return rows.withColumn("Timestamp", tp.add_seconds("Timestamp", F.coalesce("TimeFromStopBar", F.lit(0.0)))).withColumn(
        "Phase", event_phase(F.col("EventCode"), F.col("EventParam"), F.col("CallPhase"))).drop("CallPhase", "TimeFromStopBar")


#: What an event sets, by the rows it holds for afterwards: all of the signal, its phase, detector or pedestrian input.
#: -1 is the stop code of power failures and detector faults: it is carried like any value and reads as none.
SIGNAL_MARKS = (*SIGNAL_STATES, "CycleStart", "PowerFailure")
PHASE_MARKS = ("PhaseStart", "Interval", "ProgrammedSplit", "PedWait")
#: These hold for the rows before them.
PHASE_MARKS_BACK, DETECTOR_MARKS_BACK, PED_MARKS_BACK = ("RecordedSplit",), ("DetectorOff",), ("PedInputOff",)
DETECTOR_MARKS = ("DetectorFault",)
SCOPES = {"s": (None, SIGNAL_MARKS, ()), "p": ("Phase", PHASE_MARKS, PHASE_MARKS_BACK), "d": ("Detector", DETECTOR_MARKS, DETECTOR_MARKS_BACK),
          "i": ("PedInput", (), PED_MARKS_BACK)}
FORWARD = (*SIGNAL_MARKS, *PHASE_MARKS, *DETECTOR_MARKS)
BACKWARD = (*PHASE_MARKS_BACK, *DETECTOR_MARKS_BACK, *PED_MARKS_BACK)
ORDER = ("Timestamp", "EventCode", "EventParam")
BUCKET = ["_day", "_s", "_b"]


def with_marks(rows: DataFrame) -> DataFrame:
    """What each row sets; a value set at an instant holds for every row of that instant."""
    code, param, ts = (F.col(c) for c in ("EventCode", "EventParam", "Timestamp"))
    instant, phase_instant = Window.partitionBy(*BUCKET, "Timestamp"), Window.partitionBy(*BUCKET, "Phase", "Timestamp")
    marks = {n: F.max(F.when(code == c, param)).over(instant) for n, c in SIGNAL_STATES.items()}
    marks["CycleStart"] = F.max(F.when((code == 31) & (param == 1), ts)).over(instant)
    marks["PowerFailure"] = F.when(code == 182, -1).otherwise(F.max(F.when(code.isin(183, 184), param)).over(instant))
    marks["PhaseStart"] = F.max(F.when(code == 0, ts)).over(instant)
    marks["PedWait"] = F.max(F.when(code.isin(*PED_WAIT_CODES), param)).over(instant)
    marks["DetectorFault"] = F.when(code == 83, -1).otherwise(F.max(F.when(code.isin(*range(84, 89)), param)).over(instant))
    marks["Interval"] = F.max(F.when(code.isin(1, 8, 10), code)).over(phase_instant)
    marks["ProgrammedSplit"] = F.max(F.when(code.isin(*SPLIT_CODES), param)).over(phase_instant)
    marks["RecordedSplit"] = F.max(F.when(code.isin(*ACTUAL_SPLIT_CODES), param)).over(phase_instant)
    marks["DetectorOff"], marks["PedInputOff"] = F.when(code == 81, ts), F.when(code == 89, ts)
    return rows.withColumns(marks)


def handed_states(marked: DataFrame) -> DataFrame:
    """One row for each bucket: the states that earlier buckets of its day hand to it, and for backward marks the later ones.

    _s_in is a struct, _p_in, _d_in and _i_in are maps by phase, detector and pedestrian input.  The last mark of each kind is
    found in each bucket first, so what moves from bucket to bucket is a row for each phase and detector, not for each event.
    """
    rank = F.struct(*ORDER, "date", "SignalID")  # with all columns of the layout, so that it is made once for both readers
    edge = {n: (F.max if n in FORWARD else F.min)(F.when(F.col(n).isNotNull(), F.struct(rank.alias("rank"), F.col(n).alias("mark")))).alias(n) for n in (*FORWARD, *BACKWARD)}
    tails = marked.groupBy(*BUCKET, "Phase", "Detector", "PedInput").agg(*edge.values())
    of = [F.struct(F.lit(scope).alias("_scope"), (F.lit(0) if key is None else F.col(key)).cast("int").alias("_key")) for scope, (key, _, _) in SCOPES.items()]
    scoped = tails.select("*", F.inline(F.filter(F.array(*of), lambda x: x["_key"].isNotNull())))
    mine = lambda n: F.when(F.col("_scope") == next(s for s, (_, f, b) in SCOPES.items() if n in (*f, *b)), F.col(n))
    ends = scoped.groupBy(*BUCKET, "_scope", "_key").agg(*[(F.max if n in FORWARD else F.min)(mine(n)).alias(n) for n in (*FORWARD, *BACKWARD)])
    entity = Window.partitionBy("_day", "_s", "_scope", "_key")
    before = entity.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    after = entity.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(*BUCKET, "_scope", "_key", *[F.last(F.col(f"{n}.mark"), ignorenulls=True).over(before if n in FORWARD else after).alias(n) for n in (*FORWARD, *BACKWARD)])
    packed = []
    for scope, (key, forward, backward) in SCOPES.items():
        state = F.when(F.col("_scope") == scope, F.struct(*forward, *backward))
        packed.append(F.any_value(state, F.lit(True)).alias("_s_in") if key is None
                      else F.map_from_entries(F.collect_list(F.when(F.col("_scope") == scope, F.struct("_key", state)))).alias(f"_{scope}_in"))
    return handed.groupBy(*BUCKET).agg(*packed)


def widen(events: DataFrame, config: DataFrame, bucket_minutes: int = 60) -> DataFrame:
    """State columns for every event; state lasts at most from the day before.

    Each event joins the group of its own day and, where its effect can outlast the day, of the next.  Within a day the
    events of a signal are laid out by buckets of an hour, once: the marks, the filling inside a bucket and the table of what buckets
    hand on (``handed_states``) all work on that layout, so no task sorts more than an hour of a signal at a time.
    """
    rows = map_detectors(events.where(~F.col("EventCode").isin(*DROPPED)), config)
    code, param, ts = F.col("EventCode"), F.col("EventParam"), F.col("Timestamp")
    last_day = events.select(F.max("date")).scalar()
    rows = rows.withColumn("_day", F.explode(F.array(F.col("date"), F.date_add("date", 1))))
    lasting = code.isin(*STATE_CODES) | (tp.day("Timestamp") == F.col("_day"))
    rows = rows.where((F.col("_day") == F.col("date")) | (lasting & (F.col("_day") <= last_day)))
    rows = rows.withColumn("_b", tp.floor_minutes("Timestamp", bucket_minutes))
    rows = rows.withColumns({"_day": never_null(rows, "_day"), "_s": never_null(rows, "SignalID"), "_b": never_null(rows, "_b")}).repartition(*BUCKET)
    rows = with_marks(rows.withColumns({
        "PedInput": F.when(code.isin(89, 90), param),
        "PedPhase": F.when(code.isin(*PED_PHASE_CODES), param),
        "PedIndication": F.when(code.isin(*PED_PHASE_CODES), code),
        "TermType": F.when(code.isin(4, 5, 6), code)}))

    def inside(name, key, backward):
        # backwards means the rows in reverse, so that the frame grows
        order = [F.desc(c) if backward else F.asc(c) for c in (*ORDER, "date")]
        w = Window.partitionBy(*BUCKET, *([key] if key else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return F.last(name, ignorenulls=True).over(w)

    marks = [(n, scope, key, n in BACKWARD) for scope, (key, forward, backward) in SCOPES.items() for n in (*forward, *backward)]
    filled = rows.withColumns({f"_w_{n}": inside(n, key, back) for n, _, key, back in marks})
    joined = filled.join(handed_states(rows), BUCKET, "left")
    fills = {}
    for n, scope, key, _ in marks:
        state = F.col("_s_in") if key is None else F.try_element_at(F.col(f"_{scope}_in"), F.col(key))
        value = F.coalesce(f"_w_{n}", state[n])
        fills[n] = value if key is None else F.when(F.col(key).isNotNull(), value)
    fills["PowerFailure"], fills["DetectorFault"] = (F.nullif(fills[n], F.lit(-1)) for n in ("PowerFailure", "DetectorFault"))
    fills["DetectorOff"] = F.when(code == 82, fills["DetectorOff"])
    fills["PedInputOff"] = F.when(code == 90, fills["PedInputOff"])
    out = joined.withColumns(fills).withColumns({
        "DetectorDuration": tp.seconds_between("Timestamp", "DetectorOff"),
        "PedInputDuration": tp.seconds_between("Timestamp", "PedInputOff")})
    return out.where(~code.isin(*DROPPED_AFTER_PAIRING) & (tp.day("Timestamp") == F.col("_day"))).select(*OUTPUT)
