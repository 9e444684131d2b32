"""Wide event table and what is read from it."""

from pyspark.sql import functions as F

from greenwave.operators import config as cfg, counts as ct, cycles as cy, wide as wd
from greenwave.plans.registry import register

SIG = wd.SIGNAL_STATES
DOWN = "ORDER BY ts, EventCode, EventParam"


def _fill(name, part, op="last_value", frame=""):
    return f"{op}({name}_m IGNORE NULLS) OVER (PARTITION BY day, SignalID{part} {DOWN} {frame})"


UP = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
_marks = [f"max(CASE WHEN EventCode = {c} THEN EventParam END) OVER i AS {n}_m" for n, c in SIG.items()]
_marks += ["max(CASE WHEN EventCode = 31 AND EventParam = 1 THEN ts END) OVER i AS CycleStart_m",
           "CASE WHEN EventCode = 182 THEN -1 ELSE max(CASE WHEN EventCode IN (183, 184) THEN EventParam END) OVER i END AS PowerFailure_m",
           "max(CASE WHEN EventCode = 0 THEN ts END) OVER i AS PhaseStart_m",
           "max(CASE WHEN EventCode BETWEEN 612 AND 651 THEN EventParam END) OVER i AS PedWait_m",
           "CASE WHEN EventCode = 83 THEN -1 ELSE max(CASE WHEN EventCode BETWEEN 84 AND 88 THEN EventParam END) OVER i END AS DetectorFault_m",
           "max(CASE WHEN EventCode IN (1, 8, 10) THEN EventCode END) OVER p AS Interval_m",
           "max(CASE WHEN EventCode BETWEEN 134 AND 149 THEN EventParam END) OVER p AS ProgrammedSplit_m",
           "max(CASE WHEN EventCode BETWEEN 300 AND 315 THEN EventParam END) OVER p AS RecordedSplit_m",
           "CASE WHEN EventCode = 81 THEN ts END AS DetectorOff_m", "CASE WHEN EventCode = 89 THEN ts END AS PedInputOff_m"]
_outs = [f"{_fill(n, '')} AS {n}" for n in (*SIG, "CycleStart")]
_outs += [f"nullif({_fill('PowerFailure', '')}, -1) AS PowerFailure"]
_outs += [f"CASE WHEN Phase IS NOT NULL THEN {_fill(n, ', Phase')} END AS {n}" for n in ("PhaseStart", "Interval", "ProgrammedSplit", "PedWait")]
_outs += [f"CASE WHEN Phase IS NOT NULL THEN {_fill('RecordedSplit', ', Phase', 'first_value', UP)} END AS RecordedSplit",
          f"nullif(CASE WHEN Detector IS NOT NULL THEN {_fill('DetectorFault', ', Detector')} END, -1) AS DetectorFault",
          f"CASE WHEN EventCode = 82 THEN {_fill('DetectorOff', ', Detector', 'first_value', UP)} END AS DetectorOff",
          f"CASE WHEN EventCode = 90 THEN {_fill('PedInputOff', ', PedInput', 'first_value', UP)} END AS PedInputOff"]
_state_codes = ", ".join(str(c) for c in wd.STATE_CODES)
WIDE = {"wide_ev": f"""SELECT * FROM (WITH e AS (SELECT c.SignalID, c."Timestamp" + to_microseconds(CAST(round(coalesce(d.TimeFromStopBar, 0) * 1000000) AS BIGINT)) AS ts,
      c.EventCode, c.EventParam, c.date, CASE WHEN c.EventCode BETWEEN 81 AND 88 THEN c.EventParam END AS Detector,
      CASE WHEN c.EventCode BETWEEN 81 AND 88 THEN d.CallPhase WHEN c.EventCode BETWEEN 134 AND 149 THEN c.EventCode - 133
        WHEN c.EventCode BETWEEN 300 AND 315 THEN c.EventCode - 299 WHEN c.EventCode BETWEEN 612 AND 651 THEN c.EventCode - 611
        WHEN c.EventCode BETWEEN 0 AND 24 OR c.EventCode BETWEEN 41 AND 49 OR c.EventCode = 151 THEN c.EventParam END AS Phase
      FROM controller_events c LEFT JOIN det_config d ON c.SignalID = d.SignalID AND c.EventCode BETWEEN 81 AND 88 AND c.EventParam = d.Detector
      WHERE c.EventCode NOT IN (43, 44)),
    x AS (SELECT *, date AS day FROM e UNION ALL SELECT *, CAST(date + 1 AS DATE) AS day FROM e WHERE date + 1 <= (SELECT max(date) FROM controller_events)
      AND (EventCode IN ({_state_codes}) OR CAST(ts AS DATE) = CAST(date + 1 AS DATE))),
    m AS (SELECT *, CASE WHEN EventCode IN (89, 90) THEN EventParam END AS PedInput, CASE WHEN EventCode BETWEEN 21 AND 24 THEN EventParam END AS PedPhase,
      CASE WHEN EventCode BETWEEN 21 AND 24 THEN EventCode END AS PedIndication, CASE WHEN EventCode IN (4, 5, 6) THEN EventCode END AS TermType,
      {', '.join(_marks)} FROM x WINDOW i AS (PARTITION BY day, SignalID, ts), p AS (PARTITION BY day, SignalID, Phase, ts)),
    f AS (SELECT day, ts, SignalID, EventCode, EventParam, date, Phase, TermType, Detector, PedInput, PedPhase, PedIndication, {', '.join(_outs)} FROM m)
    SELECT f.* EXCLUDE (day, ts), ts AS "Timestamp", date_diff('microsecond', ts, DetectorOff) / 1000000.0 AS DetectorDuration,
      date_diff('microsecond', ts, PedInputOff) / 1000000.0 AS PedInputDuration
    FROM f WHERE EventCode NOT IN (81, 89) AND CAST(ts AS DATE) = day)"""}


def wide(t):
    return wd.widen(t.controller_events, t.det_config)


register("c7_wide_events", wide, "SELECT * FROM wide_ev", "DetectorDuration PedInputDuration", extra=WIDE)
for unit, m in (("1 hour", 60), ("15 min", 15)):
    b = f"""time_bucket(INTERVAL '{m} minutes', "Timestamp")"""
    register(f"c8_arrivals_by_color_{'1hr' if m == 60 else '15min'}", lambda t, unit=unit: cy.arrivals_by_color(wide(t), unit), f"""
    SELECT *, Vehicles / sum(Vehicles) OVER (PARTITION BY SignalID, Timeperiod, Phase) AS "Percent" FROM (
    SELECT SignalID, {b} AS Timeperiod, Phase, CASE Interval WHEN 1 THEN 'Green' WHEN 8 THEN 'Yellow' WHEN 10 THEN 'Red' END AS Interval, count(*) AS Vehicles
    FROM wide_ev WHERE DetectorOff IS NOT NULL AND Phase IS NOT NULL AND Interval IS NOT NULL GROUP BY ALL)""", "Percent", extra=WIDE)
    register(f"m15_wide_vehicle_counts_{'1hr' if m == 60 else '15min'}", lambda t, unit=unit: ct.wide_vehicle_counts(wide(t), unit),
             f"SELECT SignalID, {b} AS Timeperiod, Detector, Phase, count(*) AS Vehicles FROM wide_ev WHERE DetectorOff IS NOT NULL GROUP BY ALL", extra=WIDE)


def with_calls(t):
    """Detections of even parameters get a phase call one tick later; odd ones get two."""
    from greenwave.functions.timeparts import add_seconds
    ev = t.controller_events
    on = ev.where(F.col("EventCode") == 82)
    call = lambda shift: on.select("SignalID", add_seconds("Timestamp", 0.1).alias("Timestamp"), F.lit(43).alias("EventCode"),
                                   ((F.col("EventParam") + shift) % 4 + 1).alias("EventParam"), "date", F.col("EventParam").alias("_d"))
    two = call(1).where(F.col("_d") % 2 == 1)
    return ev.unionByName(call(0).drop("_d")).unionByName(two.drop("_d"))


register("d12_channel_phase_mapping", lambda t: cfg.channel_phase_mapping(with_calls(t)), """
WITH o AS (SELECT SignalID, "Timestamp" AS ts, EventParam FROM controller_events WHERE EventCode = 82),
c AS (SELECT SignalID, ts, EventParam % 4 + 1 AS p FROM o UNION ALL SELECT SignalID, ts, (EventParam + 1) % 4 + 1 FROM o WHERE EventParam % 2 = 1),
j AS (SELECT o.SignalID, o.ts, EventParam AS d, p, count(*) OVER (PARTITION BY o.SignalID, o.ts) AS n FROM o JOIN c ON o.SignalID = c.SignalID AND o.ts = c.ts)
SELECT DISTINCT SignalID, d AS Detector, p AS CallPhase FROM j WHERE n = 1""")
