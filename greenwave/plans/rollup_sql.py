"""SQL text for the generic roll-ups, for checking the Spark plans."""

from __future__ import annotations

from greenwave.plans.adapters_sql import dow, week

PEAK = "hour({c}) IN (6, 7, 8, 9, 15, 16, 17, 18, 19)"
AM, PM = "hour(Hour) IN (6, 7, 8, 9)", "hour(Hour) IN (15, 16, 17, 18, 19)"
MIDWEEK = "DOW IN (3, 4, 5)"


def wmean(x: str, w: str) -> str:
    return (f'CASE WHEN count(*) FILTER ({x} IS NOT NULL AND {w} IS NULL) = 0 THEN sum({x} * {w}) / '
            f'nullif(sum({w}) FILTER ({x} IS NOT NULL), 0) END')


def mean(src: str, keys: str, x: str, w: str) -> str:
    return f"SELECT {keys}, {wmean(x, w)} AS {x}, coalesce(sum({w}), 0) AS {w} FROM ({src}) GROUP BY ALL"


def total(src: str, keys: str, x: str) -> str:
    return f"SELECT {keys}, coalesce(sum({x}), 0) AS {x} FROM ({src}) GROUP BY ALL"


def avg(src: str, keys: str, x: str) -> str:
    return f"SELECT {keys}, avg({x}) AS {x} FROM ({src}) GROUP BY ALL"


def delta(src: str, entity: str, per: str, x: str) -> str:
    return (f"SELECT *, ({x} - lag({x}) OVER w) / nullif(lag({x}) OVER w, 0) AS delta FROM ({src}) "
            f"WINDOW w AS (PARTITION BY {entity} ORDER BY {per})")


def ones(src: str, w: str | None) -> tuple[str, str]:
    return (f"SELECT *, 1.0::DOUBLE AS ones FROM ({src})", "ones") if w is None else (src, w)


def tuesday(src: str, base: str, date: str = "Date") -> str:
    return (f"SELECT *, greatest((SELECT min({date}) FROM ({base})), CAST(DATE '2016-12-25' + CAST(Week * 7 + 2 AS INTEGER) AS DATE)) AS Date FROM ({src})")


def period_avg(src, x, per, w=None, entity="SignalID"):
    src, w = ones(src, w)
    return delta(mean(src, f"{entity}, {per}", x, w), entity, per, x)


def period_sum(src, x, per, entity="SignalID"):
    return delta(total(src, f"{entity}, {per}", x), entity, per, x)


def weekly_sum_by_day(src, x):
    a = total(avg(src, "SignalID, Week, CallPhase", x), "SignalID, Week", x)
    return tuesday(delta(a, "SignalID", "Week", x), src)


def weekly_avg_by_day(src, x, w=None, peak=True):
    s, w = ones(src, w)
    rows = f"SELECT * FROM ({s}) WHERE {PEAK.format(c='Date_Hour')}" if peak else s
    keys = f"SELECT DISTINCT SignalID, CallPhase FROM ({rows})"
    grid = f"SELECT k.*, unnest(range((SELECT min(Week) FROM ({rows})), (SELECT max(Week) + 1 FROM ({rows})))) AS Week FROM ({keys}) k"
    dense = f"SELECT g.SignalID, g.CallPhase, g.Week, {x}, {w} FROM ({grid}) g LEFT JOIN ({rows}) r ON g.SignalID = r.SignalID AND g.CallPhase = r.CallPhase AND g.Week = r.Week"
    out = mean(mean(dense, "SignalID, CallPhase, Week", x, w), "SignalID, Week", x, w)
    return tuesday(delta(out, "SignalID", "Week", x), src)


def monthly_avg_by_day(src, x, w=None, peak=False):
    rows = f"SELECT *, CAST(date_trunc('month', Date) AS DATE) AS Month FROM ({src})" + (f" WHERE {PEAK.format(c='Date_Hour')}" if peak else "")
    keys = f"SELECT DISTINCT SignalID, CallPhase FROM ({rows})"
    span = f"generate_series(CAST((SELECT min(Month) FROM ({rows})) AS TIMESTAMP), CAST((SELECT max(Month) FROM ({rows})) AS TIMESTAMP), INTERVAL 1 MONTH)"
    grid = f"SELECT k.*, CAST(unnest({span}) AS DATE) AS Month FROM ({keys}) k"
    ws = f", {w}" if w else ""
    dense = f"SELECT g.SignalID, g.CallPhase, g.Month, {x}{ws} FROM ({grid}) g LEFT JOIN ({rows}) r ON g.SignalID = r.SignalID AND g.CallPhase = r.CallPhase AND g.Month = r.Month"
    if w is None:
        out = total(avg(dense, "SignalID, Month, CallPhase", x), "SignalID, Month", x)
    else:
        out = mean(mean(dense, "SignalID, Month, CallPhase", x, w), "SignalID, Month", x, w)
    return delta(out, "SignalID", "Month", x)


def weekly_avg_by_hr(src, x, w=None, phased=True):
    first = f"(SELECT min(CAST(Hour AS DATE)) FROM ({src}))"
    rows = (f"SELECT * REPLACE (CAST(greatest({first}, CAST(DATE '2016-12-25' + CAST(Week * 7 + 2 AS INTEGER) AS DATE)) AS TIMESTAMP) "
            f"+ (Hour - date_trunc('day', Hour)) AS Hour) FROM ({src})")
    keys = "SignalID, Week, Hour"
    ph = keys + (", CallPhase" if phased else "")
    out = avg(avg(rows, ph, x), keys, x) if w is None else mean(mean(rows, ph, x, w), keys, x, w)
    return delta(out, "SignalID, Week", "Hour", x)


MONTH_HOUR = "Hour - to_days(CAST(day(Hour) - 1 AS INTEGER))"


def avg_by_hr(src, x, w=None):
    s, w = ones(src, w)
    rows = f"SELECT *, date_trunc('hour', Date_Hour) AS Hour FROM ({s})"
    out = f"SELECT *, {week('CAST(Hour AS DATE)')} AS Week, {dow('Hour')} AS DOW FROM ({mean(rows, 'SignalID, CallPhase, Hour', x, w)})"
    return delta(out, "SignalID, CallPhase", "Hour", x)


def monthly_avg_by_hr(src, x, w=None, with_delta=True):
    s, w = ones(src, w)
    hour = mean(s, "SignalID, Hour", x, w)
    out = mean(f"SELECT * REPLACE ({MONTH_HOUR} AS Hour) FROM ({hour})", "SignalID, Hour", x, w)
    return delta(out, "SignalID", "Hour", x) if with_delta else out


def monthly_hourly_volume(src, x):
    hour = total(f"SELECT * FROM ({src}) WHERE {MIDWEEK}", "SignalID, Hour", x)
    return avg(f"SELECT * REPLACE ({MONTH_HOUR} AS Hour) FROM ({hour})", "SignalID, Hour", x)


def corridor_means(src, x, per, w, corridors="corridors"):
    joined = f"SELECT s.{per}, s.{x}, s.{w}, c.Zone_Group, c.Zone, c.Corridor FROM ({src}) s JOIN {corridors} c ON s.SignalID = c.SignalID"
    return delta(mean(joined, f"Zone_Group, Zone, Corridor, {per}", x, w), "Zone_Group, Zone, Corridor", per, x)


def zone_groups(cor, x, per, w, extra: str = "", by: str = "Zone"):
    """``extra`` is further SQL list members, each NULL when the row does not belong."""
    members = f"SELECT * FROM (SELECT *, unnest([{by}{', ' + extra if extra else ''}]) AS g FROM ({cor})) WHERE g IS NOT NULL"
    groups = delta(f"SELECT g AS Corridor, g AS Zone_Group, {per}, {x}, {w} FROM ({mean(members, f'g, {per}', x, w)})", "Zone_Group", per, x)
    own = f"SELECT Corridor, Zone AS Zone_Group, {per}, {x}, {w}, delta FROM ({cor})"
    return f"{own} UNION SELECT Corridor, Zone_Group, {per}, {x}, {w}, delta FROM ({groups})"


def corridor_rollup(src, x, per, w=None, drop_empty=True, extra="", by="Zone", corridors="corridors"):
    s, w = ones(src, w)
    cor = corridor_means(s, x, per, w, corridors)
    if drop_empty:
        cor = f"SELECT * FROM ({cor}) WHERE {x} IS NOT NULL"
    return zone_groups(cor, x, per, w, extra, by)


def with_week(src):
    return f"SELECT *, {week('Date')} AS Week FROM ({src})"


def quarterly(src, x, w=None, operation="avg"):
    s, w = ones(src, w)
    rows = f"SELECT *, CAST(year(Month) AS VARCHAR) || '.' || CAST(quarter(Month) AS VARCHAR) AS Quarter FROM ({s})"
    keys = "Corridor, Zone_Group, Quarter"
    if operation == "avg":
        out = mean(rows, keys, x, w)
    elif operation == "sum":
        out = total(rows, keys, x)
    else:
        out = f"SELECT {keys}, {x}, {w} FROM (SELECT *, max(Month) OVER (PARTITION BY {keys}) AS mm FROM ({rows})) WHERE Month = mm"
    return delta(out, "Corridor, Zone_Group", "Quarter", x)
