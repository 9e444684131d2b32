"""The metrics a report can ask for, and how their tables are named."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Metric:
    label: str
    table: str
    variable: str
    weight: str | None = "ones"
    hourly_table: str | None = None
    goal: float | None = None
    has_weekly: bool = True
    source: str | None = None

    def like(self, **changes) -> "Metric":
        return replace(self, **changes)


# Labels, table names, variables, weights and goals.
_uptime = Metric("Uptime [%]", "", "uptime", goal=0.95)
_tasks = Metric("Tasks", "", "Reported", has_weekly=False)
METRICS: dict[str, Metric] = {
    "daily_traffic_volume": Metric("Traffic Volume [veh/day]", "vpd", "vpd", source="vehicles_pd"),
    "am_peak_hour_volume": Metric("AM Peak Volume [veh/hr]", "vphpa", "vph", source="vehicles_ph"),
    "pm_peak_hour_volume": Metric("PM Peak Volume [veh/hr]", "vphpp", "vph", source="vehicles_ph"),
    "throughput": Metric("Throughput [veh/hr]", "tp", "vph", source="throughput"),
    "arrivals_on_green": Metric("Arrivals on Green [%]", "aogd", "aog", "vol", "aogh", source="arrivals_on_green"),
    "progression_ratio": Metric("Progression Ratio", "prd", "pr", "vol", "prh", source="arrivals_on_green"),
    "queue_spillback_rate": Metric("Queue Spillback Rate [%]", "qsd", "qs_freq", "cycles", "qsh", source="queue_spillback"),
    "peak_period_split_failures": Metric("Peak Period Split Failures Rate [%]", "sfd", "sf_freq", "cycles", source="split_failures"),
    "off_peak_split_failures": Metric("Off-Peak Split Failures Rate [%]", "sfo", "sf_freq", "cycles", source="split_failures"),
    "travel_time_index": Metric("Travel Time Index (TTI)", "tti", "tti", None, "ttih", 1.2, False),
    "planning_time_index": Metric("Planning Time Index (PTI)", "pti", "pti", None, "ptih", 1.3, False),
    "average_speed": Metric("Average Speed [mph]", "spd", "speed_mph", None, "spdh", None, False),
    "daily_pedestrian_pushbuttons": Metric("Pedestrian Activations per Day [pa/day]", "papd", "papd", source="ped_actuations_pd"),
    "detector_uptime": _uptime.like(label="Detector Uptime [%]", table="du", weight="all", source="detector_uptime_pd"),
    "ped_button_uptime": _uptime.like(label="Pedestrian Pushbutton Uptime [%]", table="pau", source="ped_detector_uptime_pd"),
    "cctv_uptime": _uptime.like(label="CCTV Uptime [%]", table="cctv", source="cctv_uptime"),
    "comm_uptime": _uptime.like(label="Communication Uptime [%]", table="cu", source="comm_uptime"),
    "rsu_uptime": _uptime.like(label="RSU Uptime [%]", table="ru", source="rsus"),
    "tasks_by_type": _tasks.like(label="Tasks This Period By Type", table="ttyp"),
    "tasks_by_subtype": _tasks.like(label="Tasks This Period By Subtype", table="tsub"),
    "tasks_by_source": _tasks.like(label="Tasks This Period By Source", table="tsou"),
    "tasks_reported": _tasks.like(label="Tasks Reported This Period", table="reported"),
    "tasks_resolved": _tasks.like(label="Tasks Resolved This Period", table="resolved", variable="Resolved"),
    "tasks_outstanding": _tasks.like(label="Tasks Outstanding [Unresolved]", table="outstanding", variable="Outstanding"),
    "tasks_over45": _tasks.like(label="Tasks Over 45 Days [Unresolved]", table="over45", variable="over45"),
    "tasks_mttr": _tasks.like(label="Tasks Mean Time to Resolve [Days]", table="mttr", variable="mttr"),
}

LEVELS = {"corridor": "cor", "subcorridor": "sub", "signal": "sig"}
RESOLUTIONS = {"quarterly": "qu", "monthly": "mo", "weekly": "wk", "daily": "dy"}


def table_name(metric: Metric, level: str, resolution: str, hourly: bool = False) -> str:
    base = metric.hourly_table if hourly and metric.hourly_table else metric.table
    return f"{LEVELS[level]}_{RESOLUTIONS[resolution]}_{base}"
