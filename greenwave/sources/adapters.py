"""Domain tables made from the driver's star-schema tables.

Every adapter reads its whole base table.  The number of signals, cameras and corridors grows with
the data (ids are key ranges, not a fixed set), and wall-clock times are stretched or squeezed so
that cycles, gaps and streaks occur.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from greenwave.functions.layout import laid_out
from greenwave.functions.timeparts import day_interval, month_start
from greenwave.session import cut_lineage, stored

DAY_SHIFT = 9131  # 25 years, so that weeks count from the week origin


# Fixed event codes of the 20 regular slots; slots 18 and 19 rotate through rarer ones.
REGULAR_CODES = (1, 82, 81, 82, 81, 8, 9, 90, 45, 21, 22, 31, 1, 132, 173, 502, 503, 4)
ROTATING = {18: (9, 0, 10), 19: (89, 131, 150, 134, 89, 300, 131, 612, 84, 89, 83, 150, 135, 301, 613, 131)}
# parameter = add + scale * ((k * mul) mod mod)
PARAMETER_RULE = {31: (1, 1, 1, 2), 132: (60, 30, 1, 3), 131: (0, 1, 1, 4), 150: (0, 1, 1, 7), 502: (0, 1, 2, 101),
                  503: (100, 1, 1, 1000), 173: (0, 1, 1, 6), **{c: (1, 1, 1, 4) for c in (81, 82, 83, 84, 89, 90)}}


def _event_slots() -> list[tuple[int, ...]]:
    """(code, add, scale, mul, mod) of every event slot: 16 rounds of 20."""
    out = []
    for i in range(320):
        regular, turn = i % 20, i // 20
        code = REGULAR_CODES[regular] if regular < 18 else ROTATING[regular][turn % len(ROTATING[regular])]
        out.append((code, *PARAMETER_RULE.get(code, (2, 2, 1, 4))))
    return out


EVENT_SLOTS = _event_slots()


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _block(c: str, size: int) -> Column:
    return (F.floor(F.col(c) / size) + 1).cast("int")


def _phase(c: str = "l_linenumber") -> Column:
    r = F.col(c) % 4
    return F.when(r == 0, 2).when(r == 1, 4).when(r == 2, 6).otherwise(8)


class Tables:
    """Lazy domain frames over one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._kept: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def kept(self, name: str, make, packed: bool = False) -> DataFrame:
        """An intermediate table that several later steps read, stored once: as a checkpoint, or ``packed`` as Parquet, which takes
        less space where values repeat but forgets the layout (see session.cut_lineage and session.stored)."""
        if name not in self._kept:
            self._kept[name] = stored(make(), name) if packed else cut_lineage(make())
        return self._kept[name]

    # ---- events -------------------------------------------------------------
    @cached_property
    def _events(self) -> DataFrame:
        origin = _ntz("2024-01-01 00:00:00")
        micros = F.timestamp_diff("MICROSECOND", origin, F.col("ts"))
        return self.base("events").select(
            "event_id", "ts", "event_type", "value",
            F.col("user_id"), _block("user_id", 5).alias("SignalID"),
            F.timestamp_add("MICROSECOND", F.floor(micros / 10).cast("bigint"), origin)
            .cast("timestamp_ntz").alias("Timestamp"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"))

    @cached_property
    def controller_events(self) -> DataFrame:
        # one array lookup per column: filters on code or parameter stay small when pushed into the scan
        slot = (F.col("event_id") % len(EVENT_SLOTS) + 1).cast("int")
        look = lambda i: F.element_at(F.array(*[F.lit(s[i]) for s in EVENT_SLOTS]), slot)
        param = look(1) + look(2) * F.pmod(F.col("k") * look(3), look(4))
        free = (F.col("EventCode") == 132) & (F.col("SignalID") % 3 == 0)
        return (self._events.withColumn("EventCode", look(0))
                .select("SignalID", "Timestamp", "EventCode", F.when(free, 0).otherwise(param).cast("int").alias("EventParam"),
                        F.col("Timestamp").cast("date").alias("date")))

    @cached_property
    def ramp_events(self) -> DataFrame:
        kind = F.col("event_type")
        code = (F.when(kind == "click", 1058).when(kind == "view", 1371).when(kind == "purchase", 1372)
                .when(kind == "signup", 1373).otherwise(1013))
        return self._events.select("SignalID", "Timestamp", code.alias("EventCode"),
                                   (F.col("k") % 60).alias("EventParam"))

    @cached_property
    def camera_log(self) -> DataFrame:
        return self._events.select(
            F.concat(F.lit("CAM-"), F.floor(F.col("user_id") / 2).cast("string")).alias("CameraID"),
            F.col("ts").alias("Timestamp"), F.col("ts").cast("date").alias("Date"),
            F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")).alias("Size"))

    @cached_property
    def cam_config(self) -> DataFrame:
        return self._events.select(
            F.concat(F.lit("CAM-"), F.floor(F.col("user_id") / 2).cast("string")).alias("CameraID"),
            "SignalID").groupBy("CameraID").agg(F.min("SignalID").alias("SignalID")).select(
            "CameraID", "SignalID", F.concat(F.lit("Location "), F.col("CameraID")).alias("Location"),
            F.lit("2024-01-03").cast("date").alias("As_of_Date"))

    # ---- lineitem -----------------------------------------------------------
    @cached_property
    def _line(self) -> DataFrame:
        offset = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-02").cast("date"))
        base = _ntz("2024-01-17 00:00:00")
        return self.base("lineitem").select(
            _block("l_suppkey", 5).alias("SignalID"), F.col("l_linenumber").alias("Detector"),
            _phase().alias("CallPhase"), "l_suppkey", "l_orderkey", "l_partkey", "l_quantity", "l_discount",
            "l_tax", "l_returnflag",
            (base + day_interval(minutes=(offset * 15).cast("int"))).cast("timestamp_ntz").alias("quarter_hour"),
            (base + day_interval(hours=offset.cast("int"))).cast("timestamp_ntz").alias("hour"),
            F.date_add(F.col("l_shipdate").cast("date"), DAY_SHIFT).alias("Date"),
            (F.date_add(F.col("l_shipdate").cast("date"), DAY_SHIFT).cast("timestamp_ntz")
             + day_interval(hours=(F.col("l_orderkey") % 24).cast("int"))).cast("timestamp_ntz").alias("Date_Hour"))

    @cached_property
    def _line_by_signal(self) -> DataFrame:
        """Laid out once for the grouping by signal and time and for what later steps group by signal."""
        return laid_out(self._line, ["SignalID"], self.base("lineitem").count(), 250_000)

    @cached_property
    def counts_15min(self) -> DataFrame:
        return (self._line.groupBy("SignalID", F.col("quarter_hour").alias("Timeperiod"), "Detector", "CallPhase")
                .agg(F.sum(F.col("l_quantity") * 5).cast("bigint").alias("vol")))

    @cached_property
    def counts_1hr(self) -> DataFrame:
        hour = F.date_trunc("hour", "quarter_hour").cast("timestamp_ntz")
        return (self._line.groupBy("SignalID", hour.alias("Timeperiod"), "Detector", "CallPhase")
                .agg(F.sum(F.col("l_quantity") * 5).cast("bigint").alias("vol")))

    @cached_property
    def metrics_hourly(self) -> DataFrame:
        from greenwave.functions.timeparts import dow, week_index
        skip = F.sum("Detector") % 11 == 0
        return (self._line_by_signal.groupBy("SignalID", "CallPhase", "Date", "Date_Hour").agg(
            F.when(~skip, F.avg("l_discount") * 10).alias("aog"),
            F.when(~skip, F.avg("l_tax") * 20).alias("pr"),
            F.sum("l_quantity").alias("vol"),
            F.avg("l_discount").alias("sf_freq"), F.avg("l_tax").alias("qs_freq"),
            F.count(F.lit(1)).cast("double").alias("cycles"),
            F.sum(F.col("l_quantity") * 3).alias("paph"))
            .withColumn("Week", week_index("Date")).withColumn("DOW", dow("Date")))

    @cached_property
    def metrics_daily(self) -> DataFrame:
        from greenwave.functions.timeparts import dow, week_index
        skip = F.sum("Detector") % 13 == 0
        return (self._line_by_signal.groupBy("SignalID", "CallPhase", "Date").agg(
            F.when(~skip, F.sum("l_quantity")).alias("vpd"),
            F.sum(F.col("l_quantity") * 2).alias("papd"),
            (F.max("l_quantity") * 4).alias("vph"),
            F.avg(F.col("l_discount") * 10).alias("uptime"),
            F.count(F.lit(1)).cast("double").alias("all"))
            .withColumn("Week", week_index("Date")).withColumn("DOW", dow("Date")))

    @cached_property
    def det_config(self) -> DataFrame:
        d = F.col("Detector")
        r = d % 4
        return self._line.select("SignalID", "Detector", "CallPhase").distinct().select(
            "SignalID", "Detector", "CallPhase", (d % 3).cast("int").alias("CountPriority"),
            (d * 0.5).cast("double").alias("TimeFromStopBar"),
            F.when(d != 5, (d * 20.0)).cast("double").alias("DistanceFromStopBar"),
            F.when(d % 2 == 0, "NB Mainline").otherwise("EB Side").alias("ApproachDesc"),
            d.alias("LaneNumber"),
            F.when(r == 0, "Advanced Count").when(r == 1, "Stop Bar Presence")
            .when(r == 2, "Advanced Count, Advanced Speed").otherwise("Exit").alias("DetectionTypeDesc"))

    @cached_property
    def _presses(self) -> DataFrame:
        offset = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-02").cast("date"))
        d = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(offset / 5).cast("int"))
        return self.base("lineitem").select(
            _block("l_suppkey", 5).alias("SignalID"), F.col("l_linenumber").alias("Detector"), _phase().alias("CallPhase"),
            d.alias("Date"), (d.cast("timestamp_ntz") + day_interval(hours=(F.col("l_orderkey") % 24).cast("int")))
            .cast("timestamp_ntz").alias("Hour"), "l_quantity")

    @cached_property
    def ped_daily(self) -> DataFrame:
        return self._presses.groupBy("SignalID", "Detector", "CallPhase", "Date").agg(F.sum("l_quantity").alias("papd"))

    @cached_property
    def ped_hourly(self) -> DataFrame:
        return self._presses.groupBy("SignalID", "Detector", "CallPhase", "Date", "Hour").agg(
            (F.sum("l_quantity") * 8).alias("paph"))

    @cached_property
    def travel_times(self) -> DataFrame:
        return self._line.select(
            F.concat(F.lit("Corridor "), F.floor(F.col("l_suppkey") / 10).cast("string")).alias("Corridor"),
            F.concat(F.floor(F.col("l_suppkey") / 5).cast("string"), F.lit("-"), F.col("Detector").cast("string")).alias("tmc_code"),
            F.col("hour").alias("Hour"),
            (1.0 + F.col("l_tax") * 10).alias("miles"),
            (30 + F.col("Detector")).cast("double").alias("reference_speed"),
            (F.col("l_quantity") / 5 + 1.0).alias("travel_time_minutes"),
            (F.col("l_quantity") + 10.0).alias("speed"))

    @cached_property
    def segments(self) -> DataFrame:
        g = F.floor(F.col("l_suppkey") / 5)
        return self._line.select(
            F.concat(g.cast("string"), F.lit("-"), F.col("Detector").cast("string")).alias("tmc_code"),
            F.concat(F.lit("Corridor "), F.floor(F.col("l_suppkey") / 10).cast("string")).alias("Corridor"),
            F.when(F.col("Detector") == 7, "None").otherwise(F.concat(F.lit("Sub "), g.cast("string"))).alias("Subcorridor"),
            (0.5 + F.col("Detector") * 0.25).cast("double").alias("miles")).distinct()

    @cached_property
    def delay_costs(self) -> DataFrame:
        day0 = F.date_add(F.col("o_orderdate").cast("date"), DAY_SHIFT)
        g = F.floor(F.col("o_custkey") / 100)
        return self.base("orders").select(
            F.concat(F.lit("Zone "), (g % 5).cast("string")).alias("Zone"), F.concat(F.lit("Corridor "), g.cast("string")).alias("Corridor"),
            (day0.cast("timestamp_ntz") + day_interval(hours=(F.col("o_orderkey") % 24).cast("int"))).cast("timestamp_ntz").alias("date"),
            F.col("o_totalprice").alias("delay_cost"))

    @cached_property
    def health_input(self) -> DataFrame:
        c = self.corridors.select("SignalID", "Zone_Group", "Zone", "Corridor", "Subcorridor")
        g = self._line.withColumn("Month", month_start("Date")).groupBy("SignalID", "Month").agg(
            F.avg("l_discount").alias("d"), F.avg("l_tax").alias("x"), F.avg("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"),
            F.sum("Detector").alias("s"))
        d, x, q, n, s = (F.col(k) for k in "dxqns")
        return g.join(c, "SignalID").select(
            "Zone_Group", "Zone", "Corridor", "Subcorridor", "Month", (F.col("SignalID") % 6 + 1).alias("Context"),
            F.round(d * 12, 4).alias("du"), F.round(x * 16, 4).alias("pau"), F.round(0.92 + x, 4).alias("cu"),
            F.when(s % 5 != 0, F.round(d * 14, 4)).alias("cctv"), F.when(s % 3 != 0, n % 12).alias("flash_events"),
            F.when(s % 7 != 0, F.round(0.9 + d * 4, 4)).alias("pr"), F.round(q * 6, 4).alias("pd"), F.round(x * 5, 4).alias("sf_freq"),
            F.when(s % 11 != 0, F.round(1 + d * 10, 4)).alias("tti"), F.round(1 + d * 10 + x * 3, 4).alias("pti"),
            F.when(s % 4 != 0, F.round(q / 5, 4)).alias("cri"), F.round(q * 18, 4).alias("kabco"), F.round(0.8 + d * 6, 4).alias("rsi"),
            F.round(x * 15, 4).alias("bpsi"))

    # ---- dimensions ---------------------------------------------------------
    @cached_property
    def corridors(self) -> DataFrame:
        s, n, r = self.base("supplier"), self.base("nation"), self.base("region")
        key = F.col("s_suppkey")
        return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
                .groupBy(_block("s_suppkey", 5).alias("SignalID"), F.col("r_name").alias("Zone_Group"),
                         F.col("n_name").alias("Zone"),
                         F.concat(F.lit("Corridor "), F.floor(key / 10).cast("string")).alias("Corridor"),
                         F.concat(F.lit("Sub "), F.floor(key / 5).cast("string")).alias("Subcorridor"))
                .agg(F.min("s_name").alias("Name"), F.min(key).alias("_k"))
                .select("SignalID", "Zone_Group", "Zone", "Corridor", "Subcorridor", "Name",
                        F.when(F.col("SignalID") % 4 == 0, F.lit("2024-01-20")).otherwise(F.lit("2000-01-01"))
                        .cast("date").alias("Asof"),
                        (33.0 + F.col("SignalID") * 0.01).cast("double").alias("Latitude"),
                        (-84.0 - F.col("SignalID") * 0.01).cast("double").alias("Longitude"),
                        F.concat(F.col("SignalID").cast("string"), F.lit(": "), F.col("Name")).alias("Description")))

    @cached_property
    def speed_limits(self) -> DataFrame:
        g = F.floor(F.col("s_suppkey") / 10)
        return self.base("supplier").select(
            F.concat(F.lit("Corridor "), g.cast("string")).alias("Corridor"),
            (30 + g % 4 * 5).cast("double").alias("Speed_Limit")).distinct()

    @cached_property
    def locations(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.base("customer").select(
            c.alias("LocationId"),
            (33.01 + F.floor(c / 50) * 0.01 + (c % 7) * 0.0002).cast("double").alias("Latitude"),
            (-84.01 - F.floor(c / 50) * 0.01).cast("double").alias("Longitude"),
            F.col("c_name").alias("Custom_Identifier"))

    # ---- orders -------------------------------------------------------------
    @cached_property
    def tasks(self) -> DataFrame:
        status, day0 = F.col("o_orderstatus"), F.date_add(F.col("o_orderdate").cast("date"), DAY_SHIFT)
        return self.base("orders").select(
            F.col("o_orderkey").alias("TaskID"), _block("o_custkey", 50).alias("SignalID"),
            F.col("o_orderpriority").alias("Priority"),
            F.when(status == "F", "Repair").when(status == "O", "Inspect").otherwise("Other").alias("Task_Type"),
            F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("Sub "), (F.col("o_orderkey") % 5).cast("string")))
            .alias("Task_Subtype"),
            F.when(F.col("o_orderkey") % 3 == 0, "Field").otherwise("Desk").alias("Task_Source"),
            day0.alias("Date_Reported"),
            F.when(status != "O", F.date_add(day0, (F.col("o_orderkey") % 120).cast("int"))).alias("Date_Resolved"))

    @cached_property
    def crashes(self) -> DataFrame:
        p = F.col("o_orderpriority")
        n = lambda v: F.count_if(p == v)
        day0 = F.date_add(F.col("o_orderdate").cast("date"), DAY_SHIFT)
        return (self.base("orders").groupBy(_block("o_custkey", 50).alias("SignalID"), month_start(day0).alias("Month"))
                .agg(n("1-URGENT").alias("crashes_k"), n("2-HIGH").alias("crashes_a"), n("3-MEDIUM").alias("crashes_b"),
                     n("4-NOT SPECIFIED").alias("crashes_c"), n("5-LOW").alias("crashes_o"),
                     F.count(F.lit(1)).alias("crashes_total"), F.sum("o_totalprice").alias("cost")))
