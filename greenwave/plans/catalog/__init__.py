"""All named queries, by area."""

from greenwave.plans.catalog import (alerts_ramp, config, counts, cycles, direct_rollups, health, ped_uptime, rollups, serve, tasks, travel,  # noqa: F401
                                     wide)
