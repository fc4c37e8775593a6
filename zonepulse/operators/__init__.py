"""DataFrame -> DataFrame operators, grouped by pipeline layer."""

from zonepulse.operators import clean, cluster, demand, insights, profile, zones

__all__ = ["clean", "cluster", "demand", "insights", "profile", "zones"]
