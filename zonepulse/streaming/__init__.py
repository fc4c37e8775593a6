from zonepulse.streaming.alerts import (
    batch_window_alerts,
    pickups,
    read_alerts,
    run_alert_stream,
    start_alert_stream,
    window_counts,
    window_threshold,
)

__all__ = [
    "batch_window_alerts",
    "pickups",
    "read_alerts",
    "run_alert_stream",
    "start_alert_stream",
    "window_counts",
    "window_threshold",
]
