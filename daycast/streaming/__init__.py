from daycast.streaming.daily_updates import (  # noqa: F401
    merged_daily,
    partial_daily,
    read_daily_updates,
    run_daily_updates,
    start_daily_updates,
)
