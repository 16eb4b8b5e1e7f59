from daycast.sources.readers import (  # noqa: F401
    attach_daily_dates,
    coerce_date_columns,
    latest_table,
    read_by_extension,
    read_csv,
    read_latest,
    write_json_result,
    write_table,
)
from daycast.sources.tables import load, visits_from_events, visits_from_orders  # noqa: F401
