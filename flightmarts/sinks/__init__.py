"""Writers: partitioned lake and raw table, typed batched export."""

from flightmarts.sinks.export import export_frame, write_export
from flightmarts.sinks.lake import load_full, load_months, overwrite_months, write_lake

__all__ = ["export_frame", "load_full", "load_months", "overwrite_months", "write_export", "write_lake"]
