"""Scans, sinks and series construction from fact tables (inventory rows 1-9)."""

from tidecast.sources.facts import series_from_facts  # noqa: F401
from tidecast.sources.files import (  # noqa: F401
    csv_long_scan, csv_long_sink, train_record_scan, train_record_sink)
from tidecast.sources.synthetic import synth_series  # noqa: F401
from tidecast.sources.tables import (  # noqa: F401
    drop_if_exists, ensure_namespace, scan_series, write_series_table)
