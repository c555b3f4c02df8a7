"""Scalar Column helpers (F1-F13)."""

from tidemart.functions.columns import (  # noqa: F401
    change_flag, cutoff_text, date_text, now_text, default_location, epoch_text, file_factor,
    instant_text, json_map, map_default, ntz_epoch_millis, partition_spec_map,
    partition_value, retention_cutoff, safe_cast, statistic_payload, step_number,
    unescape_partition_value,
)
