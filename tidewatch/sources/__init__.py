from tidewatch.sources.io import (  # noqa: F401
    partition_coverage, read_features, read_raw_csv, read_recent, read_slices,
    write_features, write_run_log,
)
