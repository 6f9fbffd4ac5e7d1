"""Sources (scans) and sinks."""

from lodestar.sources.spec import DatasetSpec
from lodestar.sources.readers import (
    read_parquet, read_csv, read_orc, detect_format, read_detected, sniff_delimiter,
    read_delimited_with_label, read_partitioned, read_date_range, from_pandas,
    limit_rows, read_dataset, plan_scan, planned_reads,
)
from lodestar.sources.sinks import (
    write_once, write_orc_once, write_csv_columns, write_result_table, write_split,
)

__all__ = [
    "DatasetSpec", "read_parquet", "read_csv", "read_orc", "detect_format",
    "read_detected", "sniff_delimiter", "read_delimited_with_label",
    "read_partitioned", "read_date_range", "from_pandas", "limit_rows",
    "read_dataset", "write_once", "write_orc_once", "write_csv_columns", "write_result_table",
    "write_split", "plan_scan", "planned_reads",
]
