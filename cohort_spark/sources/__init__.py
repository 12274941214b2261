from .tables import TABLES, encounter_facts, encounter_rows, encounters, order_stats, read_table  # noqa: F401
from .readers import (apply_missing_mode, normalize_missing, raw_schema,  # noqa: F401
                      read_raw_csv, read_records_json, request_schema)
