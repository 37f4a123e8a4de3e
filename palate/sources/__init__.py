from palate.sources.files import Checked, read_csv, read_csv_checked, read_csv_tables, read_parquet_tables, read_result
from palate.sources.schemas import SCHEMAS, Tables

__all__ = [
    "SCHEMAS",
    "Checked",
    "Tables",
    "read_csv",
    "read_csv_checked",
    "read_csv_tables",
    "read_parquet_tables",
    "read_result",
]
