from palate.sinks.csv_sink import write_csv

__all__ = ["write_csv"]
