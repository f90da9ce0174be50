from hangarline.sources.settings import ConnectionSettings, read_settings
from hangarline.sources.tables import SourceTables, jdbc_tables, parquet_tables

__all__ = ["ConnectionSettings", "SourceTables", "jdbc_tables", "parquet_tables", "read_settings"]
