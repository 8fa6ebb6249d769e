"""Input tables, file formats and intermediate tables."""

from .buckets import KEYS, OrderBuckets, write_order_buckets
from .counted import ColumnCounts, TableCounts, counted, counts_table
from .files import (
    columns_at,
    first_rows,
    open_csv_tables,
    open_tables,
    read_csv,
    read_parquet,
    table_path,
    write_table,
)
from .ingest import ingest
from .publish import Published, side_by_side
from .quarantine import TooDamaged
from .schemas import SCHEMAS
from .scratch import materialize, remove_folder, scratch_folder
from .snapshots import Conflict, Snapshots
from .star import StarTables

__all__ = [
    "SCHEMAS",
    "ColumnCounts",
    "Conflict",
    "KEYS",
    "OrderBuckets",
    "Published",
    "Snapshots",
    "StarTables",
    "TableCounts",
    "TooDamaged",
    "columns_at",
    "counted",
    "counts_table",
    "first_rows",
    "ingest",
    "materialize",
    "open_csv_tables",
    "open_tables",
    "read_csv",
    "read_parquet",
    "remove_folder",
    "scratch_folder",
    "side_by_side",
    "table_path",
    "write_order_buckets",
    "write_table",
]
