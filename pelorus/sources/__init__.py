from .tables import (
    INTERACTIONS_SCHEMA,
    ITEMS_SCHEMA,
    append_runs,
    read_interactions_csv,
    read_items_csv,
    read_parquet,
)

__all__ = [
    "INTERACTIONS_SCHEMA",
    "ITEMS_SCHEMA",
    "append_runs",
    "read_interactions_csv",
    "read_items_csv",
    "read_parquet",
]
