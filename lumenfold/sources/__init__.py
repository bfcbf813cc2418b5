"""File sources with explicit schemas, and file sinks."""

from lumenfold.sources.checked import (
    Checked,
    check_numeric_csv,
    check_reviews,
    check_transactions,
    checked_transaction_stream,
)
from lumenfold.sources.files import (
    read_header_csv,
    read_numeric_csv,
    read_reviews,
    read_transactions,
    stream_transactions,
    write_csv,
    write_parquet,
    write_tuples,
)
from lumenfold.sources.layout import drop_panel, join_laid_out, mean_laid_out, read_panel, write_panel
from lumenfold.sources.tables import table

__all__ = [
    "Checked",
    "check_numeric_csv",
    "check_reviews",
    "check_transactions",
    "checked_transaction_stream",
    "drop_panel",
    "join_laid_out",
    "mean_laid_out",
    "read_header_csv",
    "read_numeric_csv",
    "read_panel",
    "read_reviews",
    "read_transactions",
    "stream_transactions",
    "table",
    "write_csv",
    "write_panel",
    "write_parquet",
    "write_tuples",
]
