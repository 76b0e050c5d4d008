from .lookup import (  # noqa: F401
    DeclaredTable, append_conform, build_once, read_lookup, read_sorted, write_sorted, write_summary_csv)
from .tables import DRIVER_TABLES, Fixtures, fixture_ctes, read_table  # noqa: F401
