from freightlens.sources import schemas  # noqa: F401
from freightlens.sources.tables import (  # noqa: F401
    append_rows,
    apply_defaults,
    inline_rows,
    quarantine,
    read_table,
    read_view_csv,
    read_with_rejects,
    write_view_csv,
)
