"""Reading and writing tables."""

from foldspark.sources.tables import (  # noqa: F401
    integer_range,
    read_jdbc,
    read_table,
    register_table,
    shape,
    write_table,
)
