from .tables import (read_table, read_until, run_sql, table_exists, write_partitioned,
                     write_table)

__all__ = ["read_table", "read_until", "run_sql", "table_exists",
           "write_partitioned", "write_table"]
