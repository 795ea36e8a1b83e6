"""Result writers: managed tables and JDBC."""

from clickscope.sinks.writers import overwrite_table, append_jdbc

__all__ = ["overwrite_table", "append_jdbc"]
