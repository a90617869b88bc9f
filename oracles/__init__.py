"""Independent SQL statements the registered queries are compared with."""
