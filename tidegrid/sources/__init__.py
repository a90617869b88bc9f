"""Reading and writing of tables and fitted state."""
