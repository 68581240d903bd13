"""Reading and writing: delimited files, tables, score requests."""
