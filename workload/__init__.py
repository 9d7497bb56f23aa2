"""The operators on the benchmark tables, each with the SQL that checks it."""
