"""Stand-in bindings of the test tables, registered queries with their DuckDB oracles, and the
as-written reference shapes timed by the bench."""
