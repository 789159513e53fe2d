"""Named queries and models built from operators, and their DuckDB oracle SQL."""

# Fixed evaluation time for every now-dependent query, so results are repeatable.
# The driver data spans 1995-2001; mid-2001 makes the "complete years" and
# "not in the future" rules cut real rows.
AS_OF = "2001-06-30 12:00:00"
