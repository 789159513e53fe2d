"""Writers for tables, partitioned layouts, merges and raw landing."""
