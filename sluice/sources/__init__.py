"""Reading and writing tables, shards, reports and fitted parts."""
