"""Writers: tables, partitioned snapshots, keyed publishing, JSON Lines."""
