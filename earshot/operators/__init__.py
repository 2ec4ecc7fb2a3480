"""DataFrame -> DataFrame operators: dimensions, fact, marts, reports, quality, merge."""
