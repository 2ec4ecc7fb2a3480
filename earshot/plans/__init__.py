"""Jobs that tie operators to sources and sinks, and the registered query suite."""
