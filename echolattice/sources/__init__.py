"""Sources and sinks, and the tables derived from the supplied data."""
