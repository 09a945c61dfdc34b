"""Jobs a user submits, put together from sources, operators and sinks."""
