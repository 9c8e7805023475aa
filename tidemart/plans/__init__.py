"""Jobs put together from operators, sources and sinks."""
