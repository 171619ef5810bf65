"""The four jobs, put together from operators, sources and sinks."""
