from planekit.streaming.probe import join_stream, range_stream, write_stream  # noqa: F401
