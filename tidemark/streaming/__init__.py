from tidemark.streaming.ingest import landed_stream, merge_stream  # noqa: F401
from tidemark.streaming.rollup import bucket_stream, refresh_touched  # noqa: F401
