from tidemark.sinks.published import ConcurrentPublish, PublishedTable  # noqa: F401
