from tidemark.functions.scalars import *  # noqa: F401,F403
from tidemark.functions.buckets import first_by, last_by, next_bucket, time_bucket  # noqa: F401
