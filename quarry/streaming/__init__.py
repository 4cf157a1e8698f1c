"""Structured Streaming forms of the aggregating analytics.

The source jobs are batch jobs over a directory of rating or review files.
Here the same statistics are kept up to date as new files land in that
directory: a file stream, a stream-static join to the (static) dimension, and
one stateful aggregation whose state is the exact (sum, count) per key --
bounded by the number of keys, not by the number of ratings.  Progress and
state live under the session's checkpoint folder, so a restarted query
resumes exactly where it stopped.
"""

from quarry.streaming.incremental import (
    rating_lines_stream,
    review_lines_stream,
    running_item_stats,
    running_word_counts,
    start_snapshots,
)

__all__ = ["rating_lines_stream", "review_lines_stream", "running_item_stats", "running_word_counts", "start_snapshots"]
