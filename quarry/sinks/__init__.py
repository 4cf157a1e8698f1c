"""Writers.  All run as Spark writes from executors; none collects to the driver."""

from quarry.sinks.text import (
    nested_bag_text,
    ordered,
    report_lines,
    write_delimited,
    write_kv_text,
    write_lines,
)

__all__ = ["nested_bag_text", "ordered", "report_lines", "write_delimited", "write_kv_text", "write_lines"]
