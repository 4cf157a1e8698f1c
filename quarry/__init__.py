"""quarry: batch rating, review-text and order analytics as Spark DataFrame plans.

Layout:
  sources/    readers for positional text, delimited files, word lists, CSV, parquet tables
  functions/  column expressions (field splitting, tokenising, parsing, binning, rounding)
  operators/  reusable relational blocks (lookups, anti joins, pivots, top-k, distinct totals)
  plans/      the named analytics built from those blocks
  sinks/      text / delimited / nested / report writers (no driver collect)
  streaming/  file-stream driver that runs the aggregating analytics incrementally
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "sinks", "streaming"]
