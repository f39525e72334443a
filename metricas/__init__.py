"""Social-media metrics on Spark.

Landed API response pages from four platforms are exploded, normalised,
pivoted, joined, given period-over-period deltas and merged into keyed
tables. Everything is expressed with DataFrame / SQL built-ins.

Sub-packages:
  functions  column expressions (format inference, date parsing, Python-style ``or``)
  sources    landed pages -> items (S1-S3)
  operators  normalisers, last-wins pivots, joins, deltas, keyed merges
  plans      per-platform jobs composed from operators, fixtures, query registry
  streaming  incremental runs of the batch jobs over a landing folder
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
