"""roadflow: road-traffic camera analytics on Spark (DataFrame API and Structured Streaming).

Modules: ``sources`` (readers and the line parser), ``operators`` (batch jobs), ``functions`` (Column
expressions), ``streaming`` (live jobs), ``sinks`` (tables and snapshots), ``plans`` (query registry and SQL
oracles), ``jobs`` (end-to-end entry points), ``session`` (runtime settings and the shared folder).
"""

__version__ = "0.1.0"
