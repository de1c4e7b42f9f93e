"""snapreel: reproducible catalogue analytics as plain Spark DataFrame operators.

Raw JSON snapshots are kept immutable, loaded into raw tables whose body is a
Spark ``VARIANT``, flattened into staging models, summarised, and joined into
dimension and fact marts, with not-null / key-uniqueness checks over all of
them. Every operator is a DataFrame -> DataFrame function made of built-in
Spark expressions, so Catalyst and adaptive execution plan the whole graph.
"""

__version__ = "0.1.0"
