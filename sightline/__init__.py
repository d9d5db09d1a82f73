"""sightline — table inspection and document preparation as Spark jobs.

Operators are plain functions ``f(df, ...) -> DataFrame``: they build a
logical plan and never trigger an action themselves (a few size checks
that guard a broadcast are the documented exception).
"""

__version__ = "0.1.0"
