"""kestrel: Spark-native data jobs.

Every job is a function ``DataFrame(s) -> DataFrame`` built from the
DataFrame/SQL API so that Catalyst plans it (pushdown, pruning, partial
aggregation) and AQE re-plans it at run time (coalescing, skew splits,
broadcast conversion from measured sizes).  Actions happen only in sinks,
in the iterative graph search (one emptiness test per round), and in the
explicit size check that guards a hinted broadcast.
"""

__version__ = "0.1.0"
