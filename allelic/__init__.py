"""allelic: Spark-native family-genomics analytics.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function
built from native Spark expressions.  The same operator runs on a batch
table and inside a streaming ``foreachBatch`` or stateful aggregation.

Sub-packages
------------
functions  Column expressions (genotype classes, labels, normalisation)
sources    readers, JSON codec, topic routing, the ``snps`` fixture view
operators  gene annotation, metrics, profiles, time series, top-k, family
streaming  file/Kafka streams, windowed state, metric sinks, snapshots
plans      the registered named queries and their DuckDB oracle SQL
"""

from allelic.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
