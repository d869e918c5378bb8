"""mediafeat: labelled audio/visual feature records -> training tables, on Spark.

Every public operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, so Catalyst sees the whole plan (pruning, pushdown,
join selection, AQE).  Python runs inside tasks only where bytes are decoded
(record codec, uint8 vectors) or gradients are computed (data-parallel fit).

Layout
------
functions/   column expressions (multi-hot, vectors, geo, text)
operators/   DataFrame -> DataFrame operators (labels, sequences, joins, splits,
             geo radius join, metrics, training)
sources/     record-file codec and readers/writers, table scans and sinks
streaming/   incremental shard ingest (Structured Streaming)
plans/       fixtures built from the input tables, composed plans, query catalog
"""

from mediafeat.session import get_session, scratch_path  # noqa: F401

__all__ = ["get_session", "scratch_path"]
