"""tidewater: data-lake operators on Spark.

Every operator is a plain function from DataFrame(s) to DataFrame(s).
Batch and streaming share the same operators; streams call them from
``foreachBatch`` so both paths give the same answer.
"""

from tidewater.session import checkpoint_dir, cut_lineage, get_session, sized_broadcast, spread

__all__ = ["get_session", "checkpoint_dir", "cut_lineage", "sized_broadcast", "spread"]
