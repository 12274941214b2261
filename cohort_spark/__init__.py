"""cohort_spark: cohort risk analytics as Spark DataFrame jobs.

Subpackages: ``sources`` (readers, the encounter view, dimension tables),
``functions`` (Column expressions), ``operators`` (table operators),
``plans`` (multi-step jobs: cleaning, profiling, models, monitoring) and
``streaming`` (Structured Streaming twins of the monitoring windows).
"""
from .session import cut_lineage, ensure_checkpoint_dir, get_spark  # noqa: F401

__version__ = "0.1.0"
