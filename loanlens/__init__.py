"""loanlens: credit-risk features, statistics and scoring as Spark jobs.

Modules (all functions take and return DataFrames, or are Spark ML stages):

* ``sources``    - parquet/CSV scans and sinks, loan stand-in views
* ``functions``  - column-level recodes, flags, fills, renames
* ``operators``  - features, quality, relational, reports, stats, splits,
                   evaluate, ranking, attribution
* ``modeling``   - fitted preprocessing stages, pipelines, boosted trees
* ``plans``      - feature marts, the registered queries, oracle SQL
* ``streaming``  - record validation, batch and stream scoring
"""

from importlib import import_module

from .session import ensure_checkpoint_dir, get_spark  # noqa: F401

_OPERATORS = ("attribution", "evaluate", "features", "quality", "ranking", "relational", "reports", "splits", "stats")


def __getattr__(name: str):
    """Operator modules load on first use: Python workers import only what they run."""
    if name in _OPERATORS:
        return import_module(f".operators.{name}", __name__)
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")


__version__ = "0.1.0"
