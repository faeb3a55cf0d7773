"""tessera: exact t-SNE neighbour embedding on the Spark DataFrame API.

Every operator takes and returns DataFrames.  The two quadratic steps
(exact k-nearest neighbours and the Student-t normaliser / repulsion) run
as hash-blocked tiles through a grouped ``applyInPandas``; everything else
is plain Catalyst (joins, grouped aggregates, windows, projections).
"""

from tessera.params import AS_EXECUTED, INTENDED, TsneParams
from tessera.session import ensure_checkpoint_dir, get_session

__all__ = ["TsneParams", "INTENDED", "AS_EXECUTED", "get_session", "ensure_checkpoint_dir"]
