"""Parameters of the embedding and the two presets.

``AS_EXECUTED`` follows what the original batch job really computes (several
of its intended steps have no effect there); ``INTENDED`` follows the
published algorithm.  Everything not listed in a preset is shared.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class TsneParams:
    k: int = 2                      # output dimensions
    max_iter: int = 100
    initial_momentum: float = 0.5
    final_momentum: float = 0.8
    momentum_switch_iter: int = 20  # iterations (from 0) below this use initial_momentum
    lr: float = 500.0
    min_gain: float = 0.01
    perplexity: float = 30.0
    tol: float = 1e-5
    max_tries: int = 50
    exaggeration: float = 4.0
    stop_exaggeration_at: int | None = 100   # completed iterations; None = never
    neighbours: str = "knn"         # "knn" (floor(3*perplexity) nearest), "approximate" or "all"
    probes: int = 8                 # "approximate": cells that each point meets
    cells: int | None = None        # "approximate": number of cells; None = one per block
    repulsion: str = "full"         # "full" (all pairs) or "graph" (edges of P only)
    floor_p: bool = True            # max(p, 1e-12) on stored edges
    floor_q: bool = True            # max(q, 1e-12) where Q is an output (edge_affinity)
    diagonal_value: float = 1e-12   # diagonal written into the P output
    pca_dims: int | None = 50       # None = no PCA
    seed: int = 42
    block_rows: int = 2048          # most points in a block of the quadratic passes
    snapshot_every: int = 0         # 0 = no snapshots

    @property
    def n_neighbours(self) -> int:
        return int(3 * self.perplexity)

    def with_(self, **kw) -> "TsneParams":
        return replace(self, **kw)


INTENDED = TsneParams()

AS_EXECUTED = TsneParams(
    floor_p=False,
    floor_q=False,
    stop_exaggeration_at=None,
    repulsion="graph",
    neighbours="knn",
    diagonal_value=0.0,
)
