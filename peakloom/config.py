"""Typed parameters of a refinement run."""

from __future__ import annotations

from dataclasses import dataclass

# Exponents of the composite score (similarity, library, mass error, profile).
SCORE_EXPONENTS = (9.5, 4.5, 2.5, 0.5)

# Stage labels written in the Comment column.
STAGE_SMALL = "aa-NonOptimized_LowerNumOfMinTrans"
STAGE_INITIAL = "a-Initial"
STAGE_FILTER_1 = "b-After 1st similarity score filter"
STAGE_SEARCH_1 = "c-After 1st GA optimization"
STAGE_FILTER_2 = "d-After 2nd similarity score filter"
STAGE_SEARCH_2 = "e-After 2nd GA optimization"
STAGE_RESCORE = "f.GlobalRefinement"


@dataclass(frozen=True)
class RefineParams:
    """Every tunable of the refinement; there are no hidden globals."""

    mass_error_tolerance: float = 5.0
    mass_error_cutoff: float = 10.0
    remove_below_ordinal: int = 3
    remove_shared_signals: bool = True
    min_initial_fragments: int = 3
    min_fragments: int = 3
    keep_small_analytes: bool = True
    name_tag: str = "T"
    n_groups: int = 6
    apply_prefilter: bool = False
    drop_fraction: float = 0.25
    edge_fraction: float = 0.05
    # Up to this many kept fragments an analyte has all its subsets scored (2^n of them, so at most 16); beyond,
    # the search climbs from its starts. 0: every analyte climbs.
    exhaustive_limit: int = 12
    # The fragments of a run are put side by side in one row up to this many; beyond, every step works on
    # long rows. The results are the same.
    list_limit: int = 64
    # So are analytes whose run matrices (runs times fragments squared) exceed this.
    local_limit: int = 4_000_000
    # Groups with more rows than this get their quantiles from a bracketing sketch plus an exact finish.
    hot_group_rows: int = 1_000_000

    # Buckets of the table of traces by run; the shuffle partitions unless given.
    run_buckets: int | None = None

    def __post_init__(self) -> None:
        if self.mass_error_cutoff <= self.mass_error_tolerance:
            raise ValueError("mass_error_cutoff must exceed mass_error_tolerance")
        if self.list_limit < 0 or self.local_limit < 0:
            raise ValueError("limits must not be negative")
        if not 0 <= self.exhaustive_limit <= 16:
            raise ValueError("exhaustive_limit must lie in 0..16")
        if not 1 <= self.n_groups <= 256:
            raise ValueError("n_groups must lie in 1..256")
