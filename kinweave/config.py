"""Parameters that change results, and the named flags of observable quirks."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Quirks:
    """True reproduces the established behaviour, False corrects it."""

    whole_rep_never_target: bool = True  # a representative without region has a key that no search target equals
    architecture_by_model_start: bool = True  # domains are ordered by the fourth item of a hit, not by sequence start
    ignore_pair_count: bool = True  # each (protein, biome) pair adds 1 whatever its own count
    cut_renamed: bool = True  # a new name longer than the old one is cut
    exclusive_clip_end: bool = True  # the last column over the occupancy threshold is dropped
    size_before_dedupe: bool = True  # the stored family size counts duplicate names
    final_search_fast_model: bool = True  # the last search uses the loop's model, not the stored one


@dataclass(frozen=True)
class Config:
    fasta_input: bool = False
    min_sequence_length: int = 100
    cluster_identity: float = 0.5
    cluster_coverage: float = 0.9
    minimum_members: int = 25
    clusters_chunk_size: int = 20
    min_rep_length: int = 75
    max_rep_length: int = 2000
    min_starting_membership: float = 0.9
    max_seed_identity: float = 0.8
    max_seed_sequences: int = 2000
    gap_occupancy: float = 0.5
    recruit_e_value: float = 0.001
    recruit_length_fraction: float = 0.9
    search_e_value: float = 0.001
    redundant_length: float = 0.9
    redundant_score: float = 0.95
    similarity_score: float = 0.5
    starting_id: int = 1
    structure_chunk: int = 50
    structure_chunk_long: int = 5
    hh_mode: str = "hhsearch"
    hh_reported: tuple[int, int] = (0, 1000)
    hh_probability: float = 80.0
    hh_e_value: float = 0.001
    fold_e_value: float = 0.001
    query_hmm_length: float = 0.8
    topology_max_residues: int = 1022
    skip_topology: bool = False
    id_prefix: str = "FAM"
    quirks: Quirks = field(default_factory=Quirks)

    def __post_init__(self) -> None:
        if self.hh_mode not in ("hhsearch", "hhblits"):
            raise ValueError(f"hh_mode must be hhsearch or hhblits, not {self.hh_mode!r}")
