"""Explicit schemas of every table: nothing is inferred, ids are text."""

from __future__ import annotations

PROTEIN = "protein_id string, sequence string, full_length boolean, cluster_size int, metadata string"
SEQUENCE = "id string, seq string"
CLUSTER = "representative string, member string"
FAMILY_MEMBER = "family string, member string"
FAMILY_METADATA = "iteration int, size int, rep string, region string, rep_length int, sequence string, consensus string, converged boolean"
DISCARDED = "rep string, reason string, value double"
DOMTBL = (
    "target string, target_acc string, tlen int, query string, query_acc string, qlen int, e_value string, score string, bias string, "
    "n int, of int, c_evalue string, i_evalue string, dom_score string, dom_bias string, hmm_from int, hmm_to int, "
    "ali_from int, ali_to int, env_from int, env_to int, acc string, description string"
)
FOLD_HIT = (
    "query string, target string, identity string, aligned_length int, mismatches int, gaps int, "
    "q_start int, q_end int, t_start int, t_end int, e_value string, bits string"
)
SIMILARITY = "row int, family1 string, family2 string, score double"
STRUCTURE_SCORE = "id string, plddt double, ptm double"
LOOKUP = "protein_id string, biomes string, domains string"
NAME_MAP = "id string, name string"

SAMPLES = {
    "families": "sample string, protein_input string",
    "init_db": "sample string, schema string, results_folder string",
    "update_db": "sample string, results_folder string, existing_db string, protein_db_config string",
}

BLOBS = ("seed_msa_blob", "hmm_blob", "rf_blob", "cif_blob", "biome_blob", "domain_blob", "s4pred_blob", "tm_blob")
FAMILY_HEADER = (
    "id", "full_size", "protein_rep", "rep_region", "rep_length", "converged", "plddt", "ptm",
    "helix_percent", "strand_percent", "coil_percent", "inside_percent", "membrane_alpha_percent", "outside_percent",
    "signal_percent", "membrane_beta_percent", "periplasm_percent", "rep_sequence", "consensus", *BLOBS,
)

_HIT = "e_value double, score double, hmm_from int, hmm_to int, ali_from int, ali_to int, env_from int, env_to int, acc double"
#: The serving database: one fact table with blobs and four child tables.
SERVING = {
    "family": (
        "id bigint, full_size int, protein_rep string, rep_region string, rep_length int, converged boolean, plddt double, ptm double, "
        "helix_percent double, strand_percent double, coil_percent double, inside_percent double, membrane_alpha_percent double, "
        "outside_percent double, signal_percent double, membrane_beta_percent double, periplasm_percent double, rep_sequence string, "
        "consensus string, " + ", ".join(f"{b} binary" for b in BLOBS)
    ),
    "family_pfams": f"id bigint, family_id bigint, pfam string, name string, {_HIT}",
    "family_funfams": f"id bigint, family_id bigint, funfam string, {_HIT}",
    "family_folds": "id bigint, family_id bigint, fold string, aligned_length int, q_start int, q_end int, t_start int, t_end int, e_value double",
    "family_model_pfams": (
        "id bigint, family_id bigint, pfam string, name string, description string, prob double, e_value double, "
        "length int, query_hmm string, template_hmm string"
    ),
}
