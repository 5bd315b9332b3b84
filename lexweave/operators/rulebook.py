"""The static rulebook of the molecule namer as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rule, title, predicate, action, status.
RULEBOOK = (
    ("P-10", "Structure containing at least one carbon atom is organic for nomenclature purposes", "molecule.contains_carbon", "route_to_organic_nomenclature", "partial"),
    ("P-11", "Elements in organic nomenclature scope", "all_atoms_in_groups_13_to_17_or_allowed_organometallic_scope", "accept_bluebook_element_domain_or_route_elsewhere", "partial"),
    ("P-12.1", "Preferred IUPAC names are selected among multiple recommended names", "candidate_set.has_multiple_iupac_names", "rank_candidates_for_pin", "planned"),
    ("P-13.1", "Substitutive operation", "compound_can_be_derived_from_parent_by_replacing_hydrogen", "construct_substitutive_name", "partial"),
    ("P-13.2.1.1", "Skeletal replacement operation", "heteroatoms_replace_skeletal_atoms_in_parent", "construct_replacement_name", "planned"),
    ("P-13.3.3.2", "Functional class operation", "class_name_preferred_or_allowed", "construct_functional_class_name", "planned"),
    ("P-14.4", "General rules, locants, lowest locant sets, first point of difference", "candidate_numberings_exist", "select_lowest_locant_numbering", "partial"),
    ("P-21.2.1", "Unbranched saturated acyclic hydrocarbons", "acyclic_unbranched_saturated_carbon_parent", "select_alkane_parent_hydride", "partial"),
    ("P-22.1.1", "Monocyclic saturated hydrocarbons", "monocyclic_saturated_carbon_parent", "select_cycloalkane_parent_hydride", "partial"),
    ("P-22.1.2", "Retained benzene and monocyclic unsaturated hydrocarbon parents", "isolated_six_membered_aromatic_carbon_parent", "select_retained_benzene_parent", "partial"),
    ("P-29.6", "Retained prefixes derived from parent hydrides", "retained_substituent_prefix_is_preferred", "render_phenyl_or_retained_organyl_prefix", "partial"),
    ("P-31.1.3.1", "Subtractive unsaturation operation for alkenes", "parent_has_double_bond", "render_ene_suffix", "partial"),
    ("P-31.1.3.2", "Subtractive unsaturation operation for alkynes", "parent_has_triple_bond", "render_yne_suffix", "partial"),
    ("P-33", "Characteristic groups as suffixes and prefixes", "functional_groups_detected", "rank_characteristic_groups_and_render_suffix_or_prefix", "partial"),
    ("P-44", "Selection of parent structures", "parent_candidates_exist", "rank_parent_candidates", "partial"),
    ("P-45", "Selection of preferred prefixes", "substituent_candidates_exist", "rank_and_render_prefixes", "partial"),
    ("P-52.2.8", "Selection between ring and chain parent structures for preferred names", "ring_and_chain_parent_candidates_tied_by_class_and_suffix_count", "prefer_ring_parent_for_pin", "partial"),
    ("P-5", "Selecting preferred IUPAC names", "candidate_set.complete", "select_pin", "planned"),
    ("P-93.4", "Citation and placement of stereodescriptors", "absolute_parent_stereodescriptors_assigned", "render_stereodescriptors_with_final_parent_locants", "partial"),
)


def rulebook(spark: SparkSession) -> DataFrame:
    """``pos``, ``rule_id``, ``title``, ``predicate``, ``action``, ``status``, ``priority`` (the numbers of the id)."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(RULEBOOK)], "pos int, rule_id string, title string, predicate string, action string, status string")
    # two entries rank by a number that isn't their id's
    special = F.when(F.col("rule_id") == "P-14.4", F.array(F.lit(14))).when(F.col("rule_id") == "P-5", F.array(F.lit(50)))
    return df.withColumn("priority", F.coalesce(special, F.transform(F.split(F.substring("rule_id", 3, 40), r"\."), lambda x: x.cast("int"))))
