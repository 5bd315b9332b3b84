"""Queries that name molecules: parts of the warehouse stand for samples, each of one of the known molecules."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.chem import batch, cases


def samples(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    known = F.array(*map(F.lit, cases.NAMES))
    return p.select("p_partkey", F.element_at(known, (F.col("p_partkey") % len(cases.NAMES) + 1).cast("int")).alias("smiles"))


def smiles_names(spark, sf_dir):
    """The name of every part's molecule. Distinct molecules are named once and joined back."""
    s = samples(spark, sf_dir)
    named = batch.name_molecules(s.select("smiles").distinct())
    return s.join(named.select("smiles", "named.name", "named.status"), "smiles").select("p_partkey", "smiles", "name", "status")


def smiles_blockers(spark, sf_dir):
    """What stops molecules, by stage, over all known cases."""
    rows = [(s,) for s in (*cases.NAMES, *cases.REASONS)]
    return batch.first_blockers(batch.name_molecules(spark.createDataFrame(rows, "smiles string")))


QUERIES = {f.__name__: f for f in (smiles_names, smiles_blockers)}

_VALUES = ", ".join("({}, '{}', '{}')".format(i, s.replace("'", "''"), n.replace("'", "''")) for i, (s, n) in enumerate(cases.NAMES.items()))
ORACLES = {
    "smiles_names": f"SELECT p_partkey, smiles, name, 'success' AS status FROM part JOIN (VALUES {_VALUES}) AS k(i, smiles, name) ON p_partkey % {len(cases.NAMES)} = i",
}
