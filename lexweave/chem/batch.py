"""Naming as a DataFrame operator."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "struct<status:string,name:string,reason:string,stereo_complete:boolean,trace:array<struct<rule_id:string,message:string,selected:string>>>"
_ARROW = pa.struct(
    [
        ("status", pa.string()),
        ("name", pa.string()),
        ("reason", pa.string()),
        ("stereo_complete", pa.bool_()),
        ("trace", pa.list_(pa.struct([("rule_id", pa.string()), ("message", pa.string()), ("selected", pa.string())]))),
    ]
)
#: First words of reasons by stage of failure.
STAGES = (("disconnected", "^Disconnected"), ("charge, isotope or stereo", "^(?:Formal-charge|Isotopic|Radical|Enhanced|Explicit unknown|Stereochemistry|Non-)"), ("ring or aromatic", "(?i)ring|cycl|benzene|aromatic|phenyl"), ("invalid input", "^(?:Invalid|Empty)"))


def name_molecules(df: DataFrame, smiles_col: str = "smiles", out: str = "named", compat: bool = False) -> DataFrame:
    """``df`` with ``out``: status, name, reason, stereo_complete and trace of each molecule; nulls are unsupported."""

    @F.arrow_udf(RESULT)
    def of(texts: pa.Array) -> pa.Array:
        from lexweave.chem.namer import name_smiles

        rows = []
        for t in texts.to_pylist():
            r = name_smiles(t or "", compat)
            rows.append({**r, "trace": [dict(zip(("rule_id", "message", "selected"), s, strict=True)) for s in r["trace"]]})
        return pa.array(rows, _ARROW)

    return df.withColumn(out, of(F.col(smiles_col)))


def first_blockers(named: DataFrame, out: str = "named") -> DataFrame:
    """How many molecules each stage stops, and how many are named: ``stage``, ``n``."""
    stage = F.lit("other unsupported scope")
    for name, pattern in reversed(STAGES):
        stage = F.when(F.col(f"{out}.reason").rlike(pattern), name).otherwise(stage)
    return named.groupBy(F.when(F.col(f"{out}.status") == "success", "named").otherwise(stage).alias("stage")).agg(F.count(F.lit(1)).alias("n"))


def score(named: DataFrame, expected_col: str = "expected", out: str = "named") -> DataFrame:
    """Exact matches, other names and failures of cases with an expected name."""
    same = F.col(f"{out}.name") == F.col(expected_col)
    return named.agg(F.count_if(same).alias("exact"), F.count_if(~same & F.col(f"{out}.name").isNotNull()).alias("different"), F.count_if(F.col(f"{out}.name").isNull()).alias("unsupported"))
