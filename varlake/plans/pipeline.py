"""The prioritised table: all steps over an annotated table in their order, one chain of DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.functions.values import once
from varlake.operators import rows, scores, splicing, status
from varlake.operators.status import GRPMAX, rarity


def prioritise(df: DataFrame, below: float | None = None, impacts: list[str] | None = None, freq_col: str = GRPMAX, constraint: DataFrame | None = None) -> DataFrame:
    """Locus, intron offset, frequency, ClinVar, predictors, QC, impact, criteria, score and tier. Steps whose columns are
    there already are left out; below and impacts filter as early as they can."""
    out = rows.build_locus(df)
    if "HGVSc" in out.columns and "intron_offset_signed" not in out.columns:
        out = splicing.intron_offsets(out)
    if "POPULATION_AF_STATUS" not in out.columns:
        out = status.resolve_population_af(out, freq_col)
    if below is not None:
        out = out.where(rarity().isNull() | (rarity() < below))
    if "CLINVAR_SELECTED_CLNSIG" not in out.columns:
        out = status.annotate_clinvar(out)
    if constraint is not None:
        out = scores.gene_constraint(out, constraint)
    if "SPLICE_MAX_UNIFIED" not in out.columns:
        out = splicing.splice_unified(splicing.splice_max(out))
    if "QC_STATUS" not in out.columns:
        out = rows.qc_status(out)
    out = scores.new_impact(out)
    if impacts:
        # made once a row: the planner would write the whole of it into the filter, too
        out = once(out, {"NEW_IMPACT": F.col("NEW_IMPACT")}, drop=["NEW_IMPACT"])
        out = out.where(F.col("NEW_IMPACT").isin(*impacts))
    return scores.priority(scores.acmg_criteria(out, freq_col), freq_col)
