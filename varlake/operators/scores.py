"""Impact, evidence codes, priority score and tier, gene curation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.values import fixed_text, has_word, number, true
from varlake.operators.splicing import splice_unified
from varlake.operators.status import ABSENT, GRPMAX, clinvar_masks, column, rarity, resolve_population_af

# Genes whose loss-of-function variants never get PVS1.
PVS1_VETO_GENES = ("MYH7",)
# Consequence terms of loss of function and of functional effects; names of the tiers.
LOF, FUNCTIONAL = "stop_gained|frameshift|splice_donor|splice_acceptor", "missense|splice|stop|frameshift|inframe|utr|5_prime|3_prime"
TIERS = ("Tier 1 (Critical Pathogenic Candidate)", "Tier 2 (Likely Deleterious / Strong Candidate)", "Tier 3 (VUS / Moderate Potential)", "Tier 4 (Benign / Tolerated)")
# Evidence of curated genes, with the points a match gives.
EVIDENCE = {"Definitive / Primary Evidence": 25.0, "Strong / Sarcomeric Evidence": 18.0, "Moderate / Candidate Evidence": 12.0, "Heart Expressed (RNA-seq)": 6.0, "HPO Cardiac Related": 3.0}
# Below which frequency a rare variant of a gene priority and impact is a candidate.
DOMINANT = {("prioritary", "HIGH"): 0.01, ("prioritary", "MODERATE"): 1e-3, ("prioritary", "MODIFIER"): 1e-3, ("prioritary", "LOW"): 5e-4, ("secondary", "HIGH"): 1e-4, ("secondary", "MODERATE"): 1e-4, ("secondary", "LOW"): 5e-4, ("candidate", "HIGH"): 1e-4, ("candidate", "MODERATE"): 1e-4}
# Actionable genes (ACMG SF v3.2, cardiac).
ACTIONABLE = "MYBPC3 MYH7 TNNT2 TNNI3 TPM1 MYL2 MYL3 ACTC1 LMNA FLNC PKP2 DSP DSC2 DSG2 TMEM43 KCNQ1 KCNH2 SCN5A RYR2 FBN1 TGFBR1 TGFBR2 SMAD3 ACTA2 MYH11 COL3A1".split()


def _score(df: DataFrame, name: str) -> Column:
    """A scoring input: unreadable or absent is 0."""
    return number(column(df, name), 0.0)


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


def _splice(df: DataFrame) -> DataFrame:
    return df if "SPLICE_MAX_UNIFIED" in df.columns else splice_unified(df)


def _terms(df: DataFrame) -> DataFrame:
    """What consequence and ClinVar classification say, as flags: __lof, __functional, __pathogenic, __benign."""
    consequence = F.lower(_text(df, "Consequence"))
    pathogenic, benign = clinvar_masks(_text(df, "CLINVAR_SELECTED_CLNSIG"))
    return df.withColumns({"__lof": has_word(consequence, LOF), "__functional": has_word(consequence, FUNCTIONAL), "__pathogenic": pathogenic, "__benign": benign})


_FLAGS = ("__lof", "__functional", "__pathogenic", "__benign")


def new_impact(df: DataFrame) -> DataFrame:
    """NEW_IMPACT: the caller's impact raised by splicing, missense, 5'UTR and ClinVar evidence, in this order."""
    out = _terms(_splice(df))
    splice, pangolin, spip = F.col("SPLICE_MAX_UNIFIED"), _score(out, "Pangolin_max_score"), _score(out, "SPiP_prediction")
    spip_on = _text(out, "SPiP_interpretation") != "NTR"
    aberrant = _text(out, "SpliceVault_status") == "aberrant_event_detected"
    listed = F.trim(_text(out, "splicevardb_classification")) != ""
    moderate = true(splice > 0.2) | ((spip > 0.2) & spip_on) | (pangolin >= 0.2) | aberrant
    high = true(splice > 0.5) | ((spip > 0.5) & spip_on) | (pangolin >= 0.5) | (aberrant & true(splice >= 0.2)) | listed
    am, revel = _score(out, "am_pathogenicity"), _score(out, "REVEL_score")
    am_on = (am >= 0.564) | (F.lower(_text(out, "am_class")) == "pathogenic")
    low = ("LOW", "MODIFIER")
    # flags are columns, each step is one: a step uses the one before twice
    flags = {"moderate": moderate, "high": high, "am": am_on, "revel5": revel >= 0.5, "revel75": revel >= 0.75, "utr": _text(out, "UTRAnnotator_status") == "high_impact"}
    out = out.withColumns({f"__f_{k}": v for k, v in flags.items()})
    moderate, high, am_on, revel_on, revel_high, utr_on = (F.col(f"__f_{k}") for k in flags)
    impact = F.coalesce(column(out, "IMPACT"), F.lit("MODIFIER"))
    impact = F.when((impact != "HIGH") & moderate, "MODERATE").otherwise(impact)
    impact = F.when(high, "HIGH").otherwise(impact)
    # the steps in order, read from the last one back: the first that holds decides
    raised = am_on | revel_on | utr_on
    mid = F.when((impact != "HIGH") & moderate, "MODERATE").otherwise(impact)
    impact = F.when(F.col("__pathogenic") | (am_on & revel_high) | high, "HIGH").when(mid.isin(*low) & raised, "MODERATE").otherwise(mid)
    return out.withColumn("NEW_IMPACT", impact).drop(*(f"__f_{k}" for k in flags), *_FLAGS)


def acmg_criteria(df: DataFrame, freq_col: str = GRPMAX) -> DataFrame:
    """ACMG_CRITERIA: evidence codes joined by ', ', or Unclassified."""
    out = _terms(_splice(df if "POPULATION_AF_STATUS" in df.columns else resolve_population_af(df, freq_col)))
    consequence, af = F.lower(_text(out, "Consequence")), rarity()
    splice, spip, am, revel = F.col("SPLICE_MAX_UNIFIED"), _score(out, "SPiP_prediction"), _score(out, "am_pathogenicity"), _score(out, "REVEL_score")
    pathogenic = F.col("__pathogenic")
    lof = F.col("__lof") & (_score(out, "pLI_gene_value") >= 0.9) & ~F.upper(_text(out, "SYMBOL")).isin(*PVS1_VETO_GENES)
    codes = [
        F.when(af > 0.05, "BA1").when(af > 0.01, "BS1"),
        F.when(lof, "PVS1"),
        F.when(pathogenic & F.contains(consequence, F.lit("missense")), "PS1"),
        F.when(af < 0.0001, "PM2_Supporting"),
        F.when(has_word(consequence, "inframe_insertion|inframe_deletion|stop_lost|start_lost"), "PM4"),
        F.when(true(splice >= 0.5) | (spip >= 0.5) | (am >= 0.564) | (revel >= 0.75), "PP3_Strong"),
        F.when((splice < 0.1) & (spip < 0.1) & (am > 0) & (am < 0.34) & (revel < 0.25), "BP4"),
        F.when(F.contains(consequence, F.lit("synonymous")) & (splice < 0.1), "BP7"),
    ]
    text = F.concat_ws(", ", *codes)
    return out.withColumn("ACMG_CRITERIA", F.when(text == "", "Unclassified").otherwise(text)).drop(*_FLAGS)


def priority(df: DataFrame, freq_col: str = GRPMAX, hpo_genes: list[str] | None = None) -> DataFrame:
    """VARIANT_PRIORITY_SCORE (0 to 100), PRIORITY_TIER, HPO_MATCH, SCORE_EXPLANATION and TIER_RATIONALE from what the table has.
    Optional inputs: QC_STATUS, DISEASE_EVIDENCE_SCORE, INHERITANCE_MODEL, COMPOUND_HET_STATUS, GENE_TIER, FAF_POPMAX_*, PVS1_ELIGIBILITY."""
    out = _terms(_splice(df if "POPULATION_AF_STATUS" in df.columns else resolve_population_af(df, freq_col)))
    symbol = F.upper(_text(out, "SYMBOL"))
    veto = true(F.lower(_text(out, "PVS1_ELIGIBILITY")).contains("vetoed")) | symbol.isin(*PVS1_VETO_GENES)
    parts = {
        "lof": F.col("__lof") & ~veto, "aberrant": _text(out, "SpliceVault_status") == "aberrant_event_detected",
        "utr": _text(out, "UTRAnnotator_status") == "high_impact", "intolerant": _score(out, "pLI_gene_value") >= 0.9,
        "low_qual": _text(out, "QC_STATUS") == "LOW_QUAL", "hpo": F.col("SYMBOL").isin(*hpo_genes) if hpo_genes else F.lit(False),
        "splice": F.col("SPLICE_MAX_UNIFIED"), "spip": _score(out, "SPiP_prediction"), "pangolin": _score(out, "Pangolin_max_score"),
        "revel": _score(out, "REVEL_score"), "am": _score(out, "am_pathogenicity"), "rarity": rarity(),
        "ba1_from": number(column(out, "FAF_POPMAX_BA1"), 0.002 if "FAF_POPMAX_BA1" not in out.columns else 0.0), "bs1_from": number(column(out, "FAF_POPMAX_BS1"), 0.0001 if "FAF_POPMAX_BS1" not in out.columns else 0.0),
        "model": _text(out, "INHERITANCE_MODEL"), "pair": _text(out, "COMPOUND_HET_STATUS"), "gene_tier": _text(out, "GENE_TIER"),
        "pathogenic": F.col("__pathogenic"), "benign": F.col("__benign"), "functional": F.col("__functional"),
    }
    # columns, not a struct: what is used often is then worked out once
    out = out.withColumns({f"__p_{k}": v for k, v in parts.items()})
    p = {k: F.col(f"__p_{k}") for k in parts}
    expert = p["pathogenic"] & true(number(column(out, "ClinVar_Stars")) >= 3)
    ba1 = true(p["rarity"] >= p["ba1_from"])
    bs1 = ~ba1 & true(p["rarity"] >= p["bs1_from"])
    pm2 = ~ba1 & ~bs1 & true(p["rarity"] < p["bs1_from"] / 2.5)
    paired = p["pair"].isin("Phased TRANS Pair", "Unphased Candidate Pair")
    composite = F.greatest(F.coalesce(p["splice"], F.lit(0.0)), p["spip"], p["pangolin"])
    revel = F.when(p["revel"] >= 0.932, 25.0).when(p["revel"] >= 0.773, 18.0).when(p["revel"] >= 0.644, 10.0).when(p["revel"] < 0.183, -15.0).when(p["revel"] <= 0.289, -8.0).otherwise(0.0)
    am = F.when(p["am"] >= 0.75, 18.0).when(p["am"] >= 0.564, 10.0).when(p["am"] < 0.34, -8.0).otherwise(0.0)
    insilico = F.when(p["lof"], 0.0).when(p["revel"] > 0, revel).when(p["am"] > 0, am).otherwise(0.0)
    model = F.when(p["model"] == "De Novo", 20.0).when(paired, 0.0).when(p["model"].isin("Autosomal Recessive (Hom)", "Autosomal Dominant / Heterozygous", "X-Linked"), 15.0).when(p["model"] == "Homozygous Variant", 10.0).otherwise(0.0)
    pair = F.when(p["pair"] == "Phased TRANS Pair", 15.0).when(p["pair"] == "Unphased Candidate Pair", 10.0).otherwise(0.0)
    frequency = F.when(ba1, -100.0).when(bs1, -25.0).when(pm2, 15.0).otherwise(0.0)

    def points(flag: Column, n: float) -> Column:
        return F.when(flag, n).otherwise(0.0)

    total = points(p["lof"], 35.0) + composite * 30.0 + points(p["aberrant"], 5.0) + insilico + points(p["utr"], 20.0) + points(p["intolerant"], 10.0)
    total = total + F.when(expert, 50.0).when(p["pathogenic"], 45.0).otherwise(0.0) - points(p["benign"], 40.0) + frequency - points(p["low_qual"], 25.0) + model + pair + _score(out, "DISEASE_EVIDENCE_SCORE") + points(p["hpo"], 15.0)
    tier_c, tier_d = p["gene_tier"] == "Tier_C", p["gene_tier"] == "Tier_D"
    total = F.when(tier_c, F.least(total, F.lit(45.0))).when(tier_d, F.least(total, F.lit(35.0))).otherwise(total)
    out = out.withColumn("__total", total)
    out = out.withColumn("VARIANT_PRIORITY_SCORE", F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("__total"))), 1))
    score = F.col("VARIANT_PRIORITY_SCORE")
    bent = true(p["splice"] >= 0.2) | (p["spip"] >= 0.2) | (p["pangolin"] >= 0.2)
    signal = bent | p["aberrant"] | p["utr"] | (p["revel"] >= 0.25) | (p["am"] >= 0.34) | p["lof"] | p["pathogenic"] | F.upper(_text(out, "NEW_IMPACT")).isin("MODERATE", "HIGH") | p["functional"]
    capped = p["low_qual"] | tier_c | tier_d | ba1 | bs1
    first = ~capped & pm2 & ((score >= 75) | (p["lof"] & p["intolerant"]) | p["pathogenic"] | (true(p["splice"] >= 0.8) & (p["aberrant"] | p["lof"] | p["intolerant"])) | (p["revel"] >= 0.932) | ((p["am"] >= 0.75) & (p["revel"] >= 0.773)))
    second = ~capped & signal & ((score >= 50) | true(p["splice"] >= 0.5) | (p["spip"] >= 0.3) | (p["pangolin"] >= 0.3) | p["utr"] | (p["am"] >= 0.75) | (p["revel"] >= 0.773) | p["lof"])
    third = ~ba1 & signal & ((score >= 25) | bent)
    out = out.withColumns({"PRIORITY_TIER": F.when(first, TIERS[0]).when(second, TIERS[1]).when(third, TIERS[2]).otherwise(TIERS[3]), "HPO_MATCH": p["hpo"]})

    af, tier, method = F.col("POPULATION_AF"), F.col("PRIORITY_TIER"), F.col("SPLICEAI_METHOD")

    # All texts from here to the end, which the tables' readers know.
    quality = F.coalesce(column(out, "QC_DETAIL"), F.lit("Low QUAL/GQ/FILTER"))
    via = F.when(F.contains(method, F.lit("Custom")), F.concat(F.lit(", SpliceAI "), fixed_text(p["splice"], 2), F.lit(" via Custom -D 4999"))).when(F.contains(method, F.lit("VEP")), F.concat(F.lit(", SpliceAI "), fixed_text(p["splice"], 2), F.lit(" via VEP Standard ~50bp"))).otherwise("")
    text = F.concat_ws(
        " | ",
        F.when(p["lof"], "LoF (+35.0)"),
        F.when(composite > 0.05, F.concat(F.lit("Splicing (+"), fixed_text(composite * 30, 1), via, F.lit(")"))),
        F.when(p["aberrant"], "SpliceVault (+5.0)"),
        F.when(insilico > 0, F.concat(F.lit("InSilico PP3 (+"), fixed_text(insilico, 1), F.lit(")"))).when(insilico < 0, F.concat(F.lit("InSilico BP4 ("), fixed_text(insilico, 1), F.lit(")"))),
        F.when(p["utr"], "UTR (+20.0)"), F.when(p["intolerant"], "LoF-Intolerant (+10.0)"),
        F.when(expert, "ClinVar Expert Panel / Practice Guideline Pathogenic (+50.0)").when(p["pathogenic"], "ClinVar Pathogenic (+45.0)").when(p["benign"], "ClinVar Benign (-40.0)"),
        F.when(F.col("POPULATION_AF_STATUS") == ABSENT, "PM2_Supporting absent from gnomAD v4 (+15.0)").when(af.isNull(), "Population AF unknown (no frequency evidence)").when(ba1, "BA1 Exceeds FAF_PopMax Threshold (Terminal Tier 4)").when(bs1, "BS1_Strong AF > FAF_BS1 (-25.0)").when(pm2, "PM2_Supporting AF < MCAF (+15.0)"),
        F.when(p["pair"] == "Phased TRANS Pair", "Compound Het TRANS Phased (+15.0)").when(p["pair"] == "Unphased Candidate Pair", "Compound Het Unphased Candidate (+10.0)").when(p["model"] == "De Novo", "De Novo (+20.0)").when(p["model"] == "Homozygous Variant", "Homozygous Variant (+10.0)").when(model > 0, F.concat(p["model"], F.lit(" (+15.0)"))),
        F.when(p["low_qual"], F.concat(F.lit("Low Quality Caller Metric (-25.0, "), quality, F.lit(")"))),
    )
    top = F.when(expert, "ClinGen VCEP Pathogenic / Likely Pathogenic Expert Entry").when(p["pathogenic"], "ClinVar Pathogenic / Likely Pathogenic Entry").when(p["lof"] & p["intolerant"], F.concat(F.lit("High-Confidence Loss-of-Function in Constrained Gene (pLI = "), fixed_text(_score(out, "pLI_gene_value"), 2), F.lit(" >= 0.90)")))
    top = top.when(p["splice"] >= 0.8, F.concat(F.lit("Ultra-High Splicing Alteration (SpliceAI = "), fixed_text(p["splice"], 2), F.lit(" >= 0.80 via "), method, F.lit(")"))).when(p["revel"] >= 0.932, F.concat(F.lit("Strong Pathogenic Missense (REVEL = "), fixed_text(p["revel"], 3), F.lit(" >= 0.932, PP3_Strong)"))).otherwise(F.concat(F.lit("High-Priority Composite Score ("), fixed_text(score, 1), F.lit("/100 >= 75.0) & Ultra-Rare Population Frequency (AF < MCAF)")))
    strong = F.when(p["lof"], F.concat(F.lit("Loss-of-Function Alteration"), F.when(F.col("POPULATION_AF_STATUS") == ABSENT, " (absent from gnomAD v4)").when(af.isNotNull(), F.concat(F.lit(" (AF = "), fixed_text(af, 4), F.lit(")"))).otherwise(" (population AF unknown)")))
    strong = strong.when(p["splice"] >= 0.5, F.concat(F.lit("High Splicing Delta Score (SpliceAI = "), fixed_text(p["splice"], 2), F.lit(" >= 0.50 via "), method, F.lit(")"))).when(p["revel"] >= 0.773, F.concat(F.lit("Moderate Pathogenic Missense (REVEL = "), fixed_text(p["revel"], 3), F.lit(" >= 0.773, PP3_Moderate)"))).when(p["am"] >= 0.75, F.concat(F.lit("Moderate Pathogenic Missense (AlphaMissense = "), fixed_text(p["am"], 3), F.lit(" >= 0.750, PP3_Moderate)"))).otherwise(F.concat(F.lit("Strong Priority Composite Score ("), fixed_text(score, 1), F.lit("/100 >= 50.0)")))
    middle = F.when(bent, F.concat(F.lit("Moderate Splicing Delta Alteration (SpliceAI = "), F.coalesce(fixed_text(p["splice"], 2), F.lit("nan")), F.lit(" >= 0.20 via "), method, F.lit(")"))).otherwise(F.concat(F.lit("Moderate Priority Composite Score ("), fixed_text(score, 1), F.lit("/100 >= 25.0)")))
    last = F.when(ba1, F.concat(F.lit("Stand-Alone Benign: AF ("), fixed_text(af, 4), F.lit(") Exceeds FAF_PopMax Threshold ("), fixed_text(p["ba1_from"], 4), F.lit(")"))).when(bs1, F.concat(F.lit("Strong Benign: AF ("), fixed_text(af, 4), F.lit(") Exceeds FAF_BS1 Threshold ("), fixed_text(p["bs1_from"], 4), F.lit(")"))).when(p["benign"], "ClinVar Benign / Likely Benign Entry").otherwise(F.concat(F.lit("Low Priority Composite Score ("), fixed_text(score, 1), F.lit("/100 < 25.0) Without Functional Evidence")))
    why = F.when(tier == TIERS[0], top).when(tier == TIERS[1], strong).when(tier == TIERS[2], middle).otherwise(last)
    warned = F.when(p["low_qual"], F.concat(F.lit(" [⚠️ LOW_QUAL Caller Warning: "), quality, F.lit("]"))).otherwise("")
    return out.withColumns({"SCORE_EXPLANATION": F.when(text == "", "Neutral Rarity / Benign").otherwise(text), "TIER_RATIONALE": F.concat(why, warned)}).drop(*(f"__p_{k}" for k in parts), "__total", *_FLAGS)


def dominant_rank(df: DataFrame, thresholds: dict = DOMINANT) -> DataFrame:
    """Variant_rank: Candidate below the threshold of (gene_priority, NEW_IMPACT), Excluded, or Unknown frequency."""
    limits = F.create_map(*(F.lit(x) for (a, b), v in thresholds.items() for x in (f"{a}/{b}", v)))
    limit = F.try_element_at(limits, F.concat_ws("/", "gene_priority", "NEW_IMPACT"))
    return df.withColumn("Variant_rank", F.when(rarity().isNull(), "Unknown frequency").when(rarity() < limit, "Candidate").otherwise("Excluded"))


def hpo_match(df: DataFrame, panels: DataFrame, terms: list[str]) -> DataFrame:
    """HPO_MATCH for genes of the terms' panels (term, symbol), with 15 points where there is a score."""
    names = [t.split(" - ")[0].strip().upper() for t in terms]
    names = [t if t.startswith("HP:") else f"HP:{t}" for t in names]
    genes = panels.where(F.col("term").isin(*names)).select(F.col("symbol").alias("SYMBOL")).distinct().withColumn("__hit", F.lit(True))
    out = df.join(genes, "SYMBOL", "left").withColumn("HPO_MATCH", F.coalesce("__hit", F.lit(False))).drop("__hit")
    if "VARIANT_PRIORITY_SCORE" in df.columns:
        out = out.withColumn("VARIANT_PRIORITY_SCORE", F.when(F.col("HPO_MATCH"), F.bround(F.least(F.lit(100.0), F.col("VARIANT_PRIORITY_SCORE") + 15), 1)).otherwise(F.col("VARIANT_PRIORITY_SCORE")))
    return out


def merge_gene_curation(first: DataFrame, second: DataFrame, core: list[str]) -> DataFrame:
    """Two curation lists (GENE, SOURCE, EVIDENCE) and (Gen, Prioridad) as symbol, source, evidence_tier; each gene once per list."""
    a = first.select(F.upper(F.trim("GENE")).alias("symbol"), "SOURCE", "EVIDENCE").where("symbol <> '' AND symbol <> 'NAN'")
    b = second.select(F.upper(F.trim("Gen")).alias("symbol"), F.rtrim(F.trim("Prioridad"), F.lit(",")).alias("v2")).where("symbol <> '' AND symbol <> 'NAN'")
    both = a.join(b, "symbol", "full_outer").withColumns({"v4": F.coalesce("EVIDENCE", F.lit("Candidate")), "v2": F.coalesce("v2", F.lit("")), "source": F.coalesce("SOURCE", F.lit("Cardiomyopathies"))})
    names = list(EVIDENCE)
    tier = F.when((F.col("v4") == "Prioritary") | (F.col("v2") == "Prioritario") | F.col("symbol").isin(*core), names[0]).when(F.col("v2") == "sarcomere_genes_GO", names[1]).when((F.col("v4") == "Candidate") | (F.col("v2") == "Candidato"), names[2])
    tier = tier.when(F.col("v2") == "rna_heart_tissue", names[3]).when((F.col("v2") == "HPO_heart_related_genes") | (F.col("v4") == "Secondary"), names[4]).otherwise(names[2])
    return both.select("symbol", "source", tier.alias("evidence_tier"))


def disease_curation(df: DataFrame, curation: DataFrame, primary: list[str], high_risk: list[str], source_word: str | None = None) -> DataFrame:
    """DISEASE_GENE_EVIDENCE, _SOURCE, _MATCH, _SCORE, HIGH_RISK_DISEASE_GENE and ACMG_SF_V3_2 by gene symbol."""
    names = list(EVIDENCE)
    out = df.withColumn("__gene", F.upper(F.trim(F.coalesce("SYMBOL", F.lit(""))))).join(curation.withColumnRenamed("symbol", "__gene"), "__gene", "left")
    known_, core = F.col("evidence_tier").isNotNull(), F.col("__gene").isin(*primary)
    match = known_ & (core | (F.contains(F.lower("source"), F.lit(source_word.lower())) if source_word else F.lit(False)))
    base = F.col("evidence_tier")
    tier = F.when(~known_, "Uncurated / Other Genomic").when(match & core, names[0]).when(~match & (base == names[0]), names[2]).otherwise(base)
    points = F.create_map(*(F.lit(x) for kv in EVIDENCE.items() for x in kv))
    out = out.withColumns({"DISEASE_GENE_EVIDENCE": tier, "DISEASE_CURATION_SOURCE": F.when(known_, F.when(F.col("source") != "", F.col("source")).otherwise("Cardiovascular Panel")).otherwise("Genome-Wide Background"), "DISEASE_PHENOTYPE_MATCH": true(match), "HIGH_RISK_DISEASE_GENE": F.col("__gene").isin(*high_risk), "ACMG_SF_V3_2": F.col("__gene").isin(*ACTIONABLE)})
    return out.withColumn("DISEASE_EVIDENCE_SCORE", F.when(F.col("DISEASE_PHENOTYPE_MATCH"), F.coalesce(F.try_element_at(points, F.col("DISEASE_GENE_EVIDENCE")), F.lit(0.0))).otherwise(0.0)).drop("__gene", "source", "evidence_tier")


def gene_priority(evidence: Column, source: Column, context: str) -> Column:
    low = F.lower(evidence)
    if context == "Peripheral_and_conduction":
        value = F.when(F.contains(source, F.lit(context)), "prioritary").otherwise(low)
    elif context == "Cardiomyopathies":
        value = F.when(F.contains(source, F.lit(context)), low).when(F.contains(source, F.lit("Peripheral_and_conduction")), "candidate").otherwise(low)
    elif context == "Aortic_and_vascular":
        value = F.when(F.contains(source, F.lit(context)), low).when(F.contains(source, F.lit("Cardiomyopathies")), "candidate").otherwise(low)
    else:
        value = F.when(F.contains(low, F.lit("prioritary")), "prioritary").otherwise(low)
    value = F.when(evidence.isNull() | F.trim(evidence).isin("", ".", "nan", "NaN", "None"), "others").otherwise(value)
    return F.when(value.isin("prioritary", "secondary", "candidate", "others"), value)


def prioritize_genes(df: DataFrame, genes: DataFrame, context: str = "all") -> DataFrame:
    """SOURCE, EVIDENCE and gene_priority of the row's symbol; an unknown context is an error."""
    if context != "all":
        there = {s for r in genes.select(F.explode(F.split("SOURCE", ";")).alias("s")).distinct().collect() for s in [r.s]}  # a few categories
        if any(c not in there for c in context.split(",")):
            raise ValueError(f"unknown gene category {context}")
    named = genes.select(F.trim("GENE").alias("SYMBOL"), "SOURCE", "EVIDENCE")
    out = df.drop("SOURCE", "EVIDENCE").join(named, "SYMBOL", "left")
    return out.withColumn("gene_priority", gene_priority(F.col("EVIDENCE"), F.col("SOURCE"), context))


def gene_constraint(df: DataFrame, constraint: DataFrame | None) -> DataFrame:
    """pLI, LOEUF and missense Z of the row's gene, and gene_constraint_status. A repeated gene in the table is an error."""
    gene = F.trim(F.coalesce("Gene", F.lit("")))
    has = gene.startswith("ENSG")
    names = {"pLI_gene_value": "pLI", "LOEUF_gene_value": "LOEUF", "mis_z_gene_value": "mis_z"}
    if constraint is None:
        return df.withColumns({k: F.lit(None).cast("double") for k in names} | {"gene_constraint_status": F.when(has, "not_annotated").otherwise("not_applicable")})
    if not constraint.groupBy("gene_id").count().where("count > 1").isEmpty():
        raise ValueError("the constraint table repeats a gene")
    values = constraint.select(F.col("gene_id").alias("__id"), *(F.col(v).alias(k) for k, v in names.items()), F.lit(True).alias("__in"))
    out = df.withColumn("__gene", gene).join(values, (F.col("__gene") == F.col("__id")) & F.col("__gene").startswith("ENSG"), "left")
    return out.withColumn("gene_constraint_status", F.when(~has, "not_applicable").when(F.col("__in"), "matched").otherwise("not_in_table")).drop("__gene", "__id", "__in")
