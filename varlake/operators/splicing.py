"""Splicing predictors: packed values unpacked to the row's own gene, transcript and allele."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.values import alt_from_locus, intron_offset, known, listed_number, number, numbers, split_entries, strip_version, true, unit_score
from varlake.operators.status import column

VEP_SCORES = [f"SpliceAI_{p}DS_{k}" for p in ("pred_", "") for k in ("AL", "AG", "DL", "DG")]
CUSTOM, STANDARD, UNCOVERED = "Custom Window (-D 4999 / ~10kb)", "VEP Standard (~50bp)", "Not Covered"


def intron_offsets(df: DataFrame) -> DataFrame:
    """intron_offset_signed and splice_side from HGVSc, else CDNA_NAME."""
    text = F.coalesce(known(column(df, "HGVSc")), known(column(df, "CDNA_NAME")))
    offset = F.coalesce(intron_offset(text), F.lit(0))
    return df.withColumns({"intron_offset_signed": offset, "splice_side": F.when(offset > 0, "donor").when(offset < 0, "acceptor").otherwise("exonic")})


def symbol_routes(coordinates: DataFrame, aliases: DataFrame) -> DataFrame:
    """gene and state of each symbol (__symbol) by two routes that must agree: coordinates (symbol, ensg) and the alias
    edges (symbol, ensg, tier: 0 current, 1 previous or alias). A symbol that neither has is unresolved."""
    current = F.collect_set(F.when(F.col("tier") == 0, F.col("ensg")))
    other = F.collect_set(F.when(F.col("tier") == 1, F.col("ensg")))
    edges = aliases.groupBy(F.col("symbol").alias("__symbol")).agg(F.when(F.size(current) > 0, current).otherwise(other).alias("__genes"))
    routes = coordinates.groupBy(F.col("symbol").alias("__symbol")).agg(F.max("ensg").alias("__by_place"))
    genes, place = F.coalesce("__genes", F.array().cast("array<string>")), F.col("__by_place")
    gene = F.when(place.isNotNull(), F.when((F.size(genes) == 0) | F.array_contains(genes, place), place)).when(F.size(genes) == 1, F.element_at(genes, 1))
    state = F.when(gene.isNotNull(), "alias_resolved").when(place.isNotNull() | (F.size(genes) > 1), "ambiguous").otherwise("unresolved")
    return routes.join(edges, "__symbol", "full_outer").select("__symbol", gene.alias("resolved_gene"), state.alias("resolve_status"))


def resolve_symbol(df: DataFrame, symbol: str, coordinates: DataFrame, aliases: DataFrame) -> DataFrame:
    """resolved_gene and resolve_status of a symbol, as symbol_routes has them."""
    found = symbol_routes(coordinates, aliases)
    out = df.join(found, F.col(symbol) == F.col("__symbol"), "left").drop("__symbol")
    return out.withColumn("resolve_status", F.coalesce("resolve_status", F.lit("unresolved")))


def pick_gene_entry(df: DataFrame, entries: DataFrame, key: list[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """For each row the entry of its own gene and match, the reason. entries has key, ordinal, is_symbol (the entry's symbol is the row's),
    gene, resolve_status and entry; df has key and row_gene. Of several the first counts. extra: more aggregates of
    the entries, taken in the same pass."""
    own = F.when(F.col("is_symbol"), "matched").when(F.col("gene") == F.col("row_gene"), "alias_resolved")
    worst = F.when(F.col("resolve_status") == "ambiguous", 2).when(F.col("resolve_status") == "unresolved", 1).otherwise(0)
    ranked = entries.withColumn("own", own).groupBy(*key).agg(
        F.min(F.when(F.col("own").isNotNull(), F.struct("ordinal", "own", "entry"))).alias("hit"), F.max(worst).alias("worst"), *(c.alias(n) for n, c in (extra or {}).items()))
    out = df.join(ranked, key, "left")
    state = F.when(F.col("row_gene").isNull(), "no_row_gene").when(F.col("hit").isNotNull(), F.col("hit.own")).when(F.col("worst") == 2, "ambiguous").when(F.col("worst") == 1, "unresolved").otherwise("no_entry_for_row_gene")
    return out.withColumns({"match": state, "entry": F.when(F.col("row_gene").isNotNull(), F.col("hit.entry"))}).drop("hit", "worst")


def spliceai_unpack(df: DataFrame, key: list[str], coordinates: DataFrame, aliases: DataFrame, raw: str = "SpliceAI") -> DataFrame:
    """spliceai_custom_* of the entry for the row's gene and ALT, spliceai_custom_match, and the maximum over all genes."""
    score = [listed_number(F.get("__p", F.lit(i))) for i in range(2, 10)]
    rows = df.withColumn("__alt", alt_from_locus(F.col("Locus")))
    entries = rows.where(known(F.col(raw)).isNotNull()).select(*key, "__alt", F.col("SYMBOL").alias("__own"), strip_version(F.col("Gene")).alias("row_gene"), F.posexplode(split_entries(F.col(raw))).alias("ordinal", "__text"))
    entries = entries.withColumn("__p", F.split("__text", "\\|")).where("size(__p) >= 10").where("__alt IS NULL OR __p[0] = __alt")
    names = ["DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL"]
    entries = entries.withColumn("entry", F.struct(F.get("__p", F.lit(1)).alias("SYMBOL"), *(s.alias(n) for s, n in zip(score, names)), F.array_max(F.filter(F.array(*score[:4]), lambda x: x.isNotNull())).alias("MAX")))
    entries = entries.withColumn("__symbol_text", F.get("__p", F.lit(1)))
    entries = resolve_symbol(entries, "__symbol_text", coordinates, aliases).withColumnRenamed("resolved_gene", "gene")
    entries = entries.withColumn("is_symbol", true(F.col("__symbol_text") == F.col("__own")))
    picked = pick_gene_entry(df.withColumn("row_gene", strip_version(known(F.col("Gene")))), entries, key, {"spliceai_custom_anygene_MAX": F.max("entry.MAX")})
    cells = {f"spliceai_custom_{n}": F.col(f"entry.{n}") for n in ["SYMBOL", *names, "MAX"]}
    return picked.withColumns(cells | {"spliceai_custom_match": F.when(known(F.col(raw)).isNull(), "no_prediction").otherwise(F.col("match"))}).drop("entry", "match", "row_gene")


def _pangolin_best(block: Column) -> Column:
    """Largest absolute score in [0, 1] of a gene's block."""
    def score(p: Column) -> Column:
        value = F.substring_index(p, ":", -1)
        one_colon = F.length(F.substring_index(p, ":", 1)) + F.length(value) + 1 == F.length(p)
        return F.when(one_colon, F.abs(value.try_cast("double")))

    return F.array_max(F.filter(F.transform(F.split(block, "\\|"), score), lambda v: v <= 1))


def pangolin_unpack(df: DataFrame, raw: str = "Pangolin") -> DataFrame:
    """Pangolin_max_score of the row's own gene, Pangolin_status, Pangolin_match, and the maximum over all genes. Where there is
    only a score from before, it passes."""
    text, gene = known(column(df, raw)), strip_version(known(F.col("Gene")))
    before = number(column(df, "Pangolin_max_score"))
    df = df.withColumns({"__text": text, "__gene": gene, "__before": before, "__blocks": split_entries(text)})
    text, gene, before, blocks = (F.col(f"__{n}") for n in ("text", "gene", "before", "blocks"))
    ids = F.transform(blocks, lambda b: strip_version(F.substring_index(b, "|", 1)))
    df = df.withColumn("__place", F.nullif(F.array_position(ids, gene), F.lit(0).cast("long")).cast("int"))
    place = F.col("__place")
    own = F.when(text.isNotNull(), _pangolin_best(F.try_element_at(blocks, place))).otherwise(before)
    most = F.when(text.isNotNull(), F.array_max(F.filter(F.transform(blocks, _pangolin_best), lambda v: v.isNotNull()))).otherwise(before)
    match = F.when(text.isNull(), F.when(before.isNotNull(), "preparsed").otherwise("no_prediction")).when(gene.isNull(), "no_row_gene").when(place.isNotNull(), "matched").otherwise("no_entry_for_row_gene")
    return df.withColumns({"Pangolin_max_score": own, "Pangolin_status": F.when(own.isNotNull(), "scored").otherwise("not_covered"), "Pangolin_match": match, "Pangolin_anygene_max": most}).drop("__text", "__gene", "__before", "__blocks", "__place")


SPIP = "struct<interpretation:string,ci:string,prediction:double,mechanism:string,status:string>"


def spip_unpack(df: DataFrame, structure: DataFrame, gene_edges: DataFrame, raw: str = "SPiP") -> DataFrame:
    """SPiP_* of the row's own transcript: by the accession of MANE_SELECT or MANE_PLUS_CLINICAL, else by exon structure (structure: enst,
    spip_nm); SPiP_match, the maximum over all transcripts, and the same gene's maximum with its transcript and the number
    of the gene's transcripts (gene_edges: symbol, ensg)."""
    text = known(F.col(raw))
    error = true(F.contains(text, F.lit("caused an error in SPiP execution")))
    alt = alt_from_locus(F.col("Locus"))
    near = structure.groupBy(strip_version(F.col("enst")).alias("__enst")).agg(F.collect_set(strip_version(F.col("spip_nm"))).alias("__near"))
    symbols = gene_edges.groupBy(F.col("ensg").alias("__gene")).agg(F.collect_set("symbol").alias("__symbols"))
    rows = df.withColumns({"__enst": strip_version(F.col("Feature")), "__gene": strip_version(known(F.col("Gene")))}).join(near, "__enst", "left").join(symbols, "__gene", "left")
    parts = F.transform(split_entries(text), lambda e: F.split(e, "\\|"))
    entries = F.filter(parts, lambda p: (F.size(p) > 12) & (alt.isNull() | (F.trim(p[0]) == alt)))
    rows = rows.withColumn("__e", F.when(~error, entries))

    def first(test) -> Column:
        return F.get(F.filter("__e", test), F.lit(0))

    own = F.filter(F.array(*(strip_version(known(column(df, c))) for c in ("MANE_SELECT", "MANE_PLUS_CLINICAL"))), lambda x: x.isNotNull())
    exact = first(lambda p: F.array_contains(own, strip_version(p[11])))
    like = first(lambda p: true(F.array_contains("__near", strip_version(p[11]))))
    hit = F.coalesce(exact, like)

    def at(i: int) -> Column:
        return F.get(hit, F.lit(i))

    prediction, esr, cryptic = at(4).try_cast("double"), at(21).try_cast("double"), at(24).try_cast("double")
    mechanism = F.when(true(cryptic >= 0.2) | true(at(25).isin("Cryptic", "High Risk", "Medium Risk")), "cryptic_site").when(true(F.lower(at(20)).isin("1", "true", "yes")), "bp_disruption").when(true(F.abs(esr) > 0.05), "esr_alteration").when(true(prediction >= 0.2), "complex_splicing").otherwise("none")
    gene_own = F.filter("__e", lambda p: true((F.trim(p[12]) == F.col("SYMBOL")) | F.array_contains("__symbols", F.trim(p[12]))) & p[4].try_cast("double").isNotNull())
    gene_best = F.array_max(F.transform(gene_own, lambda p: F.struct(p[4].try_cast("double").alias("prediction"), strip_version(p[11]).alias("nm"))))
    match = F.when(text.isNull(), "no_prediction").when(error, "predictor_error").when((F.size(own) == 0) & F.col("__near").isNull(), "not_applicable_transcript").when(exact.isNotNull(), "matched").when(like.isNotNull(), "matched_by_exon_structure").otherwise("no_entry_for_row_gene")
    return rows.withColumns({
        "SPiP_interpretation": F.when(error, "Error").otherwise(at(2)), "SPiP_prediction": prediction,
        "SPiP_mechanism": F.when(error, "error").otherwise(mechanism), "SPiP_status": F.when(error, "error").when(prediction.isNotNull(), "scored").otherwise("not_covered"),
        "SPiP_match": match, "SPiP_anygene_max_prediction": F.array_max(numbers(F.transform("__e", lambda p: p[4]))),
        "SPiP_samegene_prediction": gene_best["prediction"], "SPiP_samegene_transcript": gene_best["nm"],
        "SPiP_samegene_n_transcripts": F.coalesce(F.when(F.col("__e").isNotNull(), F.size(F.array_distinct(F.transform(gene_own, lambda p: strip_version(p[11]))))), F.lit(0)),
    }).drop("__e", "__near", "__symbols", "__enst", "__gene")


def splicevault_decode(df: DataFrame) -> DataFrame:
    """SpliceVault_Predictions_Decoded and SpliceVault_status from events rank:type:impact:percent:frame; positions run along the strand."""
    missing = ("", ".", "nan", "N/A", "None")
    text, site = known(F.col("SpliceVault_top_events"), missing), known(column(df, "SpliceVault_site_pos"), missing)
    covered = site.isNotNull() | known(column(df, "SpliceVault_site_sample_count"), missing).isNotNull()
    place = site.try_cast("double").cast("long")
    minus = true(F.trim(column(df, "STRAND").cast("string")).isin("-1", "-", "negative"))
    kinds = F.create_map(*map(F.lit, ("CD", "Cryptic Donor", "CA", "Cryptic Acceptor", "ES", "Exon Skipping", "IR", "Intron Retention")))

    def described(p: Column) -> Column:
        offset, kind = p[2].try_cast("int"), p[1]
        where = F.when(offset == 0, "the annotated splice site").otherwise(F.concat(F.abs(offset).cast("string"), F.lit(" bp "), F.when(offset > 0, "downstream").otherwise("upstream"), F.lit(" of the annotated splice site"), F.when(place.isNotNull(), F.concat(F.lit(" (pos:"), (F.when(minus, place - offset).otherwise(place + offset)).cast("string"), F.lit(")"))).otherwise("")))
        impact = F.when(kind == "ES", F.concat(F.lit("Exon "), p[2], F.lit(" skipping"))).when(offset.isNull(), F.concat(F.lit("Offset "), p[2], F.lit(" bp"))).otherwise(F.concat(F.lit("Cryptic Site at "), where))
        share, frame = F.get(p, F.lit(3)), F.get(p, F.lit(4))
        full = F.concat(F.lit("Rank "), p[0], F.lit(": "), F.coalesce(F.try_element_at(kinds, kind), kind), F.lit(" ("), impact, F.lit(")"), F.when(true(share != ""), F.concat(F.lit(", "), share, F.lit("% support"))).otherwise(""), F.when(true(frame != ""), F.concat(F.lit(", "), F.replace(frame, F.lit("_"), F.lit(" ")))).otherwise(""))
        return F.when(F.size(p) < 3, F.array_join(p, ":")).otherwise(full)

    # events and their fields are split once; the texts are only made where they are asked for
    df = df.withColumn("__events", F.filter(F.transform(F.split(F.replace(text, F.lit(","), F.lit("&")), "&"), lambda e: F.trim(e)), lambda e: ~e.isin("", ".")))
    decoded = F.array_join(F.transform(F.transform("__events", lambda e: F.split(e, ":")), described), "; ")
    # the first character of an event tells that there is one; only a text of signs alone is split for its status
    found = true((F.ltrim(text, F.lit(",&. ")) != "") | (F.size("__events") > 0))
    return df.withColumns({
        "SpliceVault_Predictions_Decoded": F.when(found, decoded).when(covered, "No aberrant events detected in RNA-seq cohort").otherwise("Not covered"),
        "SpliceVault_status": F.when(found, "aberrant_event_detected").when(covered, "no_events_found").otherwise("not_covered"),
    }).drop("__events")


def labranchor_status(df: DataFrame) -> DataFrame:
    """LaBranchoR numbers with scored / not_covered; the allele-aware ones also not_applicable for other than single bases."""
    score = number(known(column(df, "LaBranchoR_score")))
    out = df.withColumns({"LaBranchoR_score": score, "LaBranchoR_status": F.when(score.isNotNull(), "scored").otherwise("not_covered")})
    if "LaBranchoR_ISM_d_best" in df.columns:
        ism = number(known(F.col("LaBranchoR_ISM_d_best")))
        snv = (F.length("REF") == 1) & (F.length("ALT") == 1)
        out = out.withColumns({"LaBranchoR_ISM_d_best": ism, "LaBranchoR_ISM_status": F.when(ism.isNotNull(), "scored").when(true(snv), "not_covered").otherwise("not_applicable")})
    return out


def maxentscan(df: DataFrame, threshold: float = 0.15) -> DataFrame:
    """Relative decrease from reference to alternative; disrupted from the threshold on; not_covered without a positive reference."""
    ref, alt = number(F.col("MaxEntScan_ref")), number(F.col("MaxEntScan_alt"))
    drop = F.when(ref > 0, (ref - alt) / ref)
    return df.withColumns({"MaxEntScan_pct_decrease": drop, "MaxEntScan_disrupted": F.when(drop >= threshold, "YES").otherwise("NO"), "MaxEntScan_status": F.when(drop.isNotNull(), "scored").otherwise("not_covered")})


def splice_max(df: DataFrame, columns: list[str] = VEP_SCORES) -> DataFrame:
    """spliceAI_MAX over the valid VEP scores and SpliceAI_status; nothing is imputed."""
    there = [c for c in columns if c in df.columns]
    state = column(df, "SpliceAI_status")
    if there:
        most = F.array_max(F.filter(F.array(*(unit_score(F.col(c)) for c in there)), lambda x: x.isNotNull()))
    else:
        most = F.when(~true(state.isin("not_covered", "error")), unit_score(column(df, "spliceAI_MAX", "double")))
    return df.withColumns({"spliceAI_MAX": most, "SpliceAI_status": F.when(most.isNotNull(), "scored").when(true(state == "error"), "error").otherwise("not_covered")})


def splice_unified(df: DataFrame) -> DataFrame:
    """SPLICE_MAX_UNIFIED: the custom score, else VEP's; SPLICEAI_METHOD says which; SPLICEAI_STATUS."""
    custom = unit_score(column(df, "spliceai_custom_MAX", "double"))
    state = column(df, "SpliceAI_status")
    vep = F.when(~true(state.isin("not_covered", "error")), unit_score(column(df, "spliceAI_MAX", "double")))
    failed = true(state == "error") | true(column(df, "spliceai_custom_match") == "predictor_error")
    best = F.coalesce(custom, vep)
    return df.withColumns({"SPLICE_MAX_UNIFIED": best, "SPLICEAI_METHOD": F.when(custom.isNotNull(), CUSTOM).when(vep.isNotNull(), STANDARD).otherwise(UNCOVERED), "SPLICEAI_STATUS": F.when(best.isNotNull(), "scored").when(failed, "error").otherwise("not_covered")})


# Columns of an unpacked splice entry, after its allele, and the columns beside which they stand.
BACKFILLED = ("SYMBOL", "DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL", "MAX")
ANCHORS = ("SpliceAI_status", "spliceAI_MAX", "IMPACT")


def backfill_columns(df: DataFrame, source: str = "SpliceAI", prefix: str = "spliceai_custom_") -> DataFrame:
    """A table that lacks the unpacked splice columns, with them: the fields of the first entry (entries are parted by commas) and the
    largest delta score, beside the first anchor column that is there. An entry of fewer fields, or with an unreadable number, gives nulls."""
    if source not in df.columns or f"{prefix}MAX" in df.columns:
        return df
    parts = F.split(F.trim(F.substring_index(F.trim(F.col(source).cast("string")), ",", 1)), "\\|")
    cells = {n: F.when(F.get(parts, F.lit(i + 1)) != ".", F.get(parts, F.lit(i + 1))) for i, n in enumerate(BACKFILLED[:-1])}
    readable = F.size(parts) >= 10
    for name in BACKFILLED[1:-1]:
        readable &= cells[name].isNull() | cells[name].try_cast("double").isNotNull()
    values = {n: F.when(readable, c if n == "SYMBOL" else c.try_cast("double")) for n, c in cells.items()}
    values["MAX"] = F.greatest(*(values[n] for n in BACKFILLED[1:5]))
    anchor = next((a for a in ANCHORS if a in df.columns), df.columns[-1])
    at = df.columns.index(anchor) + 1
    return df.select(*df.columns[:at], *(values[n].alias(prefix + n) for n in BACKFILLED), *df.columns[at:])
