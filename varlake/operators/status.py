"""Status columns: what each annotation says for a row, and why it says nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varlake.functions.values import MISSING_CLINVAR, MISSING_FREQUENCY, by_value, exact_number, has_word, known, number, numbers, strip_version, true

GRPMAX, JOINT, AN_JOINT = "gnomADv4_AF_grpmax_joint", "gnomADv4_AF_joint", "gnomADv4_AN_joint"
ABSENT = "absent_from_gnomad"
# ClinVar columns in order of preference, each with its review column.
CLINVAR_SOURCES = (("ClinVarVCF_CLNSIG", "ClinVarVCF_CLNREVSTAT"), ("clinvar_clnsig", "clinvar_review"), ("CLIN_SIG", None), ("CLNSIG", "CLNREVSTAT"), ("ClinicalSignificance", None), ("ClinVar", None), ("clinvar", None), ("CLINVAR_DISPLAY", None))
# Review stars.
REVIEW_STARS = {"practice guideline": 4, "reviewed by expert panel": 3, "criteria provided, multiple submitters, no conflicts": 2, "criteria provided, single submitter": 1, "criteria provided, conflicting classifications": 1, "criteria provided, conflicting interpretations": 1, "no assertion criteria provided": 0, "no assertion provided": 0, "no classification provided": 0}


def column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null where the table has none."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


def resolve_population_af(df: DataFrame, freq_col: str = GRPMAX) -> DataFrame:
    """POPULATION_AF, _SOURCE and _STATUS: grpmax, else joint; a custom column by itself. Values must lie in [0, 1]; an
    allele without a joint frequency and number is absent from the database, not zero."""
    names = [c for c in ((GRPMAX, JOINT) if freq_col == GRPMAX else (freq_col,)) if c in df.columns]
    # columns of their own are worked out once, however often they are used
    df = df.withColumns({f"__raw_{i}": F.col(c) if exact_number(df, c) else known(F.col(c), MISSING_FREQUENCY) for i, c in enumerate(names)})
    raw = {c: F.col(f"__raw_{i}") for i, c in enumerate(names)}
    df = df.withColumns({f"__number_{i}": number(raw[c]) for i, c in enumerate(names)})
    valid = {c: F.when(F.col(f"__number_{i}").between(0, 1), F.col(f"__number_{i}")) for i, c in enumerate(names)}
    invalid = reduce(lambda a, b: a | b, [raw[c].isNotNull() & valid[c].isNull() for c in names], F.lit(False))
    af = F.coalesce(*valid.values(), F.lit(None).cast("double"))
    status = F.when(af.isNotNull(), "available_frequency").when(invalid, "invalid_frequency")
    if freq_col in (GRPMAX, JOINT) and JOINT in df.columns:
        status = status.when((F.col(JOINT) if exact_number(df, JOINT) else known(F.col(JOINT), MISSING_FREQUENCY)).isNull() & known(column(df, AN_JOINT), MISSING_FREQUENCY).isNull(), ABSENT)
    source = reduce(lambda w, c: w.when(valid[c].isNotNull(), c), names, F.when(F.lit(False), ""))
    return df.withColumns({"POPULATION_AF": af, "POPULATION_AF_SOURCE": source.otherwise(""), "POPULATION_AF_STATUS": status.otherwise("missing_frequency")}).drop(*(f"__{k}_{i}" for k in ("raw", "number") for i in range(len(names))))


def rarity() -> Column:
    """The frequency for thresholds: an absent allele was seen no time."""
    return F.when(F.col("POPULATION_AF_STATUS") == ABSENT, F.lit(0.0)).otherwise(F.col("POPULATION_AF"))


def filter_frequency(df: DataFrame, below: float, freq_col: str = GRPMAX) -> DataFrame:
    """Rows rarer than that, or of unknown frequency. A table without the column is an error."""
    if not any(c in df.columns for c in ((GRPMAX, JOINT) if freq_col == GRPMAX else (freq_col,))):
        raise ValueError(f"no frequency column {freq_col}")
    out = resolve_population_af(df, freq_col)
    return out.where(rarity().isNull() | (rarity() < below))


def review_stars(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(F.replace(F.replace(F.lower(text), F.lit("_"), F.lit(" ")), F.lit("&"), F.lit(",")), "\\s+", " ")), ",\\s*", ", "), "\\s+$", "")
    stars = F.create_map(*(F.lit(x) for kv in REVIEW_STARS.items() for x in kv))
    return F.try_element_at(stars, plain).cast("double")


def resolve_clinvar(df: DataFrame) -> DataFrame:
    """__clinvar: classification, source, review and stars from the first source that has a classification; review and stars never come from another."""
    inputs = [c for pair in CLINVAR_SOURCES for c in pair if c in df.columns] + ["ClinVar_Stars"]
    return by_value(df, inputs, _resolve_clinvar)


def _resolve_clinvar(df: DataFrame) -> DataFrame:
    found = []
    for rank, (name, review) in enumerate(CLINVAR_SOURCES):
        if name not in df.columns:
            continue
        text = known(F.when(~F.lower(F.trim(F.col(name))).isin(*MISSING_CLINVAR), F.col(name)), ("",))
        own = known(F.when(~F.lower(F.trim(F.col(review))).isin(*MISSING_CLINVAR), F.col(review)), ("",)) if review in df.columns else F.lit(None).cast("string")
        stars = review_stars(own) if review in df.columns else F.lit(None).cast("double")
        if review not in df.columns and rank > 2 and "ClinVar_Stars" in df.columns:
            given = number(F.col("ClinVar_Stars"))
            stars = F.when(given.isin(0, 1, 2, 3, 4), given)
        found.append(F.when(text.isNotNull(), F.struct(F.lit(rank).alias("rank"), text.alias("sig"), F.lit(name).alias("source"), F.coalesce(own, F.lit("")).alias("review"), stars.alias("stars"))))
    best = F.coalesce(*found) if found else F.lit(None).cast("struct<rank:int,sig:string,source:string,review:string,stars:double>")
    return df.withColumn("__clinvar", best)


def best_source_per_variant(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows of a variant whose source is worse than the variant's best take over that row's values; of rows of one rank the first
    in the order of the columns given counts."""
    best = F.min(F.when(F.col("__clinvar").isNotNull(), F.struct(F.col("__clinvar.rank").alias("rank"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.col("__clinvar").alias("own")))).over(W.partitionBy("Locus"))
    better = F.coalesce(best["rank"] < F.coalesce(F.col("__clinvar.rank"), F.lit(len(CLINVAR_SOURCES))), F.lit(False))
    return df.withColumn("__clinvar", F.when(better, best["own"]).otherwise(F.col("__clinvar")))


def annotate_clinvar(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """CLINVAR_SELECTED_CLNSIG, CLINVAR_SOURCE, CLINVAR_SELECTED_REVIEW, ClinVar_Stars; shared over a variant's rows if there is a Locus and an order."""
    out = resolve_clinvar(df)
    if order and "Locus" in df.columns:
        out = best_source_per_variant(out, order)
    texts = {"CLINVAR_SELECTED_CLNSIG": "sig", "CLINVAR_SOURCE": "source", "CLINVAR_SELECTED_REVIEW": "review"}
    return out.withColumns({k: F.coalesce(F.col(f"__clinvar.{v}"), F.lit("")) for k, v in texts.items()} | {"ClinVar_Stars": F.col("__clinvar.stars")}).drop("__clinvar")


def clinvar_masks(sig: Column) -> tuple[Column, Column]:
    """(pathogenic, benign): one of the tokens says so and nothing conflicts."""
    plain = F.replace(F.lower(sig), F.lit("_"), F.lit(" "))
    # a text without the word needs no pattern
    pathogenic, benign = (true(F.contains(plain, F.lit(word)) & plain.rlike(f"(?:^|[&/|;,]) *(?:likely )?{word} *(?:[&/|;,]|$)")) for word in ("pathogenic", "benign"))
    conflict = true(has_word(plain, "conflicting|uncertain significance")) | (pathogenic & benign)
    return pathogenic & ~conflict, benign & ~conflict


def nmd_status(df: DataFrame) -> DataFrame:
    consequence = F.coalesce(column(df, "Consequence"), F.lit(""))
    truncating = consequence.rlike("stop_gained|frameshift_variant")
    scope = truncating | consequence.rlike("splice_donor_variant|splice_acceptor_variant")
    if "NMD" not in df.columns:
        return df.withColumn("NMD_STATUS", F.when(scope, "not_annotated").otherwise("not_applicable"))
    cds = F.trim(F.coalesce(column(df, "CDS_position"), F.lit("")))
    placed = ~cds.isin("", "-", ".", "nan") & ~F.contains(cds, F.lit("?"))
    escape = true(F.contains(F.col("NMD"), F.lit("NMD_escaping_variant")))
    return df.withColumn("NMD_STATUS", F.when(scope & escape, "escape_predicted").when(truncating & placed, "nmd_predicted").when(scope, "not_evaluated").otherwise("not_applicable"))


def snv_track_status(df: DataFrame, raw: list[str], out: list[str], status: str) -> DataFrame:
    """Scores that only single-base changes have: numbers and scored / not_covered / not_applicable / error, or not_annotated without the column."""
    if raw[0] not in df.columns or "VARIANT_CLASS" not in df.columns:
        return df.withColumns({o: F.lit(None).cast("double") for o in out} | {status: F.lit("not_annotated")})
    snv = F.coalesce(F.col("VARIANT_CLASS"), F.lit("")) == "SNV"
    text = {r: known(column(df, r), ("", ".", "-", "nan")) for r in raw}
    bad = reduce(lambda a, b: a | b, [text[r].isNotNull() & number(text[r]).isNull() for r in raw])
    state = F.when(~snv, "not_applicable").when(bad, "error").when(number(text[raw[0]]).isNull(), "not_covered").otherwise("scored")
    return df.withColumns({o: F.when(snv & ~bad, number(text[r])) for r, o in zip(raw, out)} | {status: state})


def remm_status(df: DataFrame) -> DataFrame:
    return snv_track_status(df, ["ReMM"], ["ReMM_score"], "ReMM_status")


def avi_status(df: DataFrame) -> DataFrame:
    return snv_track_status(df, ["AVI_PHRED", "AVI_RAW"], ["AVI_PHRED", "AVI_RAW"], "AVI_status")


def missense_max(df: DataFrame, columns: list[str]) -> DataFrame:
    """The largest readable number of & lists."""
    return df.withColumns({c: F.array_max(numbers(F.split(F.col(c).cast("string"), "&"))) for c in columns if c in df.columns})


def aligned_list_pick(df: DataFrame, aligned: list[str], numeric: list[str], ids: str = "Ensembl_transcriptid") -> DataFrame:
    """Of lists that run along the transcript list, the element of the row's own transcript; dbNSFP_match says what happened.
    A single value holds for all. numeric columns also get the maximum over all transcripts."""
    missing = F.col(ids).isNull() | F.col(ids).isin(".", "")
    listed = F.transform(F.split(ids, "&"), lambda x: strip_version(x))
    place = F.nullif(F.array_position(listed, strip_version(F.col("Feature"))), F.lit(0).cast("long"))
    cells, most, bent = {}, {}, []
    for c in (c for c in aligned if c in df.columns):
        items = F.split(F.col(c).cast("string"), "&")
        same, single = F.size(items) == F.size(listed), F.size(items) == 1
        value = F.when(same, F.try_element_at(items, place.cast("int"))).when(single, F.element_at(items, 1))
        cells[c] = F.when(missing, F.col(c).cast("string")).when(place.isNotNull() & (value != "."), value)
        bent.append(true(~same & ~single))
        if c in numeric:
            most[f"{c}_anytranscript_max"] = F.when(~missing & F.col("Feature").isNotNull(), F.array_max(numbers(items)))
    state = F.when(missing, "no_prediction").when(F.col("Feature").isNull(), "no_row_transcript").when(place.isNull(), "no_entry_for_row_transcript")
    state = state.when(reduce(lambda a, b: a | b, bent, F.lit(False)), "misaligned_list").otherwise("matched_transcript")
    return df.withColumns(cells | most | {"dbNSFP_match": state, "dbNSFP_transcripts_all": F.when(~missing, F.col(ids))})


def utr5_status(df: DataFrame, consequence: str = "5UTR_consequence", annotation: str = "5UTR_annotation") -> DataFrame:
    """UTRAnnotator_status: the worst class of the row's uORF effects (high_impact > unclassified > other), each graded by its
    own term; else no_uorf_effect, not_evaluated or not_applicable."""
    if consequence not in df.columns:
        return df.withColumn("UTRAnnotator_status", F.lit("not_annotated"))
    marked = df.withColumn("__counted", column(df, "Existing_uORFs").isNotNull())
    done = by_value(marked, [consequence, annotation, "Consequence", "__counted"], lambda rows: _utr5_status(rows, consequence, annotation))
    return done.drop("__counted")


def _utr5_status(df: DataFrame, consequence: str, annotation: str) -> DataFrame:
    text = F.trim(F.coalesce(F.col(f"`{consequence}`"), F.lit("")))
    entries = F.filter(F.split(F.coalesce(column(df, annotation), F.lit("")), "[&,]"), lambda e: F.contains(e, F.lit("=")))
    terms = F.filter(F.transform(F.split(F.lower(text), "[&,]"), lambda t: F.trim(t)), lambda t: t != "")
    df = df.withColumns({"__text": text, "__entries": entries, "__terms": terms})
    text, entries, terms = F.col("__text"), F.col("__entries"), F.col("__terms")
    linked = F.exists(entries, lambda e: e.rlike("(?:^|:)\\s*consequence\\s*="))

    def get(e: Column, key: str) -> Column:
        return F.lower(F.trim(F.regexp_extract(e, f"(?:^|:)\\s*{key}\\s*=([^:]*)", 1)))

    def started(e: Column) -> Column:
        strong, weak = get(e, "KozakStrength").isin("strong", "moderate") | (get(e, "Evidence") == "true"), (get(e, "KozakStrength") == "weak") & (get(e, "Evidence") == "false")
        return F.when(strong, "high_impact").when(weak, "other").otherwise("unclassified")

    overlapping = ("inframe_oorf", "outofframe_oorf")

    def grade(t: Column, e: Column) -> Column:
        gain = F.when(~get(e, "type").isin(*overlapping), F.when(get(e, "type") != "", "other").otherwise("unclassified"))
        gain = gain.when(get(e, "KozakStrength").isin("strong", "moderate"), "high_impact").when(get(e, "KozakStrength") == "weak", "other").otherwise("unclassified")
        loss = F.when(get(e, "AltStop") == "true", "other").when(get(e, "AltStop") != "false", "unclassified").otherwise(started(e))
        shift = F.when((get(e, "ref_type") == "") | (get(e, "alt_type") == ""), "unclassified").when(get(e, "ref_type").isin(*overlapping) | ~get(e, "alt_type").isin(*overlapping), "other").otherwise(started(e))
        return F.when(F.contains(t, F.lit("premature_start_codon_gain")), gain).when(F.contains(t, F.lit("uorf_stop_codon_loss")), loss).when(F.contains(t, F.lit("uorf_frameshift")), shift).otherwise("unclassified")

    def classes(t: Column) -> Column:
        own = F.filter(entries, lambda e: ~linked | (get(e, "consequence") == t))
        graded = F.when(F.size(own) > 0, F.transform(own, lambda e: grade(t, e))).otherwise(F.array(F.lit("unclassified")))
        return F.when(F.contains(t, F.lit("premature_start_codon_loss")) | F.contains(t, F.lit("uorf_stop_codon_gain")), F.array(F.lit("other"))).otherwise(graded)

    all_ = F.col("__classes")
    worst = F.when(F.array_contains(all_, "high_impact"), "high_impact").when(F.array_contains(all_, "unclassified"), "unclassified").when(F.array_contains(all_, "other"), "other").otherwise("unclassified")
    utr5 = true(F.contains(column(df, "Consequence"), F.lit("5_prime_UTR_variant")))
    state = F.when(~text.isin("", "-", ".", "nan"), worst).when(utr5 & F.col("__counted"), "no_uorf_effect").when(utr5, "not_evaluated").otherwise("not_applicable")
    return df.withColumn("__classes", F.when(text != "", F.flatten(F.transform(terms, classes)))).withColumn("UTRAnnotator_status", state).drop("__classes", "__text", "__entries", "__terms")


def tag_transcript_tier(df: DataFrame, curated: DataFrame, mane: str = "MANE_SELECT") -> DataFrame:
    """TRANSCRIPT_PRIORITY_TIER: 1 for a curated transcript (ENST, versions ignored), 2 with a MANE transcript, 3 otherwise."""
    chosen = curated.select(strip_version(F.col("ENST")).alias("__enst")).distinct().withColumn("__curated", F.lit(True))
    out = df.withColumn("__enst", strip_version(F.col("Feature"))).join(chosen, "__enst", "left")
    return out.withColumn("TRANSCRIPT_PRIORITY_TIER", F.when(F.col("__curated"), 1).when(known(F.col(mane)).isNotNull(), 2).otherwise(3)).drop("__enst", "__curated")
