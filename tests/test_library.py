"""Operators on small frames, with the cases that queries over the tables do not reach."""

import pytest
from pyspark.sql import functions as F

from varlake.functions import values as V
from varlake.operators import family, joins, rows, scores, splicing, status
from varlake.sources import scans, sinks


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("text", "offset"), [("ENST1:c.100+5A>G", 5), ("c.-45+3del", 3), ("c.*12-2A>T", -2), ("c.99_100+2del", 2), ("n.123+5A>C", 5), ("c.100A>G", 0)])
def test_intron_offset(spark, text, offset):
    assert one(spark, text, V.intron_offset) == offset


@pytest.mark.parametrize(("raw", "state"), [("0/0", "hom_ref"), ("0|1", "het"), ("1/0", "alt_plus_other_allele"), ("1|0", "het"), ("1/2", "multiallelic_other"), ("1/1", "hom_alt"), ("./.", "no_call"), ("./1", "partial_no_call"), ("0", "haploid_ref"), ("2", "haploid_alt"), (None, "no_call"), (".", "no_call")])
def test_genotype_status(spark, raw, state):
    assert one(spark, raw, family.genotype_status) == state


@pytest.mark.parametrize(("text", "ms"), [("1d 2h 3m 4.5s", 93784500), ("12ms", 12), ("-", None), ("3m", 180000)])
def test_duration(spark, text, ms):
    assert one(spark, text, V.duration_ms) == ms


def test_frequency(spark):
    df = spark.createDataFrame([("0.1", "0.2"), (None, "0.3"), ("7", None), (".", "."), (None, "0")], f"{status.GRPMAX} string, {status.JOINT} string")
    got = [(r.POPULATION_AF, r.POPULATION_AF_STATUS) for r in status.resolve_population_af(df).collect()]
    assert got == [(0.1, "available_frequency"), (0.3, "available_frequency"), (None, "invalid_frequency"), (None, "absent_from_gnomad"), (0.0, "available_frequency")]
    with pytest.raises(ValueError):
        status.filter_frequency(df, 0.1, "nope")


def test_low_gq_and_samples(spark):
    df = spark.createDataFrame([("0/1", 5, "0/0"), ("0/0", 40, "0/0"), (None, 40, "")], "GT_A string, GQ_A int, GT_B string")
    assert [r.GT_A for r in rows.tag_low_gq(df).collect()] == ["0/1_LOWQUAL", "0/0", None]
    assert rows.select_samples(df, ["GT_A", "GT_B"]).count() == 2


def test_cache_seed_refuses_conflicts(spark):
    cache = spark.createDataFrame([("1", 1, "A", "C", 0.5)], "CHROM string, POS long, REF string, ALT string, score double")
    with pytest.raises(ValueError):
        joins.cache_seed(cache.withColumn("score", F.lit(0.6)), cache)
    assert joins.cache_seed(cache, cache).count() == 0


def test_constraint_refuses_repeats(spark):
    table = spark.createDataFrame([("ENSG1", 0.9, 0.1, 1.0)] * 2, "gene_id string, pLI double, LOEUF double, mis_z double")
    with pytest.raises(ValueError):
        scores.gene_constraint(spark.createDataFrame([("ENSG1",)], "Gene string"), table)


def test_unify_parts(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, t string"), spark.createDataFrame([(0.5, "y", True)], "n double, t string, k boolean")
    out = sinks.unify_parts([a, b])
    assert dict(out.dtypes) == {"n": "double", "t": "string", "k": "boolean"} and out.count() == 2
    with pytest.raises(ValueError):
        sinks.unify_parts([a, b.select("t", "n")])


def test_segments(spark, tmp_path):
    df = spark.createDataFrame([("1", 1, 0.5)], "CHROM string, POS long, score double")
    sinks.append_segment(df, str(tmp_path), "v1", "s1")
    manifest = spark.read.parquet(f"{tmp_path}/manifest")
    assert manifest.first().n_records == 1
    stored = df.withColumn("segment", F.lit("s1"))
    assert sinks.valid_segments(stored, manifest).count() == 1
    assert sinks.valid_segments(stored.union(stored), manifest).count() == 0


def test_intron_chain(spark):
    df = spark.createDataFrame([([(1, 5), (9, 12), (20, 30)],), ([(3, 5), (9, 12), (20, 25)],), ([(4, 9)],)], "e array<struct<start:int,end:int>>")
    keys = [r.k for r in df.select(joins.transcript_key(F.col("e")).alias("k")).collect()]
    assert keys[0] == keys[1] != keys[2] == "4-9"


def test_pedigree(spark):
    lines = spark.createDataFrame([("FamilyID IndividualID PaternalID MaternalID Sex Phenotype",), ("#c 1 2 3 4 5",), ("F1\tS1\tS2\tS3\t1\t2",)], "value string")
    assert [tuple(r) for r in family.read_pedigree(lines).collect()] == [("F1", "S1", "S2", "S3", 1, 2)]
    assert family.parse_relations("a:child,b:father") == {"a": "child", "b": "father"}


def test_columns_of_consequences():
    assert scans.match_columns(["SYMBOL", "_AF", "AF", "AF.2", "AFX"], ["AF"]) == ["_AF", "AF", "AF.2"]
    assert scans.choose_samples(["S1", "S2", "T1"], ["S"]) == ["S1", "S2"]


def test_splicevault_strand(spark):
    df = spark.createDataFrame([("1:CD:5:30:", "100", "-1"), (None, "7", "1"), (".", None, "1")], "SpliceVault_top_events string, SpliceVault_site_pos string, STRAND string")
    got = splicing.splicevault_decode(df).collect()
    assert "(pos:95)" in got[0].SpliceVault_Predictions_Decoded and [r.SpliceVault_status for r in got] == ["aberrant_event_detected", "no_events_found", "not_covered"]


def test_spip_by_either_accession(spark):
    def entry(nm, score, gene):
        return f"G|NTR|x|y|{score}" + "|" * 7 + f"{nm}|{gene}" + "|" * 13

    raw = "&".join([entry("NM_1.2", 0.3, "G1"), entry("NM_2.1", 0.5, "G1"), entry("NM_3.1", 0.9, "G2")])
    rows_ = [(1, raw, "ENST1.1", None, "NM_2.9", "chr1:1-A-G", "G1", "E1"), (2, raw, "ENST1.1", "NM_1.1", "NM_2.9", "chr1:1-A-G", "G1", "E1"), (3, raw, "ENST1.1", None, None, "chr1:1-A-G", "G1", "E1"), (4, None, "ENST1.1", None, None, "chr1:1-A-G", "G1", "E1")]
    df = spark.createDataFrame(rows_, "k int, SPiP string, Feature string, MANE_SELECT string, MANE_PLUS_CLINICAL string, Locus string, SYMBOL string, Gene string")
    none = spark.createDataFrame([], "enst string, spip_nm string"), spark.createDataFrame([], "symbol string, ensg string")
    got = {r.k: (r.SPiP_match, r.SPiP_prediction, r.SPiP_samegene_n_transcripts, r.SPiP_samegene_transcript) for r in splicing.spip_unpack(df, *none).collect()}
    assert got == {1: ("matched", 0.5, 2, "NM_2"), 2: ("matched", 0.3, 2, "NM_2"), 3: ("not_applicable_transcript", None, 2, "NM_2"), 4: ("no_prediction", None, 0, None)}


def test_input_columns_and_genotypes(spark):
    from varlake.operators import checks
    from varlake.sources import tables

    assert tables.find_columns(["Gene", "HGVS", "pos"]) == {"cdna": "HGVS", "ids": None}
    assert tables.find_columns(["CHR", "Start", "Reference", "alt"])["ids"] == ["CHR", "Start", "Reference", "alt"]
    assert tables.find_columns(["x", "Locus"])["ids"] == ["Locus"] and tables.find_columns(["x"])["ids"] is None
    df = spark.createDataFrame([([], ["GT"]), (["a"], ["DP"]), (["a"], ["GT"]), (["a", "b", "a"], ["GT"]), (None, None)], "s array<string>, f array<string>")
    got = [(r.m, r.d) for r in df.select(checks.genotype_mode(F.col("s"), F.col("f")).alias("m"), checks.repeated_names(F.col("s")).alias("d")).collect()]
    assert got == [("no_samples", []), ("samples_without_GT", []), ("single_sample", []), ("multi_sample", ["a"]), ("no_samples", None)]


def test_stamp_and_scan(spark, tmp_path):
    from varlake.sources import tables

    df = tables.with_stamp(spark.createDataFrame([("1", "x", ".", "True")], "a string, b string, c string, d string"), {"b": 1, "a": "x"})
    sinks.save_table(df, f"{tmp_path}/t.parquet")
    assert tables.read_stamp(tables.scan_table(spark, f"{tmp_path}/t.parquet")) == {"a": "x", "b": 1} and tables.read_stamp(spark.range(1)) is None
    sinks.save_table(df, f"{tmp_path}/t.tsv")
    assert dict(tables.scan_table(spark, f"{tmp_path}/t.tsv").dtypes) == {"a": "bigint", "b": "string", "c": "string", "d": "boolean"}
    with pytest.raises(ValueError):
        tables.scan_table(spark, "x.feather")


def test_kinds_of_odd_numbers(spark):
    """Casts decide what a number is; only texts that no cast can read are told by their look."""
    texts = ["1", "-7", "+3", " 4 ", "\t5\n", "9223372036854775808", "1.", ".5", "1e3", "1.5E-3", "2d", "3F", "0x1p3", "NaN", "-inf", "Infinity", "-", "+", "e5", "1-2", "1_0", "chr1", "G1", "1 2", "0x", "", "--1", "1.2.3", "١", "1L"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    read = {r.x: "int" if r.n is not None else "float" if r.d is not None else "str" for r in df.select("x", F.col("x").try_cast("long").alias("n"), F.col("x").try_cast("double").alias("d")).collect()}
    wide = spark.createDataFrame([tuple(texts)], ", ".join(f"c{i} string" for i in range(len(texts))))
    assert {r.column: r.kind for r in scans.whole_file_kinds(wide).collect()} == {f"c{i}": read[t] for i, t in enumerate(texts)}
    assert list(read.values()).count("str") > 10 and list(read.values()).count("int") == 5


def test_no_cast_of_texts_that_are_no_numbers(spark):
    plan = scans.whole_file_kinds(spark.createDataFrame([("chr1",)], "x string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == plan.count("RLIKE") == 2


def test_formats_are_made_once(spark):
    lines = spark.createDataFrame([("1\t5\tr1\tA\tC\t.\tPASS\tDB\tGT:GQ:DP\t0/1:7:.\t0/0",), ("1\t6\tr2\tA\tC\t.\tPASS\tDB\tGT:GQ:DP\t0/0:7:.\t./.",)], "value string")
    found = scans.sample_format_columns(scans.vcf_records(lines, ["S0", "S1"]), ["S0", "S1"])
    assert [(r.ID, r.GT_S0, r.GQ_S0, r.GT_S1, r.GQ_S1, r.FORMAT_S1["DP"]) for r in found.collect()] == [("r1", "0/1", "7", "0/0", ".", ".")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("map_from_entries") == 2


def test_key_values_of_repeats(spark):
    """Of a repeated key the last counts; the items are made once, not again for each of them."""
    assert one(spark, "a=1: b = 2:c:a=x=3:d=", V.key_values) == {"b": "2", "a": "3", "d": ""}
    assert one(spark, None, V.key_values) is None and one(spark, "a", V.key_values) == {}
    plan = spark.createDataFrame([("a=1",)], "x string").select(V.key_values(F.col("x")).alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_cache_seed_works_out_once(spark):
    cache = spark.createDataFrame([("1", 1, "A", "C", 0.5), ("1", 1, "A", "C", 0.5), (None, 2, "A", "C", 0.1)], "CHROM string, POS long, REF string, ALT string, score double")
    made = spark.createDataFrame([("1", 1, "A", "C", 0.5), ("1", 3, "A", "C", None), (None, 2, "A", "C", 0.1)], cache.schema)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    got = joins.cache_seed(made.mapInArrow(count, made.schema), cache)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [("1", 3, "A", "C", None), (None, 2, "A", "C", 0.1)]
    assert got.columns == made.columns and seen.value == made.count()


def test_segments_are_not_dealt_out(spark, tmp_path):
    df = spark.createDataFrame([("1", n, 0.5) for n in range(50)], "CHROM string, POS long, score double")
    sinks.append_segment(df, str(tmp_path), "v1", "s1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # a table that is too large for it
    try:
        found = sinks.valid_segments(spark.read.parquet(f"{tmp_path}/version=v1"), spark.read.parquet(f"{tmp_path}/manifest").drop("version"))
        assert found.count() == 50
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert "BroadcastHashJoin [segment" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbers_as_text(spark):
    for value, digits in ((0.5, 0), (0.125, 2), (-0.04, 1), (-0.0, 1), (2.5, 1), (-97.25, 1), (1e20, 1), (1e40, 1), (float("nan"), 2), (float("inf"), 1), (0.00005, 4), (123456.785, 2)):
        same = lambda x: F.format_string(f"%.{digits}f", F.bround(x, digits))  # noqa: E731, B023
        assert one(spark, value, lambda x: V.fixed_text(x, digits), "double") == one(spark, value, same, "double")  # noqa: B023
    assert one(spark, None, lambda x: V.fixed_text(x, 1), "double") is None


def test_listed_numbers(spark):
    """The sign for none is null without a cast, in lists and packed entries alike."""
    assert one(spark, "0.5&.&x&-1&nan", lambda x: V.numbers(F.split(x, "&"))) == [0.5, -1.0]
    assert [one(spark, t, V.listed_number) for t in ("0.25", ".", "", None, "bad")] == [0.25, None, None, None, None]
    plan = spark.createDataFrame([(".",)], "x string").select(V.numbers(F.split("x", "&")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT" in plan


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_do_not_repeat_the_impact(spark):
    """The filter on NEW_IMPACT reads the column; it does not hold all that the impact is made of once more."""
    from varlake.plans.pipeline import prioritise

    df = spark.createDataFrame([("chr1", 5, "A", "C", "LOW", "missense_variant", 0.001, 0.3, 0.1)], f"CHROM string, POS long, REF string, ALT string, IMPACT string, Consequence string, {status.GRPMAX} double, spliceAI_MAX double, Pangolin_max_score double")
    done = prioritise(df, below=0.01, impacts=["HIGH", "MODERATE"]).select("NEW_IMPACT", "PRIORITY_TIER")
    assert [r.NEW_IMPACT for r in done.collect()] == ["MODERATE"]
    filters = [line for line in optimized(done).split("\n") if "Filter" in line and "NEW_IMPACT" in line or "Filter" in line and "MODERATE" in line]
    assert filters and not any("Pangolin" in line for line in filters)


def test_numbers_are_not_written_to_be_read(spark):
    """Doubles and integers say the same as their texts do, also where they are no numbers, and are not cast to texts."""
    nan = float("nan")
    cells = [(29.5, None, 60, nan, "PASS"), (None, None, None, None, None), (nan, 2.0, 60, 40.0, "."), (30.0, 1.9, 0, 39.9, " q10 ")]
    numbers = spark.createDataFrame(cells, "QUAL double, QD double, FS int, MQ double, FILTER string")
    texts = numbers.select(*(F.col(c).cast("string").alias(c) for c in numbers.columns))
    got, want = ([(r.QC_STATUS, r.QC_DETAIL) for r in rows.qc_status(df).collect()] for df in (numbers, texts))
    assert got == want and [s for s, _ in got] == ["LOW_QUAL", "UNSCORED", "PASS", "LOW_QUAL"]
    values = [(0.5, None), (nan, 0.25), (None, None), (7.0, nan), (None, 0.0)]
    numbers = spark.createDataFrame(values, f"{status.GRPMAX} double, {status.JOINT} double")
    texts = numbers.select(*(F.col(c).cast("string").alias(c) for c in numbers.columns))
    states = [[tuple(r)[-3:] for r in status.resolve_population_af(df).collect()] for df in (numbers, texts)]
    assert states[0] == states[1]
    assert "as string" not in optimized(status.resolve_population_af(numbers))


def test_terms_and_events_without_patterns(spark):
    df = spark.createDataFrame([("frameshift_variant", "Likely_pathogenic"), ("splice_donor_variant", "not pathogenicity"), ("x", "Benign|Conflicting"), (None, None)], "Consequence string, CLINVAR_SELECTED_CLNSIG string")
    terms = scores._terms(df)
    assert [tuple(r) for r in terms.select("__lof", "__functional", "__pathogenic", "__benign").collect()] == [(True, True, True, False), (True, True, False, False), (False, False, False, False), (False, False, False, False)]
    assert "stop_gained|frameshift" not in optimized(terms)
    for text, state in (("1:CD:1", "aberrant_event_detected"), (" ,&..", "aberrant_event_detected"), (", .&", "not_covered"), (".", "not_covered"), ("", "not_covered"), (None, "not_covered")):
        assert splicing.splicevault_decode(spark.createDataFrame([(text,)], "SpliceVault_top_events string")).first().SpliceVault_status == state
    for text, score in (("G|1:0.5|-4:-0.75&H|1:0.9", 0.75), ("G|1:2:0.5|3:nan|bad|4:1.5", None), ("G|1:1", 1.0), ("G|1:x|2:0.1,", 0.1)):
        assert splicing.pangolin_unpack(spark.createDataFrame([(text, "G.1")], "Pangolin string, Gene string")).first().Pangolin_max_score == score
