"""Upstream reading frames against a loop over single variants."""

import random

from pyspark.sql import functions as F

from varlake.operators import utr
from varlake.sources import scans

STOPS = ("TAA", "TAG", "TGA")
PAIR = str.maketrans("ACGT", "TGCA")


def stop_after(seq, start):
    return next((i for i in range(start, len(seq) - 2, 3) if seq[i : i + 3] in STOPS), None)


def starts(seq):
    return [i for i in range(len(seq) - 2) if seq[i : i + 3] == "ATG"]


def context(seq, s):
    if s < 3 or s + 3 >= len(seq):
        return "KozakContext=-:KozakStrength="
    word = seq[s - 3 : s + 4]
    return f"KozakContext={word}:KozakStrength={('Weak', 'Moderate', 'Strong')[(word[0] in 'AG') + (word[-1] == 'G')]}"


def sort(stop, distance, same="InFrame_oORF"):
    return "uORF" if stop is not None else "OutOfFrame_oORF" if distance % 3 else same


def na(x):
    return "NA" if x is None else x


def effect(strand, pieces, seq, cds, pos, ref, alt):
    """consequence and annotation of one variant."""
    path = [p for a, b in sorted(pieces) for p in range(a, b + 1)]
    path = path if strand > 0 else path[::-1]
    ref, alt = ref.replace("-", ""), alt.replace("-", "")
    if strand < 0:
        alt = alt[::-1].translate(PAIR)
    n = len(ref)
    first, last = (pos, pos + n - 1) if strand > 0 else (pos + n - 1, pos)
    last = first if n == 0 else last
    if first not in path or last not in path:
        return "-", "-"
    b, e = path.index(first), path.index(last)
    new = seq[:b] + alt + seq[b + n :]
    found = {t: [] for t in (utr.GAINED, utr.LOST, utr.STOP_GAINED, utr.STOP_LOST, utr.FRAMESHIFT)}
    fresh = [i for i in starts(new) if i >= b - 2 and i + 2 <= b + n + 1]
    if fresh:
        g = fresh[0]
        far = stop_after(new + cds, g)
        found[utr.GAINED].append(f"CapDistanceToStart={g}:DistanceToCDS={len(new) - g}:DistanceToStop={na(far and far - g)}:{context(new, g)}:type={sort(stop_after(new, g), len(new) - g, 'inFrame_oORF')}")
    for s in starts(seq):
        stop, far, now = stop_after(seq, s), stop_after(seq + cds, s), stop_after(new, s)
        border = len(seq) - 1 if stop is None else stop - 1
        type_, known = sort(stop, len(seq) - s), f"Evidence=NA:{context(seq, s)}"
        if s <= b <= s + 2 and (not alt or new[s : s + 3] != "ATG"):
            found[utr.LOST].append(f"CapDistanceToStart={s}:DistanceToCDS={len(seq) - s}:DistanceToStop={na(far and far - s)}:{known}:type={type_}")
        if n == len(alt) and b >= s + 3 and e <= border and now is not None and now < border:
            found[utr.STOP_GAINED].append(f"{known}:newSTOPDistanceToCDS={len(new) - now}:ref_StartDistanceToCDS={len(seq) - s}:ref_type={type_}")
        if stop is not None and b <= stop + 2 and b + n - 1 >= stop and (not alt or new[stop : stop + 3] not in STOPS):
            found[utr.STOP_LOST].append(f"AltStop={now is not None}:AltStopDistanceToCDS={na(None if now is None else len(new) - now)}:Evidence=NA:FrameWithCDS={'outOfFrame' if (len(new) - s) % 3 else 'inFrame'}:{context(seq, s)}")
        if n != len(alt) and b >= s + 3 and e <= border and abs(n - len(alt)) % 3:
            later = stop_after(new + cds, s)
            found[utr.FRAMESHIFT].append(f"{known}:alt_type={sort(now, len(new) - s)}:alt_type_length={na(None if later is None else later - s + 3)}:ref_StartDistanceToCDS={len(seq) - s}:ref_type={type_}:ref_type_length={na(None if far is None else far - s + 3)}")
    entries = [f"consequence={t}:{x}" for t, xs in found.items() for x in xs]
    return ",".join(t for t, xs in found.items() if xs) or "-", ",".join(entries) or "-"


def test_uorf_effect(spark):
    rng = random.Random(21)
    contigs, transcripts, variants, expected = [], [], [], {}
    for t in range(40):
        contig = "".join(rng.choice(["A", "C", "G", "T", "ATG", "TGA", "TAA"]) for _ in range(300))
        pieces, at = [], rng.randint(1, 20)
        for _ in range(rng.randint(1, 4)):
            pieces.append((at, at + rng.randint(0, 60)))
            at = pieces[-1][1] + rng.randint(1, 30)
        strand, cds = rng.choice([1, -1]), "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 5, 80])))
        seq = "".join(contig[a - 1 : b] for a, b in pieces)
        seq = seq if strand > 0 else seq[::-1].translate(PAIR)
        contigs.append((t, contig))
        transcripts.append((t, t, strand, [{"start": a, "end": b} for a, b in rng.sample(pieces, len(pieces))], cds or None))
        for k in range(40):
            pos = rng.choice([rng.randint(1, at), rng.choice(pieces)[rng.randint(0, 1)]])
            ref = rng.choice(["-", contig[pos - 1], contig[pos - 1 : pos + rng.randint(1, 5)]])
            alt = rng.choice(["-", "".join(rng.choice("ACGT") for _ in range(len(ref))), rng.choice(["A", "ATG", "TGA", "CATGC", "T"])])
            variants.append((f"{t}-{k}", t, pos, ref, alt))
            expected[f"{t}-{k}"] = (*effect(strand, pieces, seq, cds, pos, ref, alt), sum(stop_after(seq, s) is not None for s in starts(seq)))
    tiles = scans.sequence_tiles(spark.createDataFrame(contigs, "contig long, seq string"), 64)
    rows = spark.createDataFrame(transcripts, "transcript long, contig long, strand int, pieces array<struct<start: long, end: long>>, cds string")
    utrs = utr.spliced(rows.select("transcript", "contig", "strand", F.inline("pieces")), tiles, 64, ["transcript"]).select("transcript", F.col("seq").alias("utr"))
    frames = utr.reference_frames(rows.join(utrs, "transcript"))
    df = spark.createDataFrame(variants, "key string, transcript long, pos long, ref string, alt string").withColumn("orfs", F.lit("a clashing name"))
    got = {r.key: (r.utr5_consequence, r.utr5_annotation, r.existing_uORFs) for r in utr.uorf_effect(df, frames).collect()}
    assert got == expected
    assert {t for v in expected.values() for t in v[0].split(",")} == {"-", utr.GAINED, utr.LOST, utr.STOP_GAINED, utr.STOP_LOST, utr.FRAMESHIFT}


def test_uorf_edges(spark):
    transcript = [("T", "c", 1, [{"start": 1, "end": 10}, {"start": 21, "end": 24}], "CCCATGCCCATAGC", None)]
    rows = spark.createDataFrame(transcript, "transcript string, contig string, strand int, pieces array<struct<start: long, end: long>>, utr string, cds string")
    evidence = spark.createDataFrame([("c", 4), ("c", 4), ("c", 99)], "contig string, pos long")
    frames = utr.reference_frames(rows, evidence)
    assert [(o.start, o.stop, o.far, o.evidence) for o in frames.first().orfs] == [(3, None, None, "True")]
    variants = [("T", 5, "T", "A"), ("T", 12, "A", "C"), ("U", 5, "T", "A"), ("T", 1, "C" * 10, "-"), ("T", 21, "TAGC", "-"), (None, 5, "T", "A"), ("T", None, "T", "A")]
    df = spark.createDataFrame(variants, "transcript string, pos long, ref string, alt string")
    got = {(r.transcript, r.pos): (r.utr5_consequence, r.existing_OutOfFrame_oORFs) for r in utr.uorf_effect(df, frames).collect()}
    assert got == {("T", 5): (utr.LOST, 1), ("T", 12): ("-", 1), ("U", 5): (None, None), ("T", 1): ("-", 1), ("T", 21): (utr.FRAMESHIFT, 1), (None, 5): (None, None), ("T", None): ("-", 1)}
    covered = utr.uorf_effect(df.where("pos = 21"), frames, max_overlap=70).first()
    assert covered.utr5_consequence == "-"  # the second piece does not count, so the variant is outside
    assert utr.uorf_effect(df.limit(0), frames).count() == 0 and utr.reference_frames(rows.limit(0)).count() == 0


def test_spliced_without_a_tile(spark):
    tiles = spark.createDataFrame([(1, 0, "ACGTACGTAC"), (1, 2, "TTTTTTTTTT")], "contig long, tile long, seq string")
    pieces = spark.createDataFrame([("a", 1, 1, 3, 5), ("b", 1, -1, 8, 10), ("b", 1, -1, 21, 22), ("c", 1, 1, 9, 12)], "k string, contig long, strand int, start long, end long")
    assert sorted((r.k, r.seq) for r in utr.spliced(pieces, tiles, 10, ["k"]).collect()) == [("a", "GTA"), ("b", "AAGTA")]


def test_stops_are_found_without_lists(spark):
    """The first stop in frame is that of the list of all stops, and the effect of a variant needs neither lists nor generators."""
    random.seed(5)
    seqs = ["".join(random.choice("ACGTTAGAN") for _ in range(n)) for n in (0, 2, 3, 5, 40, 90, 200) for _ in range(4)]
    df = spark.createDataFrame([(s, i) for s in seqs for i in range(len(s))], "seq string, start int")
    got = df.select("seq", "start", utr.stop_after(F.col("seq"), F.col("start")).alias("stop"), utr.first_stop(utr.codons(F.col("seq"), "|".join(STOPS)), F.col("start")).alias("listed")).collect()
    assert all(r.stop == r.listed == stop_after(r.seq, r.start) for r in got) and any(r.stop is not None for r in got) and any(r.stop is None for r in got)
    frames = spark.createDataFrame([("t", "c", 1, [(1, 40)], "A" * 40, "C", [], 0, 0, 0)], "transcript string, contig string, strand int, pieces array<struct<start: bigint, end: bigint>>, utr string, cds string, orfs array<struct<start: int, stop: int, far: int, evidence: string>>, existing_uORFs int, existing_OutOfFrame_oORFs int, existing_InFrame_oORFs int")
    variants = spark.createDataFrame([("t", 5, "A", "ATG")], "transcript string, pos long, ref string, alt string")
    plan = utr.uorf_effect(variants, frames)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "split(" not in plan
