"""Upstream open reading frames: spliced 5'UTRs from sequence tiles, and what variants do to their start and stop codons.

Places in a 5'UTR count from 0 at its 5' end. What depends on the transcript alone (frames of the reference, known starts) is
made once for each transcript, before variants join it. All of it is expressions over arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.values import once, reverse_complement

# Consequence terms, in the order in which they are listed.
GAINED, LOST = "5_prime_UTR_premature_start_codon_gain_variant", "5_prime_UTR_premature_start_codon_loss_variant"
STOP_GAINED, STOP_LOST = "5_prime_UTR_uORF_stop_codon_gain_variant", "5_prime_UTR_uORF_stop_codon_loss_variant"
FRAMESHIFT = "5_prime_UTR_uORF_frameshift_variant"
START, STOPS = "ATG", ("TAA", "TAG", "TGA")

_PIECES = "array<struct<start: bigint, end: bigint>>"


def spliced(pieces: DataFrame, tiles: DataFrame, size: int, keys: list[str]) -> DataFrame:
    """keys, contig, strand and seq: pieces (keys, contig, strand 1 or -1, start, end; 1-based, inclusive) cut out of tiles (contig, tile, seq) of
    size bases and joined in the order of transcription. Keys of which a tile is missing are left out.

    A piece asks for the tiles that it touches, so a shuffle carries tiles and never contigs."""
    tile = lambda c: F.floor((F.col(c) - 1) / size)
    wanted = pieces.withColumn("tile", F.explode(F.sequence(tile("start"), tile("end"))))
    low = F.greatest(F.col("start") - F.col("tile") * size, F.lit(1))
    high = F.least(F.col("end") - F.col("tile") * size, F.lit(size))
    cut = F.substr("seq", low.cast("int"), (high - low + 1).cast("int"))
    found = wanted.join(tiles, ["contig", "tile"]).groupBy(*keys, "contig", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "tile", cut.alias("seq")))).alias("cuts"))
    asked = wanted.groupBy(*keys, "contig", "strand").agg(F.count("*").alias("asked"))
    whole = F.array_join(F.transform("cuts", lambda c: c["seq"]), "")
    out = found.join(asked, [*keys, "contig", "strand"]).where(F.size("cuts") == F.col("asked"))
    return out.select(*keys, "contig", "strand", F.when(F.col("strand") < 0, reverse_complement(whole)).otherwise(F.upper(whole)).alias("seq"))


def codons(seq: Column, pattern: str) -> Column:
    """Places of codons, of which none can overlap another. What stands between them is split off and added up."""
    parts = F.split(seq, pattern, -1)
    sizes = F.transform(F.slice(parts, 1, F.size(parts) - 1), F.length)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))
    return F.aggregate(sizes, empty, lambda a, n: F.struct((a["at"] + n + 3).alias("at"), F.concat(a["found"], F.array(a["at"] + n)).alias("found")), lambda a: a["found"])


def first_stop(stops: Column, start: Column) -> Column:
    """The first of stops in frame with start; null if there is none."""
    return F.array_min(F.filter(stops, lambda m: (m >= start) & ((m - start) % 3 == 0)))


def stop_after(seq: Column, start: Column) -> Column:
    """The first stop codon of a sequence in frame with start, as first_stop has it, found without a list of all stops."""
    until = F.regexp_extract(F.substr(seq, start + 1), f"(?s)^(?:...)*?(?:{'|'.join(STOPS)})", 0)
    return F.when(until != "", start + F.length(until) - 3)


def kozak(seq: Column, start: Column) -> Column:
    """context and strength of the start codon at a place: three bases before and one after it count."""
    first, last = F.substr(seq, start - 2, F.lit(1)), F.substr(seq, start + 4, F.lit(1))
    good = F.when(first.isin("A", "G"), 1).otherwise(0) + F.when(last == "G", 1).otherwise(0)
    has = (start >= 3) & (start + 3 < F.length(seq))
    strength = F.when(~has, "").when(good == 2, "Strong").when(good == 1, "Moderate").otherwise("Weak")
    return F.struct(F.when(has, F.concat(F.substr(seq, start - 2, F.lit(3)), F.lit(START), last)).otherwise("-").alias("context"), strength.alias("strength"))


def kind(inside: Column, distance: Column, in_frame: str = "InFrame_oORF") -> Column:
    """uORF if the stop is inside the 5'UTR, else by the frame of the coding sequence."""
    return F.when(inside, "uORF").when(distance % 3 != 0, "OutOfFrame_oORF").otherwise(in_frame)


def place(pieces: Column, strand: Column, pos: Column) -> Column:
    """The place in the spliced sequence of a position; null outside the pieces, which come in the order of transcription."""
    def add(a: Column, p: Column) -> Column:
        own = F.when(strand < 0, p["end"] - pos).otherwise(pos - p["start"])
        return F.struct((a["at"] + p["end"] - p["start"] + 1).alias("at"), F.when(pos.between(p["start"], p["end"]), a["at"] + own).otherwise(a["found"]).alias("found"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("found"))
    return F.aggregate(pieces, none, add, lambda a: a["found"]).cast("int")


def position(pieces: Column, strand: Column, at: Column) -> Column:
    """The position of a place in the spliced sequence: the reverse of place."""
    def add(a: Column, p: Column) -> Column:
        here = at - a["at"]
        inside = (here >= 0) & (here <= p["end"] - p["start"])
        return F.struct((a["at"] + p["end"] - p["start"] + 1).alias("at"), F.when(inside, F.when(strand < 0, p["end"] - here).otherwise(p["start"] + here)).otherwise(a["found"]).alias("found"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("found"))
    return F.aggregate(pieces, none, add, lambda a: a["found"])


def reference_frames(transcripts: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """transcripts (transcript, contig, strand, pieces array<struct<start, end>> in any order, utr, cds) with orfs, an array of start, stop (in the 5'UTR), far
    (stop in 5'UTR and coding sequence), evidence (True, False, or NA without a table of known starts: contig, pos), and the numbers
    existing_uORFs, existing_OutOfFrame_oORFs, existing_InFrame_oORFs. transcript is unique."""
    ordered = F.array_sort(F.col("pieces").cast(_PIECES))
    rows = transcripts.withColumn("pieces", F.when(F.col("strand") < 0, F.reverse(ordered)).otherwise(ordered))
    rows = once(rows, {"starts": codons(F.col("utr"), START), "stops": codons(F.col("utr"), "|".join(STOPS)), "far_stops": codons(F.concat("utr", F.coalesce("cds", F.lit(""))), "|".join(STOPS))})
    if evidence is not None:
        places = rows.select("transcript", "contig", F.explode("starts").alias("start"), "pieces", "strand")
        places = places.select("transcript", "contig", "start", position(F.col("pieces"), F.col("strand"), F.col("start")).alias("pos"))
        known = places.join(evidence.select("contig", "pos").distinct(), ["contig", "pos"]).groupBy("transcript").agg(F.collect_list("start").alias("known"))
        rows = rows.join(known, "transcript", "left")
    seen = F.lit("NA") if evidence is None else None
    orf = lambda s: F.struct(
        s.alias("start"), first_stop(F.col("stops"), s).alias("stop"), first_stop(F.col("far_stops"), s).alias("far"),
        (seen if seen is not None else F.when(F.coalesce(F.array_contains("known", s), F.lit(False)), "True").otherwise("False")).alias("evidence"))
    rows = once(rows, {"orfs": F.transform("starts", orf), "utr_length": F.length("utr")})
    out_of_frame = lambda o: o["stop"].isNull() & ((F.col("utr_length") - o["start"]) % 3 != 0)
    in_frame = lambda o: o["stop"].isNull() & ((F.col("utr_length") - o["start"]) % 3 == 0)
    return rows.select(
        "transcript", "contig", "strand", "pieces", "utr", "cds", "orfs",
        F.size(F.filter("orfs", lambda o: o["stop"].isNotNull())).alias("existing_uORFs"), F.size(F.filter("orfs", out_of_frame)).alias("existing_OutOfFrame_oORFs"), F.size(F.filter("orfs", in_frame)).alias("existing_InFrame_oORFs"),
    )


def _entry(term: str, fields: dict[str, Column]) -> Column:
    """consequence=TERM and the fields in the order of their names, as one text."""
    return F.concat_ws(":", F.lit(f"consequence={term}"), *(F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in sorted(fields.items())))


def _or_na(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("NA"))


def uorf_effect(variants: DataFrame, frames: DataFrame, max_overlap: float = 100) -> DataFrame:
    """variants (transcript, pos, ref, alt; an empty allele is -) of 5'UTRs with utr5_consequence (terms joined by comma, or -), utr5_annotation (an entry for each
    frame that changes, or -) and the three numbers of frames (see reference_frames).

    A variant outside the spliced sequence, that leaves it, or without a position changes no frame. Pieces that it covers by max_overlap per cent or more do not count;
    one without pieces left has nulls, as has one of an unknown transcript. Reading of alleles: the reference allele only counts by its length; a
    gained start is looked for from two bases before the change to one base after as many bases as the reference allele has. A start codon
    too near to an end has the context - and no strength. Further columns stay, those of frames' names do not.
    """
    own = [c for c in variants.columns if c not in frames.columns or c == "transcript"]
    rows = variants.select(*own).join(frames.drop("contig"), "transcript", "left")
    size = lambda c: F.when(F.col(c) == "-", 0).otherwise(F.length(c))
    last = F.col("pos") + F.greatest(F.col("n_ref"), F.lit(1)) - 1
    covered = lambda p: (F.least(p["end"], last) - F.greatest(p["start"], F.col("pos"))) * 100 / (p["end"] - p["start"] + 1)
    forward = F.when(F.col("alt") == "-", "").otherwise(F.upper("alt"))
    # columns, not once: each is used more than once, so that no projection takes it over, and a generator is not compiled
    rows = rows.withColumns({"n_ref": size("ref"), "put": F.when(F.col("strand") < 0, reverse_complement(forward)).otherwise(forward)})
    rows = rows.withColumns({"pieces": F.filter("pieces", lambda p: ~(covered(p) >= max_overlap)), "end": F.col("pos") + F.col("n_ref") - 1, "n_put": F.length("put")})
    minus = F.col("strand") < 0
    at = place(F.col("pieces"), F.col("strand"), F.when(minus, F.col("end")).otherwise(F.col("pos")))
    to = place(F.col("pieces"), F.col("strand"), F.when(minus, F.col("pos")).otherwise(F.col("end")))
    rows = rows.withColumn("at", at)
    # of a change of one base or none both ends are one
    rows = rows.withColumn("to", F.when(F.col("n_ref") <= 1, F.col("at")).otherwise(to))
    inside = F.col("at").isNotNull() & F.col("to").isNotNull()
    rows = rows.withColumns({"changed": F.when(inside, F.concat(F.substr("utr", F.lit(1), F.col("at")), "put", F.substr("utr", F.col("at") + F.col("n_ref") + 1)))})
    far = F.concat("changed", F.coalesce("cds", F.lit("")))
    rows = rows.withColumns({"new_far": far, "length": F.length("utr"), "new_length": F.length("changed")})
    length, new_length, n_ref, n_put = (F.col(c) for c in ("length", "new_length", "n_ref", "n_put"))
    begin, end = F.col("at"), F.col("to")

    low = F.greatest(begin - 2, F.lit(0))
    window = F.substr("changed", low + 1, begin + n_ref + 2 - low)
    gained = low + F.instr(window, START) - 1
    rows = rows.withColumns({"gain": F.when(F.contains(window, F.lit(START)), gained)})
    gain = F.col("gain")
    near = kozak(F.col("changed"), gain)
    gains = F.when(gain.isNotNull(), F.array(_entry(GAINED, {
        "CapDistanceToStart": gain, "DistanceToCDS": new_length - gain, "DistanceToStop": _or_na(stop_after(F.col("new_far"), gain) - gain), "KozakContext": near["context"], "KozakStrength": near["strength"],
        "type": kind(stop_after(F.col("changed"), gain).isNotNull(), new_length - gain, "inFrame_oORF")})))

    def codon(start: Column) -> Column:
        return F.substr("changed", start + 1, F.lit(3))

    def of(term: str, test, fields) -> Column:
        """An entry for each frame that passes the test."""
        def entry(o: Column) -> Column:
            near = kozak(F.col("utr"), o["start"])
            return _entry(term, {"Evidence": o["evidence"], "KozakContext": near["context"], "KozakStrength": near["strength"], **fields(o)})

        return F.transform(F.filter("orfs", test), entry)

    def ref_kind(o: Column) -> Column:
        return kind(o["stop"].isNotNull(), length - o["start"])

    def within(o: Column) -> Column:
        """The change lies between start and stop codon, or the end of the 5'UTR."""
        return (begin >= o["start"] + 3) & (end <= F.coalesce(o["stop"] - 1, length - 1))

    def new_stop(o: Column) -> Column:
        return stop_after(F.col("changed"), o["start"])

    losses = of(LOST, lambda o: begin.between(o["start"], o["start"] + 2) & ((n_put == 0) | (codon(o["start"]) != START)), lambda o: {
        "type": ref_kind(o), "CapDistanceToStart": o["start"], "DistanceToCDS": length - o["start"], "DistanceToStop": _or_na(o["far"] - o["start"])})
    stop_gains = of(STOP_GAINED, lambda o: (n_ref == n_put) & within(o) & F.coalesce(new_stop(o) < F.coalesce(o["stop"] - 1, length - 1), F.lit(False)), lambda o: {
        "ref_type": ref_kind(o), "ref_StartDistanceToCDS": length - o["start"], "newSTOPDistanceToCDS": new_length - new_stop(o)})
    stop_losses = of(STOP_LOST, lambda o: o["stop"].isNotNull() & (begin <= o["stop"] + 2) & (begin + n_ref - 1 >= o["stop"]) & ((n_put == 0) | ~codon(o["stop"]).isin(*STOPS)), lambda o: {
        "AltStop": F.when(new_stop(o).isNotNull(), "True").otherwise("False"), "AltStopDistanceToCDS": _or_na(new_length - new_stop(o)),
        "FrameWithCDS": F.when((new_length - o["start"]) % 3 != 0, "outOfFrame").otherwise("inFrame")})
    shifts = of(FRAMESHIFT, lambda o: within(o) & (F.abs(n_ref - n_put) % 3 != 0), lambda o: {
        "ref_type": ref_kind(o), "ref_type_length": _or_na(o["far"] - o["start"] + 3), "ref_StartDistanceToCDS": length - o["start"],
        "alt_type": kind(new_stop(o).isNotNull(), new_length - o["start"]), "alt_type_length": _or_na(stop_after(F.col("new_far"), o["start"]) - o["start"] + 3)})

    none = F.array().cast("array<string>")
    effects = {GAINED: gains, LOST: losses, STOP_GAINED: stop_gains, STOP_LOST: stop_losses, FRAMESHIFT: shifts}
    rows = rows.withColumns({f"e{i}": F.when(F.col("changed").isNotNull(), F.coalesce(e, none)).otherwise(none) for i, e in enumerate(effects.values())})
    terms = F.concat_ws(",", *(F.when(F.size(f"e{i}") > 0, t) for i, t in enumerate(effects)))
    entries = F.array_join(F.concat(*(F.col(f"e{i}") for i in range(len(effects)))), ",")
    known = F.col("utr").isNotNull() & (F.size("pieces") > 0)
    dash = lambda c: F.when(known, F.when(c == "", "-").otherwise(c))
    return rows.select(*own, dash(terms).alias("utr5_consequence"), dash(entries).alias("utr5_annotation"), *(F.when(known, F.col(c)).alias(c) for c in ("existing_uORFs", "existing_OutOfFrame_oORFs", "existing_InFrame_oORFs")))
