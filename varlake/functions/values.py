"""Column expressions for texts, numbers, durations and hashes as variant tables hold them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for "no value".
MISSING_PREDICTOR = ("", ".", "nan", "N/A")
MISSING_FREQUENCY = ("", ".", "-", "nan", "None", "<NA>", "NA")
MISSING_CLINVAR = ("", ".", "-", "nan", "none", "<na>", "na", "not_provided", "not provided")

_DIGITS = "0123456789"


def known(column: Column, missing: tuple[str, ...] = MISSING_PREDICTOR) -> Column:
    """The trimmed text, or null if it stands for no value."""
    text = F.trim(column.cast("string"))
    return F.when(~text.isin(*missing), text)


def exact_number(df: DataFrame, name: str) -> bool:
    """Whether a column holds doubles or integers: writing one as a text and reading that again gives the same number, so it need not be written."""
    return dict(df.dtypes).get(name) in ("double", "bigint", "int", "smallint", "tinyint")


def has_word(text: Column, words: str) -> Column:
    """Whether one of the words, parted by |, is in a text. Words are looked for one by one, which takes a fraction of a pattern's time."""
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words.split("|")))


def once(df: DataFrame, columns: dict[str, Column], drop: list[str] | None = None) -> DataFrame:
    """df with columns that are evaluated once a row, however often later ones use them: the planner merges projections and would
    write a column's expression into each of its uses, but not through a generator (here, of one row). drop: old columns that new ones replace."""
    made = F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items()))))
    return df.select(*(c for c in df.columns if c not in (drop or [])), made)


#: Distinct values up to which columns are worked out once for each.
FEW = 20_000


def by_value(df: DataFrame, inputs: list[str], make: Callable[[DataFrame], DataFrame], few: int = FEW) -> DataFrame:
    """make(df), where make adds columns that depend on the columns inputs alone: status texts, class lists, consequence terms.

    Their distinct values are looked at first (a pass over inputs; few + 1 rows come to the driver at most). Where there are few, make works on
    those and the rows get its columns by a broadcast of that many rows; else it works on every row. The result is the same."""
    inputs = [c for c in dict.fromkeys(inputs) if c in df.columns]
    found = df.select(*inputs).distinct().limit(few + 1).collect() if inputs else []
    if not inputs or len(found) > few:
        return make(df)
    made = make(df.sparkSession.createDataFrame(found, df.select(*inputs).schema))
    new = [c for c in made.columns if c not in inputs]
    there = made.select(*(F.col(c).alias(f"__in_{i}") for i, c in enumerate(inputs)), *(F.col(c).alias(f"__new_{c}") for c in new))
    same = F.lit(True)
    for i, c in enumerate(inputs):
        same = same & F.col(c).eqNullSafe(F.col(f"__in_{i}"))
    joined = df.drop(*(c for c in new if c in df.columns)).join(F.broadcast(there), same)
    return joined.select(*(F.col(c) for c in df.columns if c not in new), *(F.col(f"__new_{c}").alias(c) for c in new))


def true(column: Column) -> Column:
    """A condition under which unknown is false."""
    return F.coalesce(column, F.lit(False))


def strip_version(column: Column) -> Column:
    return F.substring_index(F.trim(column.cast("string")), ".", 1)


def number(column: Column, default: float | None = None) -> Column:
    """The value as a double; unreadable ones and NaN are the default (null, if none is given)."""
    value = F.expr(f"try_cast({_sql(column)} AS double)") if isinstance(column, str) else column.try_cast("double")
    value = F.when(~F.isnan(value), value)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def _sql(column: str) -> str:
    return f"`{column}`"


def fixed_text(value: Column, digits: int) -> Column:
    """A double rounded half to even and written with so many digits; null stays null. Written through a decimal, which takes a fraction of a
    format's time; what no decimal holds (NaN, infinities, numbers too large) is formatted."""
    rounded = F.bround(value, digits)
    plain = rounded.try_cast(f"decimal(38,{digits})").cast("string")
    return F.when(value.isNotNull(), F.coalesce(plain, F.format_string(f"%.{digits}f", rounded)))


def unit_score(column: Column) -> Column:
    """A score in [0, 1], else null; a true zero stays."""
    value = number(column)
    return F.when(value.between(0, 1), value)


def split_entries(column: Column, sep: str = "[&,]") -> Column:
    """Entries of a packed value, without empty ones."""
    # a class of characters is compiled anew for each row, a character is not
    parts = F.split(F.replace(column, F.lit(","), F.lit("&")), "&") if sep == "[&,]" else F.split(column, sep)
    return F.filter(parts, lambda x: x != "")


def listed_number(item: Column) -> Column:
    """The number of an item of a packed value, or null. The usual sign for none is not cast: the cast throws an exception inside for it."""
    return F.when(item != ".", item).try_cast("double")


def numbers(items: Column) -> Column:
    """The readable numbers of an array of texts."""
    return F.filter(F.transform(items, listed_number), lambda x: x.isNotNull() & ~F.isnan(x))


def alt_from_locus(locus: Column) -> Column:
    """ALT of CHROM:POS-REF-ALT; null if there are not as many parts."""
    parts = F.split(locus, "-")
    return F.when(F.size(parts) >= 3, F.element_at(parts, -1))


def locus_parts(locus: Column) -> Column:
    """chrom, pos, ref, alt of a locus written with :, - or |."""
    parts = F.split(locus, "[:|-]")
    return F.struct(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(("chrom", "pos", "ref", "alt"))))


def bare_chrom(chrom: Column) -> Column:
    """1 to 22, X, Y, MT, without chr; M becomes MT."""
    text = F.regexp_replace(F.trim(chrom.cast("string")), "(?i)^chr", "")
    return F.when(F.upper(text).isin("M", "MT"), "MT").otherwise(text)


def chr_chrom(chrom: Column) -> Column:
    """With chr; MT becomes chrM."""
    text = bare_chrom(chrom)
    return F.concat(F.lit("chr"), F.when(text == "MT", "M").otherwise(text))


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(F.upper(sequence), "ACGTN", "TGCAN"))


def fold_accents(text: Column) -> Column:
    """Letters without accents; characters that a VCF INFO value may not hold become _."""
    plain = F.translate(text, "áàâäãéèêëíìîïóòôöõúùûüñçÁÀÂÄÉÈÊËÍÓÖÚÜÑÇ", "aaaaaeeeeiiiiooooouuuuncAAAAEEEEIOOUUNC")
    return F.regexp_replace(plain, "[\\s;=,]", "_")


def truncate(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def attribute(attributes: Column, name: str) -> Column:
    """A GTF attribute: name "value"; or name=value."""
    found = F.regexp_extract(attributes, f'(?:^|[;\\s]){name}[ =]"?([^";]+)"?', 1)
    return F.when(found != "", found)


def clean_file_name(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), "[^A-Za-z0-9_.-]+", "_")


def key_values(text: Column, item: str = ":", equals: str = "=") -> Column:
    """key=value items as a map; items without = are left out, of a repeated key the last counts."""
    items = F.filter(F.split(text, item), lambda x: F.contains(x, F.lit(equals)))
    pairs = F.transform(items, lambda x: F.struct(F.trim(F.substring_index(x, equals, 1)).alias("key"), F.trim(F.substring_index(x, equals, -1)).alias("value")))

    def last(found: Column) -> Column:
        keys = found["key"]
        again = F.filter(found, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["key"]))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), found).otherwise(again)

    # a list of one list: what is bound in a lambda is made once, however often it is used
    return F.map_from_entries(F.get(F.transform(F.array(pairs), last), F.lit(0)))


def intron_offset(hgvs: Column) -> Column:
    """Signed offset of the first intronic end of an HGVS c. or n. description; 0 if there is none.

    The description is what follows c. or n. up to a blank. It is a list of ends, parted by _; an end is a place (digits, - or *
    before them) that an offset may follow, and what comes after the digits (bases, del, ins and so on) does not count.
    """
    text = F.coalesce(hgvs, F.lit(""))
    typed = F.filter(F.split(text, r"[:\s]"), lambda part: F.left(part, F.lit(2)).isin("c.", "n."))
    ends = F.split(F.substring(F.get(typed, F.lit(0)), 3, 1 << 30), "[_;]")
    # an end without what may stand before its place; then the place's digits go, and a sign is left where an offset follows
    after = F.transform(ends, lambda end: F.ltrim(F.ltrim(end, F.lit("([-*")), F.lit(_DIGITS)))
    signed = F.filter(F.arrays_zip(ends.alias("end"), after.alias("after")), lambda x: F.left(x["after"], F.lit(1)).isin("+", "-") & (F.length(x["after"]) < F.length(F.ltrim(x["end"], F.lit("([-*")))))
    offset = F.get(signed, F.lit(0))["after"]
    digits = F.substring(offset, 2, 1 << 30)
    size = F.left(digits, F.length(digits) - F.length(F.ltrim(digits, F.lit(_DIGITS)))).try_cast("int")
    return F.coalesce(F.when(F.left(offset, F.lit(1)) == "-", -size).otherwise(size), F.lit(0))


def duration_ms(text: Column) -> Column:
    """Milliseconds of a duration such as 1d 2h 3m 4.5s 6ms; null if nothing can be read."""
    units = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
    total, found = F.lit(0.0), F.lit(False)
    for unit, factor in units.items():
        part = F.regexp_extract(text, rf"(?:^|\s)([0-9.]+)\s*{unit}(?:\s|$)", 1)
        total, found = total + F.coalesce(part.try_cast("double"), F.lit(0.0)) * factor, found | (part != "")
    return F.when(found, F.round(total).cast("long"))


def size_bytes(text: Column) -> Column:
    """Bytes of a size such as 1.5 GB (powers of 1024)."""
    value, unit = F.regexp_extract(text, r"^\s*([0-9.]+)\s*([KMGT]?)B?\s*$", 1).try_cast("double"), F.regexp_extract(text, r"^\s*([0-9.]+)\s*([KMGT]?)B?\s*$", 2)
    power = F.when(unit == "K", 1).when(unit == "M", 2).when(unit == "G", 3).when(unit == "T", 4).otherwise(0)
    return F.round(value * F.pow(F.lit(1024.0), power)).cast("long")


def clock(seconds: Column) -> Column:
    """1h 02m 03s."""
    s = F.round(seconds).cast("long")
    return F.format_string("%dh %02dm %02ds", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def hours_between(start: Column, end: Column) -> Column:
    return F.round((F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))) / 3600.0, 2)


def identity(fields: dict[str, Column]) -> Column:
    """16 hex digits of the SHA-256 of the fields in the order of their names: a version id."""
    text = F.concat_ws("\n", *(F.concat(F.lit(f"{k}="), F.coalesce(fields[k].cast("string"), F.lit(""))) for k in sorted(fields)))
    return F.substring(F.sha2(text, 256), 1, 16)


def map_difference(a: Column, b: Column) -> Column:
    """Sorted keys whose values differ between two maps, or that only one has."""
    keys = F.array_union(F.map_keys(a), F.map_keys(b))
    return F.array_sort(F.filter(keys, lambda k: ~F.try_element_at(a, k).eqNullSafe(F.try_element_at(b, k))))


def contains_all(superset: Column, subset: Column) -> Column:
    return F.size(F.array_except(subset, superset)) == 0


def flags_text(json: Column) -> Column:
    """A JSON list of flags joined by ;."""
    return F.array_join(F.from_json(json, "array<string>"), ";")
