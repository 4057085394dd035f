"""Each operator against a brute-force version on small tables with nulls, empty and repeated rows, and clashing columns."""

import base64
import hashlib
import random
import re
import time
from pathlib import Path

import pytest

from varlake.llm import bpe, chat, common, decontaminate, fingerprint, jaccard, lines, markup, substrings, toxicity, warc

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [sentence(rng, n) for n in (3, 12, 40, 80, 300, 25, 60)]
    texts = [None, "", "one", "Two words"] + base + [base[3], base[4].upper(), base[4] + " tail", base[2] + "\n" + base[3], base[3] + "\n" + base[2]]
    words = base[4].split()
    for k in (3, 9, 40, 120):  # copies further and further away
        texts.append(" ".join(w if i % 300 >= k else w + "x" for i, w in enumerate(words)))
    texts += [sentence(rng, 50) + ".\n" + base[1] + "\n" + sentence(rng, 30) for _ in range(4)] + ["a b c d e f g", "a b c d e f g", "\n\n \t", "é" * 50]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 1

def test_fingerprint_edits(docs, rows):
    got = {r.doc_id: r for r in fingerprint.edits(docs).collect()}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    by = {}
    for i, text in rows:
        by.setdefault("\n".join(sorted((text or "").split("\n"))), set()).add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def test_fingerprint_is_homomorphic(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("x y\nlong clause, and more.", "x y", "long clause, and more.")], "whole string, a string, b string")
    df = df.select(*(fingerprint.vector(c).alias(c) for c in df.columns))
    ok = df.select(fingerprint.add(F.col("b"), F.col("a")) == F.col("whole"), fingerprint.subtract(F.col("whole"), F.col("a")) == F.col("b")).first()
    assert all(ok)


def test_fingerprint_repeated_and_null_rows(spark):
    df = spark.createDataFrame([(None, "n"), (1, "same"), (1, "same"), (2, "x")], "doc_id long, text string")
    got = fingerprint.edits(df).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars) for r in got) == [(False, 0, 1), (True, 1, 4), (True, 1, 4), (True, 2, 1)]
    assert fingerprint.edits(empty(spark)).count() == 0


def test_fingerprint_likeness(spark):
    """Likenesses against the exact share of word pairs, for texts of all lengths, with and without blanks and line ends."""
    rng = random.Random(41)
    texts = [sentence(rng, n).replace(" of", "\n") for n in (4, 9, 15, 30, 60, 120, 400, 3000)] * 2 + ["x" * 500, "".join(rng.choice("abcdefg") for _ in range(3000)), sentence(rng, 20000), "a", ""]
    texts = [t if k % 3 else t.replace(" ", "\n", 2) for k, t in enumerate(texts)]
    rows = list(enumerate(texts))

    def pairs(text):
        out = {}
        for p in text.split("\n"):
            w = re.findall(r"\S{1,12}", p)
            for u in set(zip(w, w[1:])) if len(w) > 1 else w:
                out[u] = out.get(u, 0) + 1
        return out

    def share(a, b):
        if sorted(a.split("\n")) == sorted(b.split("\n")):
            return 1.0
        x, y = pairs(a), pairs(b)
        squares = sum(v * v for v in (*x.values(), *y.values()))
        return 1 - sum((x.get(u, 0) - y.get(u, 0)) ** 2 for u in {*x, *y}) / squares if squares else 0.0

    got = {r.doc_id: r for r in fingerprint.edits(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS hash", "1 AS lanes")).collect()}
    errors = []
    for i, text in rows:
        after = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        errors += [got[i].near_edited - max(0, share(text, edited)), got[i].near_next - max(0, share(text, after))]
    assert max(map(abs, errors)) < 0.35 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.12


# --- 2

@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, public.PATTERN, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(docs, rows, tokenizer):
    path, pattern, reference = tokenizer
    encoded = bpe.encode(docs, path, pattern)
    got = {r.doc_id: r for r in bpe.decode(encoded, path).collect()}
    digests = {r.doc_id: r for r in bpe.round_trip(docs, path, pattern, ["doc_id"]).collect()}
    for i, text in rows:
        ids = reference.encode_ordinary(text or "")
        assert got[i].tokens == ids and got[i].n_tokens == len(ids) and bytes(got[i].decoded) == (text or "").encode()
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_rows(spark, tokenizer):
    """Repeated rows, rows without an id, a very long text, clashing columns, an empty table."""
    path, pattern, reference = tokenizer
    long = sentence(random.Random(3), 40000)
    rows = [(1, "same"), (1, "same"), (None, "x"), (None, None), (2, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'t' AS tokens", "0 AS n_tokens", "'d' AS decoded")
    got = bpe.decode(bpe.encode(df, path, pattern, ["doc_id", "text", "tokens", "decoded"]), path).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(i), len(reference.encode_ordinary(t or ""))) for i, t in rows)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in got)
    assert bpe.round_trip(df.limit(0), path, pattern, ["doc_id"]).count() == 0


def test_bpe_long_pieces(tokenizer):
    path, pattern, reference = tokenizer
    rng = random.Random(1)
    texts = ["a" * 3000, "".join(rng.choice("theanosr") for _ in range(2500)), "".join(rng.choice("aé漢🙂 \n'9") for _ in range(2000))]
    ids, ends = bpe.Encoder(bpe.Vocabulary(open(path, "rb").read()), pattern).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [reference.encode_ordinary(t) for t in texts]


# --- 3

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (c != d)))
        row = new
    return row[-1]


def brute_lines(rows, similarity=0.8):
    """Every pair of lines by plain edit distance; nothing of the operator is used."""
    places, names = [], {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for n, line in enumerate(text.split("\n") if text is not None else []):
            normal = " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in line)))
            if normal:
                places.append((i, n, names.setdefault(normal, len(names))))
    parent, kinds = list(range(len(names))), list(names)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(kinds)):
        for b in range(a):
            most = int((1 - similarity) * max(len(kinds[a]), len(kinds[b])) + 1e-9)
            if find(a) != find(b) and abs(len(kinds[a]) - len(kinds[b])) <= most and plain_distance(kinds[a], kinds[b]) <= most:
                parent[find(a)] = find(b)
    first, gone = {}, {}
    for i, n, name in places:
        if first.setdefault(find(name), (i, n)) != (i, n):
            gone.setdefault(i, set()).add(n)
    return {i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, ())) for i, t in rows}


def test_line_dedup(docs, rows, monkeypatch):
    expected = brute_lines(rows)
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == expected
    monkeypatch.setattr(lines, "CHUNK", 2)
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == expected


def test_line_dedup_finds_edited_lines(spark):
    """Lines with replaced words, inserted or left out words, or changed letters, of the similarity asked for: at least nine in ten."""
    rng = random.Random(21)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    rows, kinds = [], {}
    for k in range(400):
        n = rng.choice((6, 8, 12, 20, 30, 60))
        line = [rng.choice(vocabulary) for _ in range(n)]
        other, kind = list(line), ("words", "letter", "indel", "several")[k % 4]
        for _ in range(1 if kind != "several" else max(1, n // 10)):
            at = rng.randrange(n)
            if kind == "letter":
                c = rng.randrange(len(other[at]))
                other[at] = other[at][:c] + rng.choice("0123456789") + other[at][c + 1 :]
            elif kind == "indel":
                other.insert(at, rng.choice(vocabulary))
            else:
                other[at] = rng.choice(vocabulary)
        a, b = " ".join(line), " ".join(other)
        if a != b and plain_distance(a, b) <= 0.2 * max(len(a), len(b)):
            rows += [(2 * k, a), (2 * k + 1, b)]
            kinds.setdefault(kind, []).append(2 * k + 1)
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(got[i] for i, _ in rows if i % 2 == 0)
    for own in kinds.values():
        assert len(own) > 50 and sum(got[i] for i in own) >= 0.9 * len(own)


def _edited(rng, word, line, kind):
    """The words of line after an edit of that kind."""
    out, at = list(line), rng.randrange(len(line))
    typo = lambda w: (lambda c: w[:c] + rng.choice("abcdefghijklmnopqrstuvwxyz") + w[c + 1 :])(rng.randrange(len(w)))
    if kind == "letter":
        out[at] = typo(out[at])
    elif kind == "replaced":
        out[at] = word()
    elif kind == "inserted":
        out.insert(at, word())
    elif kind == "swapped":
        at = min(at, len(out) - 2)
        out[at : at + 2] = out[at + 1], out[at]
    elif kind == "split":
        c = rng.randrange(1, len(out[at]))
        out[at : at + 1] = [out[at][:c], out[at][c:]]
    else:
        for k in rng.sample(range(len(out)), max(1, len(out) // 4)):
            out[k] = typo(out[k])
    return out


@pytest.fixture(scope="module")
def edited_lines(spark):
    """(length, kind) to the shares of edited lines found, of lines alike at 0.8 by plain edit distance; untouched lines removed."""
    rng, rows, cells = random.Random(5), [], {}
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 10)))
    for n, kind in EDITS:
        own = cells.setdefault((n, kind), [])
        while len(own) < 40:
            line = [word() for _ in range(n)]
            a, b = " ".join(line), " ".join(_edited(rng, word, line, kind))
            if a != b and plain_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9):
                own.append(len(rows) + 1)
                rows += [(len(rows), a), (len(rows) + 1, b)]
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    return {cell: sum(got[i] for i in own) / len(own) for cell, own in cells.items()}, sum(got[i] for i in range(0, len(rows), 2))


#: Lines of two or three words are seldom alike after a word was swapped or replaced.
EDITS = [(n, kind) for n in (2, 3, 4, 6, 8, 12, 20) for kind in ("letter", "replaced", "inserted", "swapped", "split", "quarter") if (n > 3 or kind in ("letter", "split", "quarter")) and (n < 20 or kind != "quarter")]


@pytest.mark.parametrize("cell", EDITS, ids=lambda c: f"{c[0]}-{c[1]}")
def test_line_dedup_finds_each_kind_of_edit(edited_lines, cell):
    assert edited_lines[0][cell] >= 0.9 and edited_lines[1] == 0


def test_line_dedup_short_lines_of_few_letters(spark):
    """One word, no blanks in common, other scripts, lines of one letter, and lines on both sides of the border of LETTERS."""
    long = "".join(chr(97 + k % 26) * (1 + k % 3) for k in range(60))[:93]
    rows = [(1, "extraordinary"), (2, "extraordinery"), (3, "extra ordinary"), (4, "a"), (5, "b"), (6, "\u0434\u0440\u0443\u0433\u0438\u0435\u0441\u043b\u043e\u0432\u0430"), (7, "\u0434\u0440\u0443\u0433\u0438\u0435 \u0441\u043b\u043e\u0432\u0430"), (8, long[:91]), (9, long[:90]), (10, "a\nb")]
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 1, 8: 0, 9: 1, 10: 2}


def test_line_dedup_long_lines_and_rows_of_one_id(spark):
    rng = random.Random(22)
    long = sentence(rng, 30000)
    changed = " ".join(w if k % 50 else "new" for k, w in enumerate(long.split()))
    rows = [(1, long), (2, "x y z w\n" + changed), (3, "first line of three"), (3, "other words\nfirst line of three"), (3, "first line of three"), (None, "no id at all here"), (None, "no id at all here\nmore")]
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert [x for x in got if x[0] in "12"] == [("1", 1, 0), ("2", 2, 1)]
    # of the texts of one id that come first in the order of their hashes all rows keep the line
    assert sum(r for i, n, r in got if i == "3") in (1, 2) and sum(r for i, n, r in got if i == "None") == 1


def test_line_dedup_edges(spark):
    df = spark.createDataFrame([(1, "A b!\n\n--\nA  b", 5, "z"), (None, "a B", 3, "z"), (2, None, None, "z")], "doc_id long, text string, n_chars long, n_lines string")
    got = {r.doc_id: (r.text, r.n_chars, r.n_lines, r.n_removed) for r in lines.dedup_lines(df).collect()}
    assert got == {1: ("\n--", 3, 4, 2), None: ("a B", 3, 1, 0), 2: (None, None, 0, 0)}
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_walk_through_words_bounds_the_edit_distance():
    rng = random.Random(7)
    for _ in range(500):
        x = [rng.choice(("a", "bb", "cd", "the", "of", "abc")) for _ in range(rng.randint(1, 14))]
        y = [w for w in x if rng.random() < 0.8] + [rng.choice(("the", "q"))] * rng.randint(0, 2)
        for _ in range(rng.randint(0, 3)):
            y.insert(rng.randint(0, len(y)), rng.choice(("a", "q", "the")))
        assert lines._rewritten(x, y) >= plain_distance(" ".join(x), " ".join(y))
        assert lines._rewritten(x, x) == 0


def test_line_groups_leave_out_lines_of_no_group(spark):
    """First occurrences are given of repeated and of like lines only; lines that occur once and are like no other are not shuffled for them."""
    rows = [(1, "one line of its own here\nsame words again and again today"), (2, "same words again and again today\nthe quick brown fox jumps over the dog"), (3, "the quick brown fox jumps over the cat\nquite another sentence without a pair")]
    occurrences, firsts = lines.line_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    names = {(r.doc, r.number): r.line for r in occurrences.collect()}
    got = {r.line: (r.first.doc, r.first.number) for r in firsts.collect()}
    assert got == {names[1, 1]: (1, 1), names[2, 1]: (2, 1), names[3, 0]: (2, 1)} and names[1, 1] == names[2, 0]


def test_many_edit_distances_at_once(monkeypatch):
    """Right for every length and script, and no pair of usual length is worked on alone."""
    rng, pairs = random.Random(8), []
    for k in range(1200):
        n = rng.choice((0, 1, 2, 20, 63, 64, 65, 128, 129, 200, 300))
        a = "".join(rng.choice("abcdefgh \u00e9\u6f22\U0001f600") for _ in range(n))
        b = list(a) if k % 5 else [rng.choice("abcdef ") for _ in range(n)]
        for _ in range(rng.randint(0, n // 3 + 1)):
            c = rng.randint(0, len(b))
            b[c : c + rng.randint(0, 1)] = rng.choice(("", "x", "ab"))
        pairs.append((a, "".join(b), max(0, n // 5 + rng.randint(-2, 2))))
    assert lines.within(pairs).tolist() == [plain_distance(a, b) <= most for a, b, most in pairs]
    assert lines.within([]).tolist() == [] and lines.within([("", "", 0), ("a", "", 0), ("", "ab", 2)]).tolist() == [True, False, True]
    monkeypatch.setattr(lines, "CELLS", 2000)  # tables of several parts
    assert lines.within(pairs[:100]).tolist() == [plain_distance(a, b) <= most for a, b, most in pairs[:100]]
    monkeypatch.undo()
    alone = []
    monkeypatch.setattr(lines, "edit_distance", lambda a, b, most: alone.append(a) or plain_distance(a, b))
    lines.within([p for p in pairs if 100 < len(p[0]) and 100 < len(p[1]) <= 180])
    assert not alone


def test_line_dedup_of_a_key_with_more_rows_than_a_batch(spark, monkeypatch):
    """Rows of a key come in any order of their SimHashes: groups of more lines than one batch and than GROUP are found all the same."""
    rng = random.Random(9)
    base = sentence(rng, 40).split()
    rows = [(k, " ".join(w if (i * 7 + k) % 41 else f"new{k}" for i, w in enumerate(base))) for k in range(120)] + [(1000 + k, sentence(rng, 12)) for k in range(40)]
    docs_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    expected = {r.doc_id: r.n_removed for r in lines.dedup_lines(docs_).collect()}
    assert sum(expected.values()) == 119
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch, group in (("7", lines.GROUP), ("7", 16)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            monkeypatch.setattr(lines, "GROUP", group)
            assert {r.doc_id: r.n_removed for r in lines.dedup_lines(docs_).collect()} == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_keys_held_by_a_task_stay_few(spark, monkeypatch):
    """Keys are dealt out to as many tasks as their number asks for; a task that holds many drops repeated ones and lets those of large
    groups go, which changes no result."""
    rng = random.Random(10)
    base = sentence(rng, 40).split()
    rows = [(k, " ".join(w if (i * 7 + k) % 41 else f"new{k}" for i, w in enumerate(base))) for k in range(90)] + [(500 + k, sentence(rng, 9)) for k in range(60)] + [(600 + k, sentence(rng, 9)) for k in range(2)] * 3
    docs_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = sorted((r.doc_id, r.n_removed) for r in lines.dedup_lines(docs_).collect())
    assert sum(n for _, n in expected) >= 89
    for dealt, held, group in ((lines.DEALT, 40, 12), (100, 1, 4096), (1000, 300, 30)):
        for name, value in (("DEALT", dealt), ("HELD", held), ("GROUP", group)):
            monkeypatch.setattr(lines, name, value)
        assert sorted((r.doc_id, r.n_removed) for r in lines.dedup_lines(docs_).collect()) == expected


def test_unlike_texts_are_told_before_their_end(monkeypatch):
    """A distance never is below its bound, unlike texts are given up before they are read, and walks end where they cost too much."""
    rng, bounds, columns = random.Random(11), [], []
    least = lines._least
    monkeypatch.setattr(lines, "_least", lambda up, down, column, long, short: bounds.append(least(up, down, column, long, short)) or columns.append(column) or bounds[-1])
    for k in range(40):
        a = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(600, 900)))
        b = list(a) if k % 2 else [rng.choice("abcdefgh ") for _ in a]
        for _ in range(rng.randint(0, 30)):
            c = rng.randint(0, len(b))
            b[c : c + rng.randint(0, 1)] = rng.choice(("", "x", "ab"))
        b, bounds[:], columns[:] = "".join(b), [], []
        d = lines.edit_distance(a, b, len(a))
        assert bounds and max(bounds) <= d == plain_distance(a, b)
        columns.clear()
        if not k % 2:
            assert lines.edit_distance(a, b, len(a) // 8) > len(a) // 8 and columns[-1] < len(a) // 2
    x, y = "a b c d e f".split(), "a bb cc dd ee f".split()
    assert lines._rewritten(x, y, 5) > 5 and lines._rewritten(x, y, 50) == lines._rewritten(x, y)


def test_words_hash_alike_wherever_they_stand():
    """Words of odd and even lengths, longer than _COMMON bytes too, beside other texts' words or alone."""
    import pyarrow as pa

    from varlake.llm import arrays

    words_ = ["a", "ab", "abc", "x" * 31, "x" * 32, "x" * 33, "y" * 34, "\u00e9", "\u6f22a", "z" * 1000]
    alone = [arrays.Words(pa.array([w]), lower=True, terms=True).hashes().tolist() for w in words_]
    assert arrays.Words(pa.array(words_), lower=True, terms=True).hashes().tolist() == [h for x in alone for h in x]
    assert arrays.Words(pa.array([" ".join(words_), "A,B"]), lower=True, terms=True).hashes().tolist() == [h for x in alone for h in x] + [alone[0][0], *arrays.Words(pa.array(["b"]), terms=True).hashes().tolist()]
    assert arrays._COMMON % 2 == 0


def test_edit_distance():
    rng = random.Random(3)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a):
            new = [i + 1]
            for j, d in enumerate(b):
                new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (c != d)))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 25))) for _ in "ab")
        d = plain(a, b)
        assert lines.edit_distance(a, b, d) == d and (d == 0 or lines.edit_distance(a, b, d - 1) >= d)


# --- 4

def brute_components(rows, n, num, den):
    sets = {}
    for i, text in rows:
        w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and den * both >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("n", "num", "den", "chunk"), [(4, 85, 100, 512), (5, 80, 100, 2), (2, 60, 100, 3)])
def test_near_duplicates(docs, rows, n, num, den, chunk, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, n, (num, den)).collect()}
    assert got == brute_components(rows, n, num, den)


def test_near_duplicates_null_and_repeated_ids(spark):
    """Links that run through rows without an id, exact copies in plenty, a very long text, and clashing columns."""
    rng = random.Random(31)
    base = sentence(rng, 60)
    words = base.split()
    near, further = list(words), list(words)
    near[0], further[0], further[-1] = "x", "x", "y"
    long = sentence(rng, 40000)
    rows = [(5, base), (None, " ".join(near)), (9, " ".join(further)), (7, long), (8, long + " tail"), (3, sentence(rng, 20)), (3, sentence(rng, 20))] + [(20 + k, base) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS component", "'c' AS copy", "2 AS size").repartition(4)
    got = jaccard.near_duplicates(docs, 4, (94, 100)).collect()
    by = {r.doc_id: r.component_id for r in got if r.doc_id != 3}
    # base and further link only over the row without an id
    assert brute_components([(5, base), (9, " ".join(further))], 4, 94, 100)[9][1] == 9
    assert len(got) == len(rows) and by == {5: 5, None: 5, 9: 5, 7: 7, 8: 7} | {20 + k: 5 for k in range(30)}


def test_walk_compares_children_in_one_go():
    """A walk finds the pairs that a bitmap bound leaves, in few steps: fewer than there are pairs of sets."""
    import numpy as np

    class Counted(np.ndarray):
        asked = 0

        def __getitem__(self, at):
            Counted.asked += 1
            return np.asarray(super().__getitem__(at))

    random = np.random.default_rng(3)
    sets = [random.integers(0, 1 << 63, 60).astype(np.uint64) for _ in range(100)]
    sets += [np.concatenate([s[:57], random.integers(0, 1 << 63, 3).astype(np.uint64)]) for s in sets[:10]]
    maps, sizes, names = np.stack([jaccard.token_bitmap(s) for s in sets]), np.full(len(sets), 60), np.arange(len(sets))
    whole, left, right = (jaccard.SignatureTree(maps[r], sizes[r], names[r]) for r in (names, names[:3], names[3:]))
    found = {tuple(sorted(pair)) for pair in jaccard.walk(whole, whole, 80, 100, names.copy().view(Counted))}
    assert found >= {(k, 100 + k) for k in range(10)} and Counted.asked < len(sets) * (len(sets) - 1) // 2 / 4
    across = {pair for pair in jaccard.walk(left, right, 80, 100, names)}
    assert across == {pair for pair in found if pair[0] < 3 <= pair[1]}


def test_near_duplicates_empty(spark):
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_bands_hold_every_link():
    bands = jaccard.Bands(80, 100)
    for size in range(1, 400):
        for other in range(size, int(size / 0.8) + 1):
            assert bands.band(other) - bands.band(size) in (0, 1)


# --- 5

def test_substrings(docs, rows, monkeypatch):
    seen, expected = set(), {}
    for i, text in sorted(rows):
        w = words_of(text)
        gone = set()
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                gone.update(range(s, s + 20))
            seen.add(key)
        expected[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))

    def result():
        return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(docs).collect()}

    assert result() == expected and any(v[1] for v in expected.values())
    monkeypatch.setattr(substrings, "max", lambda a, b: 0, raising=False)  # every repeated window counts as hot
    monkeypatch.setattr(substrings, "_repeated", _all_hot(substrings._repeated))
    assert result() == expected


def test_substrings_repeated_and_null_ids(spark, monkeypatch):
    rng = random.Random(15)
    p, q, r, u = (sentence(rng, 30) for _ in range(4))
    rows = [(5, p), (5, p), (5, sentence(rng, 30)), (6, f"x {p}"), (None, q), (None, q), (None, sentence(rng, 40)), (None, f"y z {q}"), (7, f"{r} {u}"), (7, f"{r} {r}"), (8, f"{u} {q}"), (8, f"{u} {p}")]
    first, expected = {}, []
    for i, text in rows:
        w = words_of(text)
        for s in range(len(w) - 19):
            key, at = tuple(w[s : s + 20]), (i is not None, i or 0, s)
            first[key] = min(first.get(key, at), at)
    for i, text in rows:
        w = words_of(text)
        gone = {k for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] < (i is not None, i or 0, s) for k in range(s, s + 20)}
        expected.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def result():
        return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(df).collect())

    assert expected[0][2] == expected[1][2] == expected[4][2] == 0 < expected[3][2]
    assert result() == sorted(expected)
    monkeypatch.setattr(substrings, "_repeated", _all_hot(substrings._repeated))
    assert result() == sorted(expected)


def _all_hot(plain):
    from pyspark.sql import functions as F

    def repeated(parts):
        kept = substrings.stage(parts.groupBy("part").agg(F.sum("n").alias("n")).where("n > 1"), "level")
        ids = [r.part for r in kept.collect()]
        return (substrings.bitmap(kept, "part", 1 << 16), ids) if ids else (None, [])

    return repeated


def test_substrings_long_texts(spark):
    rng = random.Random(51)
    passage, long = sentence(rng, 60), sentence(rng, 40000)
    rows = [(1, long), (2, f"{sentence(rng, 30000)} {passage}"), (3, f"a {passage} b"), (4, f"x {long} y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'p' AS places", "1 AS copy")
    assert {r.doc_id: (r.n_removed, r.kept if r.doc_id > 2 else "") for r in substrings.dedup_substrings(df).collect()} == {1: (0, ""), 2: (0, ""), 3: (60, "a b"), 4: (40000, "x y")}


def test_substrings_without_repeats(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in substrings.dedup_substrings(df).collect()} == {1: "a b", 2: ""}
    assert substrings.dedup_substrings(empty(spark)).count() == 0


# --- 6

def test_chat(spark):
    odd = [(1, 0, "us\\er\nx<|im_end|>", "<|im_end|>\n<\\|im_end|> [\\\\INST] <|\\| é"), (1, 1, "assistant", None), (1, 2, None, "x"), (1, 2, None, "x"), (None, None, "assistant", "<\\\\s></\\s>"), (2, 0, "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    for size in (1, 60, 1 << 20):
        parts = sorted(chat.format_conversations(df, size).collect(), key=lambda r: (r.conv_id or 0, r.part))
        turns = [(p.conv_id, *t) for p in parts for t in chat.read_back(p.formatted)]
        assert turns == sorted([(c, r or "", t or "") for c, _, r, t in odd], key=lambda x: x[0] or 0)
        loss = {p.conv_id: "" for p in parts}
        for p in parts:
            loss[p.conv_id] += "".join(chat.unescape(p.formatted[s.start : s.end]) for s in p.loss)
        assert loss == {1: "", None: "<\\\\s></\\s>", 2: "</s>[INST] ok [/INST]"}
        own = {r.conv_id: r for r in chat.digests(chat.format_conversations(df, size)).collect()}
        assert own[2].loss_chars == 21 and own[1].n_turns == 4
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_long_texts(spark):
    """A text longer than a part, a conversation of many parts, clashing columns."""
    rows = [(1, k, "assistant" if k % 2 else "user", f"<|im_end|> {k} " * (20000 if k == 3 else 50)) for k in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "0 AS part", "'f' AS formatted")
    parts = sorted(chat.format_conversations(df, 4000).collect(), key=lambda r: r.part)
    assert len(parts) > 10 and [t for p in parts for t in chat.read_back(p.formatted)] == [(r, t) for _, _, r, t in rows]
    own = chat.digests(chat.format_conversations(df, 4000)).first()
    assert own.n_turns == 60 and own.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()


# --- 7

PAGE = """<html><head><title>T</title></head><body><div class="cookie-banner"><p>We use cookies here.</p></div><nav><ul><li><a href=x>One</a><li><a>Two</a></ul></nav>
<main><article><h1>The title &amp; more</h1><p>First para&nbsp;with <b>bold</b> text.<p>Second   para<br>line, with some more words in it.</p><div class="ad">Buy now</div></article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I like this.</p></div></section></main><footer><p>Copyright</p></footer><script>var a="<p>no</p>"</script></body></html>"""


def test_blocks():
    assert [b.text for b in markup.blocks(PAGE)] == ["T", "We use cookies here.", "One", "Two", "The title & more", "First para with bold text.", "Second para line, with some more words in it.", "Buy now", "Comments", "I like this.", "Copyright"]
    assert markup.blocks("") == [] and [b.text for b in markup.blocks("<p>a<p>b</i></div><p>c &lt;x&gt;")] == ["a", "b", "c <x>"]


def test_labeller_gradients():
    import numpy as np

    model = markup.Labeller(hidden=3)
    rng = np.random.default_rng(0)
    x, mask = rng.standard_normal((4, 2, markup.WIDTH)).astype(np.float32) * 0.3, np.array([[1, 1], [1, 1], [1, 0], [1, 0]], bool)
    y = np.array([[1, 0], [0, 1], [1, 0], [1, 0]], np.float32)
    _, grad = model.gradients(x, mask, y)
    for key in ("hf", "hb", "xf", "xb", "o", "bf"):
        at = tuple(np.unravel_index(int(np.abs(grad[key]).argmax()), grad[key].shape))
        old, step = model.w[key][at], np.float32(1e-2)
        model.w[key][at] = old + step
        up, _ = model.gradients(x, mask, y)
        model.w[key][at] = old - step
        down, _ = model.gradients(x, mask, y)
        model.w[key][at] = old
        assert abs((up - down) / (2 * step) - grad[key][at]) < 2e-3


def made_pages(rng, n, first=0):
    """(page_id, url, html, main text) of pages with an article of their own."""
    pages = []
    for i in range(first, first + n):
        paragraphs = [sentence(rng, rng.randint(5, 40)).capitalize() + "." for _ in range(rng.randint(2, 7))]
        title = sentence(rng, 4)
        body = "".join(f"<p>{x}</p>" for x in paragraphs)
        pages.append((i, f"u{i}", f"<html><head><title>{sentence(rng, 3)}</title></head><body><nav><ul><li><a href=x>{sentence(rng, 1)}</a></li></ul></nav><div class='ad'>{sentence(rng, 6)}</div><article><h1>{title}</h1>{body}</article><footer>{sentence(rng, 5)}</footer></body></html>", "\n\n".join([title, *paragraphs])))
    return pages


def plain_pages(rng, n, first):
    """The same, in layouts without any telling tag, with comments, links and a notice around."""
    pages = []
    for i in range(first, first + n):
        paragraphs = [sentence(rng, rng.randint(15, 60)).capitalize() + "." for _ in range(rng.randint(3, 8))]
        title = sentence(rng, rng.randint(3, 8)).capitalize()
        menu = "".join(f"<li><a href='/{k}'>{sentence(rng, 1)}</a>" for k in range(rng.randint(3, 7)))
        remarks = "".join(f"<div class='comment'><div class='comment-author'>{sentence(rng, 2)}</div><p>{sentence(rng, rng.randint(4, 25))}</p></div>" for _ in range(rng.randint(0, 4)))
        html = f"""<html><head><title>{title}</title></head><body><div><ul>{menu}</ul></div><div class="cookie-notice"><p>We use cookies. {sentence(rng, 6)}</p></div><div><h1>{title}</h1>{"".join(f"<p>{x}" for x in paragraphs)}</div>
<div class="comments">{"<h3>Comments</h3>" + remarks if remarks else ""}</div><div class="footer"><p>&copy; {sentence(rng, 5)}</p></div></body></html>"""
        pages.append((i, f"u{i}", html, "\n\n".join([title, *paragraphs])))
    return pages


def test_extract(spark):
    rng = random.Random(4)
    train, other = made_pages(rng, 40), plain_pages(rng, 60, 200)
    pages = [p[:3] for p in train] + [(90, None, None), (91, "e", ""), (92, "u", PAGE), (93, "l", "<article>" + "<p>A long page of many words.</p>" * 20_000 + "</article>"), (None, "n", "<p>"), (5, train[5][1], train[5][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "7 AS size", "1 AS copy")
    assert len(markup.sample(df)) == 42 and sum(map(len, markup.sample(df, max_bytes=5000))) <= 5000  # the long page is none to train on
    model = markup.fit(df)
    got = {r.page_id: r for r in markup.extract(df, model, ["page_id", "url", "text"]).collect()}
    right = sum(got[i].text == want and got[i].n_chars == len(want) for i, _, _, want in train)
    assert right >= 38 and got[90].text == "" == got[91].text and got[None].text == ""
    assert got[93].n_blocks == 20_000
    assert markup.extract(df.limit(0), markup.fit(df.limit(0)), ["page_id"]).count() == 0
    # layouts that name nothing: blocks found of those wanted, and wanted of those found
    unseen = spark.createDataFrame([p[:3] for p in other], "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in markup.extract(unseen, model, ["page_id"]).collect()}
    both = sum(len(set(got[i]) & set(want.split("\n\n"))) for i, _, _, want in other)
    assert both >= 0.9 * sum(len(want.split("\n\n")) for *_, want in other) and both >= 0.9 * sum(map(len, got.values()))


def test_masked():
    page = markup.blocks("<main class=a><p id=b>x</main><div class=c>y</div>")
    assert [b.path for b in markup.masked(page, True, True)] == [(("div", ""), ("p", "")), (("div", ""),)]
    assert [b.path for b in markup.masked(page, False, True)] == [(("main", ""), ("p", "")), (("div", ""),)]


# --- 8

def brute_scores(rows, labels, k=15):
    """Scores before calibration from plain dictionaries: every term of every text, every example."""
    import math

    counts = {i: {} for i, _ in rows}
    for i, text in rows:
        for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            counts[i][w] = counts[i].get(w, 0) + 1
    df, total = {}, len(rows)
    for own in counts.values():
        for w in own:
            df[w] = df.get(w, 0) + 1
    known = {i: y for i, y in labels.items()}
    n = [sum(y == v for y in known.values()) for v in (0, 1)]
    seen = [{}, {}]
    for i, y in known.items():
        for w in counts[i]:
            seen[y][w] = seen[y].get(w, 0) + 1

    def weight(w):
        if w not in seen[0] and w not in seen[1]:
            return (math.log(1 + total) + 1) * 0.02
        part = [seen[0].get(w, 0), seen[1].get(w, 0)]
        rate, g = sum(part) / sum(n), 0
        for have, size in zip(part, n):
            g += have * math.log(have / (size * rate)) if have else 0
            g += (size - have) * math.log((size - have) / (size * (1 - rate))) if size > have else 0
        g = max(0, 2 * g)
        return (math.log((1 + total) / (1 + df[w])) + 1) * (0.02 + 0.98 * (g / (g + 30)) ** 2)

    def unit(own):
        v = {w: (1 + math.log(c)) * weight(w) for w, c in own.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = {i: unit(counts[i]) for i in known if counts[i]}
    prior, out = (n[1] + 0.5) / (sum(n) + 1), {}
    for i, _ in rows:
        if not counts[i]:
            continue
        own = unit(counts[i])
        near = sorted(((round(sum(x * v.get(w, 0) for w, x in own.items()), 6), known[j]) for j, v in vectors.items()), reverse=True)
        near = [(c, y) for c, y in near if c > 0 and c >= near[min(k, len(near)) - 1][0]]
        if not near:
            continue  # scored like a text without terms
        share = [(1 / (1.05 - min(c, 1)), y) for c, y in near]
        out[i] = (sum(w * y for w, y in share) + prior) / (sum(w for w, _ in share) + 1)
    return out


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(6)
    rows, labels = [], {}
    for i in range(400):
        bad = i % 8 == 0
        rows.append((i, sentence(rng, rng.randint(3, 60)) + (f" You {rng.choice(['Idiot', 'scum', 'moron'])}, {rng.choice(['loser', 'idiot', 'scum'])}!" if bad else "")))
        labels[i] = int(bad)
    rows += [(900, None), (901, ""), (902, "scum idiot"), (903, sentence(rng, 30000)), (904, "zzz unknown"), (905, rows[8][1]), (905, rows[8][1]), (None, "a loser and a scum")]
    return rows, labels


def test_toxicity(spark, toxic_rows):
    rows, labels = toxic_rows
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0.1D AS score", "'x' AS number").repartition(3)
    train = {i: y for i, y in labels.items() if i % 5}
    model = toxicity.fit(docs, spark.createDataFrame(list(train.items()), "doc_id long, toxic int"))
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) and "number" in found[0].__fields__
    got = {r.doc_id: r for r in found}
    held_out = {i: y for i, y in labels.items() if not i % 5}
    assert sum(got[i].predicted for i, y in held_out.items() if y) >= 0.9 * sum(held_out.values()) and sum(got[i].predicted for i, y in held_out.items() if not y) <= 2
    assert got[900].score == got[901].score < 0.5 < got[902].score and got[902].evidence and "scum" in got[902].matched
    # the same neighbours and votes as by brute force, whatever blocks are left out; ties at the k-th all vote
    expected = brute_scores(rows, train)
    for i, vote in expected.items():
        assert abs(toxicity._calibrated(model, vote) - got[i].score) < 1e-4, i


def test_toxicity_blocks(spark, toxic_rows, monkeypatch):
    """Small blocks, so that many are left out, and postings for all terms; the sample bounded by bytes."""
    monkeypatch.setattr(toxicity, "BLOCK", 2)
    monkeypatch.setattr(toxicity, "ROUND", 10)
    rows, labels = toxic_rows
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = {i: y for i, y in labels.items() if i % 5}
    known = spark.createDataFrame(list(train.items()) + [(None, 1), (1, None), (77777, 1)], "doc_id long, toxic int")
    for common in (2.0, 1 / 16):
        monkeypatch.setattr(toxicity, "COMMON", common)
        model = toxicity.fit(docs, known)
        import pyarrow as pa

        expected, read, every = brute_scores(rows, train), 0, 0
        for (h, n), (i, _) in zip(toxicity._counted(pa.array([t for _, t in rows], pa.string())), rows):
            if i in expected and len(h):
                tally = []
                assert abs(toxicity._vote(model, *toxicity.nearest(model, *toxicity._unit(model, h, n), tally=tally)) - expected[i]) < 1e-3
                read, every = read + tally[0], every + tally[1]
        assert read < every  # of blocks that are left out no posting is read
    few = toxicity.examples(docs, known, max_bytes=2000).collect()
    assert 1 < len(few) < len(train) and sum(len(r.text.encode()) for r in few) <= 2000
    assert toxicity.examples(docs, known, max_examples=7).count() == 7


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5, 0.5]
    assert toxicity.score(empty(spark), model).count() == 0


# --- 9

def test_warc(spark):
    pages = [(3, "u\nv", "same"), (1, None, "same"), (2, "u", None), (None, "n", "same"), (5, "w", ""), (7, "x", "é" * 99)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    index = warc.write_warc(df, archive_bytes=300)
    got = {r.page_id: r for r in warc.read_warc(index).collect()}
    assert len(got) == 6 and got[3].refers_to == 1 and got[5].refers_to == 2 and got[3].record_type == "revisit" and got[None].record_type == "response"
    for i, _, page in pages:
        data = (page or "").encode()
        assert got[i].payload_bytes == len(data) and got[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert got[i].payload is None if got[i].record_type == "revisit" else bytes(got[i].payload) == data
    assert warc.read_warc(index.where("page_id = 7")).count() == 1
    assert warc.read_warc(warc.write_warc(df.limit(0))).count() == 0
    assert warc.read_warc(warc.write_warc(df, revisit_bytes=1)).where("page_id = 5 AND record_type = 'response'").count() == 1


def test_warc_common_payload(spark, monkeypatch):
    """One payload of most rows, and a very long page."""
    monkeypatch.setattr(warc, "HOT_ROWS", 5)
    pages = [(k, "u", "<p>common</p>") for k in range(40)] + [(100 + k, "u", f"own {k // 2}") for k in range(6)] + [(None, None, "<p>common</p>"), (200, "l", "long " * 500_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4).selectExpr("*", "'clash' AS digest", "1 AS offset")
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_warc(warc.write_warc(df)).collect()), key=str)
    want = [(k, "revisit" if k else "response", 0 if k else None, 13) for k in range(40)] + [(100 + k, "revisit" if k % 2 else "response", 100 + k - 1 if k % 2 else None, 5) for k in range(6)] + [(None, "response", None, 13), (200, "response", None, 2_500_000)]
    assert got == sorted(want, key=str)


def test_coalesced():
    import numpy as np

    assert warc.coalesced(np.array([0, 10, 500, 505]), np.array([10, 10, 5, 5]), gap=100) == [(0, 2), (2, 4)]
    assert warc.coalesced(np.array([0, 10, 20]), np.array([10, 10, 10]), gap=100, most=20) == [(0, 2), (2, 3)]


# --- 10

def test_decontamination(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate((30, 20, 15, 13, 6, 3))] + [(7, None)]
    plain = [sentence(rng, 80) for _ in range(10)]
    changed = " ".join(w if k % 6 else "other" for k, w in enumerate(items[0][1].split()))
    texts = [f"{plain[0]} {items[1][1]} {plain[1]}", f"{plain[2]} {changed}", f"{items[4][1].upper()}!", f"{plain[3]} {' '.join(items[0][1].split()[:16])} {plain[4]}", *plain[5:], None, "", items[5][1]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    # the last text is the item of three terms as a whole; within other texts it would not count
    assert {r.doc_id: r["items"] for r in decontaminate.contaminated(df, bench).collect()} == {0: [1], 1: [0], 2: [4], 3: [0], len(texts) - 1: [5]}
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0 == decontaminate.contaminated(df, bench.limit(0)).count()


def test_decontamination_replaced_terms():
    """Random substitutions against brute force over all stretches of the passage's diagonal."""
    from types import SimpleNamespace

    import pyarrow as pa

    def hashes(words):
        return decontaminate.Words(pa.array([" ".join(words)]), lower=True, terms=True).hashes()

    def run(item, passage):
        before, after = ([f"other{rng.random()}".replace(".", "") for _ in range(15)] for _ in "ab")
        seeds = decontaminate._seeds([SimpleNamespace(item_id=1, text=" ".join(item))], 0.8)
        shorter = [len(item)] if len(item) < 9 else []
        return decontaminate._found(hashes(before + passage + after), seeds, shorter, 0.8, 13)

    rng = random.Random(12)
    item = [f"w{k}" for k in range(14)]
    assert run(item, [w if k != 3 else "new" for k, w in enumerate(item)]) == [(0, 15, 14, 13)]
    counted = 0
    for n in (4, 5, 6, 8, 9, 10, 12, 13, 14, 15, 17, 20, 25, 30):
        for _ in range(40):
            item, gone = [f"w{k}" for k in range(n)], set(rng.sample(range(n), rng.randint(0, n // 3)))
            got = run(item, [w if k not in gone else f"x{k}" for k, w in enumerate(item)])
            lengths = [b - a for a in range(n) for b in range(a + 1, n + 1) if 5 * sum(k not in gone for k in range(a, b)) >= 4 * (b - a)]
            want = max(lengths, default=0)
            assert [x[2] for x in got] == ([want] if want >= min(13, n) else []), (n, gone)
            counted += len(got)
    assert counted > 300


def test_decontamination_rows(spark):
    """Rows without an id or with a repeated one are told apart by their texts; short items count as whole lines; very long texts."""
    rng = random.Random(18)
    item, short = sentence(rng, 20), "Paris, France"
    rows = [(None, f"a b {item}"), (None, "clean"), (3, item), (3, item), (3, "clean, too"), (4, f"x\n{short.lower()}!\ny"), (5, f"in {short} it was"), (6, sentence(rng, 30000) + " " + item + " " + sentence(rng, 30000)), (7, f"{item[:60]} and no more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "9 AS item_id", "'z' AS copy").repartition(3)
    bench = spark.createDataFrame([(1, item), (2, short), (2, None), (None, "")], "item_id long, text string")
    got = sorted((str(r.doc_id), r["items"], r.n_overlaps) for r in decontaminate.contaminated(df, bench).collect())
    assert got == [("3", [1], 2), ("4", [2], 1), ("6", [1], 1), ("None", [1], 1)]
    kept = decontaminate.without_leaks(df, bench)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "5", "7", "None"]


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_SEEDS", 50)
    rng = random.Random(9)
    items = [(i, sentence(rng, 20)) for i in range(12)]
    df = spark.createDataFrame([(i, f"x {t} y") for i, t in items], "doc_id long, text string")
    got = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r["items"] for r in got} == {i: [i] for i, _ in items}


def test_components(spark, monkeypatch):
    from varlake.llm import common

    rng = random.Random(11)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(k, k + 1) for k in range(200, 260)] + [(5, 5), (300, 1000)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    expected = {n: find(n) for e in edges if e[0] != e[1] for n in e}
    df = spark.createDataFrame(edges, "src long, dst long")
    for small in (500_000, 0):
        monkeypatch.setattr(common, "SMALL", small)
        assert {r.node: r.component for r in common.components(df).collect()} == expected
        assert common.components(df.limit(0)).count() == 0


def test_stage_leaves_no_shuffle_files(spark):
    """A write's shuffle files go at its end, and the session's setting is as before."""
    def files():
        return {f for f in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data")}

    before = files()
    df = common.stage(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "test")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and {r.k: r["count"] for r in df.collect()} == {k: len(range(k, 1000, 7)) for k in range(7)}
    assert spark.conf.get(common.CLEANUP, None) is None or spark.conf.get(common.CLEANUP) == "false"


def test_sets_are_written_once(spark, monkeypatch):
    """A set that lies in several groups is not written for each of them, neither its bits nor its hashes, nor is a line."""
    written, stage = [], common.stage

    def noted(df, name):
        written.append((name, set(df.columns)))
        return stage(df, name)

    for module in (common, jaccard, lines):
        monkeypatch.setattr(module, "stage", noted)
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate([5, 45, 85, 125])] + [(9, "far from all of the others")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 5, 80, 100).items()}
    assert {r.doc_id for r in lines.dedup_lines(docs).where("n_removed = 0").collect()} == {0, 9}
    large = [columns for _, columns in written if columns & {"bits", "hashes", "normal"}]
    assert len(large) == 3 and not any("component" in columns for columns in large)
