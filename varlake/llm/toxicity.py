"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index.

Fitting takes a bounded sample of labelled rows. Every term of a text and of the examples counts; a term's weight is its IDF over all
documents, more for terms whose document frequency differs between the labels. Scoring finds each document's k
nearest examples exactly: blocks of examples are visited in order of their upper bound, which block maxima give, and the
search ends when no block left can beat the k-th. Votes weighted by distance are calibrated by a logistic curve
that is fitted on leave-one-out votes of the examples.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.llm.arrays import Words, ranges, signed, slices
from varlake.llm.common import stage

#: Labelled rows that a model is fitted on at most, and bytes of their texts: the bounds of what is broadcast.
MAX_EXAMPLES, MAX_EXAMPLE_BYTES = 4096, 16 << 20
#: Neighbours that vote.
NEIGHBOURS = 15
#: Examples in a block of the index, and blocks that are looked at before the next bound is.
BLOCK, ROUND = 32, 16
#: A term without any contrast between the labels still has this share of its IDF as weight; G statistic that gives half of the
#: rest, before it is squared.
LEAST, HALF = 0.02, 30.0
#: Terms of at least this share of the examples have a column of their own instead of postings.
COMMON = 1 / 16


@dataclass
class Model:
    terms: np.ndarray  # sorted 64-bit hashes of the examples' terms
    weight: np.ndarray  # of each term
    unknown: float  # weight of any other term
    ids: np.ndarray  # doc_id of each example
    labels: np.ndarray
    number: np.ndarray  # where each example of the sample stands in the index
    column: np.ndarray  # column of each common term, -1: it has postings
    dense: np.ndarray  # common terms x examples
    dense_most: np.ndarray  # common terms x blocks
    block_at: np.ndarray  # entries of term t, one for each block that has it, are block_at[t] to block_at[t + 1]
    block: np.ndarray
    most: np.ndarray  # the largest unit weight in the block
    at: np.ndarray  # postings of entry e are at[e] to at[e + 1]
    example: np.ndarray
    own: np.ndarray  # unit weights of the postings
    prior: float
    empty: float  # score of a text without terms
    curve: tuple[float, float] = (0.0, 1.0)
    k: int = NEIGHBOURS


def _counted(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct terms (hashes) and how often each occurs."""
    words = Words(column, lower=True, terms=True)
    h = words.hashes()
    for lo, hi in zip(words.first[:-1], words.first[1:]):
        yield np.unique(h[lo:hi], return_counts=True)


def _known(terms: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the terms among h that the model has, and which of h they are."""
    if not len(terms):
        return np.zeros(0, int), np.zeros(0, int)
    at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
    on = np.flatnonzero(terms[at] == h)
    return at[on], on


def _unit(model: Model, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and unit weights of a text's known terms; its unknown ones count in the norm."""
    at, on = _known(model.terms, h)
    tf = 1 + np.log(n)
    weight = tf * model.unknown
    weight[on] = tf[on] * model.weight[at]
    norm = math.sqrt(float(weight @ weight))
    return at, weight[on] / norm if norm else weight[on]


def nearest(model: Model, terms: np.ndarray, weights: np.ndarray, skip: int = -1, tally: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and cosines of the k nearest examples with a cosine above 0, and of all others as near as the k-th.

    Exact: a block is left out only if its upper bound, the query's weights times the block's largest weights,
    is below the k-th cosine found. Of a block that is left out no posting is read. Cosines are compared to six digits.
    tally, if given, gets the number of postings read and that of all postings of the terms.
    """
    column = model.column[terms]
    common, rare = column >= 0, column < 0
    column, wide = column[common], weights[common].astype(np.float32)
    terms, weights = terms[rare], weights[rare]
    size = model.block_at[terms + 1] - model.block_at[terms]
    entry, weights = ranges(model.block_at[terms], size), np.repeat(weights, size)
    block, count = model.block[entry], model.at[entry + 1] - model.at[entry]
    bound = wide @ model.dense_most[column] + np.bincount(block, model.most[entry] * weights, model.dense_most.shape[1])
    order = np.argsort(-bound, kind="stable")
    found, cosines, least, read = [], [], 0.0, 0
    for visit in (order[:ROUND], order[ROUND:]):
        visit = visit[(bound[visit] >= least - 2e-6) & (bound[visit] > 0)]
        if not len(visit):
            break
        on = np.zeros(len(order), bool)
        on[visit] = True
        own = np.flatnonzero(on[block])
        at = ranges(model.at[entry[own]], count[own])
        rest = np.bincount(model.example[at], model.own[at] * np.repeat(weights[own], count[own]), len(model.labels))
        read += len(at)
        if len(visit) * 2 < len(order):
            examples = (visit[:, None] * BLOCK + np.arange(BLOCK)).reshape(-1)
            examples = examples[examples < len(model.labels)]
            dense = wide @ model.dense[column[:, None], examples]
        else:  # most blocks: all, of which those that were seen count for nothing
            examples = np.flatnonzero(np.repeat(on, BLOCK)[: len(model.labels)])
            dense = (wide @ model.dense[column])[examples]
        cosine = np.round(dense + rest[examples], 6)
        keep = np.flatnonzero((cosine > 0) & (cosine >= least) & (examples != skip))
        found.append(examples[keep])
        cosines.append(cosine[keep])
        every = np.concatenate(cosines)
        if len(every) >= model.k:
            least = float(np.partition(every, len(every) - model.k)[len(every) - model.k])
    if tally is not None:
        tally += [read, int(count.sum())]
    found, cosines = (np.concatenate(x) if x else np.zeros(0) for x in (found, cosines))
    on = np.flatnonzero(cosines >= least)
    on = on[np.lexsort((found[on], -cosines[on]))]
    return found[on].astype(int), cosines[on]


def _vote(model: Model, at: np.ndarray, cosine: np.ndarray) -> float:
    """Share of label 1 among the neighbours, each weighted by the inverse of its distance."""
    weight = 1 / (1.05 - np.minimum(cosine, 1))
    return float((weight @ model.labels[at] + model.prior) / (weight.sum() + 1))


def _calibrated(model: Model, vote: float) -> float:
    a, b = model.curve
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * (vote - 0.5)))))


def _curve(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from votes to probabilities (Platt's smoothed targets, Newton steps)."""
    if not 0 < labels.sum() < len(labels):
        return 0.0, 8.0
    up, down = (labels.sum() + 1) / (labels.sum() + 2), 1 / (len(labels) - labels.sum() + 2)
    target, x = np.where(labels > 0, up, down), np.stack([np.ones(len(votes)), votes - 0.5])
    w = np.array([0.0, 4.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-2 * np.eye(2), x @ (target - p) - 1e-2 * (w - [0, 4]))
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def examples(documents: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_bytes: int = MAX_EXAMPLE_BYTES) -> DataFrame:
    """The bounded sample (number, doc_id, toxic, text): labelled documents in the order of a hash of doc_id, at most max_examples,
    and as many as max_bytes of text hold (one at least). Rows of equal doc_id and text are one."""
    chosen = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = F.broadcast(chosen.orderBy(*order).limit(max_examples))  # at most max_examples rows
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("copy", F.xxhash64("text"))
    keys = texts.join(chosen, "doc_id").groupBy("doc_id", "copy").agg(F.max("toxic").alias("toxic"), F.max(F.octet_length("text")).cast("long").alias("size"))
    # windows over at most max_examples rows
    by = W.orderBy(*order, "copy")
    keys = keys.orderBy(*order, "copy").limit(max_examples).withColumns({"number": F.row_number().over(by), "upto": F.sum("size").over(by)})
    keys = stage(keys.where((F.col("upto") <= max_bytes) | (F.col("number") == 1)).select("doc_id", "copy", "toxic", "number"), "chosen")
    sample = texts.join(F.broadcast(keys), ["doc_id", "copy"]).dropDuplicates(["number"])
    return sample.select("number", "doc_id", "toxic", "text")


def fit(documents: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, k: int = NEIGHBOURS, contrast: bool = True) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic 0 or 1). Without contrast a term weighs its IDF alone,
    whatever the labels of the examples that have it.

    Repeated labels of a document: the largest counts. Null labels and ids are left out; null texts are empty.
    Without usable labels every text gets 0.5; with one label only, nearly that label.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = list(_counted(batch.column("text")))
            number = np.repeat(batch.column("number").to_numpy(), [len(h) for h, _ in found])
            yield pa.record_batch([pa.array(number, pa.int32()), signed(np.concatenate([h for h, _ in found])), pa.array(np.concatenate([n for _, n in found]), pa.int32())], names=["number", "term", "n"])

    sample = stage(examples(documents, labels, max_examples), "examples")
    known = sample.select("number", "doc_id", "toxic").orderBy("number").toArrow()  # max_examples rows at most
    ids, toxic = known.column("doc_id").to_numpy(), known.column("toxic").to_numpy().astype(float)
    row = np.full(int(known.column("number").to_numpy().max(initial=0)) + 1, -1)
    row[known.column("number").to_numpy()] = np.arange(len(ids))
    found = sample.select("number", "text").mapInArrow(counted, "number int, term long, n int").toArrow()  # of max_bytes of text
    terms, at = np.unique(found.column("term").to_numpy().view(np.uint64), return_inverse=True)
    example, tf = row[found.column("number").to_numpy()], 1 + np.log(found.column("n").to_numpy())

    frequency, total = document_frequencies(documents, terms)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    weight = idf * _contrast(at, toxic[example], len(terms), toxic) if contrast else idf
    unknown = (math.log(1 + total) + 1) * (LEAST if contrast else 1)
    model = _index(terms, weight, unknown, ids, toxic, example, at, tf, k)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by max_examples and max_bytes

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, "text"):
            own = []
            for number, (h, n) in zip(row[batch.column("number").to_numpy()], _counted(batch.column("text"))):
                own.append(_vote(m, *nearest(m, *_unit(m, h, n), skip=int(m.number[number]))) if len(h) else None)
            yield pa.record_batch([batch.column("toxic"), pa.array(own, pa.float64())], names=["toxic", "vote"])

    left_out = sample.select("number", "toxic", "text").mapInArrow(votes, "toxic int, vote double").where("vote IS NOT NULL").toArrow()
    shared.destroy()
    model.curve = _curve(left_out.column("vote").to_numpy(), left_out.column("toxic").to_numpy())
    return model


def _contrast(term: np.ndarray, toxic: np.ndarray, n_terms: int, labels: np.ndarray) -> np.ndarray:
    """LEAST to 1 for each term, by the G statistic of its document frequencies under the two labels."""
    size = np.array([[(labels == 0).sum()], [(labels > 0).sum()]], float)
    if not size.all():
        return np.full(n_terms, LEAST)
    counts = np.stack([np.bincount(term[toxic == 0], minlength=n_terms), np.bincount(term[toxic > 0], minlength=n_terms)]).astype(float)
    rate = counts.sum(0) / size.sum()

    def log_ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.where(part > 0, part * np.log(np.maximum(part, 1e-12) / np.maximum(whole, 1e-12)), 0)

    g = np.maximum(0, 2 * (log_ratio(counts, size * rate) + log_ratio(size - counts, size * (1 - rate))).sum(0))
    return LEAST + (1 - LEAST) * (g / (g + HALF)) ** 2


def _index(terms: np.ndarray, weight: np.ndarray, unknown: float, ids: np.ndarray, toxic: np.ndarray, example: np.ndarray, at: np.ndarray, tf: np.ndarray, k: int) -> Model:
    """The block-max index of the examples that have terms: (example, at, tf) says that an example has a term, and its damped count."""
    own = tf * weight[at]
    norm = np.sqrt(np.bincount(example, own * own, minlength=len(ids)))
    own = own / norm[example]
    # like examples side by side, so that the bounds of blocks are tight: in order of their heaviest term
    first = np.lexsort((own, example))[np.cumsum(np.bincount(example, minlength=len(ids)))[norm > 0] - 1]
    has = np.flatnonzero(norm > 0)
    has = has[np.lexsort((ids[has], own[first], at[first]))]
    number = np.full(len(ids), -1)
    number[has] = np.arange(len(has))
    none = toxic[norm == 0]
    prior = float((toxic.sum() + 0.5) / (len(toxic) + 1))
    frequency = np.bincount(at, minlength=len(terms))
    common = np.flatnonzero(frequency > max(BLOCK, COMMON * len(ids)))
    column = np.full(len(terms), -1)
    column[common] = np.arange(len(common))
    blocks = -(-len(has) // BLOCK)
    dense = np.zeros((blocks * BLOCK, len(common)), np.float32)
    on = column[at] >= 0
    dense[number[example[on]], column[at[on]]] = own[on]
    at, example, own = at[~on], number[example[~on]], own[~on]
    order = np.lexsort((example, at))
    at, example, own = at[order], example[order], own[order]
    pair = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (example[1:] // BLOCK != example[:-1] // BLOCK))) if len(at) else np.zeros(0, int)
    return Model(
        terms, weight, unknown, ids[has], toxic[has], number, column, np.ascontiguousarray(dense[: len(has)].T), np.ascontiguousarray(dense.reshape(blocks, BLOCK, len(common)).max(1).T),
        np.searchsorted(at[pair], np.arange(len(terms) + 1)), example[pair] // BLOCK, np.maximum.reduceat(own, pair) if len(pair) else own,
        np.append(pair, len(at)), example, own, prior, float((none.sum() + prior) / (len(none) + 1)), k=k,
    )


def document_frequencies(documents: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all documents each of terms (sorted) occurs, and the number of documents. One sum for each term and task is
    shuffled; tasks are as many as four times the cores at most, so that this does not grow with the documents."""
    context = documents.sparkSession.sparkContext
    shared = context.broadcast(terms)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n = shared.value, 0
        counts = np.zeros(len(terms) + 1, np.int64)
        for batch in slices(batches, "text"):
            n += batch.num_rows
            own = np.concatenate([h for h, _ in _counted(batch.column("text"))])
            counts += np.bincount(_known(terms, own)[0], minlength=len(terms) + 1)
        counts[-1] = n
        on = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(on, pa.int64()), pa.array(counts[on])], names=["term", "n"])

    rows = documents.select("text").coalesce(4 * context.defaultParallelism).mapInArrow(tally, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    out = np.zeros(len(terms) + 1, np.int64)
    out[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return out[:-1], int(out[-1])


RESULT = "score double, predicted int, evidence array<struct<doc_id: bigint, similarity: double, label: int>>, matched array<string>"


def score(documents: DataFrame, model: Model, keep: list[str] | None = None, evidence: int = 3) -> DataFrame:
    """The columns named in keep (all, if None) with score, predicted (score >= 0.5), evidence (the nearest examples, so many) and
    matched (the terms of the text that count most, as many). Only text decides. A null text is an empty one; texts without terms
    have the share of label 1 among such examples. Repeated rows are scored each by itself. Columns of the input
    with these names give way."""
    names = [f.name for f in T._parse_datatype_string(RESULT)]
    keep = [c for c in (documents.columns if keep is None else keep) if c not in names]
    # a column may be called text as well as be kept: the copy to be scored has a name of its own
    source = documents.select(*keep, F.col("text").alias("__text"))
    schema = T.StructType([*documents.select(*keep).schema.fields, *T._parse_datatype_string(RESULT).fields])
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_EXAMPLES and MAX_EXAMPLE_BYTES
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, "__text"):
            scores, near, matched = [], [], []
            words = Words(batch.column("__text"), lower=True, terms=True)
            hashes = words.hashes()
            for lo, hi in zip(words.first[:-1], words.first[1:]):
                h, n = np.unique(hashes[lo:hi], return_counts=True)
                terms, weights = _unit(m, h, n)
                at, cosine = nearest(m, terms, weights) if len(h) and len(m.labels) else ((), ())
                scores.append(_calibrated(m, _vote(m, at, cosine)) if len(at) else m.empty)
                near.append([{"doc_id": int(m.ids[i]), "similarity": float(c), "label": int(m.labels[i])} for i, c in zip(at[:evidence], cosine)])
                heavy = terms[np.lexsort((terms, -weights))[:evidence]] if evidence else ()
                matched.append([words.text(lo + int(np.argmax(hashes[lo:hi] == m.terms[t]))).lower() for t in heavy])
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(near, kind), pa.array(matched, pa.list_(pa.string()))]
            yield pa.record_batch(columns, names=[f.name for f in schema])

    return source.mapInArrow(scored, schema)
