"""Language-model scores of documents.

Words are lower-cased and cut into subword ids of a public tokenizer; a causal
self-attention model (`attention.py`) gives their log10 probability. Windows
of 32 positions overlap by 16 and score each token once.

Gathered from the whole corpus: the counts of all training words (they give the
base score, and the subword frequencies that are the model's prior), and the
attention weights, which learn every window of every training document. The
training is data-parallel: in each of ROUNDS rounds every task goes on from the
common weights with its share of its own windows, and the tasks' weights are
averaged by windows learned. Each window is learned once; a corpus of fewer
than STEPS batches is repeated. The averages, and so the scores, depend on how
the rows are dealt to tasks.

1. A task turns the documents of a chunk (about CHUNK bytes of text) into word
   codes, with the chunk's distinct words and their subword ids; the table is
   written once.
2. The distinct words of all chunks (not every word of every document) are
   counted and joined back: per chunk the corpus count of each of its words.
3. The rounds of the training read the chunks' codes.
4. A chunk's codes and counts meet in one task that scores its documents.

Defined results: null text is the empty text (one end token); a null doc_id
is a training row; without training rows the base is log10(1) = 0 for each
token and the model is untrained; repeated rows count and score like others;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duka.llm import attention
from duka.llm.pieces import default_model, load
from duka.llm.scratch import Scratch
from duka.llm.words import byte_slices, ragged, word_codes

ROUNDS = 4
STEPS = 1_000       # batches that a small corpus is repeated to
LEARNER = 2 << 20   # training words of a task, at least
BLOCK = 1 << 18     # words or tokens that are cut into windows at once
CHUNK = 32 << 20
BATCH = 1 << 10     # windows scored at once
SLAB = 1 << 14      # windows laid out at once
PORTION = 1 << 15   # words segmented at once


def squeezed(x: np.ndarray) -> bytes:
    """Compressed int32."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(x.astype(np.int32).tobytes())


def restored(x: pa.Scalar) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), np.int32)


def chunks(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per chunk: chunk, doc_ids, held, ends (of each document in
    codes), codes, words, lengths and ids (subwords of the words), counts (in
    training documents). Codes, lengths and ids are compressed."""
    model = model or default_model()

    def packed(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        offsets, codes, words = word_codes(pc.cast(t.column("text"), pa.large_string()).combine_chunks())
        out = t.column("held").to_numpy(zero_copy_only=False)
        training = ~np.repeat(out, np.diff(offsets))
        counts = np.bincount(codes[training], minlength=len(words))
        starts, ids = subwords(words, model)
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([t.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            pa.array([out.tolist()], pa.list_(pa.bool_())), pa.array([offsets[1:]], pa.list_(pa.int64())),
            pa.array([squeezed(codes)], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
            pa.array([squeezed(np.diff(starts))], pa.binary()), pa.array([squeezed(ids)], pa.binary()),
            pa.array([counts], pa.list_(pa.int64()))],
            ["chunk", "doc_ids", "held", "ends", "codes", "words", "lengths", "ids", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in byte_slices(batches, "text", CHUNK):
            n = batch.column("text").nbytes
            if held and size + n > CHUNK:
                yield packed(part + k, held)
                k, held, size = k + 1, [], 0
            held, size = [*held, batch], size + n
        if held:
            yield packed(part + k, held)

    return docs.mapInArrow(run, "chunk bigint, doc_ids array<bigint>, held array<boolean>, ends array<bigint>, "
                                "codes binary, words array<string>, lengths binary, ids binary, counts array<bigint>")


def subwords(words: pa.Array | list[str], model: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids): the subword ids of each word, PORTION words at a time."""
    n, ids = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
    for k in range(0, len(words), PORTION):
        part = words[k:k + PORTION]
        got = load(model).encode(part if isinstance(part, list) else part.to_pylist(), num_threads=1)
        n.append(np.fromiter(map(len, got), np.int64, len(got)))
        ids.append(np.fromiter(chain.from_iterable(got), np.int32, int(n[-1].sum())))
    return np.cumsum(np.concatenate(n)), np.concatenate(ids)


def subword_counts(coded: DataFrame, size: int) -> DataFrame:
    """(id, n) of all subword ids (below `size`) of the chunks' training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                n, ids = (restored(batch.column(c)[k]) for c in ("lengths", "ids"))
                np.add.at(total, ids, np.repeat(batch.column("counts")[k].values.to_numpy(), n))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["id", "n"])

    return coded.select("lengths", "ids", "counts").mapInArrow(run, "id bigint, n bigint") \
        .groupBy("id").agg(F.sum("n").alias("n"))


def streams(offsets: np.ndarray, codes: np.ndarray, starts: np.ndarray, ids: np.ndarray, end_id: int):
    """Flat subword ids of the documents, each closed by `end_id`, and their ends."""
    # the end is one more word
    docs, words = len(offsets) - 1, len(starts) - 1
    closed = np.full(len(codes) + docs, words, np.int64)
    body = np.ones(len(closed), bool)
    body[offsets[1:] + np.arange(docs)] = False
    closed[body] = codes
    n = np.r_[np.diff(starts), 1][closed]
    after = np.cumsum(n)
    flat = np.repeat(np.r_[starts[:-1], len(ids)][closed] - (after - n), n)
    flat += np.arange(len(flat))
    return np.r_[ids, end_id].astype(np.int32)[flat], after[offsets[1:] + np.arange(docs)]


def inputs(flat: np.ndarray, ends: np.ndarray, vocabulary: attention.Vocabulary) -> np.ndarray:
    """Input rows: the token before, or the start of a text."""
    before = np.r_[0, vocabulary.input[flat[:-1]]] if len(flat) else vocabulary.input[flat]
    before[np.r_[0, ends[:-1]]] = attention.BEGIN
    return before


def score_texts(weights: dict, vocabulary: attention.Vocabulary, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log10 probability of each text."""
    before, out = inputs(flat, ends, vocabulary), np.zeros(len(ends))
    owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    classes, scores = vocabulary.output[flat], attention.Scorer(weights)
    total = int(attention.count(ends).sum())
    for j in range(0, total, SLAB):
        at, inside, live = attention.windows(ends, np.arange(j, min(total, j + SLAB)))
        for k in range(0, len(at), BATCH):
            a, on = at[k:k + BATCH], live[k:k + BATCH]
            own = a[:, attention.CONTEXT:]
            got = scores(before[a], inside[k:k + BATCH], classes[own])
            out += np.bincount(owner[own][on], got[on], len(ends))
    out += np.bincount(owner, vocabulary.inside[flat], len(ends))
    return out / np.log(10)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, codes) of a chunk's documents."""
    return np.r_[0, row["ends"].values.to_numpy()].astype(np.int64), restored(row["codes"])


def tabled(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids): the subword ids of a chunk's words."""
    return np.r_[0, np.cumsum(restored(row["lengths"]), dtype=np.int64)], restored(row["ids"])


def doc_slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Document ranges of about BLOCK words."""
    docs = len(offsets) - 1
    cuts = np.unique(np.r_[np.searchsorted(offsets, np.arange(0, offsets[-1] + 1, BLOCK)), docs])
    return ((a, b) for a, b in zip(np.r_[0, cuts[:-1]].tolist(), cuts.tolist()) if a < b)


def training_streams(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Subword streams (ids, ends) of the chunks' documents that are not held out, about BLOCK tokens each."""
    end_id, held, size = load(model).eos_id(), [], 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        before = np.cumsum([0, *[len(f) for f, _ in held[:-1]]])
        return np.concatenate([f for f, _ in held]), np.concatenate([e + n for (_, e), n in zip(held, before)])

    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in ("held", "ends", "codes", "lengths", "ids")}
            offsets, codes = unpacked(row)
            table = tabled(row)
            taught = ~row["held"].values.to_numpy(zero_copy_only=False)
            n = np.diff(offsets)
            for a, b in doc_slices(offsets):
                own = codes[offsets[a]:offsets[b]][np.repeat(taught[a:b], n[a:b])]
                flat, ends = streams(np.r_[0, np.cumsum(n[a:b][taught[a:b]])], own, *table, end_id=end_id)
                held, size = [*held, (flat, ends)], size + len(flat)
                if size >= BLOCK:
                    yield joined()
                    held, size = [], 0
    if size:
        yield joined()


def lesson(coded: DataFrame, weights: dict, vocabulary: attention.Vocabulary, k: int, words: int, model: str) -> DataFrame:
    """Round k: (task, n, weights): windows learned and the weights after them, of each task. `words`: of all training documents."""
    tasks = max(1, words // LEARNER)
    repeat, most = -(-STEPS * 192 * attention.STRIDE // max(1, words)), max(1, STEPS // ROUNDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, n, done = attention.Learner(weights), 0, 0
        for flat, ends in training_streams(batches, model):
            part = min(1.0, len(flat) * tasks / words)      # of this task's round, about
            n += learner.learn(inputs(flat, ends, vocabulary), vocabulary.output[flat], ends, (k, ROUNDS), repeat, most,
                               (k + min(1.0, done)) / ROUNDS, part / ROUNDS, seed=7 + len(flat))
            done += part
        if n:
            data = np.concatenate([w.reshape(-1) for w in learner.p.values()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([data.tobytes()], pa.binary())], ["task", "n", "weights"])

    return coded.select("held", "ends", "codes", "lengths", "ids").coalesce(tasks).mapInArrow(
        run, "task bigint, n bigint, weights binary")


def merged(lessons: DataFrame, tasks: int) -> DataFrame:
    """(g, n, total): sums of windows and of weights times windows, for groups of about sqrt(tasks) tasks."""
    groups = int(np.ceil(np.sqrt(max(1, tasks))))

    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("task")
        n = t.column("n").to_pylist()
        total = sum(np.frombuffer(w, np.float32) * np.float64(k) for w, k in zip(t.column("weights").to_pylist(), n))
        return pa.table({"g": t.column("g")[:1], "n": pa.array([sum(n)], pa.int64()),
                         "total": pa.array([total.tobytes()], pa.binary())})

    return lessons.withColumn("g", F.col("task") % groups).groupBy("g").applyInArrow(add, "g bigint, n bigint, total binary")


def fit(coded: DataFrame, counts: np.ndarray, words: int, model: str) -> tuple[dict, attention.Vocabulary]:
    """The model of all documents of the chunks that are not held out."""
    vocabulary = attention.Vocabulary(counts)
    weights = attention.initial(vocabulary.prior)
    for k in range(ROUNDS if words else 0):
        rows = sorted(merged(lesson(coded, weights, vocabulary, k, words, model), words // LEARNER).collect())
        n = sum(r.n for r in rows)
        if not n:
            continue
        flat = sum(np.frombuffer(r.total, np.float64) for r in rows) / n
        cuts = np.cumsum([w.size for w in weights.values()])[:-1]
        weights = {name: x.astype(np.float32).reshape(weights[name].shape) for name, x in zip(weights, np.split(flat, cuts))}
    return weights, vocabulary


SCHEMA = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def score(docs: DataFrame, held_out: Column, scratch: Scratch, model: str | None = None) -> DataFrame:
    """Base and model scores of every document; rows where `held_out` is true
    teach neither."""
    model = model or default_model()
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                    F.coalesce(held_out, F.lit(False)).alias("held"))
    coded = scratch.cut(chunks(d, model))
    words = coded.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w")).select(
        "chunk", "pos", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts = scratch.cut(words.groupBy("word").agg(F.sum("n").alias("c")))
    known = counts.where("c > 0")
    documents = coded.select(F.aggregate("held", F.lit(0), lambda a, x: a + F.when(x, 0).otherwise(1)).alias("n")) \
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    sums = known.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums.n + documents, sums.v + (documents > 0)
    vector = np.zeros(load(model).get_piece_size(), np.int64)
    for r in subword_counts(coded, len(vector)).collect():    # one row for each subword of the vocabulary at most
        vector[r.id] = r.n
    vector[load(model).eos_id()] += documents
    weights, vocabulary = fit(coded, vector, total, model)
    end_id, floor = load(model).eos_id(), np.log10(total + 0.5 * (distinct + 1)) if total else np.log10(0.5)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def chunk(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        row = {c: left.column(c)[0] for c in left.column_names}
        listed = {c: row[c].values for c in ("doc_ids", "held")}
        offsets, codes = unpacked(row)
        starts, ids = tabled(row)
        c = np.zeros(len(starts) - 1, np.int64)
        c[right.column("pos").to_numpy()] = right.column("c").to_numpy()
        n, docs_ = np.diff(offsets), len(offsets) - 1
        owner = np.repeat(np.arange(docs_), n)
        base = np.bincount(owner, (np.log10(c + 0.5) - floor)[codes], docs_) + (np.log10(documents + 0.5) - floor)
        known_ = np.bincount(owner, (c > 0)[codes], docs_).astype(np.int64) + (documents > 0)
        got = np.zeros(docs_)
        for a, b in doc_slices(offsets):
            flat, ends = streams(offsets[a:b + 1] - offsets[a], codes[offsets[a]:offsets[b]], starts, ids, end_id)
            got[a:b] = score_texts(weights, vocabulary, flat, ends)
        return pa.table([listed["doc_ids"], listed["held"], pa.array(n + 1), pa.array(known_),
                         pa.array(np.full(docs_, total), pa.int64()), pa.array(base), pa.array(got)], schema=schema)

    back = words.select("chunk", "pos", "word").join(counts, "word").select(
        F.col("chunk").alias("part"), "pos", "c")
    return coded.select("chunk", "doc_ids", "held", "ends", "codes", "lengths", "ids").groupBy("chunk").cogroup(
        back.groupBy("part")).applyInArrow(chunk, SCHEMA).select(*names)


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those with crc32(doc_id) mod 5 = 1 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return score(docs, held, Scratch(spark, "lm"))
