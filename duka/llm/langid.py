"""Language ID by compression against per-language dictionaries.

A bounded sample of labelled documents (`docs_per_lang` documents, the least by a
hash of their id, `chars_per_doc` characters from the middle of each) becomes
one raw-content zstandard dictionary per language. A text is cut into pieces
of about `piece` bytes and every piece is compressed with each dictionary; the
language with the smallest sum wins. The score is 1 - best / second best; a
score below `margin` is a rejection.

The sample is the only thing gathered (bounded by languages x docs x chars);
prediction is one pass without a shuffle over whole texts.

Defined results: null text, or text without a letter: `und`, score 0,
rejected. Ties go to the language with more labelled rows, then the smaller
name. Without any labelled row every prediction is `und`. Repeated rows are predicted alike; an empty table
gives an empty result; `identify` ignores other columns, `identified` keeps
them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from duka.llm.words import byte_slices

DOCS_PER_LANG = 96
CHARS_PER_DOC = 1_000
PIECE = 1_024
MARGIN = 0.002
_LETTER = re.compile(r"[^\W\d_]")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def train(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, chars_per_doc: int = CHARS_PER_DOC) -> dict[str, bytes]:
    """lang -> dictionary content, from `docs` with text and lang; the
    language with most rows comes first."""
    ids = docs.where("lang is not null and text is not null and doc_id is not null").select(
        F.col("lang").cast("string"), F.col("doc_id").cast("bigint"))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, list] = {}
        for batch in batches:
            for lang, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                best.setdefault(lang, []).append((zlib.crc32(b"lang %d" % i), i))
            best = {k: sorted(v)[:docs_per_lang] for k, v in best.items()}
        rows = [(k, h, i) for k, v in best.items() for h, i in v]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.int64())], ["lang", "h", "doc_id"])

    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = ids.mapInArrow(least, "lang string, h bigint, doc_id bigint") \
        .withColumn("k", F.row_number().over(order)).where(F.col("k") <= docs_per_lang).collect()
    wanted = sorted({r.doc_id for r in picked})
    if not wanted:
        return {}
    middle = F.greatest(F.lit(1), (F.length("text") - chars_per_doc).cast("bigint") / 2).cast("int")
    rows = docs.where("lang is not null and text is not null").where(F.col("doc_id").isin(wanted)).select(
        F.col("lang").cast("string").alias("lang"), "doc_id",
        F.substring(F.lower("text"), middle, F.lit(chars_per_doc)).alias("part")).distinct().collect()
    count = {r.lang: r["count"] for r in ids.groupBy("lang").count().collect()}
    out: dict[str, list[str]] = {k: [] for k in sorted(count, key=lambda k: (-count[k], k))}
    for r in sorted(rows, key=lambda r: (r.lang, r.doc_id, r.part)):
        out[r.lang].append(r.part)
    return {k: "\n".join(v).encode() for k, v in out.items() if v}


class Classifier:
    """Compresses pieces of a text with every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], piece: int = PIECE):
        import zstandard
        self.piece, self.coders = piece, {}
        # short matches count (4 bytes); no headers, so that sizes are the text's alone
        params = zstandard.ZstdCompressionParameters(
            window_log=18, chain_log=16, hash_log=17, search_log=4, min_match=4, target_length=16,
            strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        for lang, content in dictionaries.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.coders[lang] = zstandard.ZstdCompressor(dict_data=d, compression_params=params)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); und when there is nothing to go by."""
        if not self.coders or not text or not _LETTER.search(text):
            return "und", 0.0
        data = b" " + text.lower().encode()
        parts = [data[k:k + self.piece] for k in range(0, len(data), self.piece)]
        sizes = sorted((sum(len(c.compress(p)) for p in parts), k, lang)
                       for k, (lang, c) in enumerate(self.coders.items()))
        return sizes[0][2], 1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """Per document: doc_id, lang_pred, score, rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries)
        for batch in byte_slices(batches, "text"):
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[0] == "und" or f[1] < margin for f in found])],
                ["doc_id", "lang_pred", "score", "rejected"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text") \
        .mapInArrow(run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """The rows of `docs` (all their columns) that are not rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries)
        for batch in byte_slices(batches, "text"):
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([f[0] != "und" and f[1] >= margin for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of all documents; learnt
    only from documents outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(fold("doc_id", 4) != 2))
    out = identify(docs, model)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
