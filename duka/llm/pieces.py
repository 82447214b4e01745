"""SentencePiece encoding and decoding through a table of distinct chunks.

The pieces of a model whose pieces never hold a whitespace marker after
another character cannot cross the start of a marked word. So the text
`▁a ▁b ▁▁c` falls into chunks (a run of markers and what follows), each
distinct chunk is segmented once per task by the sentencepiece library, and
the ids are joined back by position. Bytes of one character lie in one chunk,
so the decoded chunks concatenate to the decoded text, less the marker that
the library itself puts in front.

Whole texts are encoded; nothing is cut. A task holds the chunk table (begun anew
beyond `table_chunks`) and one slice of texts of about SLICE bytes, or one longer
text, whose new chunks are segmented in portions. No shuffle.

Defined results: null and empty text have no ids (0, the hash of the empty
string, decoded empty); repeated rows give repeated results; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from duka.llm.words import byte_slices

MARK = "▁"
SLICE = 1 << 20         # bytes of text that a task encodes at once
PORTION = 1 << 15       # chunks that are segmented at once
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def load(model: str):
    """The processor, after checking that chunks can be segmented alone."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    with open(model, "rb") as f:
        spec = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    n = spec.normalizer_spec
    crossing = any(MARK in p.piece.lstrip(MARK) for p in spec.pieces)
    if crossing or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix:
        raise ValueError("pieces of this model can cross whitespace markers, or its normaliser changes text")
    return sp


def split_chunks(texts: pa.Array) -> pa.LargeListArray:
    """Marked chunks of each text without their first marker (an empty text
    has none); a chunk with k markers starts with k - 1 spaces."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    lists = pc.split_pattern(texts, " ")
    odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.match_substring(texts, MARK), pc.or_(
        pc.starts_with(texts, " "), pc.or_(pc.ends_with(texts, " "), pc.equal(pc.binary_length(texts), 0)))))
    if not pc.any(odd).as_py():
        return lists
    # runs of spaces, marks in the text, empty texts: chunk by chunk
    out = []
    for text, rare, plain in zip(texts.to_pylist(), odd.to_pylist(), lists):
        if not rare:
            out.append(plain.values)
        elif text:
            found = _CHUNK.findall(MARK + text.replace(" ", MARK))
            out.append(pa.array([c[1:].replace(MARK, " ") for c in found], pa.large_string()))
        else:
            out.append(pa.array([], pa.large_string()))
    ends = np.cumsum([0, *map(len, out)])
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.concat_arrays(out))


class ChunkTable:
    """chunk -> (comma-joined ids, decoded chunk with its marker as a space, ids)."""

    def __init__(self, model: str, limit: int):
        self.sp, self.limit, self.rows = load(model), limit, {}

    def look_up(self, chunks: list[str]) -> list[tuple[str, str, int]]:
        if len(self.rows) > self.limit:
            self.rows.clear()
        rows = self.rows
        every = [c for c in chunks if c not in rows]
        for k in range(0, len(every), PORTION):
            new = every[k:k + PORTION]
            ids = self.sp.encode(new, num_threads=1)
            if "" in new:   # a marker alone, at the end of a text; the library gives an empty text no marker
                ids[new.index("")] = self.sp.encode("a ")[len(self.sp.encode("a")):]
            # a text of one mark less than the chunk: the library adds its own
            for c, i, back in zip(new, ids, self.sp.decode(ids)):
                rows[c] = (",".join(map(str, i)), " " + back if c else " ", len(i))
        return [rows[c] for c in chunks]


def encode_slice(texts: pa.Array, table: ChunkTable) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(comma-joined ids, decoded text, number of ids) of each text."""
    lists = split_chunks(texts)
    coded = lists.flatten().dictionary_encode()
    at = coded.indices
    rows = table.look_up(coded.dictionary.to_pylist())
    ids, back, n = zip(*rows) if rows else ((), (), ())
    ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))].astype(np.int64)

    def joined(values, separator):
        flat = pa.array(values, pa.string()).take(at)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), separator)

    counts = np.r_[0, np.cumsum(np.asarray(n, np.int64)[at.to_numpy(zero_copy_only=False)])]
    return joined(ids, ","), pc.utf8_slice_codeunits(joined(back, ""), 1), counts[ends[1:]] - counts[ends[:-1]]


SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, model: str | None = None, table_chunks: int = 100_000,
           keep_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, with
    `keep_text`, `ids` (comma-joined) and `decoded`."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model, table_chunks)
        for batch in byte_slices(batches, "text", SLICE):
            ids, back, n = encode_slice(batch.column("text"), table)
            digest = [[hashlib.sha256(x.encode()).hexdigest() for x in col.to_pylist()] for col in (ids, back)]
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), *map(pa.array, digest)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_text:
                columns, names = [*columns, ids.cast(pa.string()), back.cast(pa.string())], [*names, "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = SCHEMA + (", ids string, decoded string" if keep_text else "")
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, schema)


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of all documents."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
