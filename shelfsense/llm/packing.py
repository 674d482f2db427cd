"""Token packing: one stream of all documents, cut at every multiple of the sequence length."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.sources.session import stored

SEQUENCE = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
_KNOWN_PIECES = 200_000

# Texts of these characters are split alike by both tokenizer libraries; any other text goes to the slower one.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ſ–—‘-„…€]*")
_TWO_SPACES = re.compile(r"\s\s")

_loaded: dict = {}


def _tokenizers(json_path: str, ranks_path: str):
    """Both readers of the one vocabulary, loaded once per Python worker."""
    if json_path not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        specials = [t.content for t in full.get_added_tokens_decoder().values()]
        _loaded[json_path] = full, fast, specials, {}
    return _loaded[json_path]


def encode(text: str, json_path: str, ranks_path: str) -> bytes:
    """Token ids of a text as little-endian 16-bit numbers.

    Where no two white-space characters meet, each space starts a new piece for the merges, so pieces
    between spaces are encoded on their own and remembered.
    """
    full, fast, specials, known = _tokenizers(json_path, ranks_path)
    if not _PLAIN.fullmatch(text) or any(s in text for s in specials):
        return np.array(full.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
    if _TWO_SPACES.search(text):
        return np.array(fast.encode_ordinary(text), "<u2").tobytes()
    first, *pieces = text.split(" ")
    out = [np.array(fast.encode_ordinary(first), "<u2").tobytes()] if first else []
    for piece in pieces:
        ids = known.get(piece)
        if ids is None:
            if len(known) >= _KNOWN_PIECES:
                known.clear()
            ids = known[piece] = np.array(fast.encode_ordinary(" " + piece), "<u2").tobytes()
        out.append(ids)
    return b"".join(out)


_END = np.array([END_ID], "<u2").tobytes()
_TOKENS = "id {0}, task int, before long, n long, ids binary"
_PIECES = pa.schema([
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def _tokens_of(json_path: str, ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [encode(t or "", json_path, ranks_path) + _END for t in part.column(1).to_pylist()]
                n = [len(x) // 2 for x in ids]
                starts = before + np.cumsum([0, *n[:-1]])
                before += sum(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([task] * len(n), pa.int32()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["id", "task", "before", "n", "ids"],
                )
        for *_, known in _loaded.values():
            known.clear()  # the worker lives on and may serve other stages

    return run


def _cut(sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], [[] for _ in _PIECES]
            for i, (at, blob) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                ids = np.frombuffer(blob.as_buffer(), "<u2")
                edges = [0, *range(sequence - at % sequence, len(ids), sequence), len(ids)]
                for lo, hi in zip(edges, edges[1:]):
                    rows.append(i)
                    crc = zlib.crc32(ids[lo:hi].astype("<u4"))
                    values = (lo, hi - lo, crc, len(ids), (at + lo) // sequence, (at + lo) % sequence)
                    for column, value in zip(columns, values):
                        column.append(value)
            owner = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [owner, *(pa.array(c, pa.int64()) for c in columns)], names=["id", *_PIECES.names]
            )

    return run


def pack(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
) -> DataFrame:
    """Pieces of documents in fixed windows of one token stream.

    Returns per piece: the id, ``start, length, ids_crc32, doc_tokens, sequence_id, offset``. A document's
    tokens are its text's ids and then id 1, so a null or empty text is one token. Documents follow each other
    in the order the tasks read them; a document that crosses a window's end is a piece on each side. Every
    window but the last is full, which is the least padding there can be. Repeated rows are documents of
    their own; a null id stays null; other columns are not read; an empty table gives no piece.

    The first pass tokenises, adds up tokens inside each task and writes both down; the second adds up the
    tasks' totals, one row per task, and cuts. A task that runs again rewrites its own rows alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    tokens = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
            _tokens_of(json_path, ranks_path), _TOKENS.format(kind)
        ),
        "tokens",
    )
    totals = tokens.groupBy("task").agg(F.sum("n").alias("n"))
    # One row per task of the first pass, so a single task can add them up and all tasks can have them.
    through = F.sum("n").over(Window.orderBy("task"))
    firsts = F.broadcast(totals.select("task", (through - F.col("n")).alias("first")))
    placed = tokens.join(firsts, "task").select("id", (F.col("first") + F.col("before")).alias("at"), "ids")
    pieces = placed.mapInArrow(_cut(sequence), f"id {kind}, " + ", ".join(f"{n} long" for n in _PIECES.names))
    return pieces.withColumnRenamed("id", id_col)


def padding(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``sequences, tokens, padding``: a sequence is filled up to ``sequence`` unless its length is a power of two."""
    lengths = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.bit_count("n") == 1
    return lengths.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(power, 0).otherwise(sequence - F.col("n"))), F.lit(0)).alias("padding"),
    )
