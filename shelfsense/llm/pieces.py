"""SentencePiece BPE: exact encoding by a table over prefixes, and decoding.

The encoding of a text is fixed, hence so is the last token of each of its prefixes. A token can be that last one
only if it ends the prefix (an automaton over the vocabulary lists these) and if it stays apart from the last token of
the prefix before it: a merge across that border must never have come first. One pass from the left fills the table,
one walk from the right reads the ids. Time is linear in the text, also where a text has no spaces at all.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_REMEMBERED = 500_000
_LONGEST_REMEMBERED = 64
_ROWS = 256

# Piece types of the model format, and the surface of the unknown id.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("shelfsense-each-byte", _each_byte)


class Vocabulary:
    """Pieces of a model with their merge order, and the two directions."""

    def __init__(self, model_path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as source:
            model.ParseFromString(source.read())
        rules = model.normalizer_spec
        if (
            model.trainer_spec.model_type != _BPE
            or not model.trainer_spec.byte_fallback
            or model.trainer_spec.treat_whitespace_as_suffix
            or rules.precompiled_charsmap
            or not rules.add_dummy_prefix
            or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces
            or {p.type for p in model.pieces} - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        ):
            raise ValueError("only BPE models with byte fallback, leading space and no other text rules are read")
        self.text = {i: p.piece for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.id = {piece: i for i, piece in self.text.items()}
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        # Characters that only occur inside longer pieces merge like others, but have bytes for ids.
        for char in sorted({c for piece in self.text.values() for c in piece} - self.id.keys()):
            self.id[char] = len(model.pieces) + len(self.id)
            self.text[self.id[char]] = char
        self._split_pieces()
        self.automaton = ahocorasick.Automaton()
        for token in self.parts:
            self.automaton.add_word(self.text[token], (token, len(self.text[token])))
        self.automaton.make_automaton()
        self.size = {token: len(piece) for token, piece in self.text.items()}
        chars = {c for piece in self.text.values() for c in piece}
        self.known = frozenset(chars)
        self.runs = re.compile(f"[{''.join(map(re.escape, sorted(chars)))}]+|.", re.DOTALL)
        self.chunks = _chunk_pattern(self.text.values())
        self.apart: dict[int, bool] = {}
        self.remembered: dict[str, bytes] = {}
        self._surfaces(model.pieces, model.trainer_spec.unk_surface)

    # --- merge order ------------------------------------------------------------------------------------

    def merged(self, chars: str) -> tuple[list[str], int]:
        """Merge pairs, best score first and leftmost among equals; also how long the last left part was."""
        parts, last = list(chars), 0
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts, last
            last = len(parts[at])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _split_pieces(self) -> None:
        """``parts``: both tokens of the last merge of each piece that merging can reach; characters have none.

        A piece is in order if each part was there strictly before the merge that uses it; the walk along the
        border needs that. Pieces of equal scores are not; pairs with them are merged for real.
        """
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.in_order: set[int] = set()
        for token, piece in sorted(self.text.items(), key=lambda item: len(item[1])):
            if len(piece) == 1:
                self.parts[token] = None
                self.in_order.add(token)
                continue
            result, at = self.merged(piece)
            if len(result) == 1:
                both = self.id[piece[:at]], self.id[piece[at:]]
                self.parts[token] = both
                born = self.score[piece]
                if all(x in self.in_order and (self.parts[x] is None or self.score[self.text[x]] > born) for x in both):
                    self.in_order.add(token)

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the text of two tokens encodes to just these two."""
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= 4 * _REMEMBERED:
                self.apart.clear()
            known = self.apart[key] = self._never_meet(left, right)
        return known

    def _never_meet(self, left: int, right: int) -> bool:
        text, score, parts = self.text, self.score, self.parts
        if left not in self.in_order or right not in self.in_order:
            return self.merged(text[left] + text[right])[0] == [text[left], text[right]]
        # Back in time along the border: the younger neighbour is undone first, of equals the right one.
        ends_left = ends_right = -np.inf
        while True:
            across = score.get(text[left] + text[right])
            if across is not None and across > ends_left and across >= ends_right:
                return False
            born_left = np.inf if parts[left] is None else score[text[left]]
            born_right = np.inf if parts[right] is None else score[text[right]]
            if born_left == born_right == np.inf:
                return True
            if born_left < born_right:
                ends_left, left = born_left, parts[left][1]
            else:
                ends_right, right = born_right, parts[right][0]

    # --- text to ids ------------------------------------------------------------------------------------------

    def _run(self, chars: str) -> list[int]:
        """Ids of a run of known characters."""
        last, apart = [-1] * len(chars), self.apart
        for end, (token, size) in self.automaton.iter(chars):
            if last[end] < 0:
                start = end - size
                if start < 0:
                    last[end] = token
                else:
                    fits = apart.get(last[start] << 32 | token)
                    if fits or fits is None and self.stay_apart(last[start], token):
                        last[end] = token
        ids, at, size = [], len(chars) - 1, self.size
        while at >= 0:
            token = last[at]
            ids.append(token)
            at -= size[token]
        ids.reverse()
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if self.known.issuperset(chunk):
            ids = self._run(chunk)
            return array("i", ids if max(ids) < len(self.lengths) else self._as_bytes(ids)).tobytes()
        ids = []
        for run in self.runs.findall(chunk):
            if run[0] in self.known:
                ids += self._as_bytes(self._run(run))
            else:
                ids += [self.byte[b] for b in run.encode("utf-8", "surrogatepass")]
        return array("i", ids).tobytes()

    def _as_bytes(self, ids: list[int]) -> Iterator[int]:
        """Ids with those of bytes for characters that are no pieces."""
        for token in ids:
            yield from [token] if token < len(self.lengths) else [self.byte[b] for b in self.text[token].encode()]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as 32-bit numbers."""
        if not text:
            return b""
        known, out = self.remembered, []
        for chunk in self.chunks.findall(SPACE + text.replace(" ", SPACE)):
            ids = known.get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(chunk) <= _LONGEST_REMEMBERED:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    known[chunk] = ids
            out.append(ids)
        return b"".join(out)

    # --- ids to text ------------------------------------------------------------------------------------

    def _surfaces(self, pieces, unknown: str) -> None:
        """Bytes of every id in one buffer, with places and lengths."""
        surfaces = []
        for i, piece in enumerate(pieces):
            if piece.type == _BYTE:
                surfaces.append(bytes([int(piece.piece[1:-1], 16)]))
            elif piece.type == _UNKNOWN:
                surfaces.append(unknown.encode())
            else:
                surfaces.append(b"" if piece.type == _CONTROL else piece.piece.replace(SPACE, " ").encode())
        self.lengths = np.array([len(x) for x in surfaces], np.int64)
        self.places = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.opens = np.array([p.type == _NORMAL and p.piece.startswith(SPACE) for p in pieces])
        self.silent = np.array([p.type == _CONTROL for p in pieces])

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """Texts of lists of ids; list i is ``ids[starts[i]:starts[i + 1]]``."""
        lengths, places = self.lengths[ids], self.places[ids]
        # The space that encoding put before the text goes from the first id that is not a control id.
        said = np.flatnonzero(~self.silent[ids])
        at = np.searchsorted(said, starts[:-1])
        first = np.append(said, len(ids))[at]
        first = first[first < starts[1:]]
        first = first[self.opens[ids[first]]]
        lengths[first] -= 1
        places[first] += 1
        ends = np.concatenate(([0], np.cumsum(lengths)))
        data = self.surface[np.repeat(places - ends[:-1], lengths) + np.arange(ends[-1])]
        offsets = ends[starts].astype(np.int64)
        texts = pa.Array.from_buffers(
            pa.large_string(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())]
        )
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            whole = data.tobytes()
            texts = pa.array(
                [whole[a:b].decode("utf-8", "shelfsense-each-byte") for a, b in zip(offsets, offsets[1:])], pa.large_string()
            )
        return texts.cast(pa.string())


def _chunk_pattern(pieces: Iterable[str]) -> re.Pattern:
    """Cuts a text where no piece can lie across.

    Characters that stand side by side in some piece are of one group; a group with what it leads to is one, too. A chunk
    is spaces and then characters of one group. If pieces hold spaces after other characters, all is one chunk.
    """
    group: dict[str, str] = {}

    def first(char: str) -> str:
        while group.setdefault(char, char) != char:
            char = group[char]
        return char

    for piece in pieces:
        body = piece.lstrip(SPACE)
        if SPACE in body:
            return re.compile(".+", re.DOTALL)
        for a, b in zip(body, body[1:]):
            group[first(a)] = first(b)
    members = defaultdict(list)
    for char in group:
        members[first(char)].append(char)
    runs = "".join(f"[{''.join(map(re.escape, sorted(m)))}]+|" for m in sorted(members.values(), key=len, reverse=True))
    return re.compile(f"{SPACE}*(?:{runs}[^{SPACE}])|{SPACE}+", re.DOTALL)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(model_path: str) -> Vocabulary:
    """One vocabulary per Python worker."""
    if model_path not in _loaded:
        _loaded[model_path] = Vocabulary(model_path)
    return _loaded[model_path]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _encode(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path)
        for part in _slices(batches):
            ids = [pieces.encode(text or "") for text in part.column(1).to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["id", "ids"])

    return run


def _decode(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path)
        for part in _slices(batches):
            lists = part.column(1)
            offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
            texts = pieces.decode(ids, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays([part.column(0), lists, texts], names=["id", "ids", "text"])

    return run


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the ids of every whole text, without begin and end ids.

    A null or empty text has no ids. Repeated rows are encoded each on its own, a null id stays null, further
    columns are not read, an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encode(model_path), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, ids, text)``: the text of each list of ids.

    A null list has no ids and, like an empty one, the empty text; null ids inside a list are left out. Control ids say
    nothing; bytes that form no character become U+FFFD one by one. An id outside the vocabulary is an error.
    """
    kind = encoded.schema[id_col].dataType.simpleString()
    ids = F.coalesce(F.array_compact(F.col(ids_col).cast("array<int>")), F.array().cast("array<int>"))
    rows = encoded.select(F.col(id_col).alias("id"), ids.alias("ids"))
    return rows.mapInArrow(_decode(model_path), f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_col)
