"""SentencePiece encoding and decoding by exact backtracking (operator 13).

For byte-pair models with an identity normalizer. A text gets a space in front, spaces become
U+2581, and the result is cut where no piece of the vocabulary holds the two characters that meet:
no merge crosses such a place, so the parts encode independently. A worker encodes each distinct
part once.

A part is encoded without running its merges. A segmentation into pieces is the merge encoding
exactly if each piece and each two neighbours come back as they are when merged anew. So the
encoder goes from left to right, takes the longest piece at each place (one pass of an
Aho-Corasick automaton over the reversed part finds them all), falls back to shorter prefixes while
the piece doesn't stand beside its neighbour, and takes the last piece back where none does. A bit
field marks places from which no way leads on, so each is left at most once. Whether two pieces
stand beside each other is asked of the merges once a pair (``remerged``) and kept.

Characters outside the vocabulary become byte pieces.

Cases: null and empty texts have the begin and end id alone; a text's length is bounded only by its
task's memory (parts are met in slices of ``SLICE_CHARS``); repeated rows and ties need no care,
rows are independent; an empty table gives none; a doc_id of any type is handed through, other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tokenizer_path, tune
from .tokens import Ragged

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Units, parts and pairs kept by a worker; each table starts anew beyond.
MAX_UNITS, MAX_PAIRS = 500_000, 1_000_000
#: Characters of a very long text that are met together.
SLICE_CHARS = 1 << 22
#: Kinds of pieces in a model file: ordinary, unknown, control, byte.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Runs of spaces stay with what follows; a text is cut into such units first.
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
#: A single space between other characters, where a very long text may be cut.
LONE = re.compile(f"(?<=[^ {SPACE}]) (?=[^ {SPACE}])")


class PieceModel:
    """``encode`` and ``decode`` of single texts; ``encode_column`` and ``decode_column`` of Arrow columns."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        if spec.model_type != spec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or spec.treat_whitespace_as_suffix or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or not spec.byte_fallback:
            raise ValueError("only merge-type models with byte pieces, a space in front and no normalization")
        self.begin, self.end = spec.bos_id, spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space behind other characters")
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.longest = ahocorasick.Automaton()
        for p in self.ids:
            self.longest.add_word(p[::-1], p)
        self.longest.make_automaton()
        shown = [p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else spec.unk_surface.encode() if p.type == UNKNOWN else b"" for p in model.pieces]
        self.shown = Ragged(np.uint8)
        self.shown.add(np.frombuffer(b"".join(shown), np.uint8), np.array([len(s) for s in shown], np.int64))
        self.kinds = np.array(kinds, np.uint8)
        self.spaced = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        self.pairs: dict[tuple[str, str], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.parts: dict[str, list[int]] = {}
        self.rows: dict[str, int] = {}
        self.table = Ragged(np.uint32)

    def remerged(self, text: str) -> list[str]:
        """What the merges make of a short text: always the best-scored neighbours that form a piece, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stands(self, left: str, right: str) -> bool:
        """Whether ``right`` can follow ``left`` (empty: nothing before)."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self.remerged(left + right) == ([left, right] if left else [right])
        return found

    def shorter(self, piece: str) -> str | None:
        """The longest proper prefix that is a piece, at last the first character."""
        for n in range(len(piece) - 1, 0, -1):
            if n == 1 or piece[:n] in self.ids:
                return piece[:n]
        return None

    def segmented(self, part: str) -> list[str]:
        """The pieces of a part by backtracking; a character that is no piece stands for itself."""
        n = len(part)
        first = list(part)
        seen = n
        for stop, piece in self.longest.iter(part[::-1]):
            at = n - 1 - stop
            if at < seen:  # the first match that ends at a place is its longest
                first[at], seen = piece, at
        out: list[str] = []
        dead = np.zeros(n + 1, bool)
        at, piece = 0, first[0]
        while at < n:
            left = out[-1] if out else ""
            while piece is not None and (dead[at + len(piece)] or not self.stands(left, piece)):
                piece = self.shorter(piece)
            if piece is not None:
                out.append(piece)
                at += len(piece)
                piece = first[at] if at < n else None
            else:
                dead[at] = True
                last = out.pop()
                at -= len(last)
                piece = self.shorter(last)
        return out

    def cut(self, unit: str) -> list[str]:
        """``unit`` cut where two characters meet that no piece holds together."""
        joined, out, start = self.joined, [], 0
        for i in range(1, len(unit)):
            if unit[i - 1 : i + 1] not in joined:
                out.append(unit[start:i])
                start = i
        out.append(unit[start:])
        return out

    def _unit_ids(self, unit: str) -> list[int]:
        out: list[int] = []
        for part in self.cut(unit):
            ids = self.parts.get(part)
            if ids is None:
                ids = []
                for piece in self.segmented(part):
                    known = self.ids.get(piece)
                    ids.extend([known] if known is not None else map(self.byte.__getitem__, piece.encode()))
                self.parts[part] = ids
            out += ids
        return out

    def _unit_rows(self, units: list[str]) -> np.ndarray:
        """Rows of the table for distinct units."""
        rows = np.fromiter(map(self.rows.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            todo = [units[i] for i in missing.tolist()]
            ids = [self._unit_ids(u) for u in todo]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            new = self.table.add(np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes)
            self.rows.update(zip(todo, new))
            rows[missing] = new
        return rows

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without begin and end."""
        return [i for u in UNIT.findall(SPACE + text.replace(" ", SPACE)) for i in self._unit_ids(u)] if text else []

    def _slices(self, texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
        """(texts begun before, texts) of about ``SLICE_CHARS``; a longer text is cut at lone spaces, which every slice has in front."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(texts):
            stop, total = at, 0
            while stop < len(texts) and (stop == at or total + sizes[stop] <= SLICE_CHARS):
                total += int(sizes[stop])
                stop += 1
            if total <= SLICE_CHARS:
                yield at, texts.slice(at, stop - at)
            else:
                text, a = texts[at].as_py(), 0
                while a < len(text):
                    m = LONE.search(text, a + SLICE_CHARS)
                    b = m.start() if m else len(text)
                    yield at, pa.array([text[a:b]], pa.string())
                    a = b + 1
            at = stop

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin and the last end), begin and end ids included; null is empty."""
        texts = pc.fill_null(texts, "")
        size = np.full(len(texts), 2, np.int64)
        flat = []
        for first, part in self._slices(texts):
            ids, n = self._encode(part)
            flat.append(ids)
            size[first : first + len(part)] += n
        ends = np.cumsum(size)
        out = np.full(int(ends[-1]) if len(ends) else 0, self.end, np.uint32)
        out[ends - size] = self.begin
        room = np.ones(len(out), bool)
        room[ends - size] = room[ends - 1] = False
        out[room] = np.concatenate([np.zeros(0, np.uint32), *flat])
        return out, np.concatenate([[0], ends])

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many each text has)."""
        if len(self.rows) > MAX_UNITS or len(self.parts) > MAX_UNITS or self.table.used > 16 * MAX_UNITS:
            self._forget()
        # Spaces that meet, stand at an end or are written as U+2581: by a regular expression, apart.
        odd = pc.match_substring_regex(texts, f"  |^ | $|{SPACE}|^$")
        cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        ends = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        rows = self._unit_rows([SPACE + u for u in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
        n = np.diff(ends).astype(np.int64)
        if len(apart := np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()):
            pieces = np.split(rows, ends[1:-1])
            for i, text in zip(apart, texts.take(pa.array(apart)).to_pylist()):
                units = UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []
                own = list(dict.fromkeys(units))
                known = dict(zip(own, self._unit_rows(own).tolist()))
                pieces[i] = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
                n[i] = len(units)
            rows = np.concatenate(pieces)
        ids, size = self.table.gather(rows)
        total = np.concatenate([[0], np.cumsum(size)])
        ends = np.cumsum(n)
        return ids, total[ends] - total[ends - n]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of some ids. Control ids have none; a space that the first piece begins with goes; each byte that is no part of a character becomes U+FFFD."""
        ids = np.asarray(ids if isinstance(ids, np.ndarray) else list(ids), np.int64)
        return self._text(ids, self.shown.gather(ids)[0].tobytes())

    def _text(self, ids: np.ndarray, raw: bytes) -> str:
        """``raw`` as text; ``ids``: as many of the first ids as show which piece comes first."""
        text = ids[self.kinds[ids] != CONTROL]
        drop = bool(len(text)) and bool(self.spaced[text[0]])
        try:
            return raw[drop:].decode()
        except UnicodeDecodeError:
            out, at = [], 0
            raw = raw[drop:]
            while at < len(raw):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(raw[at : at + n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                at += n
            return "".join(out)

    def decode_column(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The texts of ragged rows of ids, as ``encode_column`` gives them."""
        flat, size = self.shown.gather(ids.astype(np.int64))
        raw = flat.tobytes()
        place = np.concatenate([[0], np.cumsum(size)])[at].tolist()
        at = at.tolist()
        return [self._text(ids[a : min(b, a + 2)], raw[p:q]) for a, b, p, q in zip(at, at[1:], place, place[1:])]


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model a worker process, kept between tasks."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _rows(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values: each row's ids as little-endian unsigned 32-bit integers."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer((at * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])


def encode(docs: DataFrame, decoded: bool = False, model: str = MODEL, directory: str | None = None) -> DataFrame:
    """doc_id, n_tokens long, ids binary (little-endian unsigned 32-bit, begin and end ids included) of every whole text, and with ``decoded`` the text that the ids decode to."""
    tune(docs.sparkSession)
    path = tokenizer_path(model, directory)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(path)
        for batch in batches:
            ids, at = m.encode_column(batch.column(1).cast(pa.string()))
            out = {"doc_id": batch.column(0), "n_tokens": pa.array(np.diff(at), pa.int64()), "ids": _rows(ids, at).cast(pa.binary())}
            if decoded:
                out["decoded"] = pa.array(m.decode_column(ids, at), pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, n_tokens long, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, model: str = MODEL, directory: str | None = None) -> DataFrame:
    """``encoded`` (with a column ids as ``encode`` makes them) with a column decoded (in place of one that it has); null ids give null."""
    tune(encoded.sparkSession)
    path = tokenizer_path(model, directory)

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        m = piece_model(path)
        return pa.array([None if x is None else m.decode(np.frombuffer(x, "<u4")) for x in ids.to_pylist()], pa.string())

    return encoded.withColumn("decoded", text("ids"))
