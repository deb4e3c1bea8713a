"""Exact tokenization with the ``tokenizers`` library, one call per distinct unit of text.

A *unit* is a run of white space followed by a run of other characters. Neither of the
two byte-pair vocabularies has a pre-token that holds white space after another character,
so the ids of a text are the ids of its units, in order. The library encodes each distinct
unit once; a bounded table keeps the answers.

Texts are cut and deduplicated as Arrow columns: a blank before each line end, a split at
blanks, a dictionary of the pieces. Only the dictionary reaches Python; ids are gathered from
the table by numpy. That cut is right where no two white-space characters meet. Other texts are
cut by a regular expression, and a text that holds the string of an added token goes to the
library whole, because the library looks for those before it splits. Very long texts are cut at
unit starts first, so that memory follows ``SLICE_CHARS``, not the longest text.

Words (Latin letters, then perhaps punctuation) skip the library's regular expressions: letters
and punctuation are pre-tokens of their own, and letters go to the library's merge model through
a tokenizer that only splits at line ends.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode White_Space. Python's ``\s`` has U+001C..U+001F too, which the library takes for symbols.
WHITE = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

#: A place where a unit starts within a text.
START = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")
#: Distinct units kept by a worker; the table starts anew beyond (about 400 bytes each with its word).
MAX_UNITS = 600_000
#: Characters whose units are looked up together.
SLICE_CHARS = 1 << 22
#: A piece and its end mark: letters that are the same after NFC and have a one-to-one lower case, a run of
#: punctuation (one pre-token; without the apostrophe, which may begin a contraction), whatever else.
WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]++)?+([!-&(-/:-@\[-`{-~]*+)([^\0]*+)\0")


def byte_chars() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte: itself, or the next free one from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Ragged:
    """Rows of different lengths in one flat array."""

    def __init__(self, dtype: type):
        self.flat = np.zeros(1 << 20, dtype)
        self.starts, self.sizes = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)
        self.rows = self.used = 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> range:
        """Numbers of the new rows."""
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(sizes) > len(self.sizes):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        new = range(self.rows, self.rows + len(sizes))
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[new.start : new.stop], self.sizes[new.start : new.stop] = self.used + np.cumsum(sizes) - sizes, sizes
        self.rows, self.used = new.stop, self.used + len(flat)
        return new

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the rows' values in a row, their lengths)."""
        size = self.sizes[rows]
        end = np.cumsum(size)
        place = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(self.starts[rows] - end + size, size)
        return self.flat[place], size


class UnitEncoder:
    """``encode_column`` gives the ids of a column of texts, ``encode`` each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, max_units: int = MAX_UNITS):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.sep_id, sep = max(self.tok.get_added_tokens_decoder().items())
        self.sep = sep.content
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lower = spec["normalizer"] is not None
        suffix = spec["model"]["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.plain = Tokenizer(models.BPE(spec["model"]["vocab"], merges, cache_capacity=0, **({"end_of_word_suffix": suffix} if suffix else {})))
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        chars = byte_chars()
        self.to_chars = chars | {10: "\n"}
        self.edge = np.zeros(self.tok.get_vocab_size(), bool)  # tokens that end a word, or else start with a space
        for token, i in spec["model"]["vocab"].items():
            self.edge[i] = token.endswith(suffix) if suffix else token.startswith(chars[32])
        self.suffix = suffix
        self.max_units = max_units
        self._forget()

    def _forget(self) -> None:
        """Empty tables: rows by piece after a blank (or a line end of its own), rows by text as it stands, ids by row; words' ids."""
        self.words: dict[str, bytes] = {}
        self.spaced: dict[str, int] = {}
        self.bare: dict[str, int] = {}
        self.table = Ragged(np.uint32)

    def _add(self, answers: list[bytes]) -> range:
        """New rows of the table."""
        return self.table.add(np.frombuffer(b"".join(answers), "<u4"), np.fromiter(map(len, answers), np.int64, len(answers)) >> 2)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _library(self, units: list[str]) -> list[bytes]:
        """The ids of each unit, by one library call over the units joined by a special token."""
        ids = np.array(self.tok.encode_batch_fast([self.sep.join(units)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == self.sep_id)
        if len(ends) != len(units) - 1:
            return [self._whole(u) for u in units]
        raw = ids.tobytes()
        starts = [0, *((ends + 1) * 4).tolist()]
        return [raw[a:b] for a, b in zip(starts, [*(ends * 4).tolist(), len(raw)])]

    def _words(self, units: list[str]) -> list[bytes]:
        """The ids of plain units, each a space and letters."""
        joined = "\n".join(units)
        if self.lower:
            joined = joined.replace(" ", "").lower()
        if joined.isascii():  # printable ASCII stands for itself
            joined = joined.replace(" ", self.to_chars[32])
        else:
            joined = joined.encode().decode("latin-1").translate(self.to_chars)
        ids = np.array(self.plain.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(units):
            return self._library(units)
        raw = ids.tobytes()
        if self.suffix:
            cuts = [0, *((edges + 1) * 4).tolist()]
        else:
            cuts = [*(edges * 4).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _by_lots(self, ask, units: list[str]) -> list[bytes]:
        return [x for i in range(0, len(units), 20_000) for x in ask(units[i : i + 20_000])]

    def answers(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece after a blank; a piece that begins with a line end has none before it."""
        found = WORD.findall("\0".join([*pieces, ""]))
        if len(found) != len(pieces):  # a piece holds the end mark
            return self._by_lots(self._library, [p if p[:1] == "\n" else " " + p for p in pieces])
        known = self.words
        words = list({w for w, _, x in found if not x}.difference(known, ("",)))
        if len(known) + len(words) > self.max_units:
            known.clear()
            words = list({w for w, _, x in found if w and not x})
        for some in ([w for w in words if w.isascii()], [w for w in words if not w.isascii()]):
            known.update(zip(some, self._by_lots(self._words, [" " + w for w in some])))
        marks = list({m for w, m, x in found if w and m and not x})
        marks = {"": b""} | dict(zip(marks, self._by_lots(self._library, marks)))
        other = [p if p[:1] == "\n" else " " + p for p, (w, _, x) in zip(pieces, found) if x or not w]
        rest = iter(self._by_lots(self._library, other))
        return [known[w] + marks[m] if w and not x else next(rest) for w, m, x in found]

    def _spaced_rows(self, pieces: np.ndarray) -> np.ndarray:
        """``pieces``: distinct strings."""
        known = self.spaced
        rows = np.fromiter(map(known.get, pieces.tolist(), repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            todo = pieces[missing].tolist()
            new = self._add(self.answers(todo))
            known.update(zip(todo, new))
            rows[missing] = new
        return rows

    def _bare_rows(self, units: list[str], ask=None) -> np.ndarray:
        known = self.bare
        missing = list({u for u in units if u not in known})
        if missing:
            known.update(zip(missing, self._add(self._by_lots(ask or self._library, missing))))
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def _parts(self, texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
        """(documents begun before, texts) in slices of about ``SLICE_CHARS``; a longer text is cut at unit starts."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(texts):
            stop, total = at, 0
            while stop < len(texts) and (stop == at or total + sizes[stop] <= SLICE_CHARS):
                total += int(sizes[stop])
                stop += 1
            if total <= SLICE_CHARS:
                yield at, texts.slice(at, stop - at)
            else:  # one long text
                text = texts[at].as_py()
                if any(a in text for a in self.added):
                    yield at, texts.slice(at, 1)
                else:
                    a = 0
                    while a < len(text):
                        m = START.search(text, a + SLICE_CHARS)
                        b = m.start() if m else len(text)
                        yield at, pa.array([text[a:b]], pa.string())
                        a = b
            at = stop

    def encode_column(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin and the last end). Null is empty; ``end_id`` ends each text."""
        texts = pc.fill_null(texts, "")
        size = np.zeros(len(texts), np.int64)
        flat = []
        for first, part in self._parts(texts):
            ids, n = self._encode(part)
            flat.append(ids)
            size[first : first + len(part)] += n
        ids = np.concatenate([np.zeros(0, np.uint32), *flat])
        if end_id is not None:
            size += 1
            out = np.full(len(ids) + len(size), end_id, np.uint32)
            room = np.ones(len(out), bool)
            room[np.cumsum(size) - 1] = False
            out[room] = ids
            ids = out
        return ids, np.concatenate([[0], np.cumsum(size)])

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, at = self.encode_column(pa.array(texts, pa.string()))
        raw, at = ids.astype("<u4").tobytes(), (at * 4).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many each text has)."""
        if self.table.rows > self.max_units or self.table.used > 16 * self.max_units:
            self._forget()
        odd = pc.match_substring_regex(texts, f"[{WHITE}][{WHITE}]")
        whole = pa.scalar(False)
        for a in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, a))
        odd = pc.or_(odd, whole)
        odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        cut = pc.split_pattern(pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n"), " ")
        ends = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        rows = self._spaced_rows(coded.dictionary.to_numpy(zero_copy_only=False))[coded.indices.to_numpy()]
        # The first piece has no blank before it.
        heads = cut.values.take(pa.array(ends[:-1]))
        rows[ends[:-1]] = self._bare_rows(heads.to_numpy(zero_copy_only=False).tolist())
        n = np.diff(ends).astype(np.int64)
        if len(odd_at):
            is_whole = whole.to_numpy(zero_copy_only=False)[odd_at].tolist() if self.added else [False] * len(odd_at)
            own = []
            for text, w in zip(texts.take(pa.array(odd_at)).to_pylist(), is_whole):
                own.append(self._add([self._whole(text)]) if w else self._bare_rows(UNIT.findall(text)))
            pieces = np.split(rows, ends[1:-1])
            for i, r in zip(odd_at.tolist(), own):
                pieces[i], n[i] = np.asarray(r, np.int64), len(r)
            rows = np.concatenate(pieces)
        ids, size = self.table.gather(rows)
        return ids, np.add.reduceat(np.append(size, 0), np.cumsum(n) - n)


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder a worker process, kept between tasks."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]
