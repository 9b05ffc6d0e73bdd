"""SentencePiece encoding and decoding for merge-type vocabularies.

Characters are symbols at first. An agenda holds every pair of neighbours that together are a piece,
the best score first and the leftmost of equal ones; the top pair becomes one symbol, and its new
neighbours enter the agenda. No piece of such a vocabulary goes on after a character with a space
mark, so texts are cut before each run of marks, and each different part goes through its agenda
once a task (memory is bounded by KNOWN_CHARS). A vocabulary with other pieces is not cut.

The agenda of a long part is a heap. Short parts of one length take their steps together: their
agendas are the rows of an array of ranks, the top pair of each row is its smallest one.

Each Arrow batch is compared with the sentencepiece library: the ids of all parts that were not met
before, and the texts decoded from all ids. Nothing is merged over a cut, so ids that are right for
each part are right for the text. `agree` compares whole texts. A difference makes the task fail.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Characters of different parts that a task keeps with their ids.
KNOWN_CHARS = 8_000_000
#: Characters whose ids are held at a time; a longer text is taken alone.
BLOCK_CHARS = 1 << 22
#: Parts of up to this many characters take their steps together.
SHORT = 64

_MARK = "▁"  # stands for a space
_NEVER = np.iinfo(np.int64).max


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_byte", _each_byte)


class _Parts(dict):
    """Ids (little-endian, 32 bits each) of the parts met so far; a new one goes through its agenda."""

    def __init__(self, ids_of):
        super().__init__()
        self._ids_of, self._chars = ids_of, 0
        self.unchecked: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        return self.learn(part, np.array(self._ids_of(part), "<i4").tobytes())

    def learn(self, part: str, ids: bytes) -> bytes:
        self._chars += len(part)
        self[part] = self.unchecked[part] = ids
        return ids

    def trim(self) -> None:
        """Forget all parts if they are too many; between texts."""
        if self._chars > KNOWN_CHARS:
            self.clear()
            self._chars = 0


class PieceCodec:
    """Encodes and decodes with a sentencepiece model file of the merge type (BPE)."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model)
        numbers = range(lib.get_piece_size())
        names = [lib.id_to_piece(i) for i in numbers]
        special = {i for i in numbers if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)}
        self.end, self.unknown = lib.eos_id(), lib.unk_id()
        self.id = {names[i]: i for i in numbers if i not in special}
        self.unused = {names[i] for i in numbers if i not in special and lib.is_unused(i)}
        # Equal scores share a rank; the best is 0.
        scores = sorted({lib.get_score(i) for i in self.id.values()}, reverse=True)
        place = {score: rank for rank, score in enumerate(scores)}
        self.rank = {name: place[lib.get_score(i)] for name, i in self.id.items()}
        self.bytes = {int(names[i][1:-1], 16): i for i in special if lib.is_byte(i)}
        self.surface = [b"" if i in special else names[i].replace(_MARK, " ").encode() for i in numbers]
        for value, i in self.bytes.items():
            self.surface[i] = bytes([value])
        self.surface[self.unknown] = " ⁇ ".encode()
        self.silent = {i for i in special if lib.is_control(i)}
        self.marked = {i for name, i in self.id.items() if name.startswith(_MARK)}
        self.prefixed = lib.normalize("a") == _MARK + "a"
        whole = any(_MARK in name.lstrip(_MARK) for name in self.id)
        self._cut = re.compile(".+" if whole else f"{_MARK}+[^{_MARK}]*|[^{_MARK}]+", re.DOTALL)
        self.parts = _Parts(self.ids_of)
        self._lay_out()

    def _lay_out(self) -> None:
        """Symbols as numbers, and what pairs of them become, as arrays."""
        chars = sorted({c for name in self.id for c in name})
        symbols = [*self.id, *[c for c in chars if c not in self.id]]
        number = {symbol: k for k, symbol in enumerate(symbols)}
        self._ids = np.array([self.id.get(symbol, -1) for symbol in symbols], np.int64)
        self._base = len(symbols)  # a character of no piece is this and its code point
        self._symbol = np.arange(self._base, self._base + 0x110000)
        self._symbol[[ord(c) for c in chars]] = [number[c] for c in chars]
        keys, becomes = [], []
        for name in self.id:
            for k in range(1, len(name)):
                left, right = number.get(name[:k]), number.get(name[k:])
                if left is not None and right is not None:
                    keys.append(left * self._base + right)
                    becomes.append(self.rank[name] << 32 | number[name])
        order = np.argsort(np.array(keys, np.int64))
        self._keys = np.append(np.array(keys, np.int64)[order], _NEVER)
        self._becomes = np.append(np.array(becomes, np.int64)[order], _NEVER)
        self.together = not self.unused  # rows of an array cannot take these apart again

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank (high half) and symbol (low half) that pairs become, or _NEVER."""
        known = (left < self._base) & (right < self._base)
        key = np.where(known, left * self._base + right, -1)
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._becomes[at], _NEVER)

    def _steps(self, parts: list[str]) -> None:
        """Learn parts of one length, each by an agenda that is a row of ranks."""
        n = len(parts[0])
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").reshape(-1, n)
        symbols, rows = self._symbol[codes], np.arange(len(parts))
        agenda = self._pairs(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            width = symbols.shape[1]
            if width > 1:
                left = (agenda >> 32).argmin(axis=1)  # of equal ranks the leftmost
                top = agenda[np.arange(len(rows)), left]
                done = top == _NEVER
            else:
                done = np.ones(len(rows), bool)
            if done.any():
                self._learn_rows([parts[k] for k in rows[done]], symbols[done])
                symbols, rows, agenda = symbols[~done], rows[~done], agenda[~done]
                if not len(rows):
                    break
                left, top = left[~done], top[~done]
            at, column = np.arange(len(rows)), np.arange(width - 1)
            symbols = np.take_along_axis(symbols, column + (column > left[:, None]), axis=1)
            symbols[at, left] = top & 0xFFFFFFFF
            column = column[:-1]
            agenda = np.take_along_axis(agenda, column + (column >= left[:, None]), axis=1)
            for changed in (left - 1, left):  # the pairs that the new symbol is the right, the left of
                on = (changed >= 0) & (changed < width - 2)
                r, c = at[on], changed[on]
                agenda[r, c] = self._pairs(symbols[r, c], symbols[r, c + 1])

    def _learn_rows(self, parts: list[str], symbols: np.ndarray) -> None:
        ids = np.where(symbols < self._base, self._ids[np.minimum(symbols, self._base - 1)], -1)
        whole = (ids >= 0).all(axis=1)
        size, data = 4 * ids.shape[1], ids.astype("<i4").tobytes()
        for k, (part, known) in enumerate(zip(parts, whole.tolist(), strict=True)):
            self.parts.learn(part, data[k * size : (k + 1) * size]) if known else self.parts[part]

    def encode_all(self, texts: list[str], end: bool = True) -> list[np.ndarray]:
        """Ids of each text; new parts of all of them take their steps together."""
        self.parts.trim()
        cut = [self._cut.findall(self.library.normalize(t)) for t in texts]
        if self.together:
            lengths: dict[int, list[str]] = {}
            for part in set().union(*cut):
                if part not in self.parts and len(part) <= SHORT:
                    lengths.setdefault(len(part), []).append(part)
            for parts in lengths.values():
                self._steps(parts)
        last = np.array([self.end] * end, "<i4").tobytes()
        return [np.frombuffer(b"".join(map(self.parts.__getitem__, c)) + last, "<i4") for c in cut]

    def merged(self, part: str) -> list[str]:
        """The pieces of a part, by the agenda of adjacent symbol pairs.

        An entry is a pair's rank and the place of its left symbol in one number. It is out of date
        if the symbols that are at this place by now are no pair of this rank.
        """
        symbols = list(part)
        n, rank = len(symbols), self.rank.get
        pairs = map(rank, map(str.__add__, symbols, symbols[1:]))
        agenda = [r << 32 | k for k, r in enumerate(pairs) if r is not None]
        heapify(agenda)
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        split: dict[str, tuple[str, str]] = {}
        while agenda:
            top = heappop(agenda)
            left = top & 0xFFFFFFFF
            right = after[left]
            one = symbols[left]
            if not one or right == n:
                continue
            piece = one + symbols[right]
            if rank(piece) != top >> 32:
                continue
            if piece in self.unused:
                split[piece] = one, symbols[right]
            symbols[left], symbols[right] = piece, ""
            right = after[left] = after[right]
            before[right] = left
            if right < n and (r := rank(piece + symbols[right])) is not None:
                heappush(agenda, r << 32 | left)
            left = before[left]
            if left >= 0 and (r := rank(symbols[left] + piece)) is not None:
                heappush(agenda, r << 32 | left)
        if not split:
            return [s for s in symbols if s]
        pieces, waiting = [], [s for s in reversed(symbols) if s]
        while waiting:  # unused pieces only lead to longer ones
            piece = waiting.pop()
            if piece in split:
                waiting += reversed(split[piece])
            else:
                pieces.append(piece)
        return pieces

    def ids_of(self, part: str) -> list[int]:
        """Ids of a part; a symbol that is no piece becomes its bytes, or unknown."""
        ids: list[int] = []
        for piece in self.merged(part):
            number = self.id.get(piece)
            if number is not None:
                ids.append(number)
            elif self.bytes:
                ids += [self.bytes[b] for b in piece.encode()]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def encode(self, text: str, end: bool = True) -> np.ndarray:
        """Ids of a text, followed by the end id."""
        return self.encode_all([text], end)[0]

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no character become U+FFFD each."""
        runs: list[list[int]] = [[]]  # control ids part runs of bytes
        for i in ids.tolist() if self.silent.intersection(ids[:-1].tolist()) else ():
            runs.append([]) if i in self.silent else runs[-1].append(i)
        if len(runs) == 1:
            runs = [ids.tolist()]
        text = "".join(b"".join(map(self.surface.__getitem__, run)).decode(errors="each_byte") for run in runs)
        first = next((i for run in runs for i in run if i not in self.silent), None)
        # The mark that encoding puts in front goes again.
        return text[1:] if self.prefixed and first in self.marked else text


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    return PieceCodec(model)


def code_pieces(
    docs: DataFrame, *, model: str, end: bool = True, id: str = "doc_id", text: str = "text", check: bool = True
) -> DataFrame:
    """(id, ids, decoded) of every whole text: its piece ids and the text that these give again.

    A null text counts as empty: its only id is the end. Decoded texts differ from the input only
    where the vocabulary's normalisation does. Null and repeated ids are kept, other columns are not
    read. With `check`, new parts and decoded texts of each batch are compared with the library's.
    """
    kind = docs.schema[id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            first = 0
            while first < len(batch):
                some, size, row = [], 0, first
                while row < len(batch) and (row == first or size < BLOCK_CHARS):
                    some.append(texts[row].as_py())
                    size += len(some[-1])
                    row += 1
                ids = own.encode_all(some, end)
                decoded = [own.decode(i) for i in ids]
                if check:
                    agree_in_parts(own, some, ids, decoded, end)
                own.parts.unchecked.clear()
                at = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                flat = pa.array(np.concatenate(ids), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, row - first),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat),
                        pa.array(decoded, pa.large_string()),
                    ],
                    ["id", "ids", "decoded"],
                )
                first = row

    found = docs.select(id, text).mapInArrow(work, f"id {kind}, ids array<int>, decoded string")
    return found.withColumnRenamed("id", id)


def agree(own: PieceCodec, texts: list[str], ids: list[np.ndarray], decoded: list[str], end: bool) -> None:
    """Fail unless the library gives the same ids and the same texts for them."""
    theirs = own.library.encode(texts, add_eos=end, num_threads=1)
    if [i.tolist() for i in ids] != theirs:
        raise ValueError("ids differ from those of the sentencepiece library")
    if own.library.decode(theirs, num_threads=1) != decoded:
        raise ValueError("decoded texts differ from those of the sentencepiece library")


def agree_in_parts(own: PieceCodec, texts: list[str], ids: list[np.ndarray], decoded: list[str], end: bool) -> None:
    """The same for texts whose parts were compared before, but for those met since."""
    new = own.parts.unchecked
    if not own.prefixed or not all(part.startswith(_MARK) for part in new):
        return agree(own, texts, ids, decoded, end)  # the library cannot be given such a part alone
    theirs = own.library.encode([part[1:] for part in new], num_threads=1)
    if _MARK in new:  # the library puts no mark before an empty text
        theirs[list(new).index(_MARK)] = [own.library.piece_to_id(_MARK)]
    if [np.frombuffer(i, "<i4").tolist() for i in new.values()] != theirs:
        raise ValueError("ids differ from those of the sentencepiece library")
    if own.library.decode([i.tolist() for i in ids], num_threads=1) != decoded:
        raise ValueError("decoded texts differ from those of the sentencepiece library")
