"""SentencePiece encoding and decoding (byte-pair models with byte fallback) by vectorised merge rounds.

The distinct words of a batch lie in one flat array of symbols. A round takes the least pair rank of every
word, merges its occurrences in all words at once, leftmost first, and compacts the array; words without a
pair leave it, and the rounds end when none is left.

One merge at a time, best score first and leftmost among equals, is what the library does. A round does as
many of a word's merges as give the same: up to and including the first that makes a pair of the same or a
better rank beside itself, as that pair would be next.

Words end where no piece of the model holds the two characters side by side, so no merge crosses an end. Of
a run of spaces only the last belongs to the word behind it, if the model's pieces of spaces allow that
(see ``Model.longest_run``); the others are cut by the table of such runs, from the left.

Texts are taken as they are, without special tokens; null is empty and has the begin and end ids alone.
Repeated rows have results of their own, rows without doc_id are kept, an empty table gives an empty one and
columns other than doc_id and text are dropped. Ids that the model does not have make decoding fail; null ids
decode to empty text. Models with other normalisers, types or kinds of pieces are refused.
"""

from __future__ import annotations

import codecs
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from forecourt.llm.common import only, slices

_BATCH_BYTES = 8 * 1024 * 1024
_SPACE = "▁"
_NONE = np.iinfo(np.int32).max

# Field numbers and kinds of pieces in the model's file format.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_MODEL_TYPE, _BPE, _SPACE_BEHIND, _BYTE_FALLBACK, _UNKNOWN_SURFACE = 3, 2, 24, 35, 44
_CHARACTER_MAP, _DUMMY_PREFIX, _TRIM_SPACES, _ESCAPE_SPACES = 2, 3, 4, 5
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = message[at : at + size], at + size
        yield key >> 3, value


class Model:
    """Pieces, scores and pairs of a model file.

    Symbols are numbered: first the characters that occur in pieces, then the longer pieces.
    """

    def __init__(self, content: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for field, value in _fields(content):
            if field == _PIECE:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, _NORMAL)))
            elif field == _TRAINER:
                trainer = dict(_fields(value))
            elif field == _NORMALIZER:
                normalizer = dict(_fields(value))
        plain = not normalizer.get(_CHARACTER_MAP) and normalizer.get(_DUMMY_PREFIX, 1)
        plain = plain and not normalizer.get(_TRIM_SPACES, 1) and normalizer.get(_ESCAPE_SPACES, 1)
        kinds = {kind for _, _, kind in pieces}
        if not plain or trainer.get(_SPACE_BEHIND, 0) or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only plain text with a leading space and without pieces of the user's is supported")
        if trainer.get(_MODEL_TYPE, 1) != _BPE or not trainer.get(_BYTE_FALLBACK, 0):
            raise ValueError("only byte-pair models with byte fallback are supported")

        id_of = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == _NORMAL}
        characters = sorted({c for piece in id_of for c in piece} | {_SPACE})
        symbols = characters + [piece for piece in id_of if len(piece) > 1]
        symbol_of = {symbol: i for i, symbol in enumerate(symbols)}
        self.n_symbols, self.n_characters = len(symbols), len(characters)
        self.space = symbol_of[_SPACE]
        self.control = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == _CONTROL}

        # Symbol of a code point (a number past all characters: in no piece), a space being the model's mark.
        self.character = np.full(0x110000, self.n_characters, np.int32)
        self.character[list(map(ord, characters))] = np.arange(self.n_characters)
        self.character[ord(" ")] = self.space
        self.joined = np.zeros((self.n_characters + 1, self.n_characters + 1), bool)
        pairs = []
        for piece in id_of:
            places = [symbol_of[c] for c in piece]
            self.joined[places[:-1], places[1:]] = True
            halves = ((piece[:i], piece[i:]) for i in range(1, len(piece)))
            pairs += [(symbol_of[a], symbol_of[b], symbol_of[piece]) for a, b in halves if a in symbol_of and b in symbol_of]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        keys = table[:, 0] * self.n_symbols + table[:, 1]
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_into = np.append(table[order, 2], -1).astype(np.int32)
        scores = np.full(self.n_symbols, -np.inf)
        for piece, i in id_of.items():
            scores[symbol_of[piece]] = pieces[i][1]
        # The last entry serves -1, no pair.
        self.rank = np.append(np.unique(-scores, return_inverse=True)[1], _NONE).astype(np.int32)

        # Neighbouring bytes of the plain ASCII range that no piece joins.
        letters = self.character[np.arange(128)]
        self.byte_cut = np.zeros((256, 256), bool)
        self.byte_cut[:128, :128] = ~self.joined[letters[:, None], letters[None, :]]
        self.longest_run = 0
        if self._runs_come_last(id_of, scores, symbol_of):
            self._learn_runs(max(len(piece) for piece in id_of if set(piece) == {_SPACE}))

        # Ids of all symbols in a row: one of a piece, those of its bytes for another character.
        byte_id = {int(piece[1:-1], 16): i for i, (piece, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.byte_id = np.array([byte_id[b] for b in range(256)], np.int32)
        spelled = [[id_of[s]] if s in id_of else self.byte_id[list(s.encode())].tolist() for s in symbols]
        self.symbol_ids, self.symbol_start, self.symbol_length = _ragged_table(spelled, np.int32)

        surface = trainer.get(_UNKNOWN_SURFACE, " ⁇ ".encode())
        written = {
            _NORMAL: lambda piece: piece.replace(_SPACE, " ").encode(),
            _BYTE: lambda piece: bytes([int(piece[1:-1], 16)]),
            _UNKNOWN: lambda piece: surface,
            _CONTROL: lambda piece: b"",
        }
        texts = [written[kind](piece) for piece, _, kind in pieces]
        self.id_bytes, self.id_start, self.id_length = _ragged_table([list(t) for t in texts], np.uint8)
        self.id_kind = np.array([kind for _, _, kind in pieces])
        self.leads_with_space = np.array([kind == _NORMAL and p.startswith(_SPACE) for p, _, kind in pieces])

    def _runs_come_last(self, id_of: dict[str, int], scores: np.ndarray, symbol_of: dict[str, int]) -> bool:
        """Whether spaces are side by side in pieces of spaces alone, which tie and are the worst of all pieces.

        Then whatever else merges comes before them, and can take the last space of a run alone.
        """
        several = {piece for piece in id_of if _SPACE * 2 in piece}
        others = [piece for piece in id_of if len(piece) > 1 and piece not in several]
        worst = {scores[symbol_of[piece]] for piece in several}
        pure = all(set(piece) == {_SPACE} for piece in several) and not any(_SPACE in piece[1:] for piece in others)
        return pure and len(worst) == 1 and max(worst) < min((scores[symbol_of[p]] for p in others), default=np.inf)

    def _learn_runs(self, longest: int) -> None:
        """How a run of spaces is cut: the longest pieces, then a remainder. Not used if longer runs are cut otherwise.

        Merges of equal scores go from the left and look one symbol ahead, so runs of up to twice the longest tell.
        """
        runs = [merge_rounds(np.full(n, self.space), np.array([n]), self)[0] for n in range(1, 2 * longest + 1)]
        size = {int(run[0]): n for n, run in enumerate(runs, 1) if len(run) == 1}
        if all(runs[longest + n].tolist() == [*runs[longest - 1], *runs[n]] for n in range(longest)):
            self.longest_run = longest
            # Row n: the pieces of a remainder of n spaces, each where it begins, -1 elsewhere. Row 0: a longest piece.
            self.run_pieces = np.full((longest, longest), -1, np.int32)
            self.run_pieces[0, 0] = runs[longest - 1][0]
            for n in range(1, longest):
                at = np.cumsum([0, *[size[int(s)] for s in runs[n - 1]]])[:-1]
                self.run_pieces[n, at] = runs[n - 1]

    def into(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbols that pairs merge into, -1 for none."""
        keys = left.astype(np.int64) * self.n_symbols + right
        place = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[place] == keys, self.pair_into[place], -1)


def _ragged_table(rows: list[list[int]], kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values in a row, where each list begins, and its length."""
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    values = np.fromiter((value for row in rows for value in row), kind, int(lengths.sum()))
    return values, np.cumsum(lengths) - lengths, lengths


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of each stretch, one stretch after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(int(lengths.sum()))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each stretch of ``counts`` values."""
    totals = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return totals[ends] - totals[ends - counts]


def merge_rounds(symbols: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words after all merges, and their number per word. No word is empty."""
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    words = np.arange(len(lengths))
    ends = np.cumsum(lengths)
    into = np.append(model.into(symbols[:-1], symbols[1:]), -1) if len(symbols) else symbols
    into[ends - 1] = -1
    while len(words):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        rank = model.rank[into]
        least = np.minimum.reduceat(rank, starts)
        still = least < _NONE
        if not still.all():
            of_still = np.repeat(still, lengths)
            done.append((words[~still], lengths[~still], symbols[~of_still]))
            words, lengths, least = words[still], lengths[still], least[still]
            symbols, into, rank = symbols[of_still], into[of_still], rank[of_still]
            if not len(words):
                break
            ends = np.cumsum(lengths)
            starts = ends - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        at = np.flatnonzero(rank == least[word])
        # Of occurrences that overlap, the first, third, ... stand.
        order = np.arange(len(at))
        chained = np.concatenate(([False], at[1:] == at[:-1] + 1))
        at = at[(order - np.maximum.accumulate(np.where(chained, 0, order))) % 2 == 0]
        merged, own = into[at], word[at]
        beside = np.concatenate(([False], at[1:] == at[:-1] + 2)) & (at - 1 >= starts[own])
        before = np.where(beside, np.concatenate(([0], merged[:-1])), symbols[at - 1])
        left = np.where(at > starts[own], model.into(before, merged), -1)
        behind = np.minimum(at + 2, len(symbols) - 1)
        right = np.where(at + 2 < ends[own], model.into(merged, symbols[behind]), -1)
        # A new pair that would be next ends the word's round.
        first = np.minimum(model.rank[left], model.rank[right]) <= least[own]
        if first.any():
            earlier = np.cumsum(first) - first
            of_word = np.concatenate(([True], own[1:] != own[:-1]))
            stands = earlier == earlier[of_word][np.cumsum(of_word) - 1]
            at, merged, own, beside, left, right = (a[stands] for a in (at, merged, own, beside, left, right))
        symbols[at] = merged
        into[at] = right
        inner = at > starts[own]
        into[(at - 1 - beside)[inner]] = left[inner]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols, into = symbols[stays], into[stays]
        lengths = lengths - np.bincount(own, minlength=len(lengths))
    if not done:
        return symbols, lengths
    words, lengths, symbols = (np.concatenate(parts) for parts in zip(*done))
    order = np.argsort(words)
    starts = np.cumsum(lengths) - lengths
    return symbols[_places(starts[order], lengths[order])], lengths[order]


class Codec:
    """Encodes and decodes batches of texts by one model."""

    def __init__(self, content: bytes):
        self.model = Model(content)

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Parts of all texts, with the leading space that the model puts before a text, and their number per text."""
        begun = pc.binary_join_element_wise(" ", texts, "")
        begun = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", begun)
        _, offsets, data = begun.buffers()
        bounds = np.frombuffer(offsets, np.int32)[begun.offset : begun.offset + len(begun) + 1].astype(np.int64)
        whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        whole = whole[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        begins = np.zeros(len(whole) + 1, bool)
        begins[1:-1] = self.model.byte_cut[whole[:-1], whole[1:]]
        begins[bounds] = True
        begins[-1] = False
        starts = np.flatnonzero(begins)
        parts_of_text = np.diff(np.searchsorted(starts, bounds))
        ends = pa.py_buffer(np.append(starts, len(whole)).astype(np.int32))
        parts = pa.StringArray.from_buffers(len(starts), ends, pa.py_buffer(np.ascontiguousarray(whole)))
        return parts, parts_of_text

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts in a row, and their number per part."""
        model = self.model
        lengths = pc.utf8_length(parts).to_numpy().astype(np.int64)
        points = np.frombuffer("".join(parts.to_pylist()).encode("utf-32-le"), np.uint32)
        symbols = model.character[points]
        begins = np.ones(len(symbols), bool)
        begins[1:] = ~model.joined[symbols[:-1], symbols[1:]]
        begins[np.cumsum(lengths) - lengths] = True
        spaces = symbols == model.space
        if model.longest_run:
            # The last space of a run goes with the word behind, each other is a word for now.
            begins[1:] |= spaces[1:] & spaces[:-1]
        unknown = np.flatnonzero(symbols == model.n_characters)
        table, start, length = model.symbol_ids, model.symbol_start, model.symbol_length
        if len(unknown):
            distinct, which = np.unique(points[unknown], return_inverse=True)
            symbols[unknown] = model.n_symbols + which
            # No pair has an unknown character: their words have one symbol.
            spelled = [model.byte_id[list(chr(point).encode())].tolist() for point in distinct.tolist()]
            values, starts, sizes = _ragged_table(spelled, np.int32)
            table, start = np.concatenate((table, values)), np.concatenate((start, starts + len(table)))
            length = np.concatenate((length, sizes))
        first = np.flatnonzero(begins)
        words_of_part = _sums(begins.astype(np.int64), lengths)
        merged, of_word = merge_rounds(symbols, np.diff(np.append(first, len(symbols))), model)
        of_part = _sums(of_word, words_of_part)
        if model.longest_run:
            merged, of_part = self._join_runs(merged, of_part)
        return table[_places(start[merged], length[merged])], _sums(length[merged], of_part)

    def _join_runs(self, symbols: np.ndarray, of_part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces for the spaces that are left side by side in a part."""
        space = symbols == self.model.space
        part = np.repeat(np.arange(len(of_part)), of_part)
        follows = np.zeros(len(symbols), bool)
        follows[1:] = space[1:] & space[:-1] & (part[1:] == part[:-1])
        if not follows.any():
            return symbols, of_part
        longest = self.model.longest_run
        first = np.flatnonzero(space & ~follows)
        run = np.cumsum(space & ~follows) - 1
        sizes = np.bincount(run[space], minlength=len(first))
        place, size = (np.arange(len(symbols)) - first[run])[space], sizes[run][space]
        remainder = np.where(place < size - size % longest, 0, size % longest)
        symbols = symbols.copy()
        symbols[space] = self.model.run_pieces[remainder, place % longest]
        stays = symbols >= 0
        return symbols[stays], np.bincount(part[stays], minlength=len(of_part))

    def encode(self, texts: pa.Array, begin: int | None = None, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row (null: as empty), and their number per text."""
        parts, parts_of_text = self._cut(pc.fill_null(texts.cast(pa.string()), ""))
        coded = parts.dictionary_encode()
        distinct, part = coded.dictionary, coded.indices.to_numpy()
        if len(distinct):
            ids, ids_of_part = self._encode_parts(distinct)
        else:
            ids, ids_of_part = np.empty(0, np.int32), np.empty(0, np.int64)
        # The begin and end ids are two more parts, one at either end of each text.
        added = [i for i in (begin, end) if i is not None]
        ids = np.append(ids, np.array(added, np.int32))
        ids_of_part = np.append(ids_of_part, np.ones(len(added), np.int64))
        n_texts, n_parts = len(texts), len(distinct)
        every = parts_of_text + len(added)
        sequence = np.empty(int(every.sum()), np.int64)
        inner = np.ones(len(sequence), bool)
        ends = np.cumsum(every)
        if begin is not None and n_texts:
            inner[ends - every] = False
            sequence[ends - every] = n_parts
        if end is not None and n_texts:
            inner[ends - 1] = False
            sequence[ends - 1] = n_parts + len(added) - 1
        sequence[inner] = part
        start = np.cumsum(ids_of_part) - ids_of_part
        sizes = ids_of_part[sequence]
        return ids[_places(start[sequence], sizes)], _sums(sizes, every)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of the ids; control ids are silent, the leading space goes, bytes that are no UTF-8 become U+FFFD."""
        model = self.model
        if len(ids) and (ids.min() < 0 or ids.max() >= len(model.id_length)):
            raise ValueError("an id is not in the model")
        start, length = model.id_start[ids], model.id_length[ids]
        said = np.flatnonzero(length)
        ends = np.cumsum(counts)
        first = np.searchsorted(said, ends - counts)
        first = said[first[first < np.searchsorted(said, ends)]]
        first = first[model.leads_with_space[ids[first]]]
        start[first] += 1
        length[first] -= 1
        data = model.id_bytes[_places(start, length)].tobytes()
        # Bytes before and behind a control id are no character together.
        parted = np.flatnonzero((model.id_kind[ids[1:]] == _CONTROL) & (model.id_kind[ids[:-1]] == _BYTE)) + 1
        bounds = np.unique(np.concatenate((ends - counts, ends, parted)))
        totals = np.concatenate(([0], np.cumsum(length)))[bounds].tolist()
        parts = [data[a:b].decode("utf-8", "each_byte") for a, b in zip(totals, totals[1:])]
        first_part = np.searchsorted(bounds, ends - counts).tolist()
        return ["".join(parts[a:b]) for a, b in zip(first_part, np.searchsorted(bounds, ends).tolist())]


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)


@lru_cache(maxsize=2)
def codec(content: bytes) -> Codec:
    """One codec per worker process and model."""
    return Codec(content)


def read_model(path: str) -> bytes:
    """The file's content. It goes to the executors with the tasks; models take about a MB."""
    with open(path, "rb") as file:
        return file.read()


_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
_PACKED = np.dtype("<u4")


def encode(docs: DataFrame, model_path: str, begin: str | None = "<s>", end: str | None = "</s>") -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) per row of ``docs`` (doc_id, text).

    ``begin`` and ``end`` are the control pieces put before and behind every text.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(content.value)
        ends = [None if piece is None else use.model.control[piece] for piece in (begin, end)]
        for batch in slices(batches, 1 << 20, _BATCH_BYTES):
            ids, counts = use.encode(batch.column("text"), *ends)
            bounds = np.concatenate(([0], np.cumsum(counts))) * _PACKED.itemsize
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids.astype(_PACKED))]
            )
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), packed]
            yield pa.RecordBatch.from_arrays(columns, schema=_ENCODED)

    return only(docs, "doc_id", "text").mapInArrow(encoded, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the decoded text; null ids decode to empty text."""
    content = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(content.value)
        for batch in slices(batches, 1 << 20, _BATCH_BYTES):
            packed = pc.fill_null(batch.column("ids"), b"")
            lengths = pc.binary_length(packed).to_numpy().astype(np.int64)
            ids = np.frombuffer(b"".join(packed.to_pylist()), _PACKED).astype(np.int64)
            texts = use.decode(ids, lengths // _PACKED.itemsize)
            columns = [batch.column("doc_id"), batch.column("n_tokens"), batch.column("ids"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "text"])

    return only(encoded, "doc_id", "n_tokens", "ids").mapInArrow(decoded, "doc_id long, n_tokens long, ids binary, text string")
