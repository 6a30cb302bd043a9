"""Byte-pair encoding and decoding with a pair occurrence index.

The distinct words of a batch are laid out in one array of symbols. An index maps every pair that
the vocabulary can merge to its positions in all of them; the ranks that occur are applied in
ascending order, each to its whole position list, and only the lists of the pairs next to a merge
change. So a merge costs its occurrences, not a scan of the batch.

Words are the pieces that the vocabulary's byte-level pattern cuts. Text is first cut before each
single space that a visible character follows: no piece of the pattern crosses such a cut, so the
distinct parts of a batch are found in Arrow, and the pattern runs only on those that are more than
letters. Nothing is kept from batch to batch.

Special tokens of the file are found in the text as the library does by default. Null text is
empty and has no ids; a repeated row gets its own result; an empty table gives an empty one. Ids
that the vocabulary does not have make decoding fail.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from forecourt.llm.common import only, slices

# The byte-level word pattern, with white space as Unicode defines it.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_CUT = re.compile(r" (?=\S)")
#: A space that a space or the end follows (RE2; wide on purpose): such texts are cut by _CUT, one by one.
_ODD_SPACE = r" (?:[\s\x0b\x1c-\x1f\x85\p{Z}]|\z)"
_BATCH_BYTES = 2 * 1024 * 1024


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merge ranks, symbols and special tokens of a byte-level BPE file."""

    def __init__(self, content: str):
        data = json.loads(content)
        model, symbols = data["model"], byte_symbols()
        ids: dict[str, int] = model["vocab"]
        self.byte_id = [0] * 256
        for character, byte in symbols.items():
            self.byte_id[byte] = ids[character]
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        # Partners of each symbol with their ranks, and the ranks of pairs of bytes as a table.
        self.after: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.before: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        table = np.array(self.merges, np.int64).reshape(-1, 3)
        for partners, own, other in ((self.after, 0, 1), (self.before, 1, 0)):
            order = np.lexsort((table[:, other], table[:, own]))
            symbol, first = np.unique(table[order, own], return_index=True)
            for s, ranks in zip(symbol.tolist(), np.split(order, first[1:])):
                partners[s] = (table[ranks, other], ranks)
        byte_of_id = np.full(max(ids.values()) + 1, -1)
        byte_of_id[self.byte_id] = np.arange(256)
        self.byte_pairs = np.full((257, 257), -1, np.int64)  # 256: a wall between words
        of_bytes = np.flatnonzero((byte_of_id[table[:, 0]] >= 0) & (byte_of_id[table[:, 1]] >= 0))
        self.byte_pairs[byte_of_id[table[of_bytes, 0]], byte_of_id[table[of_bytes, 1]]] = of_bytes
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        spelled = {i: bytes(symbols[c] for c in token) for token, i in ids.items()}
        spelled |= {i: token.encode() for token, i in self.special.items()}
        # The bytes of all ids in a row, where each begins, and how many it has (-1: no such id).
        self.id_bytes = np.frombuffer(b"".join(spelled.values()), np.uint8)
        lengths = np.fromiter(map(len, spelled.values()), np.int64, len(spelled))
        self.id_length = np.full(max(spelled) + 1, -1)
        self.id_start = np.zeros(max(spelled) + 1, np.int64)
        self.id_length[list(spelled)] = lengths
        self.id_start[list(spelled)] = np.cumsum(lengths) - lengths
        alternatives = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.special_pattern = re.compile(f"({alternatives})") if self.special else None


_NO_PARTNERS = (np.empty(0, np.int64), np.empty(0, np.int64))


def _ranks(partners: tuple[np.ndarray, np.ndarray], others: np.ndarray) -> np.ndarray:
    """The rank of a symbol's pair with each of the others; -1 if the vocabulary has none."""
    known, ranks = partners
    if not len(known):
        return np.full(len(others), -1)
    place = np.minimum(np.searchsorted(known, others), len(known) - 1)
    return np.where(known[place] == others, ranks[place], -1)


def _strings(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings in a row, and the length of each."""
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], np.diff(bounds).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[0], starts[0] + 1, ... of each stretch, one stretch after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(int(lengths.sum()))


def merge_all(words: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row and their number per word.

    Every rank that occurs is applied, lowest first, to all its positions.
    """
    data, lengths = _strings(words)
    if not len(data):
        return np.empty(0, np.int32), np.zeros(len(words), np.int64)
    walls = np.cumsum(lengths + 1) - 1
    inside = np.ones(len(data) + len(words), bool)
    inside[walls] = False
    letters = np.full(len(inside), 256, np.int16)
    letters[inside] = data
    symbol = np.array([*vocabulary.byte_id, -1], np.int32)[letters]
    following = np.arange(1, len(symbol) + 1, dtype=np.int32)
    preceding = np.arange(-1, len(symbol) - 1, dtype=np.int32)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(ranks: np.ndarray, places: np.ndarray) -> None:
        """Add the places of pairs that have a rank to the index."""
        some = ranks >= 0
        ranks, places = ranks[some], places[some]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        starts = np.flatnonzero(np.diff(ranks, prepend=-1))
        ends = [*starts[1:].tolist(), len(ranks)]
        for rank, start, end in zip(ranks[starts].tolist(), starts.tolist(), ends):
            if rank not in index:
                index[rank] = []
                heapq.heappush(active, rank)
            index[rank].append(places[start:end])

    note(vocabulary.byte_pairs[letters[:-1], letters[1:]], np.arange(len(symbol) - 1, dtype=np.int32))
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right, merged = vocabulary.merges[rank]
        # Some occurrences are gone: an earlier merge took one of the two symbols.
        places = places[(symbol[places] == left) & (symbol[following[places]] == right)]
        if left == right and len(places) > 1:
            # Occurrences that overlap in a run of one symbol: the first, third, ... of a chain stand.
            chained = np.concatenate(([False], following[places[:-1]] == places[1:]))
            at = np.arange(len(places))
            places = places[(at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0]
        if not len(places):
            continue
        taken = following[places]
        symbol[places], symbol[taken] = merged, -2
        beyond = following[taken]
        following[places], preceding[beyond] = beyond, places
        note(_ranks(vocabulary.after.get(merged, _NO_PARTNERS), symbol[beyond]), places)
        before = preceding[places]
        before = before[before >= 0]
        note(_ranks(vocabulary.before.get(merged, _NO_PARTNERS), symbol[before]), before)
    kept = symbol >= 0
    return symbol[kept], np.diff(np.cumsum(kept)[walls], prepend=0)


class Encoder:
    """Encodes batches of texts by one vocabulary."""

    def __init__(self, content: str):
        self.vocabulary = Vocabulary(content)

    def _cut_one(self, text: str) -> list[str]:
        """The parts of a text with special tokens or odd spaces; a special token is a part by itself."""
        pattern = self.vocabulary.special_pattern
        parts = []
        for at, piece in enumerate(pattern.split(text) if pattern else [text]):
            if at % 2:
                parts.append(piece)
            else:
                first, *others = _CUT.split(piece)
                parts += [first, *[" " + other for other in others]]
        return parts

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts of all texts in a row, and their number per text."""
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        for token in self.vocabulary.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        plain = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        counts = np.diff(plain.offsets.to_numpy())
        parts = plain.flatten()
        first = np.zeros(len(parts), bool)
        first[np.cumsum(counts) - counts] = True
        parts = pc.binary_join_element_wise(pc.if_else(pa.array(first), "", " "), parts, "")
        places = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(places):
            return parts, counts
        by_hand = [self._cut_one(text) for text in texts.take(pa.array(places)).to_pylist()]
        starts = np.cumsum(counts) - counts
        starts[places] = len(parts) + np.cumsum([0, *map(len, by_hand[:-1])])
        counts[places] = list(map(len, by_hand))
        every = pa.concat_arrays([parts, pa.array([p for parts_of in by_hand for p in parts_of], pa.string())])
        return every.take(pa.array(ragged(starts, counts))), counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row (null: none), and their number per text."""
        parts, parts_of_text = self._cut(pc.fill_null(texts.cast(pa.string()), ""))
        coded = parts.dictionary_encode()
        part_of, distinct = coded.indices.to_numpy(), coded.dictionary
        # Letters alone, after a space or not, are one word; other parts are cut by the pattern.
        simple = pc.utf8_is_alpha(pc.replace_substring_regex(distinct, "^ ", ""))
        special = pc.is_in(distinct, pa.array(list(self.vocabulary.special), pa.string()))
        whole = pc.or_(simple, special)
        mixed = [_WORDS.findall(part) for part in distinct.filter(pc.invert(whole)).to_pylist()]
        whole = whole.to_numpy(zero_copy_only=False)
        words_of_part = np.ones(len(distinct), np.int64)
        words_of_part[~whole] = list(map(len, mixed))
        inner = pa.array([word for words in mixed for word in words], pa.string())
        coded = pa.concat_arrays([distinct.filter(pa.array(whole)), inner]).dictionary_encode()
        first_word = np.cumsum(words_of_part) - words_of_part
        first_word[whole] = np.arange(whole.sum())
        first_word[~whole] = whole.sum() + np.cumsum([0, *map(len, mixed[:-1])])[: len(mixed)]

        word_of, words = coded.indices.to_numpy(), coded.dictionary
        tokens = pc.index_in(words, pa.array(list(self.vocabulary.special), pa.string()))
        ids, ids_of_word = merge_all(pc.if_else(tokens.is_valid(), "", words), self.vocabulary)
        first_id = np.cumsum(ids_of_word) - ids_of_word
        for at in np.flatnonzero(tokens.is_valid().to_numpy(zero_copy_only=False)):
            first_id[at], ids_of_word[at] = len(ids), 1
            ids = np.append(ids, self.vocabulary.special[words[int(at)].as_py()])

        word = word_of[ragged(first_word[part_of], words_of_part[part_of])]
        words_of_text = _sums(words_of_part[part_of], parts_of_text)
        return ids[ragged(first_id[word], ids_of_word[word])], _sums(ids_of_word[word], words_of_text)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        lengths = self.vocabulary.id_length[ids]
        if (lengths < 0).any():
            raise ValueError("an id is not in the vocabulary")
        data = self.vocabulary.id_bytes[ragged(self.vocabulary.id_start[ids], lengths)].tobytes()
        ends = np.cumsum(_sums(lengths, counts)).tolist()
        return [data[start:end].decode("utf-8", "replace") for start, end in zip([0, *ends[:-1]], ends)]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each stretch of ``counts`` values."""
    totals = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return totals[ends] - totals[ends - counts]


@lru_cache(maxsize=2)
def encoder(content: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(content)


def read_vocabulary(path: str) -> str:
    """The file's content. It goes to the executors with the tasks; vocabularies take a few MB."""
    with open(path, encoding="utf-8") as file:
        return file.read()


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id and ids per row of ``docs`` (doc_id, text)."""
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(content.value)
        for batch in slices(batches, 1 << 20, _BATCH_BYTES):
            ids, counts = use.encode(batch.column("text"))
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), lists], schema=_ENCODED)

    return only(docs, "doc_id", "text").mapInArrow(encoded, "doc_id long, ids array<int>")



def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text; null ids decode to empty text."""
    content = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(content.value)
        for batch in slices(batches, 1 << 20, _BATCH_BYTES):
            ids = batch.column("ids")
            flat, counts = ids.flatten().to_numpy(), pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
            texts = use.decode(flat, counts.astype(np.int64))
            columns = [batch.column("doc_id").cast(pa.int64()), ids, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    return only(encoded, "doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, text string")
