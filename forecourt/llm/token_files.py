"""Token-id files: one zstandard frame per document, all with one shared dictionary.

Layout of a shard: ``MAGIC``, the 16-byte hash of the dictionary, then the frames in ascending
doc_id order. A frame holds a document's ids as little-endian integers of 2 bytes if the vocabulary
allows, else 4. The dictionary lies beside the shards under its hash. The offset index is a Parquet
table (doc_id, shard, offset, length, start, n_tokens), written by Spark's committer; a reader needs
one range of one shard and the dictionary to get at a short document.

The dictionary is trained on the ids of about ``SAMPLE_PIECES`` pieces of at most ``PIECE_CHARS``
characters, drawn by hash from the pieces of all documents; it bounds the training in bytes, and every
document is encoded. Equal pieces of equal rows count once. With too few samples to train it is their
plain content, and without documents it is empty.

Encoding: the distinct words of a batch go through the tokenizers library once each, and the ids of
the texts are put together from them. The file's pattern never joins across ASCII white space, and
a run of punctuation after a letter is a piece of its own. Words of letters alone, once normalised,
are one piece, whose last id the vocabulary marks as a word's end; so they go to the library many at a
time, and the marks part the ids again. All others go one by one. A vocabulary without such marks or with
other rules is refused.

Documents are encoded where they are read. Their frames are written once and then dealt by ranges of
doc_id, so what is shuffled is compressed ids, and no text is read or encoded twice for it.

Null text is empty and has only the end id. Rows without doc_id come first. Rows that share a doc_id
are neighbours in the order of a hash of their texts, each with its own frame; ranges split them. An empty
table gives an empty index.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from forecourt.llm import shared_files
from forecourt.llm.bpe import byte_symbols, ragged, read_vocabulary
from forecourt.llm.common import only, slices, text_or_empty
from forecourt.session import scratch_path, stage

MAGIC = b"TOKIDS01"
END_ID = 1
SAMPLE_PIECES = 2000
PIECE_CHARS = 8192
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
_TRIMMED = ".,;:!?#*$%&\"()"
_BATCH_BYTES = 8 * 1024 * 1024
_WORDS_A_TEXT = 1000
_ROW_GROUP_BYTES = 16 * 1024 * 1024
#: Pieces whose ids a worker remembers between batches; then it begins anew.
_KNOWN_PIECES = 300_000


class WordEncoder:
    """Encodes texts by a tokenizer file whose pattern drops white space, word by word."""

    def __init__(self, content: str):
        self._library = Tokenizer.from_str(content)
        self._library.no_truncation()
        self._library.no_padding()
        self._symbols = {byte: character for character, byte in byte_symbols().items()}
        self.n_ids = self._library.get_vocab_size(with_added_tokens=True)
        # The library's model alone, for words that are normalised and one piece each.
        self._words = Tokenizer(self._library.model)
        self._words.pre_tokenizer = WhitespaceSplit()
        mark = json.loads(content)["model"].get("end_of_word_suffix")
        self._ends_word = np.zeros(self.n_ids, bool)
        if mark:
            marked = [i for token, i in self._library.get_vocab(with_added_tokens=False).items() if token.endswith(mark)]
            self._ends_word[marked] = True
        shapes, plain = ["Ab", " a\t\n b ", "a.!", "é"], ["ab", "a b", "a .!", "é"]
        given = [self._one_piece(word) for word in ("ab", "é")]
        whole = self._coded(self._library, shapes)
        if not mark or whole != self._coded(self._library, plain) or [whole[0], whole[3]] != self._coded(self._words, given):
            raise ValueError("only vocabularies of lower-case words with marked ends are supported")
        self._forget()

    def _forget(self) -> None:
        """Known pieces with their ids in a row; what is known saves work and changes no result."""
        self._known = pa.array([], pa.string())
        self._flat, self._lengths = np.empty(0, np.uint32), np.empty(0, np.int64)

    @staticmethod
    def _coded(library: Tokenizer, words: list[str]) -> list[list[int]]:
        return [coded.ids for coded in library.encode_batch_fast(words, add_special_tokens=False)]

    def _one_piece(self, word: str) -> str | None:
        """What the model gets for a word that stays in one piece; None if that is not certain."""
        if "Σ" in word or not unicodedata.is_normalized("NFC", word):
            return None
        word = word.lower()
        return "".join(map(self._symbols.__getitem__, word.encode())) if word.isalpha() else None

    def _ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one piece each, many words to a text, and their number per word."""
        flat, lengths = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), _WORDS_A_TEXT):
            some = words[at : at + _WORDS_A_TEXT]
            ids = np.array(self._words.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self._ends_word[ids])
            if len(ends) != len(some):
                raise ValueError("a word has no mark at its end, or several")
            flat.append(ids)
            lengths.append(np.diff(ends, prepend=-1))
        return np.concatenate(flat), np.concatenate(lengths)

    def _learn(self, pieces: pa.Array) -> None:
        """Add the ids of pieces that are not known yet."""
        simple = pc.ascii_is_alpha(pieces).to_numpy(zero_copy_only=False)  # lower case by now
        words, other = pieces.filter(pa.array(simple)).to_pylist(), pieces.filter(pa.array(~simple)).to_pylist()
        given = [self._one_piece(word) for word in other]
        of_letters = np.array([word is not None for word in given], bool)
        flat, lengths = self._ids_of_words([*words, *[word for word in given if word is not None]])
        whole = self._coded(self._library, [word for word, g in zip(other, given) if g is None])
        sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        every = [i for ids in whole for i in ids]
        self._flat = np.concatenate((self._flat, flat, np.array(every, np.uint32)))
        self._lengths = np.concatenate((self._lengths, lengths, sizes))
        later = pieces.filter(pa.array(~simple))
        parts = [pieces.filter(pa.array(simple)), later.filter(pa.array(of_letters)), later.filter(pa.array(~of_letters))]
        self._known = pa.concat_arrays([self._known, *parts])

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All known ids in a row, and where those of each piece begin and how many they are."""
        if len(self._known) + len(pieces) > _KNOWN_PIECES:
            self._forget()
        self._learn(pieces.filter(pc.invert(pc.is_in(pieces, self._known))))
        place = pc.index_in(pieces, self._known).to_numpy()
        return self._flat, (np.cumsum(self._lengths) - self._lengths)[place], self._lengths[place]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, the end id after each, and their number per text."""
        cut = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        counts = np.diff(cut.offsets.to_numpy()).astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary
        core = pc.ascii_rtrim(words, characters=_TRIMMED)
        # U+0130 is the one letter that lower case turns into a letter and a mark, which joins what follows.
        core = pc.if_else(pc.match_substring_regex(core, r"[^\x{130}\P{L}]$"), core, words)
        core = pc.if_else(pc.ascii_is_alpha(core), pc.ascii_lower(core), core)
        # Few words have a tail.
        core_bytes = pc.binary_length(core).to_numpy()
        cut_off = np.flatnonzero(pc.binary_length(words).to_numpy() > core_bytes)
        ends = words.take(pa.array(cut_off)).cast(pa.binary()).to_pylist()
        ends = pa.array([word[n:] for word, n in zip(ends, core_bytes[cut_off].tolist())], pa.binary()).cast(pa.string())
        pieces = pa.concat_arrays([core, ends]).dictionary_encode()
        known, first, length = self._ids(pieces.dictionary)
        # Core and tail of each distinct word, then the words of the texts.
        place = pieces.indices.to_numpy()
        starts, sizes = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        starts[:, 0], sizes[:, 0] = first[place[: len(words)]], length[place[: len(words)]]
        starts[cut_off, 1], sizes[cut_off, 1] = first[place[len(words) :]], length[place[len(words) :]]
        flat = known[ragged(starts.ravel(), sizes.ravel())]
        lengths = sizes.sum(axis=1)
        word = coded.indices.to_numpy()
        sizes = lengths[word]
        totals = np.concatenate(([0], np.cumsum(sizes)))
        ends = np.cumsum(counts)
        tokens = totals[ends] - totals[ends - counts] + 1
        out = np.full(int(tokens.sum()), end_id, np.uint32)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(tokens) - 1] = False
        out[inside] = flat[ragged((np.cumsum(lengths) - lengths)[word], sizes)]
        return out, tokens


@lru_cache(maxsize=2)
def _encoder(content: str) -> WordEncoder:
    # A task is one thread; the library's own threads would each hold memory of their own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(content)


def _width(encoder: WordEncoder, end_id: int) -> str:
    return "<u2" if max(encoder.n_ids - 1, end_id) < 1 << 16 else "<u4"


def hash_of(dictionary: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(dictionary)


def dictionary_sample(docs: DataFrame) -> DataFrame:
    """text: about SAMPLE_PIECES of the pieces of all texts, each piece with the same chance."""
    rows = only(docs, "doc_id", "text").withColumn("text", text_or_empty())
    n_pieces = F.greatest(F.lit(1), F.ceil(F.length("text") / PIECE_CHARS).cast("int"))
    total = rows.agg(F.sum(n_pieces)).first()[0]
    share = min(1.0, SAMPLE_PIECES / (total or 1))

    def drawn(piece: Column) -> Column:
        number = F.pmod(F.xxhash64(F.col("row"), piece), F.lit(1 << 32))
        return number.cast("double") / float(1 << 32) < share

    rows = rows.withColumn("row", F.xxhash64(F.lit("dictionary"), "doc_id", "text"))
    pieces = rows.withColumn("piece", F.explode(F.filter(F.sequence(F.lit(0), n_pieces - 1), drawn)))
    start = F.col("piece") * PIECE_CHARS + 1
    pieces = pieces.select("row", "piece", F.substring("text", start, F.lit(PIECE_CHARS)).alias("text"))
    return pieces.dropDuplicates(["row", "piece"]).select("text")


def train_dictionary(docs: DataFrame, vocabulary_path: str, end_id: int = END_ID) -> bytes:
    """A dictionary of at most 64 KB from a hash sample of pieces, trained in one task."""
    content = read_vocabulary(vocabulary_path)

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, samples = _encoder(content), []
        for batch in slices(batches):
            ids, counts = encoder.encode(batch.column("text"), end_id)
            parts = np.split(ids.astype(_width(encoder, end_id)), np.cumsum(counts)[:-1])
            samples += [part.tobytes() for part in parts]
        if not samples:
            return
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little to train on
            trained = b"".join(samples)[-DICTIONARY_BYTES:]
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained], pa.binary())})

    trained = dictionary_sample(docs).repartition(1).mapInArrow(train, "dictionary binary").take(1)
    return bytes(trained[0]["dictionary"]) if trained else b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


_INDEX = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("shard_no", pa.int64()),
        ("shard", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("dictionary", pa.string()),
    ]
)
_INDEX_DDL = (
    "doc_id long, shard_no long, shard string, offset long, length long, before long, n_tokens long, dictionary string"
)


def write_token_files(docs: DataFrame, vocabulary_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder`` and return the offset index.

    Frames are dealt by ranges of doc_id and a hash of the text, so a shard is one task's range and a doc_id
    that many rows share is split. ``start`` counts the ids of all documents before; it is the position
    in the shard plus the sum of the shards before, of which there are as many as tasks.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    dictionary = train_dictionary(docs, vocabulary_path, end_id)
    name_of_dictionary = hash_of(dictionary)
    shared_files.write_file(folder, f"{name_of_dictionary}.dictionary", dictionary)

    def compress(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        width = _width(encoder, end_id)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        for batch in slices(batches, 1 << 20, _BATCH_BYTES):
            ids, counts = encoder.encode(batch.column("text"), end_id)
            data, size = memoryview(ids.astype(width).tobytes()), np.dtype(width).itemsize
            ends = np.cumsum(counts)
            bounds = zip(((ends - counts) * size).tolist(), (ends * size).tolist())
            frames = pa.array([compressor.compress(data[start:end]) for start, end in bounds], pa.binary())
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("tie"), pa.array(counts, pa.int64()), frames]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "n_tokens", "frame"])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, file, before = "", None, 0
        task = TaskContext.get().partitionId()
        for batch in slices(batches):
            if file is None:
                shard = shared_files.new_name(task, ".tokens")
                file = shared_files.Appender(folder, shard)
                file.write(MAGIC + bytes.fromhex(name_of_dictionary))
            places = [file.write(frame) for frame in batch.column("frame").to_pylist()]
            counts = batch.column("n_tokens").to_numpy()
            ends, n = np.cumsum(counts), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([task] * n, pa.int64()),
                    pa.array([shard] * n),
                    *[pa.array(column, pa.int64()) for column in zip(*places)],
                    pa.array(before + ends - counts, pa.int64()),
                    batch.column("n_tokens"),
                    pa.array([name_of_dictionary] * n),
                ],
                schema=_INDEX,
            )
            before += int(ends[-1])
        if file is not None:
            file.close()

    texts = only(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("tie"))
    columns, path = "doc_id long, tie long, n_tokens long, frame binary", scratch_path(docs.sparkSession, "frames")
    # Small row groups: a writer holds one in memory, beside the task that encodes.
    texts.mapInArrow(compress, columns).write.option("parquet.block.size", _ROW_GROUP_BYTES).parquet(path)
    frames = docs.sparkSession.read.schema(columns).parquet(path)
    ordered = frames.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    index = stage(ordered.mapInArrow(write, _INDEX_DDL), "token_index")
    shards = index.groupBy("shard_no").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("shard_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        shards.select("shard_no", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first")), "shards"
    )
    return index.join(offsets, "shard_no").select(
        "doc_id", "shard", "offset", "length", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "dictionary"
    )


@lru_cache(maxsize=4)
def _reader(folder: str, name: str) -> zstandard.ZstdDecompressor:
    data = shared_files.read_file(folder, f"{name}.dictionary")
    if hash_of(data) != name:
        raise ValueError(f"dictionary {name} has other content")
    return zstandard.ZstdDecompressor(dict_data=_dictionary(data))


def read_token_files(index: DataFrame, folder: str, n_ids: int) -> DataFrame:
    """doc_id, start and ids (little-endian, 32 bits, as binary) of the documents in ``index``.

    Rows of one shard that lie together are read by coalesced ranges; any subset of the index works.
    """
    width = "<u2" if n_ids <= 1 << 16 else "<u4"

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in ("shard", "offset", "length", "n_tokens", "dictionary")]
            shards, offsets, lengths, tokens, dictionaries = columns
            frames = shared_files.read_ranges(folder, zip(shards, offsets, lengths))
            ids = []
            for frame, n, name in zip(frames, tokens, dictionaries):
                data = np.frombuffer(_reader(folder, name).decompress(frame), width).astype("<u4")
                if len(data) != n:
                    raise ValueError(f"a frame holds {len(data)} ids, its index says {n}")
                ids.append(data.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"]
            )

    placed = index.sortWithinPartitions("shard", "offset")
    return placed.mapInArrow(read, "doc_id long, start long, ids binary")


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 as read back from newly written files."""
    folder = scratch_path(spark, "tokens")
    index = write_token_files(docs, vocabulary_path, folder)
    n_ids = max(_encoder(read_vocabulary(vocabulary_path)).n_ids, END_ID + 1)

    def checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("ids").to_pylist()
            columns = [
                batch.column("doc_id"),
                batch.column("start"),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array(list(map(zlib.crc32, ids)), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_token_files(index, folder, n_ids).mapInArrow(
        checked, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
