"""Token files (operator 1): ids coded by a static range asymmetric numeral system (rANS).

1. Documents are dealt into ranges of ``doc_id``, sorted, and encoded by a public tokenizer, which
   never joins what white space separates. So words are encoded, not texts. A tokenizer known to separate
   letters from punctuation too gets words in lower case and punctuation by itself, of which there are
   far fewer. A worker encodes each once as long as it has room for them. With ``share_words``, tasks first
   report the words they meet, and those that most tasks meet are encoded once for all.
2. One frequency table is counted over all ids; its size is bounded by the vocabulary.
3. Ids are coded in independent blocks of whole documents, each with interleaved lanes. A block holds
   checkpoints (the lanes' states at some steps), so that parts of it decode alone, and checksums.

Files are Parquet folders written by Spark: rows are blocks with a binary ``payload``; the columns
next to it locate documents without decoding, and the table ``frequencies`` stands beside them.
Spark commits files as a whole, so a lost executor leaves no broken file.

Payload, little-endian: magic ``RANS``, uint32 version, lanes, tokens, steps, checkpoints, words,
crc32 of the ids (uint32 each), crc32 of all that follows; then for each checkpoint uint32 step and
uint32 place in the words, and the lanes' uint64 states; then the uint32 words.

Special cases: null and empty texts hold the end id alone; a null ``doc_id`` comes first; rows that
repeat a ``doc_id`` stand next to each other in the order of their texts' hashes.
"""

from __future__ import annotations

import json
import os
import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.common import REMEMBERED, gathered, ship_package, slices, split_words
from wardlens.session import materialize, scratch_dir

SCALE_BITS = 20
LOW = 1 << 31           # states stay in LOW .. 2^63 - 1
HEADER = struct.Struct("<4s8I")
#: Words that most tasks meet are encoded once for all: so many at most, each of so many bytes at most.
SHARED_WORDS, SHARED_BYTES = 1 << 20, 32
#: Other words that a Python worker remembers between batches and tasks, at most; then they go.
CACHE_WORDS = 500_000
#: Text encoded at once, about.
ENCODED_BYTES = 6 << 20
#: Tokenizers that read a word of plain letters and punctuation behind them as these two, letters in lower case.
LETTERS_APART = ({"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
#: Letters that no letter beside them changes, and ASCII punctuation but for the apostrophe.
LETTERS = string.ascii_letters + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
PUNCTUATION = string.punctuation.replace("'", "")


@dataclass(frozen=True)
class TokenOptions:
    tokenizer: str              # file of a public tokenizer, the same path on every node
    end_id: int = 2
    block_tokens: int = 1 << 18
    lanes: int = 1024
    checkpoint_steps: int = 128
    share_words: bool = False   # encode common words once for all; for tokenizers slower than a pass over all words


# ---- entropy coder ---------------------------------------------------------------------------

def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Shares of 2^SCALE_BITS, at least 1 for every id that occurs."""
    total, scale = int(counts.sum()), 1 << SCALE_BITS
    out = np.zeros(len(counts), np.int64)
    if not total:
        return out
    seen = np.flatnonzero(counts)
    out[seen] = np.maximum(1, counts[seen].astype(np.float64) * scale / total).astype(np.int64)
    order = seen[np.argsort(-out[seen], kind="stable")]
    excess = int(out.sum()) - scale
    for k in order:  # rounding is settled by the most frequent ids
        step = min(excess, int(out[k]) - 1) if excess > 0 else excess
        out[k] -= step
        excess -= step
        if not excess:
            break
    return out


@dataclass(frozen=True)
class Coder:
    """Tables of one frequency table, shared by all blocks."""

    frequency: np.ndarray

    def __post_init__(self) -> None:
        frequency = self.frequency.astype(np.uint64)
        object.__setattr__(self, "f", frequency)
        object.__setattr__(self, "start", np.cumsum(frequency) - frequency)
        object.__setattr__(self, "symbol", np.repeat(np.arange(len(frequency)), self.frequency))

    def encode(self, ids: np.ndarray, lanes: int, checkpoint_steps: int) -> bytes:
        """Id k of a block is coded in lane k % lanes at step k // lanes."""
        n = len(ids)
        lanes = max(1, min(lanes, n))
        steps = -(-n // lanes)
        state = np.full(lanes, LOW, np.uint64)
        words, marks = [], []
        shift, bits = np.uint64(32), np.uint64(SCALE_BITS)
        limit = np.uint64(LOW >> SCALE_BITS << 32)
        f, start = self.f[ids], self.start[ids]
        for step in range(steps - 1, -1, -1):
            fs, cs = f[step * lanes:(step + 1) * lanes], start[step * lanes:(step + 1) * lanes]
            x = state[:len(fs)]
            full = x >= limit * fs
            words.append(x[full].astype(np.uint32))
            x = np.where(full, x >> shift, x)
            quotient = x // fs
            state[:len(fs)] = (quotient << bits) + (x - quotient * fs) + cs
            if step % checkpoint_steps == 0:
                marks.append((step, len(words), state.copy()))
        sizes = np.cumsum([0, *map(len, reversed(words))])
        stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
        # A state holds for steps from its own on; so many words precede them in the stream.
        points = b"".join(struct.pack("<II", step, sizes[len(words) - count]) + states.astype("<u8").tobytes()
                          for step, count, states in reversed(marks))
        body = points + stream.astype("<u4").tobytes()
        return HEADER.pack(b"RANS", 1, lanes, n, steps, len(marks), len(stream),
                           zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body

    def decode(self, payload: bytes, first_point: int = 0, points: int | None = None) -> np.ndarray:
        """Ids of a block, or those of some of its checkpoints only; checksums are tested."""
        magic, version, lanes, n, steps, marks, count, ids_crc, body_crc = HEADER.unpack_from(payload)
        if magic != b"RANS" or version != 1:
            raise ValueError("not a token block")
        if zlib.crc32(memoryview(payload)[HEADER.size:]) != body_crc:
            raise ValueError("token block is damaged")
        size = 8 + 8 * lanes
        stream = np.frombuffer(payload, "<u4", count, HEADER.size + marks * size).astype(np.uint64)
        if not marks:
            return np.empty(0, np.int64)
        at = [struct.unpack_from("<II", payload, HEADER.size + k * size) for k in range(marks)]
        last_point = marks if points is None else min(marks, first_point + points)
        last = at[last_point][0] if last_point < marks else steps
        step, place = at[first_point]
        state = np.frombuffer(payload, "<u8", lanes, HEADER.size + first_point * size + 8).astype(np.uint64)
        low, mask = np.uint64(LOW), np.uint64((1 << SCALE_BITS) - 1)
        shift, bits = np.uint64(32), np.uint64(SCALE_BITS)
        out = np.empty(min(n, last * lanes) - step * lanes, np.int64)
        done = 0
        for step in range(step, last):
            width = min(lanes, n - step * lanes)
            x = state[:width]
            slot = x & mask
            symbol = self.symbol[slot.astype(np.int64)]
            out[done:done + width] = symbol
            done += width
            x = self.f[symbol] * (x >> bits) + slot - self.start[symbol]
            need = np.flatnonzero(x < low)
            x[need] = (x[need] << shift) | stream[place:place + len(need)]
            place += len(need)
            state[:width] = x
        if len(out) == n and zlib.crc32(out.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("token block doesn't match its checksum")
        return out


# ---- tokenizer -------------------------------------------------------------------------------

class _Words:
    """Ids of words: those that all tasks share, then a bounded number that this worker met.

    Words are looked up by an Arrow hash join; place 0 is the end id, place k + 1 word k.
    """

    def __init__(self, path: str, end_id: int) -> None:
        # Tasks are the parallelism; threads of the library would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        #: They encode plain letters in lower case (ASCII, others) without the steps that leave them as they are.
        self.letters = []
        model, steps = self.tokenizer.model, (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        if (all(steps) and not self.tokenizer.post_processor and getattr(model, "end_of_word_suffix", None) == "</w>"
                and tuple(json.loads(x.__getstate__()) for x in steps) == LETTERS_APART):
            bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters = [Tokenizer(model), Tokenizer(model)]
            self.letters[0].pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.letters[1].pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
            #: Ids that end a word.
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[k for name, k in vocabulary.items() if name.endswith("</w>")]] = True
        #: A special token that stands between words, so that many are encoded as one text.
        self.mark = next(((k, t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items()
                          if t.special and not (t.lstrip or t.rstrip or t.normalized or t.single_word)), None)
        self.source: str | None = None
        self.share(None, b"")

    def share(self, source: str | None, table: bytes) -> None:
        """Begin with the words (word, ids) of an Arrow stream."""
        names, ids, sizes = pa.array([], pa.string()), b"", []
        if table and (found := pa.ipc.open_stream(table).read_all()).num_rows:
            names = pa.concat_arrays(found.column("word").chunks)
            coded = pa.concat_arrays(found.column("ids").chunks)
            # No object for each word: a million of them would be most of a worker's memory.
            ends = np.frombuffer(coded.buffers()[1], np.int32)[coded.offset:coded.offset + len(coded) + 1]
            ids, sizes = memoryview(coded.buffers()[2])[ends[0]:ends[-1]], np.diff(ends) // 4
        self.source = source
        self.base = (names, np.concatenate([np.array([self.end_id], np.uint32), np.frombuffer(ids, "<u4")]),
                     np.concatenate([np.ones(1, np.int32), sizes]).astype(np.int32))
        self.forget()

    def forget(self) -> None:
        """Drop the words met."""
        self.names, self.flat, self.sizes = self.base
        self.first = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.again = np.zeros(len(self.names), bool)

    def forget_rare(self) -> None:
        """Drop the words met once; all that were met where the others fill more than half of the room."""
        kept = self.again.copy()
        kept[:len(self.base[0])] = True
        if kept.sum() - len(self.base[0]) > CACHE_WORDS // 2:
            return self.forget()
        places = np.concatenate([[True], kept])
        self.flat = self.flat[np.repeat(places, self.sizes)]
        self.names, self.sizes = self.names.filter(pa.array(kept)), self.sizes[places]
        self.first = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.again = np.zeros(len(self.names), bool)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each word)."""
        ids, sizes = [], []
        for k in range(0, len(words), 10_000):
            part = words[k:k + 10_000]
            if self.mark:
                number, mark = self.mark
                texts = [f" {mark} ".join(part[i:i + 200]) + f" {mark}" for i in range(0, len(part), 200)]
                coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
                found = np.fromiter(chain.from_iterable(e.ids for e in coded), np.uint32)
                ends = np.flatnonzero(found == number)
                if len(ends) == len(part):
                    ids.append(found[found != number])
                    sizes.append(np.diff(ends, prepend=-1) - 1)
                    continue
            # No such token, or words that hold it.
            each = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(each), np.uint32))
            sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        empty = np.empty(0, np.int64)
        return np.concatenate([empty.astype(np.uint32), *ids]), np.concatenate([empty, *sizes])

    def encode_letters(self, words: pa.Array, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of plain letters in lower case."""
        lists = pa.ListArray.from_arrays(pa.array([*range(0, len(words), 200), len(words)], pa.int32()), words)
        texts, ids = pc.binary_join(lists, " ").to_pylist(), [np.empty(0, np.uint32)]
        for k in range(0, len(texts), 50):
            coded = tokenizer.encode_batch_fast(texts[k:k + 50], add_special_tokens=False)
            ids += [np.array(e.ids, np.uint32) for e in coded]
        found = np.concatenate(ids)
        ends = np.flatnonzero(self.last[found])
        if len(ends) != len(words):  # a letter that the vocabulary doesn't hold
            return self.encode(words.to_pylist())
        return found, np.diff(ends, prepend=-1)

    def coded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, place of the first, number) of the end id and of each word, from what is known of their parts."""
        if not self.letters or len(self.base[0]) or not len(words):  # shared words are whole ones
            places = self.places(words) if len(words) else np.empty(0, np.int64)
            return self.flat, np.insert(self.first[places], 0, self.first[0]), np.insert(self.sizes[places], 0, 1)
        head, tail = pc.ascii_rtrim(words, PUNCTUATION), pc.utf8_ltrim(words, LETTERS)
        sizes = [pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (words, head, tail)]
        plain = (sizes[1] > 0) & (sizes[1] + sizes[2] == sizes[0])  # letters, then punctuation
        ended = plain & (sizes[2] > 0)
        # Looked up together, so that all are known after it, also if others had to be forgotten.
        parts = pa.concat_arrays([pc.utf8_lower(head.filter(pa.array(plain))), tail.filter(pa.array(ended)),
                                  words.filter(pa.array(~plain))]).dictionary_encode()
        letters = np.zeros(len(parts.dictionary), bool)
        codes = parts.indices.to_numpy(zero_copy_only=False)
        letters[codes[:int(plain.sum())]] = True
        found = self.places(parts.dictionary, letters)[codes]
        place = np.full((len(words), 2), -1, np.int64)
        a, b = int(plain.sum()), int(plain.sum() + ended.sum())
        place[plain, 0], place[ended, 1], place[~plain, 0] = found[:a], found[a:b], found[b:]
        n = np.where(place >= 0, self.sizes[place], 0)
        total = np.concatenate([[1], n.sum(axis=1)])
        first = np.cumsum(total) - total
        n, start = n.reshape(-1), self.first[place].reshape(-1)
        shift = (start - (np.cumsum(n) - n)).astype(np.int32)
        ids = self.flat[np.repeat(shift, n) + np.arange(int(n.sum()), dtype=np.int32)]
        return np.concatenate([self.flat[:1], ids]), first, total

    def places(self, words: pa.Array, letters: np.ndarray | None = None) -> np.ndarray:
        found = pc.index_in(words, self.names)
        self.again[found.drop_null().to_numpy()] = True
        if found.null_count and len(self.names) - len(self.base[0]) + found.null_count > CACHE_WORDS:
            self.forget_rare()
            found = pc.index_in(words, self.names)
        new = pc.is_null(found)
        places = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        if found.null_count:
            new_words = words.filter(new)
            if letters is not None:
                # One kind behind the other in the table; places follow.
                ascii_only = pc.string_is_ascii(new_words).to_numpy(zero_copy_only=False)
                kind = np.where(letters[new.to_numpy(zero_copy_only=False)], np.where(ascii_only, 0, 1), 2)
                order = np.argsort(kind, kind="stable")
                new_words, cuts = new_words.take(pa.array(order)), np.searchsorted(kind[order], [0, 1, 2, 3])
                parts = [new_words.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]
                coded = [*map(self.encode_letters, parts, self.letters), self.encode(parts[2].to_pylist())]
                ids, sizes = (np.concatenate(x) for x in zip(*coded))
            else:
                order, (ids, sizes) = np.arange(len(new_words)), self.encode(new_words.to_pylist())
            places[np.flatnonzero(places == 0)[order]] = np.arange(len(new_words)) + len(self.names) + 1
            self.names = pa.concat_arrays([self.names, new_words])
            self.flat = np.concatenate([self.flat, ids])
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
            self.first = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
            self.again = np.concatenate([self.again, np.zeros(len(new_words), bool)])
        return places


_WORDS: dict[str, _Words] = {}
REMEMBERED.append(_WORDS)


def _known(path: str, end_id: int) -> _Words:
    if path not in _WORDS or _WORDS[path].end_id != end_id:
        _WORDS[path] = _Words(path, end_id)
    return _WORDS[path]


def encode_texts(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids of each text); the end id closes every text."""
    known = _known(path, end_id)
    codes, ends, words = split_words(texts)
    table, first, sizes = known.coded(words)
    # The end id stands as a word of its own behind each text's last one.
    places = np.insert((codes + 1).astype(np.int32), ends[1:], 0)
    borders = ends + np.arange(len(ends))
    n = sizes[places]
    after = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    at = np.repeat((first[places] - after[:-1]).astype(np.int32), n)
    at += np.arange(after[-1], dtype=np.int32)
    return table[at], np.diff(after[borders])


def _packed(ids: np.ndarray) -> bytes:
    """Two bytes for each id where that suffices."""
    return ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()


def _unpacked(ids: bytes, n_tokens: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n_tokens else "<u4").astype(np.int64)


# ---- Spark jobs ------------------------------------------------------------------------------

def word_spread(docs: DataFrame) -> DataFrame:
    """(word, n): how many tasks, or runs of ``CACHE_WORDS`` words in a task, meet a word; from 2 on."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = pa.array([], pa.string())
        for batch in gathered(batches, "text", ENCODED_BYTES):
            for piece in slices(batch, "text", _WORDS, 2 * ENCODED_BYTES):
                words = split_words(piece.column("text"))[2]
                if len(words):
                    words = words.filter(pc.less_equal(pc.binary_length(words), SHARED_BYTES))
                    met = pa.concat_arrays([met, words.filter(pc.invert(pc.is_in(words, met)))])
                if len(met) > CACHE_WORDS:
                    yield pa.RecordBatch.from_arrays([met], names=["word"])
                    met = met[:0]
        yield pa.RecordBatch.from_arrays([met], names=["word"])

    return docs.select("text").mapInArrow(meet, "word string").groupBy("word").agg(F.count("*").alias("n")).filter("n > 1")


def shared_words(docs: DataFrame, options: TokenOptions) -> bytes:
    """Arrow stream (word, ids) of at most ``SHARED_WORDS`` words, those that most tasks meet.

    Which words these are decides how much is encoded twice, never what the ids are.
    """
    # Levels of 8 steps to a doubling: a few hundred rows at most.
    spread = materialize(word_spread(docs).select("word", F.floor(8 * F.log2("n")).cast("int").alias("level")), "token-spread")
    levels, room, least = spread.groupBy("level").count().collect(), SHARED_WORDS, 0
    for level, n in sorted(map(tuple, levels), reverse=True):
        least = level
        if n > room:
            break
        room -= n
    chosen = spread.filter(F.col("level") > least).union(spread.filter(F.col("level") == least).limit(room))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = _known(options.tokenizer, options.end_id).encode(batch.column("word").to_pylist())
            raw, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum([0, *sizes.tolist()])
            coded = [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(coded, pa.binary())], names=["word", "ids"])

    coded = materialize(chosen.select("word").mapInArrow(encode, "word string, ids binary"), "token-words").toArrow()
    schema, out = pa.schema([("word", pa.string()), ("ids", pa.binary())]), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema) as stream:
        stream.write_table(coded.cast(schema))
    return out.getvalue().to_pybytes()


def encode_documents(docs: DataFrame, options: TokenOptions) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order: part, block, doc_ids, sizes, ids."""
    ship_package(docs.sparkSession)
    source = uuid.uuid4().hex
    words = docs.sparkSession.sparkContext.broadcast(shared_words(docs, options)) if options.share_words else None
    given = docs.select("doc_id", "text").withColumn("digest", F.xxhash64("text"))
    ordered = given.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest").drop("digest")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        doc_ids, sizes, ids, held = [], [], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([held], pa.int64()), pa.array([sum(doc_ids, [])], pa.list_(pa.int64())),
                 pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                 pa.array([_packed(np.concatenate(ids))], pa.binary())],
                names=["part", "block", "n_tokens", "doc_ids", "sizes", "ids"])

        for batch in gathered(batches, "text", ENCODED_BYTES):
            for piece in slices(batch, "text", _WORDS, 2 * ENCODED_BYTES):
                known = _known(options.tokenizer, options.end_id)
                if words is not None and known.source != source:
                    known.share(source, words.value)
                found, counts = encode_texts(piece.column("text"), options.tokenizer, options.end_id)
                pa.default_memory_pool().release_unused()  # what Arrow keeps would exceed what is in use
                before = np.concatenate([[0], np.cumsum(counts)])
                names, first = piece.column("doc_id").to_pylist(), 0
                while first < len(counts):
                    # Whole documents up to the block's size, one at least.
                    room = before[first] + options.block_tokens - held
                    last = max(first + 1, int(np.searchsorted(before, room, "right")) - 1)
                    if held and before[last] > room:
                        yield packed()
                        block, held, doc_ids, sizes, ids = block + 1, 0, [], [], []
                        continue
                    doc_ids.append(names[first:last])
                    sizes.append(counts[first:last])
                    ids.append(found[before[first]:before[last]])
                    held += int(before[last] - before[first])
                    first = last
        if doc_ids:
            yield packed()

    return ordered.mapInArrow(
        encode, "part int, block int, n_tokens long, doc_ids array<long>, sizes array<long>, ids binary")


def token_counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all blocks; every task adds up its own counts first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, np.int64)
        for batch in batches:
            for ids, n in zip(batch.column("ids").to_pylist(), batch.column("n_tokens").to_pylist()):
                found = np.bincount(_unpacked(ids, n))
                if len(found) > len(sums):
                    found[:len(sums)] += sums
                    sums = found
                else:
                    sums[:len(found)] += found
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["id", "n"])

    return blocks.select("ids", "n_tokens").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, options: TokenOptions) -> None:
    """Writes ``path/blocks`` and ``path/frequencies``."""
    spark = docs.sparkSession
    blocks = materialize(encode_documents(docs, options), "token-blocks")
    counts = token_counts(blocks).toArrow()  # at most one row per id of the vocabulary
    ids, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
    every = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
    every[ids] = n
    frequency = scaled_frequencies(every)
    spark.createDataFrame([(frequency.astype("<u4").tobytes(),)], "frequency binary").coalesce(1).write.parquet(f"{path}/frequencies")
    lanes, steps = options.lanes, options.checkpoint_steps

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequency)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                payload = coder.encode(_unpacked(row.column("ids")[0].as_py(), row.column("n_tokens")[0].as_py()), lanes, steps)
                yield row.drop_columns(["ids"]).append_column("payload", pa.array([payload], pa.binary()))

    coded = blocks.mapInArrow(
        encode, "part int, block int, n_tokens long, doc_ids array<long>, sizes array<long>, payload binary")
    # Payloads are dense; the columns beside them stay readable by themselves.
    coded.write.option("compression", "lz4_raw").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from decoded ids."""
    ship_package(spark)
    frequency = np.frombuffer(spark.read.parquet(f"{path}/frequencies").first()[0], "<u4").astype(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    # Ids before a block: sums over parts, of which there are as many as partitions, then in a part.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = blocks.select("part", "block", (F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")).alias("within"))
    bases = inside.join(parts, "part").select("part", "block", (F.col("before") + F.col("within")).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequency)
        for batch in batches:
            for k in range(batch.num_rows):
                ids = coder.decode(batch.column("payload")[k].as_py()).astype("<u4")
                sizes = batch.column("sizes")[k].values.to_numpy()
                ends = np.cumsum(sizes)
                raw = memoryview(ids).cast("B")
                sums = [zlib.crc32(raw[4 * (e - s):4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                m = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values, pa.repeat(batch.column("part")[k], m),
                     pa.repeat(batch.column("block")[k], m), pa.array(ends - sizes),
                     pa.array(sizes), pa.array(sums, pa.int64())],
                    names=["doc_id", "part", "block", "at", "n_tokens", "ids_crc32"])

    found = blocks.select("part", "block", "doc_ids", "sizes", "payload").mapInArrow(
        decode, "doc_id long, part int, block int, at long, n_tokens long, ids_crc32 long")
    return found.join(bases, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"


def tokenize_to_files(docs: DataFrame, options: TokenOptions, path: str | None = None) -> DataFrame:
    """Writes token files, reads them back and returns one row per document."""
    path = path or new_folder(docs.sparkSession)
    write_token_files(docs, path, options)
    return read_token_files(docs.sparkSession, path)
