"""Best-fit packing of tokenized documents into fixed-length sequences.

Method: bounded-space online best-fit. A task keeps a fixed number of open
bins; a bitset has bit ``f`` set while some open bin has ``f`` places free, so
the tightest bin that still takes an item is the lowest set bit at or above the
item's length. When one bin too many is open, the fullest is closed.

Tails of documents are dealt to tasks by a hash; the bins that a task still has
open at its end become items of the next level (a bin of used length u is an
item of length u), until one task is left. So no task sees more than
``items_per_task`` items or keeps more than ``open_bins`` bins, and the
half-full bins at the task borders are filled as well.

Defined cases: null and empty texts are the end-of-document id alone; repeated
rows and repeated ids are packed once each; an empty table gives no rows; extra
columns are ignored; a null id is kept as null.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import byte_level, stored

SEQUENCE_LENGTH = 2048
END_ID = 0
#: Distinct words whose ids a worker remembers; further words are encoded again when they come.
CACHED_WORDS = 100_000
#: Texts encoded at once, at most.
BLOCK_TEXTS = 2000
BLOCK_BYTES = 4 << 20

#: Items are fed in runs of this size, the longest of a run first, so that the short ones fill up
#: what the long ones leave; the open bins should hold a run.
RUN = 4096
OPEN_BINS = 8192

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE_FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32"]


class BestFit:
    """Open bins by free space; ``place`` returns (bin, offset), closed bins go to ``on_close``."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0
        self.n_open = 0
        self.n_bins = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        got = stack.pop()
        if not stack:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return got

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.mask |= 1 << left
            self.n_open += 1
            if self.n_open > self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
        return number, self.capacity - free

    def still_open(self) -> dict[int, int]:
        """Bin number -> used length of the bins not closed yet."""
        return {b: self.capacity - free for free, stack in enumerate(self.by_free) for b in stack}


# The mark between pre-tokens, characters that the tokenizer's normalizer does not take for white space but
# str.split does, the opening of its special tokens, and the one letter that
# str.lower treats by its place in the word.
_WHOLE = "[\\x00\x1c-\x1f\u03a3]|<\\|"


def load_tokenizer(path: str | None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    return Tokenizer.from_file(path)


#: The tokenizer's pre-tokens of a word in normal form (fixed values of its file).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_WORD_END = "</w>"


class WordEncoder:
    """Token ids of texts as little-endian uint32 bytes.

    The tokenizer drops white space and no token spans it, so a text's ids are
    its words' ids in order, and a word's are those of its pre-tokens. Words
    seen before are looked up; the new pre-tokens of a block of texts go through
    the tokenizer joined by blanks, and the tokens that end a word part them
    again, by a faster encoder of the same vocabulary if a sample shows it to
    give the same ids. Texts with characters for which that does not hold are encoded whole.
    """

    def __init__(self, path: str | None, cached: int = CACHED_WORDS):
        self.tokenizer = load_tokenizer(path)
        self.cached = cached
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.marked = self._marked_encoder(vocabulary)

    def _marked_encoder(self, vocabulary: dict[str, int]):
        """An encoder of the same vocabulary for many pre-tokens, each closed by a zero byte; None if ids differ.

        Ids are in the order of the merges, so they are the ranks of the byte
        strings, where a word's end is a zero byte, which joins the last one first.
        """
        import tiktoken
        byte = byte_level()
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks, words = {}, []
        for token, i in vocabulary.items():
            core = token.removesuffix(_WORD_END)
            if token not in added and all(c in byte for c in core):
                ranks[bytes(map(byte.__getitem__, core)) + b"\0" * (core != token)] = i
                if core != token and core.isascii() and core.isalpha() and core.islower():
                    words.append(core)
        if any(bytes([b]) not in ranks for b in range(256)) or len(ranks) + len(added) != len(vocabulary):
            return None
        coder = tiktoken.Encoding("marked", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        words.sort()
        sample = [a + b for a, b in zip(words[::20], words[7::20])]
        same = coder.encode_ordinary("\0".join(sample) + "\0") == [
            i for e in self.tokenizer.encode_batch(sample, add_special_tokens=False) for i in e.ids]
        return coder if same else None

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> None:
        for a in range(0, len(parts), 500):
            some = parts[a:a + 500]
            data = (np.array(self.marked.encode_ordinary("\0".join(some) + "\0"), "<u4").tobytes() if self.marked
                    else self._encode([" ".join(some)])[0])
            ends = (4 * np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 4).tolist()
            if len(ends) == len(some) and ends[-1] == len(data):
                self.parts.update(zip(some, [data[x:y] for x, y in zip([0, *ends], ends)]))
            else:
                self.parts.update(zip(some, self._encode(some)))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        normal = [(w if w.isascii() else unicodedata.normalize("NFC", w)).lower() for w in words]
        # letters alone are one pre-token
        split = [None if n.isalpha() else _PARTS.findall(n) for n in normal]
        single = {n for n, s in zip(normal, split) if s is None}
        new = list(single.union(*filter(None, split)).difference(self.parts))
        self._encode_parts(new)
        look = self.parts.__getitem__
        out = [look(n) if s is None else b"".join(map(look, s)) for n, s in zip(normal, split)]
        for x in new[:max(0, len(self.parts) - self.cached)]:
            del self.parts[x]
        return out

    def block(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a block; each distinct word of the block is looked up once."""
        odd = pc.match_substring_regex(texts, _WHOLE).fill_null(False).to_numpy(zero_copy_only=False)
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        found = list(map(self.known.get, words))
        gaps = [k for k, x in enumerate(found) if x is None]
        new = [words[k] for k in gaps]
        for k, x in zip(gaps, self._encode_words(new)):
            found[k] = x
        room = self.cached - len(self.known)
        if room > 0:  # words in the order in which they come, so the frequent ones are first
            self.known.update((words[k], found[k]) for k in gaps[:room] if len(words[k]) <= 64)
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        word = coded.indices.to_numpy()
        each = size[word]
        upto = np.append(0, np.cumsum(each))
        out = ids[np.repeat((np.cumsum(size) - size)[word] - upto[:-1], each) + np.arange(upto[-1])]
        cuts = upto[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        for k, whole in enumerate(odd.tolist()):
            yield self._encode([texts[k].as_py()])[0] if whole else out[cuts[k]:cuts[k + 1]].tobytes()


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded number and bytes (a longer text is a block of its own)."""
    upto = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        most = (upto[a - 1] if a else 0) + BLOCK_BYTES
        b = min(max(a + 1, int(np.searchsorted(upto, most, side="right"))), a + BLOCK_TEXTS)
        yield a, min(b, len(texts))
        a = min(b, len(texts))


def _pieces_of(path: str | None, length: int, end_id: int) -> Callable:
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        coder = WordEncoder(path)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for a, b in text_blocks(texts):
                rows = []
                for doc, data in zip(ids[a:b], coder.block(texts.slice(a, b - a))):
                    data += end
                    for p, at in enumerate(range(0, len(data), 4 * length)):
                        cut = data[at:at + 4 * length]
                        rows.append((doc, p, at // 4, len(cut) // 4, zlib.crc32(cut)))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _ARROW)], PIECE_FIELDS)
    return run


_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def pieces(docs: DataFrame, tokenizer_path: str | None = None,
           length: int = SEQUENCE_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pieces_of(tokenizer_path, length, end_id), PIECE_SCHEMA)


def _bin_id(level: int, task: int, number: int) -> int:
    # two low bits tell packed bins (1) from full pieces (0)
    return ((((level << 20) | task) << 32 | number) << 2) | 1


def _pack(columns: list[str], capacity: int, open_bins: int, level: int) -> Callable:
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        bins = BestFit(capacity, open_bins)
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            placed = [None] * len(lengths)
            for a in range(0, len(lengths), RUN):
                run_of = lengths[a:a + RUN]
                for k in np.argsort(-run_of, kind="stable").tolist():
                    placed[a + k] = bins.place(int(run_of[k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array([_bin_id(level, task, b) for b, _ in placed], pa.int64()),
                   pa.array([o for _, o in placed], pa.int64()),
                   pa.nulls(len(placed), pa.int64())],
                [*columns, "bin", "offset", "used"])
        left = bins.still_open()
        if left:  # rows of their own: the open bins and what they hold
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(left), batch.schema.field(c).type) for c in columns]
                + [pa.array([_bin_id(level, task, b) for b in left], pa.int64()),
                   pa.nulls(len(left), pa.int64()), pa.array(list(left.values()), pa.int64())],
                [*columns, "bin", "offset", "used"])
    return run


def pack(items: DataFrame, capacity: int = SEQUENCE_LENGTH, open_bins: int = OPEN_BINS,
         items_per_task: int = 200_000) -> DataFrame:
    """Place ``items`` (a column ``length`` of 1 to ``capacity``, any others) into bins.

    Adds ``sequence_id`` and ``offset``. Items of full length get a bin each
    without going through a task.
    """
    full = items.filter(F.col("length") == capacity).select(
        "*", (F.monotonically_increasing_id() * 4).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    columns = items.columns
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    todo, n_todo, level = items.filter(F.col("length") < capacity), None, 0
    levels: list[DataFrame] = []
    while True:
        n_todo = todo.count()
        tasks = max(1, -(-n_todo // items_per_task))
        key = F.xxhash64(*todo.columns)
        dealt = todo.repartition(tasks, key).sortWithinPartitions(key, *todo.columns)
        cols, kinds = (columns, types) if not level else (["length", "of"], "`length` long, `of` long")
        placed = stored(dealt.mapInArrow(
            _pack(cols, capacity, open_bins, level),
            f"{kinds}, bin long, offset long, used long"), f"packing-level{level}")
        levels.append(placed.filter("used is null").drop("used"))
        if not level and placed.rdd.getNumPartitions() == 0:
            break
        left = placed.filter("used is not null").select(
            F.col("used").alias("length"), F.col("bin").alias("of"))
        n_left = left.count()
        # done when one task had all items, or a level no longer shrinks them
        if n_left == 0 or level and (tasks == 1 or n_left >= n_todo):
            break
        todo, level = left, level + 1
    # bins of the last level downwards: where each lower bin lies in its sequence
    moved = None
    for lower in reversed(levels[1:]):
        at = lower.select(F.col("of").alias("bin"), F.col("bin").alias("up"),
                          F.col("offset").alias("base"))
        if moved is not None:
            at = (at.alias("a").join(moved.alias("m"), F.col("a.up") == F.col("m.bin"), "left")
                  .select(F.col("a.bin"), F.coalesce("m.up", "a.up").alias("up"),
                          (F.col("a.base") + F.coalesce("m.base", F.lit(0))).alias("base")))
        moved = at
    out = levels[0]
    if moved is None:
        packed = out.withColumnRenamed("bin", "sequence_id")
    else:
        packed = (out.alias("a").join(moved.alias("m"), F.col("a.bin") == F.col("m.bin"), "left")
                  .select(*[F.col(f"a.{c}") for c in columns],
                          F.coalesce("m.up", "a.bin").alias("sequence_id"),
                          (F.col("a.offset") + F.coalesce("m.base", F.lit(0))).alias("offset")))
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None,
                   length: int = SEQUENCE_LENGTH, end_id: int = END_ID,
                   open_bins: int = OPEN_BINS, items_per_task: int = 200_000) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text), cut what is longer than ``length`` and pack the pieces."""
    cut = stored(pieces(docs, tokenizer_path, length, end_id), "pieces")
    return pack(cut, length, open_bins, items_per_task)
