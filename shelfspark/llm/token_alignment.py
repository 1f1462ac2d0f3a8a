"""Alignment of the tokens of two tokenizers by their byte ranges, and the corpus counts of linked ids.

A and B encode the same bytes (a blank and the text). Tokens of both, of a block
of texts laid end to end, are sorted by the byte they start at; the running
maximum of their ends, taken over all before, tells where a start reaches it:
there a group begins. Between two neighbouring starts exactly one token of A and
one of B lie over each other: these are the links, so a group of a and b tokens
has a + b - 1 of them and none is formed that does not overlap.

Corpus counts: every text's distinct linked id pairs are written once with their
number, a pair's count is the number of texts that hold it, and an id of A has
its highest. The ``known_pairs`` most frequent pairs are broadcast (a fixed
bound), so their counts are added up where the texts lie; what a text holds of
rarer pairs is joined with the counts by pair and summed by text.

Defined cases: null and empty texts, and texts that one of the tokenizers does
not give back byte by byte, have no tokens: counts of 0 and an empty digest;
special tokens' strings in a text are plain text; rows with the same id or a
null id are texts of their own; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared, byte_level, stored

KNOWN_PAIRS = 1 << 20
#: Characters of text encoded at once, and texts at most.
CHARS_AT_ONCE = 400_000
TEXTS_AT_ONCE = 200
#: An id pair is one number: A's id times this plus B's id.
PAIR = 1 << 24

#: Units whose ids a worker remembers; further ones are encoded again when they come.
KNOWN_UNITS = 300_000
#: Where texts are cut for encoding, and what a text without has none but the plain blanks between words.
_CUT = re.compile(r"(?<=\S)(?= )")
_RUN = re.compile(r"\s | $")
_PROBE = "It's  a 12,5 -- don't\n\n  x\ty \u3000z!! 'll I'll  \n end 7th?  "

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<int>")
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class Tokenizers:
    """A (byte-level BPE) and B (sentence pieces), with the bytes of every id."""

    def __init__(self, a_path: str | None, b_path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        if a_path is None or b_path is None:
            import public_tokenizers
            a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
            b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = byte_level()
        named = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(map(byte.__getitem__, named[i])) if i in named and all(c in byte for c in named[i])
                        else named.get(i, "").encode() for i in range(max(named) + 1)]
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.odd: set[str] = set()
        # cut texts only with tokenizers for which units hold: no piece of B goes on after a word's
        # end, and A's own tokens of a sample of marks, digits and white space are those of its units
        self.cuts = False
        self.cuts = (not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
                     and self.whole(_PROBE) == tuple(map(b"".join, zip(*self._of(_CUT.split(" " + _PROBE))))))

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def whole(self, text: str) -> tuple[bytes, bytes] | None:
        """Ids of a blank and the text as little-endian 32-bit integers; None if a side does not give it back."""
        return self._of([" " + text])[0]

    def _of(self, units: list[str]) -> list[tuple[bytes, bytes] | None]:
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u[1:] for u in units], num_threads=1)  # which adds the blank
        out = []
        for u, x, y in zip(units, a, b):
            y = y if u != " " else [self.b.piece_to_id("▁")]
            data = u.encode("utf-8", "surrogatepass")
            same = (b"".join(map(self.a_bytes.__getitem__, x)) == data
                    and b"".join(map(self.b_bytes.__getitem__, y)) == data)
            out.append((np.asarray(x, "<i4").tobytes(), np.asarray(y, "<i4").tobytes()) if same else None)
        return out

    def _of_units(self, units: list[str]) -> list[tuple[bytes, bytes] | None]:
        """As ``_of``, for units: many are encoded as one text and parted at their bytes."""
        if not self.cuts:
            return self._of(units)
        out: dict[str, tuple[bytes, bytes] | None] = {}
        plain = [u for u in units if not u[-1].isspace()]
        for x in range(0, len(plain), 500):
            some = plain[x:x + 500]
            ids = self.whole("".join(some)[1:])
            if ids is None:  # one of them is not given back
                out.update(zip(some, self._of(some)))
                continue
            ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) for u in some])
            parts = []
            for data, sizes in zip(ids, (self.a_sizes, self.b_sizes)):
                cuts = [0, *(4 * np.searchsorted(np.cumsum(sizes[np.frombuffer(data, "<i4")]), ends) + 4).tolist()]
                parts.append([data[i:j] for i, j in zip(cuts, cuts[1:])])
            out.update(zip(some, zip(*parts)))
        rest = [u for u in units if u not in out]
        out.update(zip(rest, self._of(rest) if rest else []))
        return [out[u] for u in units]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of both for each text; both empty where a joined text is not a blank and the text.

        No token of either tokenizer goes over a blank that follows a character
        other than white space, so a text's ids are those of its units, cut
        there, in order; units seen before are looked up.
        """
        units = [self._units(" " + t) if t else [] for t in texts]
        new = list(set().union(*units).difference(self.known_a))
        for unit, ids in zip(new, self._of_units(new)):
            if ids is None:
                self.odd.add(unit)
                ids = (b"", b"")
            self.known_a[unit], self.known_b[unit] = ids
        a, b = ([b"".join(map(known.__getitem__, u)) for u in units] for known in (self.known_a, self.known_b))
        if self.odd:
            for k, t in enumerate(texts):
                if not self.odd.isdisjoint(units[k]):
                    a[k], b[k] = self.whole(t) or (b"", b"")
        full = len(self.known_a) > KNOWN_UNITS
        for u in new:
            if full or len(u) > 64:
                del self.known_a[u], self.known_b[u]
                self.odd.discard(u)
        return a, b

    def _units(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if _RUN.search(text, 1) or text[1] == " ":
            return _CUT.split(text)
        return [" " + w for w in text[1:].split(" ")]


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray):
    """Tokens of the same bytes -> (group of each A token, of each B token, A's and B's token of each link)."""
    sizes = np.concatenate([a_sizes, b_sizes])
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    ends = np.concatenate([a_ends, b_ends])
    starts = ends - sizes
    is_b = np.repeat(np.array([False, True]), [len(a_sizes), len(b_sizes)])
    order = np.lexsort((is_b, starts))
    start, reach = starts[order], np.maximum.accumulate(ends[order])
    opens = np.append(True, start[1:] >= reach[:-1])[:len(order)]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    # within a group: what of each side was begun last before the next start lies over each other
    b_here = is_b[order]
    a_at, b_at = np.cumsum(~b_here) - 1, np.cumsum(b_here) - 1
    last = np.append(start[1:] != start[:-1], True)[:len(order)]
    return group[:len(a_sizes)], group[len(a_sizes):], a_at[last], b_at[last]


def _digits(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ASCII bytes of the ids, each followed by its mark, and the length of each."""
    width = len(str(int(ids.max()))) if len(ids) else 1
    table = np.full((len(ids), width + 1), 32, np.uint8)
    left, size = ids.copy(), np.ones(len(ids), np.int64)
    for k in range(1, width):
        size += ids >= 10 ** k
    for k in range(width):
        here = size > k
        table[here, (size - 1 - k)[here]] = 48 + left[here] % 10
        left //= 10
    table[np.arange(len(ids)), size] = marks
    return table[np.arange(width + 1) <= size[:, None]], size + 1


class Aligned:
    """The alignment of a block of texts, whose tokens lie end to end."""

    def __init__(self, coders: Tokenizers, texts: list[str]):
        a, b = coders.encode(texts)
        self.n_a, self.n_b = (np.array([len(x) // 4 for x in side]) for side in (a, b))
        self.a, self.b = (np.frombuffer(b"".join(side), "<i4").astype(np.int64) for side in (a, b))
        self.a_group, self.b_group, self.link_a, self.link_b = coalesce(coders.a_sizes[self.a], coders.b_sizes[self.b])
        self.a_text = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = self._of_texts(np.append(True, self.a_group[1:] != self.a_group[:-1])[:len(self.a)])
        self.n_links = np.bincount(self.a_text[self.link_a], minlength=len(texts))

    def _of_texts(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.a_text[flags], minlength=len(self.n_a))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of each text in order: (pair, how often, pairs of each text)."""
        pair = self.a[self.link_a] * PAIR + self.b[self.link_b]
        text = self.a_text[self.link_a]
        order = np.lexsort((pair, text))
        pair, text = pair[order], text[order]
        head = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1]))[:len(pair)])
        return pair[head], np.diff(np.append(head, len(pair))), np.bincount(text[head], minlength=len(self.n_a))

    def digests(self) -> list[str]:
        """Hash of each text's groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        # places of all tokens when a group's A tokens stand before its B tokens
        n = len(self.a) + len(self.b)
        groups = int(self.a_group[-1]) + 1 if len(self.a) else 0
        a_in, b_in = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        a_place = np.arange(len(self.a)) + (np.cumsum(b_in) - b_in)[self.a_group]
        b_place = np.arange(len(self.b)) + np.cumsum(a_in)[self.b_group]
        ids, marks = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[a_place], ids[b_place] = self.a, self.b
        marks[np.cumsum(a_in + b_in) - b_in - 1] = ord("|")
        marks[np.cumsum(a_in + b_in) - 1] = ord(";")
        data, size = _digits(ids, marks)
        upto = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(self.n_a + self.n_b))]
        return [sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(upto[:-1], upto[1:])]


def _blocks(texts: list[str]):
    """Ranges of texts of bounded number and size (a longer text is a block of its own)."""
    a = size = 0
    for k, t in enumerate(texts):
        if k > a and (k - a == TEXTS_AT_ONCE or size + len(t) > CHARS_AT_ONCE):
            yield a, k
            a, size = k, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """A row per text: its numbers, the digest of its groups, its distinct id pairs and how often each is linked."""
    def run(batches):
        from pyspark import TaskContext
        coders = Tokenizers(a_path, b_path)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column("doc_id")
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for x, y in _blocks(texts):
                got = Aligned(coders, texts[x:y])
                pair, times, each = got.pairs()
                at = pa.array(np.append(0, np.cumsum(each)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + y - x)), ids.slice(x, y - x), pa.array(got.n_a), pa.array(got.n_b),
                     pa.array(got.n_groups), pa.array(got.n_links), pa.array(got.digests()),
                     pa.ListArray.from_arrays(at, pa.array(pair)),
                     pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32)))],
                    [c.split()[0] for c in ALIGNED.split(", ")])
                row += y - x
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): texts that hold the pair, and whether no pair of its A id is in more."""
    counted = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")),
                     "pair-counts")
    a = F.expr(f"pair div {PAIR}L")
    highest = counted.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))
    return (counted.withColumn("a", a).join(highest, "a")
            .select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))


def _add_known(shared) -> Callable:
    """Sums of the broadcast pairs; the others are handed on."""
    def run(batches):
        pair, n, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            flat, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pair, flat), max(0, len(pair) - 1))
            known = pair[at] == flat if len(pair) else np.zeros(len(flat), bool)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], owner[known], times[known] * best[at[known]])
            np.add.at(sums[1], owner[known], times[known] * n[at[known]])
            rest = np.append(0, np.cumsum(np.bincount(owner[~known], minlength=batch.num_rows))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in _NUMBERS], pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(pa.array(rest), pa.array(flat[~known])),
                 pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~known]))],
                [*_NUMBERS, "n_best", "count_sum", "pairs", "times"])
    return run


_NUMBERS = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def link_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
                known_pairs: int = KNOWN_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text."""
    spark = docs.sparkSession
    aligned = stored(align(docs, a_path, b_path), "aligned")
    counts = stored(pair_counts(aligned), "pairs-best")
    known = stored(counts.orderBy(F.desc("n"), "pair").limit(known_pairs), "pairs-known")
    got = known.toArrow()
    order = np.argsort(got["pair"].to_numpy())
    shared = Shared(spark, (got["pair"].to_numpy()[order], got["n"].to_numpy()[order],
                            got["best"].to_numpy()[order].astype(bool)))
    summed = stored(aligned.mapInArrow(_add_known(shared), ALIGNED.split(", pairs")[0]
                                       + ", n_best long, count_sum long, pairs array<long>, times array<int>"), "aligned-sums")
    rare = (summed.filter(F.size("pairs") > 0)
            .select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
            .join(counts, "pair").groupBy("row").agg(
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    add = lambda x, y: (F.col(x) + F.coalesce(F.col(y), F.lit(0))).cast("long").alias(x)
    return summed.drop("pairs", "times").join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", add("n_best", "more_best"), add("count_sum", "more_sum"),
        "groups_sha256")
