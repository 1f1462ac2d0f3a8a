"""Language identification by compression.

Each language has a zstandard dictionary of raw content: texts of a bounded
sample of its labelled documents, joined. What is in a longer dictionary is found
there more often, so two languages are compared with the first bytes of the
longer one's, as many as the shorter has; a language with a shorter dictionary
has to be smaller by ``MIN_MARGIN``, for few bytes tell less. Languages are gone
through from the longest dictionary on, each against the best so far. A text is cut into chunks, so
that the dictionary keeps its weight in long texts, and each chunk is
compressed with every dictionary; the language with the fewest bytes in all is
chosen. The margin is how much larger, relatively, the nearest other is; a margin
below ``min_margin`` rejects: ``lang`` is ``und`` then and ``lang_guess`` still
names the smallest.

Bounds of the fit: ``SAMPLE_DOCS`` documents per language of any length, the
first ``MAX_CHARS`` characters of each, and ``DICTIONARY_BYTES`` per language; a
language with less has a shorter dictionary. Every document is classified over
its whole text.

Defined cases: a null text or one without a letter is ``und`` with score 0;
equal sizes go to the language that sorts first; repeated rows are classified
one by one; with no labelled row at all every document is ``und``; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared
from shelfspark.llm.sampling import bounded_sample

SAMPLE_DOCS = 200
MAX_CHARS = 4000
DICTIONARY_BYTES = 96 << 10
CHUNK_BYTES = 4 << 10
LEVEL = 12
#: A text below this length is written three times: alone it would often be stored uncompressed.
SHORT_BYTES = 256
MIN_MARGIN = 0.02
UNKNOWN = "und"
#: Relative size differences of this order count as one unit of log odds.
SCALE = 0.02

_LETTER = re.compile(r"[^\W\d_]")
# what says nothing about a language: ASCII digits and punctuation
_NOISE = bytes(c for c in range(33, 127) if not chr(c).isalpha())


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(None, _NOISE).split())


def fit(labelled: DataFrame) -> dict[str, bytes]:
    """Dictionaries from ``labelled`` (doc_id, text, lang); null languages are skipped."""
    rows = labelled.filter("lang is not null and text is not null").select(
        "doc_id", "lang", F.substring("text", 1, MAX_CHARS).alias("text"))
    got = bounded_sample(rows, "lang", SAMPLE_DOCS)
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(got["lang"].to_pylist(), got["text"].to_pylist()):
        texts.setdefault(lang, []).append(normal(text))
    joined = {lang: b" ".join(t)[:DICTIONARY_BYTES] for lang, t in sorted(texts.items())}
    return {lang: data for lang, data in joined.items() if data.strip()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        # longest first; equal lengths by name
        self.data = dict(sorted(dictionaries.items(), key=lambda x: (-len(x[1]), x[0])))
        self.coders: dict[tuple[str, int], object] = {}

    def _coder(self, lang: str, size: int):
        """Compressor with the first ``size`` bytes of the language's dictionary."""
        import zstandard
        if (lang, size) not in self.coders:
            d = zstandard.ZstdCompressionDict(self.data[lang][:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders[lang, size] = zstandard.ZstdCompressor(
                dict_data=d, level=LEVEL, write_content_size=False, write_dict_id=False)
        return self.coders[lang, size]

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(smallest language, margin, score)."""
        if not text or not self.data or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        data = normal(text)
        if len(data) < SHORT_BYTES:
            data = b" ".join([data] * 3)
        chunks = [data[a:a + CHUNK_BYTES] for a in range(0, len(data), CHUNK_BYTES)] or [b""]
        sizes: dict[tuple[str, int], int] = {}

        def bytes_of(lang: str, size: int) -> int:
            if (lang, size) not in sizes:
                coder = self._coder(lang, size)
                sizes[lang, size] = sum(len(coder.compress(x)) for x in chunks)
            return sizes[lang, size]

        def excess(lang: str, other: str) -> float:
            """How much larger ``lang`` is than ``other``, both at the length of the shorter; it has a handicap."""
            a, b = len(self.data[lang]), len(self.data[other])
            handicap = MIN_MARGIN * ((a < b) - (a > b))
            return bytes_of(lang, min(a, b)) / bytes_of(other, min(a, b)) - 1 + handicap
        best = next(iter(self.data))
        for lang in self.data:
            if excess(lang, best) < 0:
                best = lang
        others = [max(0.0, excess(lang, best)) for lang in self.data if lang != best]
        return best, min(others, default=1.0), 1 / (1 + sum(math.exp(-x / SCALE) for x in others))


def classify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, lang (``und`` where rejected), lang_guess, margin, score of every document."""
    shared = Shared(docs.sparkSession, dictionaries)

    def run(batches):
        classifier = Classifier(shared.value)
        for batch in batches:
            texts = batch.column("text")
            found = [classifier(texts[i].as_py()) for i in range(len(texts))]
            guess, margin, score = zip(*found) if found else ((), (), ())
            lang = [g if m >= min_margin else UNKNOWN for g, m in zip(guess, margin)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(guess, pa.string()),
                 pa.array(margin, pa.float64()), pa.array(score, pa.float64())],
                ["doc_id", "lang", "lang_guess", "margin", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang string, lang_guess string, margin double, score double")
