"""Quality rules whose cutoffs come from the corpus itself.

A document's base counts give ratios (symbols per word character, characters
per word, repeated lines, repeated words, words). Per language and source, a
KLL quantile sketch of each ratio is built; sketches are merged to the
language's and the corpus's as well. A group's cutoffs are its quartiles widened
by ``SPREAD`` ranges. A range is the largest of three that the sketches give: the
interquartile range, the distance of median and outer tenth on the cutoff's side
(in units of the interquartile range of a normal distribution), and what one
event (``STEPS``) makes of the ratio in a document of median size, else a ratio
that is nearly constant would reject what differs by a hair. Farther tails are
not asked: they are what the rules are to reject. Cutoffs of groups with fewer
than ``MIN_GROUP`` rows pass over to the language's in proportion, wholly at
half as many, and the language's to the corpus's alike. Documents are joined with
their group's cutoffs.

Defined cases: null and empty texts have all counts 0 and fail the base rules;
null languages or sources are groups of their own; repeated rows are judged one
by one and count in the sketches; ties with a cutoff are kept; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import join_hot, stored

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Rows from which on a group has cutoffs wholly of its own.
MIN_GROUP = 200
SPREAD = 3.0
SKETCH_K = 400
#: Interquartile range of a normal distribution over its distance of median and tenth.
TENTH = 1.349 / 1.2816
#: ratio -> (numerator, denominator, fixed least range, lower cutoff too, upper cutoff too)
RULES = {
    "symbol_ratio": ("n_symbols", "word_chars", 0.0, False, True),
    "word_length": ("word_chars", "n_words", 0.0, True, True),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.0, False, True),
    "repeat_ratio": ("n_repeat_words", "n_words", 0.0, False, True),
}
#: ratio -> what one event adds to its numerator: a word in markup (**w**), an address among the words,
#: a line said again, a passage of a window's words said twice
STEPS = {"symbol_ratio": 4, "word_length": 16, "dup_line_ratio": 1, "repeat_ratio": 2 * WINDOW}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def base_counts(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for a text; n_lines counts the lines that have a word."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return 0, 0, len(data) - len(data.translate(None, SYMBOLS)), 0, 0, 0
    chars = len(text) - (len(data) - len(data.translate(None, SPACE)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if not x.isspace() and x]
    repeated = 0
    if len(words) > WINDOW:
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        n = len(h) - WINDOW + 1
        w = h[:n].copy()
        for k in range(1, WINDOW):
            w = (w ^ (w >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k:n + k]
        _, which, count = np.unique(w, return_inverse=True, return_counts=True)
        start = np.flatnonzero(count[which] > 1)
        if len(start):
            step = np.zeros(len(h) + 1, np.int64)
            step[start] += 1
            step[start + WINDOW] -= 1
            repeated = int((np.cumsum(step[:-1]) > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def _counted(batches):
    for batch in batches:
        texts = batch.column("text")
        rows = [base_counts(texts[i].as_py()) for i in range(len(texts))]
        columns = list(zip(*rows)) or [()] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "lang", "source")] + [pa.array(c, pa.int64()) for c in columns],
            ["doc_id", "lang", "source", *COUNTS])


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and the rules' ratios of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"),
                       F.col("source").cast("string"), "text").mapInArrow(
        _counted, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumns({
        name: F.col(top) / F.greatest(F.col(below), F.lit(1)) for name, (top, below, *_) in RULES.items()})


def sketches(rows: DataFrame) -> DataFrame:
    """A row per (lang, source): the number of documents that pass the base rules, sketches per ratio and its step."""
    return rows.filter("not base_failed").groupBy("lang", "source").agg(
        F.count("*").alias("rows"),
        *[F.kll_sketch_agg_double(name, SKETCH_K).alias(name) for name in RULES],
        *[F.kll_sketch_agg_double(F.lit(float(STEPS[name])) / F.greatest(F.col(below), F.lit(1)), SKETCH_K)
          .alias(f"{name}_step") for name, (_, below, *_) in RULES.items()])


def _cutoffs() -> list:
    out = []
    for name, (_, _, least, low, high) in RULES.items():
        # an empty sketch has no quantiles, and asking for one is an error
        at = lambda x, c=name: F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_double(c, F.lit(x)))
        q1, q2, q3, step = at(0.25), at(0.5), at(0.75), at(0.5, f"{name}_step")
        wide = lambda tail: SPREAD * F.greatest(q3 - q1, TENTH * tail, step, F.lit(least))
        out += [(q1 - wide(q2 - at(0.1)) if low else F.lit(None).cast("double")).alias(f"{name}_low"),
                (q3 + wide(at(0.9) - q2) if high else F.lit(None).cast("double")).alias(f"{name}_high")]
    return out


def _passing(rows: str, min_group: int, own, larger):
    """``own`` from ``min_group`` rows on, ``larger`` up to half as many, between them in proportion."""
    weight = 2 * F.col(rows) / F.lit(min_group) - 1
    return (F.when(weight >= 1, own).when(weight > 0, weight * own + (1 - weight) * larger).otherwise(larger))


def cutoffs(groups: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """lang, source, rows and the cutoffs of each group, of the smallest levels with enough rows."""
    merged = [F.sum("rows").alias("rows"),
              *[F.kll_merge_agg_double(c).alias(c) for n in RULES for c in (n, f"{n}_step")]]
    limits = [f"{n}_{side}" for n in RULES for side in ("low", "high")]
    of_lang = groups.groupBy("lang").agg(*merged).select("lang", F.col("rows").alias("lang_rows"), *[
        c.alias(f"lang_{n}") for c, n in zip(_cutoffs(), limits)])
    of_all = groups.agg(*merged).select(*[c.alias(f"all_{n}") for c, n in zip(_cutoffs(), limits)])
    own = groups.select("lang", "source", "rows", *_cutoffs())
    levels = (own.alias("o").join(of_lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")), "left")
              .drop(F.col("l.lang")).join(F.broadcast(of_all)))  # one row
    pick = lambda n: _passing("rows", min_group, F.col(n), _passing(
        "lang_rows", min_group, F.col(f"lang_{n}"), F.col(f"all_{n}")))
    return levels.select("lang", "source", "rows", *[pick(n).alias(n) for n in limits])


def filtered(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, the counts, base_failed, the ratios, ``failed`` (names of the rules it breaks) and kept."""
    rows = stored(counted(docs), "quality-counts")
    limits = cutoffs(stored(sketches(rows), "quality-sketches"), min_group)
    none = "\u0000none"  # a name for null, so that the join is by equality
    key = {"g_lang": F.coalesce("lang", F.lit(none)), "g_source": F.coalesce("source", F.lit(none))}
    limits = stored(limits.withColumns(key).drop("lang", "source"), "quality-cutoffs")
    joined = join_hot(rows.withColumns(key), limits, list(key), "rows", "left")
    failed = F.array_compact(F.array(*[
        F.when((F.col(n) < F.col(f"{n}_low")) | (F.col(n) > F.col(f"{n}_high")), F.lit(n)) for n in RULES]))
    return joined.select("doc_id", *COUNTS, "base_failed", *RULES, failed.alias("failed"),
                         (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"))
