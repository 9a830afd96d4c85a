"""Quality rules whose thresholds come from the data.

Every text is measured once, in whole. Per language and source, KLL sketches (mergeable, so partial sketches meet map
side and the sketches of sources merge into those of a language) hold the distribution of three ratios over the
documents that pass the base rules. A document is rejected when a ratio lies far outside its group: beyond the median
by ``SPREADS`` times the distance from the 10 % quantile to the median, and by no less than a tolerance. The spread is
taken on the side that junk does not touch, so the rule holds while less than half of a group is junk. The thresholds
join the measures on language and source. Groups with few documents use the sketch of their language, and few of those
the one of all documents.

Defined results: a null or empty text has no words and fails the base rules; null language or source is a group of
its own; repeated rows are judged alike and stay as often as they came; an empty table gives no rows; other columns
pass through, those named like a measure are replaced; a group without evidence rejects nothing beyond the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.tables import materialise
from cartwheel.llm.textops import RollingHash, chunks, mix, text_buffer, window_keys, words

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SKETCH_K = 2000
MIN_GROUP = 100
SPREADS = 6.0
# ratio → (tolerance, whether small values are judged too)
RATIOS = {"symbol_ratio": (0.1, False), "word_length": (2.5, True), "dup_line_ratio": (0.4, False)}

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(in a group of two or more, not the first of its group), in the given order."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    any_, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def measure_texts(buffer: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of the documents of one buffer."""
    n_docs = len(offsets) - 1
    starts, ends, doc = words(buffer, offsets)
    hashes = RollingHash(buffer)
    salt = mix(np.arange(1, n_docs + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    inside = np.zeros(len(buffer) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out = {
        "n_words": np.bincount(doc, minlength=n_docs),
        "word_chars": _per_doc(inside & _LEAD[buffer], offsets),
        "n_symbols": _per_doc(_SYMBOLS[buffer], offsets),
    }
    breaks = np.flatnonzero(buffer == 10)
    first = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    first = first[first < len(buffer)]
    line_doc = np.searchsorted(offsets, first, "right") - 1
    # a line ends at the next break or with its document
    next_break = np.append(breaks, len(buffer))[np.searchsorted(breaks, first, "left")]
    last = np.minimum(next_break, offsets[line_doc + 1])
    seen = np.searchsorted(starts, last, "left") > np.searchsorted(starts, first, "left")
    first, last, line_doc = first[seen], last[seen], line_doc[seen]
    _, later = _repeated(hashes.of(first, last) ^ salt[line_doc])
    out["n_lines"] = np.bincount(line_doc, minlength=n_docs)
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n_docs)
    keys = window_keys(hashes.of(starts, ends), WINDOW)
    whole = np.flatnonzero(doc[: len(keys)] == doc[WINDOW - 1:]) if len(keys) else np.zeros(0, np.int64)
    again, _ = _repeated(keys[whole] ^ salt[doc[whole]])
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, whole[again], 1)
    np.subtract.at(cover, whole[again] + WINDOW, 1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n_docs)
    return out


def measured(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` (or its columns ``keep``) with the measures, base_failed and the ratios."""
    keep = [c for c in (keep or docs.columns) if c not in (*MEASURES, *RATIOS, "base_failed", "_text")]
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(len(keep)))
            parts = [measure_texts(buffer[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]) for a, b in chunks(offsets)]
            found = [np.concatenate([p[m] for p in parts]) if parts else np.zeros(0, np.int64) for m in MEASURES]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *[pa.array(x, pa.int64()) for x in found]],
                                             names=[*keep, *MEASURES])

    out = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text")).mapInArrow(run, schema)
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return (out.withColumn("base_failed", failed)
            .withColumn("symbol_ratio", F.when(n > 0, F.col("n_symbols") / n))
            .withColumn("word_length", F.when(n > 0, F.col("word_chars") / n))
            .withColumn("dup_line_ratio", F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines"))))


def thresholds(rows: DataFrame) -> DataFrame:
    """One row per language and source with ``<ratio>_low`` and ``<ratio>_high``."""
    good = rows.filter(~F.col("base_failed"))
    sketch = [F.kll_sketch_agg_double(r, SKETCH_K).alias(r) for r in RATIOS]
    merged = [F.kll_merge_agg_double(r, SKETCH_K).alias(r) for r in RATIOS]
    # the sketches are written: their random bits must not be drawn again for another use
    by_group = materialise(good.groupBy("lang", "source").agg(F.count("*").alias("n"), *sketch), "quality-sketches")
    by_lang = by_group.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    overall = by_group.agg(F.sum("n").alias("n"), *merged)
    groups = (by_group.alias("g")
              .join(by_lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")))
              .join(F.broadcast(overall.alias("a"))))  # one row

    def pick(column: str) -> Column:
        return (F.when(F.col("g.n") >= MIN_GROUP, F.col(f"g.{column}"))
                .when(F.col("l.n") >= MIN_GROUP, F.col(f"l.{column}")).otherwise(F.col(f"a.{column}")))

    chosen = groups.select("g.lang", "g.source", *[pick(r).alias(r) for r in RATIOS])
    out = [F.col("lang"), F.col("source")]
    for ratio, (tolerance, both) in RATIOS.items():
        low, mid, high = (F.kll_sketch_get_quantile_double(ratio, F.lit(q)) for q in (0.1, 0.5, 0.9))
        above = F.greatest(F.lit(tolerance), SPREADS * (mid - low))
        below = F.greatest(F.lit(tolerance), SPREADS * (high - mid))
        out.append((mid + above).alias(f"{ratio}_high"))
        out.append((mid - below if both else F.lit(None).cast("double")).alias(f"{ratio}_low"))
    return chosen.select(*out)


def judge(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` with ``kept``: not failed by the base rules and inside the limits of its group."""
    names = [c for c in limits.columns if c not in ("lang", "source")]
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *names)
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    fine = ~F.col("base_failed")
    for ratio in RATIOS:
        fine &= F.coalesce(F.col(ratio) <= F.col(f"{ratio}_high"), F.lit(True))
        fine &= F.coalesce(F.col(ratio) >= F.col(f"{ratio}_low"), F.lit(True))
    return joined.withColumn("kept", fine).drop("_lang", "_source", *names)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns.

    The texts are measured twice, once for the thresholds and once to filter: reading them again is cheaper than
    writing and shuffling them.
    """
    limits = thresholds(measured(docs, ["lang", "source"]))
    return judge(measured(docs), materialise(limits, "quality-limits")).filter("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = materialise(measured(docs, ["doc_id", "lang", "source"]), "quality-measures")
    return judge(rows, thresholds(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {"op7_quality_rules": (op7_quality_rules, None)}
