"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a random but repeatable key (its hash). The keys of a source are cut into equal slices of the
key space, as many as the source needs for slices of ``SLICE_DOCS`` documents on average; a window over one slice and a
window over the slice totals of a source give every document the number of words before it. A source whose target is
``e`` times its size and a rest takes each document ``e`` times and then, in the order of the keys, documents up to
exactly the rest; the last one is taken in part.

Defined results: null or empty text has size 0 and is taken 0 words; a null source is a source, ordered last; a row
without an id has the hash of its text; equal keys are ordered by id, size and text; an empty table gives no rows; other
columns pass through.
A text cut for the mix ends behind its last taken word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.tables import materialise
from cartwheel.llm.textops import WORD

WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MAX_EPOCHS = 2
SLICE_DOCS = 2_000
SEED = "mix-1"
KEY_BITS = 60
WIDE = "decimal(20,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def shuffle_key(doc_id: Column, seed: str = SEED, otherwise: Column | None = None) -> Column:
    """60 hash bits as a number; ``seed`` names the shuffle. A null id is replaced by the text ``otherwise``."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("") if otherwise is None else otherwise, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = TOTAL_PERCENT,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, source_docs, target.

    Water-filling: with the sources in the order of size / weight, the first j that are full give the level
    (total - what they hold) / (weight of the others); the right j is the first whose level fills no further source.
    The windows here run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    turns = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("weight", F.element_at(
        turns, ((F.row_number().over(by_name) - 1) % F.lit(len(weights)) + 1).cast("int")).cast("bigint"))
    filling = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    # all in hundredths of a word, so that the sums are whole numbers
    per = (per.withColumn("cap", F.col("source_size") * F.lit(100 * max_epochs))
           .withColumn("total", F.sum("source_size").over(everything) * F.lit(percent))
           .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("open", F.sum("weight").over(rest))
           # the level if this source and all behind it stay open: right when this source does not overflow
           .withColumn("fits", F.col("left").cast(WIDE) * F.col("weight") <= F.col("cap").cast(WIDE) * F.col("open")))
    open_now = F.max("fits").over(filling.rowsBetween(Window.unboundedPreceding, 0))
    first = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("is_open", open_now)
           .withColumn("level", F.max(F.when(F.col("is_open"), F.struct(F.col("left"), F.col("open")))).over(first)))
    target = F.when(F.col("is_open"), F.col("level.left") * F.col("weight") / F.col("level.open")).otherwise(F.col("cap"))
    return per.select("source", "source_size", "source_docs", (target.cast("double") / F.lit(100.0)).alias("target"))


def mix(sized: DataFrame, key: str = "doc_id", seed: str = SEED, slice_docs: int = SLICE_DOCS, ties: tuple[str, ...] = (),
        **how) -> DataFrame:
    """``sized`` (key column, source, size and others) with source_size, target and taken.

    Columns of these three names, or of names with a leading underscore used here, are replaced. ``ties`` orders rows
    of one id; the first of them, a digest, also spreads rows without an id over the slices. Rows of size 0 are taken 0
    words and change nothing for others, so they are spread at will.
    """
    sized = sized.drop("source_size", "source_docs", "target", "taken", "_key", "_slice", "_source", "_of", "_inside",
                       "_slices_before")
    targets = materialise(source_targets(sized, **how), "mix-targets")
    own = shuffle_key(F.col(key), seed, F.col(ties[0]) if ties else None)
    anywhere = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - KEY_BITS)
    keyed = sized.withColumn("_key", F.when(F.col("size") > 0, own).otherwise(anywhere))
    # one row per source: adaptive execution broadcasts it when it is small and splits hot partitions otherwise
    keyed = (keyed.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
             .drop("_source"))
    slices = F.greatest(F.lit(1), F.ceil(F.col("source_docs") / F.lit(slice_docs))).cast("bigint")
    keyed = keyed.withColumn("_slice", F.floor(F.col("_key") / (F.lit(2**KEY_BITS) / slices)).cast("bigint"))
    part = keyed.groupBy("source", "_slice").agg(F.sum("size").alias("_slice_size"))
    earlier = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(F.col("source").alias("_source"), F.col("_slice").alias("_of"),
                       F.coalesce(F.sum("_slice_size").over(earlier), F.lit(0)).alias("_slices_before"))
    order = [F.col("_key"), F.col(key), F.col("size"), *[F.col(c) for c in ties]]
    inside = Window.partitionBy("source", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (keyed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(part, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_of"))))
    budget = F.floor(F.col("target")).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - epochs * F.col("source_size")
    partly = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_slices_before") - F.col("_inside")))
    return (placed.withColumn("taken", (epochs * F.col("size") + partly).cast("bigint"))
            .drop("_key", "_slice", "_slice_size", "_inside", "_source", "_of", "_slices_before", "source_docs"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, with its white space."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source and others) as the mix takes them: as often as it takes them whole, and
    once more up to their last taken word. n_chars, if there, follows a cut text. Rows alike in id, source and text
    share what their document is taken, in whole words.
    """
    digest = F.md5("text")
    names = docs.columns
    thin = materialise(docs.select("doc_id", "source", digest.alias("digest"), word_count(F.col("text")).alias("each")), "mix-rows")
    thin = thin.groupBy("doc_id", "source", "digest", "each").agg(F.count("*").alias("copies"))
    takes = mix(thin.withColumn("size", F.col("each") * F.col("copies")), ties=("digest",), **how)
    takes = takes.select(F.col("doc_id").alias("_id"), F.col("source").alias("_of"), F.col("digest").alias("_digest"), F.col("each").alias("_each"),
                         F.floor(F.col("taken") / F.col("copies")).cast("bigint").alias("_taken")).filter("_taken > 0")
    rows = docs.join(takes.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_of"))
                     & digest.eqNullSafe(F.col("_digest")))
    parts = F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("_taken") / F.col("_each")))
    rows = rows.withColumn("_part", F.explode(parts)).withColumn("_words", F.col("_taken") - (F.col("_part") - 1) * F.col("_each"))
    cut = F.col("_words") < F.col("_each")
    rows = rows.withColumn("text", F.when(cut, first_words(F.col("text"), F.col("_words"))).otherwise(F.col("text")))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in names])


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the digest of the text of rows without an id."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.when(F.col("doc_id").isNull(), F.md5("text")).alias("digest"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = materialise(sizes(docs), "mix-sizes")
    return mix(sized, ties=("digest",)).select("doc_id", "size", "source", "source_size", "target", "taken")


SQL = r"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    cast(concat('0x', substr(md5(concat('mix-1:', coalesce(cast(doc_id as varchar), md5(text)))), 1, 15)) as bigint) as k,
    case when doc_id is null then md5(text) end as digest
  from documents),
per as (
  select *, case (row_number() over (order by source is null, source) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from (select source, cast(sum(size) as bigint) as source_size from sized group by source)),
filled as (
  select *, source_size * 200 as cap,
    cast(sum(source_size) over () as bigint) * 150
      - cast(coalesce(sum(source_size * 200) over (f rows between unbounded preceding and 1 preceding), 0) as bigint) as rest,
    cast(sum(weight) over (f rows between current row and unbounded following) as bigint) as open_weight
  from per window f as (order by source_size / weight, source is null, source)),
level as (
  select rest, open_weight from filled where rest * weight <= cap * open_weight
  order by rest desc, open_weight desc limit 1),
targets as (
  select f.source, f.source_size,
    case when f.cap * l.open_weight >= l.rest * f.weight
      then cast(l.rest * f.weight / l.open_weight as double) else cast(f.cap as double) end / 100.0 as target
  from filled f cross join level l),
placed as (
  select s.doc_id, s.size, s.source, t.source_size, t.target,
    cast(coalesce(sum(s.size) over (partition by s.source order by s.k, s.doc_id, s.size, s.digest rows between unbounded preceding and 1 preceding), 0) as bigint) as before,
    cast(floor(t.target) as bigint) as budget,
    case when t.source_size > 0 then cast(floor(t.target) as bigint) // t.source_size else 0 end as epochs
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source, source_size, target,
  cast(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) as bigint) as taken
from placed
"""

QUERIES = {"op3_mix_sources": (op3_mix_sources, SQL)}
