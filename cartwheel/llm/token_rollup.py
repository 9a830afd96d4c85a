"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes (insert, revise, delete) is compared with the counts that hold so far and becomes signed rows: what
goes out is minus one document and minus its old count, what comes in is plus one and plus the new count. Totals only
ever add such rows up. A batch is written below its id and counts once its commit is there: a batch that died is
written over by its repetition, and a batch that is committed is not applied again.

Documents are dealt into buckets by a hash of their id, and a batch reads the counts of the buckets it touches. Every
``FOLD_EVERY`` batches the signed rows are folded into one row per document and version, the totals into one row per group,
and the ids of the batches into a table, so what a batch reads and lists does not grow with the number of batches before it.

Layout below ``root``: ``changes/batch=<id>/bucket=<n>`` signed rows per document, ``totals/batch=<id>`` their sums by
group, ``commits/batch=<id>`` the commit; ``state/fold=<n>`` with ``counts``, ``totals`` and ``batches`` and, written last,
its commit ``done``. A fold that died is written over; what a fold covers is deleted after its commit.

Defined results: a null text has no tokens but is a document; null source, language or id are values like others;
a document is an id and, where ids are not unique, a ``part`` of it that stands for ``docs`` rows alike; of several changes
of one document and version in one batch the last by ``sequence`` counts (where that is equal or not given, a delete, then
the greatest count); the query counts every row, whatever its id, and its parts are rows alike in source, language and text;
deleting what is not there changes nothing; an empty batch is committed; groups whose documents are all gone vanish.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.mixing import word_count
from cartwheel.llm.tables import materialise, scratch_dir
from cartwheel.llm.tokenize import default_path, groups, tokenizer
from cartwheel.sinks import files

COUNTS = "doc_id bigint, part bigint, source string, lang string, tokenizer string, docs bigint, tokens bigint"
CHANGES = COUNTS + ", bucket int"
TOTALS = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
GROUP = ["source", "lang", "tokenizer"]
BUCKETS = 32
FOLD_EVERY = 16


def _summed(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0")


class TokenRollup:
    """Totals below ``root``, a folder that all executors share. One writer at a time; the number of buckets is for life."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, fold_every: int = FOLD_EVERY):
        self.spark, self.root, self.buckets, self.fold_every = spark, root, buckets, fold_every

    def _bucket(self, doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id), F.lit(self.buckets)).cast("int")

    def _folds(self) -> list[int]:
        found = [int(n.split("=")[1]) for n in files.subfolders(self.spark, f"{self.root}/state")]
        return sorted(n for n in found if files.exists(self.spark, f"{self.root}/state/fold={n}/done/_SUCCESS"))

    def _folded(self, kind: str, schema: str) -> DataFrame:
        folds = self._folds()
        return (self.spark.read.schema(schema).parquet(f"{self.root}/state/fold={folds[-1]}/{kind}") if folds
                else self.spark.createDataFrame([], schema))

    def recent(self) -> list[str]:
        """Ids of the committed batches that no fold covers: ``fold_every`` of them at most, but for a fold that died."""
        names = [n.split("=", 1)[1] for n in files.subfolders(self.spark, f"{self.root}/commits")
                 if files.exists(self.spark, f"{self.root}/commits/{n}/_SUCCESS")]
        covered = {r.batch for r in self._folded("batches", "batch string").filter(F.col("batch").isin(names)).collect()} if names else set()
        return [n for n in names if n not in covered]

    def is_committed(self, batch: str) -> bool:
        return batch in self.recent() or not self._folded("batches", "batch string").filter(F.col("batch") == batch).isEmpty()

    def _read(self, kind: str, schema: str, folded: str) -> DataFrame:
        """Folded rows and those of the batches since."""
        rows = self._folded(folded, schema)
        for batch in self.recent():
            rows = rows.unionByName(self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/batch={batch}"))
        return rows

    def current(self, buckets: list[int] | None = None) -> DataFrame:
        """The count that holds of every document and version, with its bucket; only the given buckets are read."""
        rows = self._read("changes", CHANGES, "counts")
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(buckets))
        # a document's source may change, so its rows are summed per group too
        return _summed(rows, ["bucket", "doc_id", "part", *GROUP])

    def totals(self) -> DataFrame:
        return _summed(self._read("totals", TOTALS, "totals"), GROUP)

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (doc_id, source, lang, tokenizer, tokens; null tokens delete). False if it was applied before.

        More columns can be given: part; docs, how many documents with so many tokens each the change stands for; sequence,
        a number that ascends in the order of the changes."""
        if self.is_committed(batch):
            return False

        def given(column: str, otherwise: int | None) -> Column:
            return F.col(column).cast("bigint") if column in changes.columns else F.lit(otherwise).cast("bigint")

        last = F.max(F.struct(given("sequence", None).alias("at"), F.col("tokens").isNull().alias("gone"), "tokens", "source", "lang",
                              given("docs", 1).alias("docs")))
        news = materialise(changes.groupBy(F.col("doc_id").alias("_doc"), given("part", None).alias("_part"), F.col("tokenizer").alias("_tokenizer"))
                           .agg(last.alias("_new")).withColumn("_bucket", self._bucket(F.col("_doc"))), "rollup-news")
        touched = [r[0] for r in news.select("_bucket").distinct().collect()]  # numbers of buckets
        same = ((F.col("bucket") == F.col("_bucket")) & F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("part").eqNullSafe(F.col("_part"))
                & F.col("tokenizer").eqNullSafe(F.col("_tokenizer")))
        both = news.join(self.current(touched), same, "left")
        known = F.col("docs").isNotNull()
        out = F.when(known, F.struct(F.col("source"), F.col("lang"), (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")))
        came = F.when(~F.col("_new.gone"), F.struct(F.col("_new.source"), F.col("_new.lang"), F.col("_new.docs"),
                                                    (F.col("_new.tokens") * F.col("_new.docs")).alias("tokens")))
        signed = (both.select(F.col("_doc").alias("doc_id"), F.col("_part").alias("part"), F.col("_tokenizer").alias("tokenizer"),
                              F.explode(F.array(out, came)).alias("r"))
                  .filter("r is not null").select("doc_id", "part", "r.source", "r.lang", "tokenizer", "r.docs", "r.tokens")
                  .withColumn("bucket", self._bucket(F.col("doc_id"))))
        place = f"{self.root}/changes/batch={batch}"
        signed.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(place)
        stored = self.spark.read.schema(CHANGES).parquet(place)
        (stored.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .write.mode("overwrite").parquet(f"{self.root}/totals/batch={batch}"))
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.root}/commits/batch={batch}")
        if len(self.recent()) >= self.fold_every:
            self.fold()
        return True

    def fold(self) -> None:
        """Bring all committed batches into one state, and delete what it covers."""
        folds, recent = self._folds(), self.recent()
        place = f"{self.root}/state/fold={(folds[-1] if folds else 0) + 1}"
        own = self.spark.createDataFrame([(b,) for b in recent], "batch string")
        for kind, rows, by in (("counts", self.current(), ["bucket"]), ("totals", self.totals(), []),
                               ("batches", self._folded("batches", "batch string").unionByName(own), [])):
            writer = (rows.hint("rebalance", *by) if by else rows).write.mode("overwrite").option("partitionOverwriteMode", "static")
            (writer.partitionBy(*by) if by else writer).parquet(f"{place}/{kind}")
        self.spark.range(1).write.mode("overwrite").parquet(f"{place}/done")
        for batch in recent:  # the commit first: without it nothing of a batch is looked for
            for kind in ("commits", "changes", "totals"):
                files.delete(self.spark, f"{self.root}/{kind}/batch={batch}")
        for old in folds:
            files.delete(self.spark, f"{self.root}/state/fold={old}")


def bpe_counts(docs: DataFrame, columns: list[str], path: str | None = None) -> DataFrame:
    """``docs`` with the string columns ``columns`` replaced by their numbers of tokens (null stays null)."""
    path = path or default_path()
    names = docs.columns
    schema = ", ".join(f"`{n}` {'bigint' if n in columns else t}" for n, t in docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for batch in batches:
            out = []
            for name, column in zip(names, batch.columns):
                if name in columns:
                    texts = column.to_pylist()
                    n = [len(ids) // 4 for part in groups([t or "" for t in texts]) for ids in encode(part)]
                    column = pa.array([None if t is None else k for t, k in zip(texts, n)], pa.int64())
                out.append(column)
            yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.mapInArrow(run, schema)


def counted(docs: DataFrame) -> DataFrame:
    """Per document its counts by words and by tokens, those of the text without repeated lines where that differs, and a
    fingerprint of the text."""
    single = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    revised = F.when(single != F.col("text"), single)
    return bpe_counts(docs.select(
        "doc_id", "source", "lang", F.md5("text").alias("fingerprint"), word_count(F.col("text")).alias("words"),
        F.when(revised.isNotNull(), word_count(revised)).alias("new_words"),
        F.coalesce("text", F.lit("")).alias("bpe"), revised.alias("new_bpe")), ["bpe", "new_bpe"])


WORDS, BPE = "words-1", "byte_bpe_50k-1"


def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after the life of a corpus: all documents counted by words; a second tokenizer version added; texts with
    repeated lines revised, when the first three batches are folded; exact copies of documents with a smaller id deleted; the
    second batch delivered again."""
    rows = counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("docs"))
    alike = F.xxhash64("source", F.col("source").isNull(), "lang", F.col("lang").isNull(), "fingerprint", F.col("fingerprint").isNull())
    rows = materialise(rows.withColumn("part", alike), "token-counts")
    rollup = TokenRollup(spark, scratch_dir(spark, "token-rollup"), fold_every=3)

    def counts(version: str, column: str, of: DataFrame = rows) -> DataFrame:
        return of.select("doc_id", "part", "docs", "source", "lang", F.lit(version).alias("tokenizer"), F.col(column).alias("tokens"))

    rollup.apply("0001-words", counts(WORDS, "words"))
    rollup.apply("0002-bpe", counts(BPE, "bpe"))
    changed = rows.filter("new_words is not null")
    rollup.apply("0003-revised", counts(WORDS, "new_words", changed).unionByName(counts(BPE, "new_bpe", changed)))
    first = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    copies = rows.join(first, "fingerprint").filter(F.col("doc_id") > F.col("first")).withColumn("none", F.lit(None).cast("bigint"))
    rollup.apply("0004-copies", counts(WORDS, "none", copies).unionByName(counts(BPE, "none", copies)))
    rollup.apply("0002-bpe", counts(BPE, "bpe"))
    return rollup.totals()


QUERIES = {"op4_token_rollup": (op4_token_rollup, None)}
