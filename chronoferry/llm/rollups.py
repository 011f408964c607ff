"""Token counts as delta-maintained rollups."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoferry.llm.common import columns_as, extended, prepare, quoted, strings
from chronoferry.llm.pieces import DEFAULT_MODEL, read_model
from chronoferry.llm.tokens import loaded

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["docs", "tokens", "bytes"]
CHANGES = "op string, source string, lang string, tokenizer string, tokens long, bytes long, old_tokens long, old_bytes long"


def counted(docs: DataFrame, text_col: str = "text", model_path: str = DEFAULT_MODEL, name: str = "tokens") -> DataFrame:
    """`docs` with the number of tokens of its text as column `name`; null and empty texts have none."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    return extended(
        docs, text_col, name, "long", lambda text: pa.array(loaded(shared.value).counts(strings(text))), limit=4 << 20
    )


def changes(
    rows: DataFrame,
    op: str,
    tokenizer: str,
    tokens: Column,
    size: Column,
    old_tokens: Column | None = None,
    old_size: Column | None = None,
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """Changes of one kind: `insert` and `delete` of a document with its counts, or `revise` of old counts."""
    if op not in ("insert", "delete", "revise"):
        raise ValueError(f"unknown change {op!r}")
    if (op == "revise") != (old_tokens is not None and old_size is not None):
        raise ValueError("a revision, and nothing else, has old counts")
    nothing = F.lit(None).cast("long")
    return rows.select(
        F.lit(op).alias("op"),
        F.col(quoted(source_col)).cast("string").alias("source"),
        F.col(quoted(lang_col)).cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"),
        tokens.cast("long").alias("tokens"),
        size.cast("long").alias("bytes"),
        (nothing if old_tokens is None else old_tokens.cast("long")).alias("old_tokens"),
        (nothing if old_size is None else old_size.cast("long")).alias("old_bytes"),
    )


def between(old: DataFrame, new: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Changes that turn one counted snapshot (id, source, lang, tokenizer, tokens, bytes) into another.

    Documents are matched by id and tokenizer. Where source or language has changed, the document is
    deleted from its old group and inserted into the new one. Ids must be unique in a snapshot; null ids
    are matched with each other.
    """
    names = {c: c for c in [*KEYS, "tokens", "bytes"]}
    a, b = (columns_as(x, id=id_col, **names) for x in (old, new))
    here = F.col("a.id").eqNullSafe(F.col("b.id")) & F.col("a.tokenizer").eqNullSafe(F.col("b.tokenizer"))
    both = a.withColumn("has", F.lit(True)).alias("a").join(b.withColumn("has", F.lit(True)).alias("b"), here, "full")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & F.col("a.lang").eqNullSafe(F.col("b.lang"))
    had, has = F.col("a.has").isNotNull(), F.col("b.has").isNotNull()
    none = F.lit(None).cast("long")

    def change(op: str, when: Column, side: str, old_tokens: Column = none, old_bytes: Column = none) -> Column:
        values = [F.col(f"{side}.{c}").alias(c) for c in names]
        return F.when(when, F.struct(F.lit(op).alias("op"), *values, old_tokens.alias("old_tokens"), old_bytes.alias("old_bytes")))

    revised = had & has & same
    made = F.array_compact(F.array(
        change("delete", had & ~revised, "a"),
        change("insert", has & ~revised, "b"),
        change("revise", revised & ~(F.col("a.tokens").eqNullSafe(F.col("b.tokens")) & F.col("a.bytes").eqNullSafe(F.col("b.bytes"))),
               "b", F.col("a.tokens"), F.col("a.bytes")),
    ))
    return both.select(F.explode(made).alias("change")).select("change.*")


def deltas(rows: DataFrame) -> DataFrame:
    """Changes as signed sums by source, language and tokenizer; null counts are 0. Sums are made on the
    map side first, so a group with very many changes is no burden."""
    sign = F.when(F.col("op") == "delete", -1).otherwise(1)
    value = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("tokens", "bytes", "old_tokens", "old_bytes")}
    revised = F.col("op") == "revise"
    return rows.groupBy(*KEYS).agg(
        F.sum(F.when(revised, 0).otherwise(sign).cast("long")).alias("docs"),
        F.sum(sign * value["tokens"] - F.when(revised, value["old_tokens"]).otherwise(0)).alias("tokens"),
        F.sum(sign * value["bytes"] - F.when(revised, value["old_bytes"]).otherwise(0)).alias("bytes"),
    )


class Ledger:
    """Committed batches of deltas in a folder, one subfolder each.

    A batch is there as a whole or not at all: its folder counts once Spark has marked the write as done. To commit
    a batch again, after a failure or by mistake, changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, batch: str) -> str:
        return f"{self.folder}/{hashlib.sha256(batch.encode()).hexdigest()[:32]}"

    def committed(self, batch: str) -> bool:
        return self._exists(f"{self.path(batch)}/_SUCCESS")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Add the deltas of these changes under the name `batch`; False if it was there already."""
        if self.committed(batch):
            return False
        deltas(rows).withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(self.path(batch))
        return True

    def batches(self) -> list[str]:
        """Folders of the committed batches."""
        jvm = self.spark.sparkContext._jvm
        found = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/*/_SUCCESS")
        system = found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getParent().toString() for s in system.globStatus(found) or [])

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens, bytes) over all committed batches; groups whose documents
        are all deleted again are left out."""
        schema = ", ".join([*(f"{k} string" for k in KEYS), *(f"{s} long" for s in SUMS), "batch string"])
        paths = self.batches()
        if not paths:
            return self.spark.createDataFrame([], schema).drop("batch")
        rows = reduce(DataFrame.unionByName, (self.spark.read.schema(schema).parquet(*paths[k : k + 1000]) for k in range(0, len(paths), 1000)))
        summed = rows.groupBy(*KEYS).agg(*[F.sum(s).alias(s) for s in SUMS])
        return summed.where("docs <> 0 or tokens <> 0 or bytes <> 0")
