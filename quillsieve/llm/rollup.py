"""Token counts as rollups that signed deltas maintain.

A store keeps additive totals (documents and tokens by source, language and tokenizer version) as
one small aggregated table per committed batch. An insert adds a document's counts, a delete
subtracts them, a revision subtracts the old and adds the new ones. A batch that is sent again is
written beside the one that is there, and takes its place once the write has ended (Spark's
_SUCCESS mark); so a batch that failed, at whatever point, or is sent again changes nothing twice
and takes nothing away. ``compact`` folds batches into a base, which lists the ids of its batches;
those are then ignored, and a batch that comes late is not.

Deltas are aggregated before the shuffle, so a source that holds most rows costs one row a task.

Defined results: a null text has 0 tokens and counts as a document; null sources and languages are
groups of their own; groups whose counts are all zero vanish from the totals; repeated rows count
each; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm import bpe
from quillsieve.llm.arrays import quoted
from quillsieve.llm.tables import Scratch, shared_dir

#: Tokenizer versions: the matches of a pattern are the tokens.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]+",
    "pieces-2": r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]+",
}
KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def bpe_count(docs: DataFrame, vocabulary, out: str, text: str = "text") -> DataFrame:
    """docs with ``out``: the number of byte-level BPE tokens, for tokenizer versions that are
    vocabularies (``bpe.Vocabulary``) and not patterns."""
    coded = bpe.encode(docs, vocabulary, text, "__ids")
    return coded.withColumn(out, (F.length("__ids") / 4).cast("long")).drop("__ids")


def count(text: Column, tokenizer: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


def deltas(docs: DataFrame, tokens: dict[str, Column], sign: int = 1) -> DataFrame:
    """Signed rows of each document: source, lang, tokenizer, n_docs, n_tokens."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("tokenizer"), v.cast("long").alias("n")) for k, v in tokens.items()]))
    rows = docs.select(quoted("source").cast("string").alias("source"), quoted("lang").cast("string").alias("lang"), each.alias("t"))
    return rows.select("source", "lang", "t.tokenizer", F.lit(sign).cast("long").alias("n_docs"), (F.col("t.n") * sign).alias("n_tokens"))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class Store:
    """Totals under a path: ``batch=<id>.<try>`` and ``base=<number>.<try>`` folders. Of the tries
    of a batch the last complete one counts, of all bases the last complete one.

    A base has, beside its totals, a row for each batch it contains: the id and nothing else.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _folders(self, kind: str) -> list[tuple[int, int]]:
        """(number, try) of all folders of a kind, complete or not."""
        fs, top = self._fs(self.path)
        if not fs.exists(top):
            return []
        names = [s.getPath().getName().split("=", 1) for s in fs.listStatus(top)]
        return sorted(tuple(map(int, n[1].split("."))) for n in names if n[0] == kind and len(n) == 2)

    def _complete(self, kind: str) -> dict[int, int]:
        """The last complete try of each number."""
        done = lambda n, k: (lambda fs, where: fs.exists(where))(*self._fs(f"{self.path}/{kind}={n}.{k}/_SUCCESS"))
        return {n: k for n, k in self._folders(kind) if done(n, k)}

    def _write(self, kind: str, number: int, rows: DataFrame) -> str:
        """rows as the next try of a number; earlier tries go once it is complete."""
        tries = [k for n, k in self._folders(kind) if n == number]
        new = max(tries, default=-1) + 1
        rows.write.mode("error").parquet(f"{self.path}/{kind}={number}.{new}")
        self._delete([f"{kind}={number}.{k}" for k in tries])
        return f"{kind}={number}.{new}"

    def _delete(self, names: list[str]) -> None:
        for name in names:
            fs, where = self._fs(f"{self.path}/{name}")
            fs.delete(where, True)

    def commit(self, batch: int, rows: DataFrame) -> bool:
        """Put the deltas of a batch in place of what it had; False if the base holds it already."""
        if batch in self._contained():
            return False
        self._write("batch", batch, _sums(rows))
        return True

    def _base(self) -> list[str]:
        return [f"base={n}.{k}" for n, k in sorted(self._complete("base").items())[-1:]]

    def _contained(self) -> set[int]:
        """Ids of the batches that the base contains."""
        rows = [self.spark.read.schema(f"{SCHEMA}, batch long").parquet(f"{self.path}/{b}") for b in self._base()]
        return {r["batch"] for df in rows for r in df.where("batch is not null").select("batch").collect()}

    def _batches(self) -> dict[int, str]:
        contained = self._contained()
        return {n: f"batch={n}.{k}" for n, k in self._complete("batch").items() if n not in contained}

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{n}" for n in names]).where("tokenizer is not null")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches."""
        names = [*self._base(), *self._batches().values()]
        if not names:
            return self.spark.createDataFrame([], SCHEMA)
        return _sums(self._read(names)).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """One base for all committed batches; what it replaces goes once it is written."""
        base, batches = self._base(), self._batches()
        if batches:
            ids = self.spark.createDataFrame([(b,) for b in sorted(self._contained() | set(batches))], "batch long")
            rows = _sums(self._read([*base, *batches.values()])).unionByName(ids, allowMissingColumns=True)
            self._write("base", max((n for n, _ in self._folders("base")), default=-1) + 1, rows)
        # A base that ended before this one, and batches that it contains (after a stop, too).
        last = self._base()
        self._delete([f"base={n}.{k}" for n, k in self._folders("base") if f"base={n}.{k}" not in last])
        held = self._contained()
        self._delete([f"batch={n}.{k}" for n, k in self._folders("batch") if n in held])


def replay(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Totals after three batches, each sent twice: all documents are inserted, toxic ones are
    deleted, and the counts of pieces-1 are revised to those of pieces-2."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "rollup")
    text = quoted("text").cast("string")
    toxic = labels.where("toxic = 1").select(F.col("doc_id").alias("toxic_id")).distinct()
    counted = documents.select("doc_id", "source", "lang", *[count(text, k).alias(k) for k in TOKENIZERS])
    docs = scratch.cut(counted.join(toxic, F.col("doc_id") == F.col("toxic_id"), "left"), "counts")
    bad = F.col("toxic_id").isNotNull()
    store = Store(spark, f"{shared_dir(spark)}/quillsieve/rollup-store-{uuid.uuid4().hex}")
    first = {k: quoted(k) for k in ("words-1", "pieces-1")}
    batches = {
        1: deltas(docs, first),
        2: deltas(docs.where(bad), first, -1),
        3: deltas(docs.where(~bad), {"pieces-1": quoted("pieces-1")}, -1).union(deltas(docs.where(~bad), {"pieces-2": quoted("pieces-2")})),
    }
    for _ in range(2):
        for batch, rows in batches.items():
            store.commit(batch, rows)
    store.compact()
    store.commit(3, batches[3])
    scratch.drop(docs)
    return store.totals()


def oracle() -> str:
    """DuckDB SQL for ``replay`` on documents and labels."""
    part = """SELECT source, lang, '{0}' AS tokenizer, count(*) AS n_docs,
      CAST(sum(coalesce(len(regexp_extract_all(text, '{1}')), 0)) AS BIGINT) AS n_tokens
      FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) GROUP BY ALL"""
    return " UNION ALL ".join(part.format(k, TOKENIZERS[k]) for k in ("words-1", "pieces-2"))
