"""Token counts as delta-maintained rollups.

A change is a signed row: +1 for a document that comes, -1 for one that goes, both for one whose count is revised. A
batch of changes is summed by source, language and tokenizer version into one small delta. The delta is written to a
folder of its own, and counts once a marker file of the batch's name points at it; totals are the sums of the deltas that
markers point at. Sums are additive, so a batch never reads documents of others, and there is one marker a name, so a
batch that runs twice, or twice at a time, counts once.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.llm.common import drop_tables, quiet_threads, short_batches, stored
from grainloom.llm.textbytes import SOLID, slices, words
from grainloom.llm.wordbpe import default_path, loaded

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_chars")
#: Tokenizer versions by name: a vocabulary file, or None for white-space words.
TOKENIZERS = {"word_bpe_49k": default_path, "words": lambda: None}


def counted(docs: DataFrame, tokenizer: str, path: str | None) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, n_chars) of every row of docs, over whole texts; a null text has no tokens."""
    kinds = dict(docs.dtypes)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads(keep_tokens=path is not None)
        for batch in batches:
            if path:
                n = loaded(path).counts(batch.column("text"))
            else:
                n = np.concatenate([np.diff(words(s, SOLID)[2]) for s in slices(batch.column("text"))] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "lang", "n_chars")), pa.array(n, pa.int64())], ["doc_id", "source", "lang", "n_chars", "n_tokens"])

    chosen = docs.select("doc_id", "source", "lang", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "text")
    out = chosen.mapInArrow(rows, f"doc_id {kinds['doc_id']}, source {kinds['source']}, lang {kinds['lang']}, n_chars long, n_tokens long")
    return out.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), "n_tokens", "n_chars")


def inserts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(1))


def deletes(rows: DataFrame) -> DataFrame:
    """rows as they were counted when they came."""
    return rows.withColumn("sign", F.lit(-1))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed rows that turn the counted rows `old` into `new`; rows alike in both cancel out and aren't returned.

    Rows are compared as a whole, null like null, and as often as they stand.
    """
    both = deletes(old).unionByName(inserts(new))
    columns = [c for c in both.columns if c != "sign"]
    left = both.groupBy(*columns).agg(F.sum("sign").cast("int").alias("sign")).where("sign != 0")
    return left.withColumn("sign", F.explode(F.array_repeat(F.signum("sign").cast("int"), F.abs("sign"))))


def delta(changes: DataFrame) -> DataFrame:
    """The signed sums of a batch by KEYS."""
    sign = F.col("sign")
    return changes.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("n_docs"), F.sum(sign * F.col("n_tokens")).cast("long").alias("n_tokens"), F.sum(sign * F.col("n_chars")).cast("long").alias("n_chars"))


@dataclass
class Ledger:
    """Deltas under `path`, a folder `delta-…` each, and the markers `batch-…` of those that count."""

    spark: SparkSession
    path: str

    def _place(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _files(self):
        return self._place().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        files = self._files()
        return [s.getPath().getName() for s in files.listStatus(self._place())] if files.exists(self._place()) else []

    def _marked(self, marker: str) -> str | None:
        files = self._files()
        if not files.exists(self._place(marker)):
            return None
        stream = files.open(self._place(marker))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def batches(self) -> list[str]:
        return sorted(n for n in self._names() if n.startswith("batch-"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Commits signed changes under a name; False, and nothing read, if that name is committed already.

        The marker is written aside, whole, and moved to its name: a small file, which file systems move in one step and
        object stores copy in one. Should two writers of a batch meet there, the marker points at the delta of the last,
        and as their deltas are alike it counts once, whatever each was told. A job that dies leaves at most files that
        no marker names: tidy() removes them.
        """
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        files, marker = self._files(), f"batch-{batch}"
        if files.exists(self._place(marker)):
            return False
        own = f"delta-{uuid.uuid4().hex}"
        delta(changes).coalesce(1).write.parquet(f"{self.path}/{own}")
        aside = self._place(f"aside-{own}")
        out = files.create(aside, True)
        out.write(own.encode())
        out.close()
        if files.exists(self._place(marker)) or not files.rename(aside, self._place(marker)):
            files.delete(aside, False)
        if self._marked(marker) == own:
            return True
        files.delete(self._place(own), True)
        return False

    def tidy(self) -> list[str]:
        """Removes what no marker names; to be called while no batch is being committed. Returns the names removed."""
        kept = {self._marked(b) for b in self.batches()}
        gone = [n for n in self._names() if n.startswith("aside-") or n.startswith("delta-") and n not in kept]
        for n in gone:
            self._files().delete(self._place(n), True)
        return gone

    def totals(self) -> DataFrame:
        """Sums by KEYS over all committed batches; keys whose documents all went are left out."""
        kept = [f"{self.path}/{self._marked(b)}" for b in self.batches()]
        if not kept:
            return self.spark.createDataFrame([], ", ".join([*(f"{k} string" for k in KEYS), *(f"{s} long" for s in SUMS)]))
        sums = self.spark.read.parquet(*kept).groupBy(*KEYS).agg(*(F.sum(s).alias(s) for s in SUMS))
        return sums.where(" OR ".join(f"{s} != 0" for s in SUMS))


#: Slices that rollup() loads a table in.
SLICES = 4


def rollup(docs: DataFrame, path: str) -> DataFrame:
    """Totals of every row of docs (doc_id, text, source, lang; other columns are ignored) for all TOKENIZERS, by way of a ledger at path.

    The table comes as a crawl would bring it: in SLICES batches by a hash of the id, the last slice first with the first
    half of each text, which a batch of revised counts then replaces; one slice comes a second time by another name and
    is deleted again. Each batch is handed in twice, as after a restart, and counts once, so the totals are those of the
    whole table. Null sources and languages are keys of their own, null ids are a slice's rows like others, repeated rows
    count as often as they stand, a null or empty text has no tokens, an empty table gives no rows.
    """
    ledger = Ledger(docs.sparkSession, path)
    slice_of = F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))
    count = lambda rows: reduce(DataFrame.union, (counted(rows, name, file()) for name, file in TOKENIZERS.items()))
    # counts of whole texts, and of the last slice's earlier texts: a few bytes a row
    half = F.expr("substring(text, 1, cast(char_length(text) / 2 AS int))")
    with short_batches(docs.sparkSession):
        now = stored(count(docs))
        before = stored(count(docs.where(slice_of == SLICES - 1).select("doc_id", "source", "lang", half.alias("text"))))
    parts = [now.where(slice_of == k) for k in range(SLICES)]
    batches = [*((f"load-{k}", inserts(parts[k])) for k in range(SLICES - 1)), (f"load-{SLICES - 1}", inserts(before)), ("again-0", inserts(parts[0])), (f"revise-{SLICES - 1}", revised(before, parts[-1])), ("delete-again-0", deletes(parts[0]))]
    for name, changes in batches:
        for _ in range(2):
            ledger.commit(name, changes)
    drop_tables(now, before)
    return ledger.totals()
