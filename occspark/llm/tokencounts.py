"""Token counts kept as rollups by signed deltas, committed batch by batch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import VOCABULARY, encoder

KEYS = ("source", "lang", "tokenizer_version")
_STATE = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long, batch_id string"


def token_counts(docs: DataFrame, text: str = "text", json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """``docs`` without its text, with ``n_tokens`` (long; null and empty texts have 0).

    Whole texts are counted, of any length. Repeated rows come back as often; an empty table gives no rows; a column
    named ``n_tokens`` is replaced.
    """
    kept = [c for c in docs.columns if c not in (text, "n_tokens")]
    shape = docs.select(*kept).schema.add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(json_path, ranks_path)
        for batch in batches:
            n = pa.array([len(ids_of(t)) if t else 0 for t in batch[text].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), n], names=[*kept, "n_tokens"])

    return docs.select(*kept, text).mapInArrow(run, shape)


class TokenRollup:
    """Additive totals of documents and tokens by source, language and tokenizer version.

    The summed deltas of each batch are a folder of their own under ``data``, which is never written twice. What is
    committed is said by manifests, small files numbered one after another: each lists all committed batches with their
    folders, and the batches that were folded into others. The highest one counts. A commit or a compaction writes its
    folder first and then one manifest, which appears whole by a rename; until then the state is the old one, and after
    it the new one, so either can be repeated after a failure at any step. What no manifest needs any more is deleted
    last, and by the next writer if that fails. There is one writer at a time; totals whose key's documents and tokens
    are both zero again are left out.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        for folder in ("data", "manifests"):
            self._fs().mkdirs(self._at(f"{self.path}/{folder}"))

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs().listStatus(self._at(f"{self.path}/{folder}")))

    def _manifest(self) -> tuple[int, dict]:
        """The number and content of the manifest that counts."""
        numbers = [int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json")]
        if not numbers:
            return 0, {"batches": {}, "folded": []}
        file = self._fs().open(self._at(f"{self.path}/manifests/{max(numbers):012d}.json"))
        try:
            return max(numbers), json.loads(bytes(file.readAllBytes()))
        finally:
            file.close()

    def _publish(self, number: int, content: dict) -> None:
        """Makes ``content`` what counts, in one step."""
        fs, staged = self._fs(), self._at(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = fs.create(staged, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        final = self._at(f"{self.path}/manifests/{number:012d}.json")
        if fs.exists(final) or not fs.rename(staged, final):
            raise RuntimeError(f"manifest {number} of {self.path} could not be put in place; is there another writer?")

    def _clean(self) -> None:
        """Deletes folders and manifests that the one that counts does not need."""
        number, content = self._manifest()
        gone = [f"data/{n}" for n in self._names("data") if n not in content["batches"].values()]
        gone += [f"manifests/{n}" for n in self._names("manifests") if n != f"{number:012d}.json"]
        for name in gone:
            self._fs().delete(self._at(f"{self.path}/{name}"), True)

    def _write(self, summed: DataFrame, batch_id: str) -> str:
        name = uuid.uuid4().hex
        summed.filter("n_docs <> 0 or n_tokens <> 0").withColumn("batch_id", F.lit(batch_id)).write.parquet(f"{self.path}/data/{name}")
        return name

    def batches(self) -> list[str]:
        """The committed batches, without those folded into others."""
        return sorted(self._manifest()[1]["batches"])

    def commit(self, batch_id: str, deltas: DataFrame) -> None:
        """Adds rows (source, lang, tokenizer_version, sign, n_tokens) as one batch.

        ``sign`` is 1 for an insert and -1 for a delete; a revised count is a delete of the old and
        an insert of the new one. Null keys are keys of their own; null signs and counts are zero. Repeated rows count
        each; no rows make an empty batch; other columns are left out. Committing a batch again replaces it, so a repeat
        leaves the same state; one that was folded by ``compact`` is in the totals for good and stays as it is.
        Deltas are summed before the shuffle, so a source with a third of all rows is one row per task.
        """
        if batch_id in self._manifest()[1]["folded"]:
            return
        sign, n = F.coalesce("sign", F.lit(0)), F.coalesce("n_tokens", F.lit(0))
        folder = self._write(deltas.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("n_docs"), F.sum(sign * n).cast("long").alias("n_tokens")), batch_id)
        number, content = self._manifest()
        self._publish(number + 1, content | {"batches": content["batches"] | {batch_id: folder}})
        self._clean()

    def _state(self, content: dict) -> DataFrame:
        folders = [f"{self.path}/data/{f}" for f in content["batches"].values()]
        found = self.spark.read.schema(_STATE).parquet(*folders) if folders else self.spark.createDataFrame([], _STATE)
        return found.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, n_docs, n_tokens) over all committed batches."""
        return self._state(self._manifest()[1]).filter("n_docs <> 0 or n_tokens <> 0")

    def compact(self, into: str) -> None:
        """Sums all committed batches into the batch ``into``. Repeats change nothing, nor do later commits of the batches summed."""
        number, content = self._manifest()
        if list(content["batches"]) == [into]:
            return
        folder = self._write(self._state(content), into)
        folded = sorted({*content["folded"], *content["batches"]} - {into})
        self._publish(number + 1, {"batches": {into: folder}, "folded": folded})
        self._clean()


def document_deltas(counted: DataFrame, sign: int, version: str = VOCABULARY) -> DataFrame:
    """Rows of ``token_counts`` as deltas of one sign."""
    return counted.select("source", "lang", F.lit(version).alias("tokenizer_version"), F.lit(sign).alias("sign"), "n_tokens")
