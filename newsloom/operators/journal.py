"""The extractor's answers, kept under the hash of what was asked.

Before the extractor is called, payloads that were answered by any earlier run are taken from
the journal, a keyed table whose buckets stay in place. The others are asked in rounds; each
round is written as a whole before the next begins. A run that fails, or is killed, has its
finished rounds put into the journal by the next one, and only asks what was left. Equal
payloads are asked once. Answers that failed are not kept, so they are asked again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.merge import merge_keyed
from newsloom.session import stage
from newsloom.sources.keyed import BUCKETS, KeyedTable

SCHEMA = "payload_hash string, answer string, run_id string"
#: Payloads of a round, and of a task: what a lost run, or a lost task, asks again at most.
ROUND = 1_000_000
PER_TASK = 1024


def payload_hash(payload: Column | str) -> Column:
    return F.sha2(F.col(payload) if isinstance(payload, str) else payload, 256)


class AnswerJournal:
    """Answers below ``root``, on any file system that Spark can reach."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = BUCKETS,
        round_size: int = ROUND,
        per_task: int = PER_TASK,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = KeyedTable(spark, f"{self.root}/answers", SCHEMA, "payload_hash", buckets)
        self.round_size = round_size
        self.per_task = per_task

    def of(self, spark: SparkSession) -> AnswerJournal:
        """The same journal for another session, such as that of a micro-batch."""
        return AnswerJournal(
            spark, self.root, self.table.new_buckets, self.round_size, self.per_task
        )

    def _rounds(self) -> list[str]:
        """Folders of complete rounds that are not in the table yet."""
        fs, _ = self.table._fs(self.root)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        names = self.table._children(f"{self.root}/rounds")
        return [
            f"{self.root}/rounds/{n}" for n in sorted(names)
            if fs.exists(path(f"{self.root}/rounds/{n}/_SUCCESS"))
        ]

    def settle(self) -> int:
        """Put finished rounds into the table; how many there were."""
        rounds = self._rounds()
        if rounds:
            batch = self.spark.read.schema(SCHEMA).parquet(*rounds).where("answer IS NOT NULL")
            newest = self.table.versions()[-1:]
            number = int(newest[0]) + 1 if newest else 0
            self.table.upsert(
                batch, f"{number:012d}",
                lambda old, new, place: merge_keyed(
                    old, new, "payload_hash", ["run_id", "answer"], place=place
                ),
            )
            for path in rounds:  # a round that is put in twice changes nothing
                fs, where = self.table._fs(path)
                fs.delete(where, True)
            self.table.vacuum()
        return len(rounds)

    def known(self, payloads: DataFrame) -> DataFrame:
        """The stored answers to ``payloads`` (payload_hash), which is read twice."""
        return self.table.look_up(payloads, "payload_hash")

    def answer(self, payloads: DataFrame, ask, run_id: str) -> DataFrame:
        """``payload_hash, answer`` of ``payloads`` (payload). ``ask`` turns the column
        ``payload`` into one of answers; it sees each unknown payload once. ``payloads`` is
        read twice, and written in more than one round only."""
        self.settle()
        hashed = payloads.where("payload IS NOT NULL").withColumn(
            "payload_hash", payload_hash("payload")
        )
        # only hashes are looked up; of the payloads, the unknown ones move once they are counted
        hashes = stage(hashed.select("payload_hash").distinct(), "payload-hashes")
        new = stage(
            hashes.join(self.known(hashes), "payload_hash", "left_anti"), "unanswered"
        )
        count = new.count()
        rounds = -(-count // self.round_size)
        todo = (
            hashed.groupBy("payload_hash").agg(F.first("payload").alias("payload"))
            .join(new, "payload_hash", "left_semi")
        )
        if rounds > 1:  # each round reads its share
            todo = stage(todo, "to-ask")
        for number in range(rounds):
            own = F.pmod(F.xxhash64("payload_hash"), F.lit(rounds)) == number
            tasks = max(1, -(-count // (rounds * self.per_task)))
            asked = todo.where(own).repartition(tasks).select(
                "payload_hash", ask("payload").alias("answer"), F.lit(run_id).alias("run_id")
            )
            asked.write.parquet(f"{self.root}/rounds/{run_id}-{number:06d}-{uuid.uuid4().hex[:8]}")
        self.settle()
        return self.known(hashes).select("payload_hash", "answer")
