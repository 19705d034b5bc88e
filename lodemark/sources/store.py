"""The tables of a use case as parquet under one root, without MERGE, UPDATE or DELETE.

* `scores` (one partition per scoring run) and `labels` only grow. The monitor is committed scores, minus rows rolled
  back, left-joined to labels.
* Every attempt of a batch run has a partition of its own. Readers do not see it before its `commits` row, which is written
  last; `drop_uncommitted` removes what crashed and beaten attempts left.
* A batch run is committed by compare-and-set: a claim, named by the watermark it replaces, can be created once only. It
  holds the commit, so the next run completes one whose writer died before the `commits` row.
* The current watermark is the newest commit by UPDATED_AT, so a reset to an older timestamp is just another commit.
* `business` is kept as one delta per run; readers take the newest value per key.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import uuid
from collections.abc import Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodemark.functions.columns import col
from lodemark.operators.encode import Contract
from lodemark.operators.joins import latest_per_key
from lodemark.settings import LABEL_TYPE, UseCase
from lodemark.sources.scans import batch_bounds

RUNS = ("USE_CASE_NAME string, PREFIX string, MODEL_NAME string, MODEL_VERSION string, ALGORITHM string, CONFIG_JSON string, "
        "METRICS_JSON string, EXTRA_JSON string, CREATED_AT timestamp_ntz")
CONTRACTS = ("ORDER_IDX int, ENCODED_NAME string, SOURCE_NAME string, FEATURE_ROLE string, CREATED_AT timestamp_ntz, "
             "USE_CASE_NAME string, MODEL_VERSION string")
COMMITS = ("USE_CASE_NAME string, RUN_ID string, LAST_RECORD_TS timestamp_ntz, UPDATED_AT timestamp_ntz, KIND string, "
           "SCHEMA_JSON string")
LOG = ("RUN_TS timestamp_ntz, USE_CASE_NAME string, PROCEDURE_NAME string, N_ROWS bigint, STATUS string, MESSAGE string")
REMOVED = "FEED_ROW_ID string, MODEL_VERSION string, RUN_ID string, N_ROWS bigint, ROLLBACK string"
PARTITIONS = ("USE_CASE_NAME", "MODEL_VERSION", "RUN_ID")


@dataclasses.dataclass(frozen=True)
class PastRun:
    """A logged run, with its JSON columns parsed."""

    version: str
    algorithm: str
    task: str
    metrics: dict
    extra: dict

    @classmethod
    def of(cls, row: Row) -> PastRun:
        parsed = {c: json.loads(row[f"{c}_JSON"] or "{}") for c in ("CONFIG", "METRICS", "EXTRA")}
        return cls(row["MODEL_VERSION"], row["ALGORITHM"], parsed["CONFIG"]["task"], parsed["METRICS"], parsed["EXTRA"])


class Store:
    def __init__(self, spark: SparkSession, root: str, use_case: UseCase):
        self.spark, self.root, self.use_case = spark, root.rstrip("/"), use_case
        self._written: dict[str, T.StructType] = {}   # schemas of runs written here, recorded by their commit

    # ------------------------------------------------------------------------------------------------- plumbing
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, table: str, schema: str | T.StructType) -> DataFrame:
        """The table, or no rows of that schema before the first write."""
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def read_any(self, table: str) -> DataFrame:
        """A table whose columns depend on the model; partition values stay text even when they look like numbers."""
        found = self.spark.read.parquet(self.path(table)).schema
        fixed = T.StructType([T.StructField(f.name, T.StringType()) if f.name in PARTITIONS else f for f in found.fields])
        return self.spark.read.schema(fixed).parquet(self.path(table))

    def _append_row(self, table: str, schema: str, values: Sequence):
        """One file, written beside the table and moved into it: writers at work in one folder would remove each other's drafts."""
        draft, target = (self.spark._jvm.org.apache.hadoop.fs.Path(self.path(t)) for t in (f"drafts/{uuid.uuid4().hex}", table))
        self.spark.createDataFrame([tuple(values)], schema).coalesce(1).write.parquet(str(draft))
        fs = draft.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        for part in fs.globStatus(draft.suffix("/part-*")):
            if not fs.rename(part.getPath(), target):
                raise OSError(f"could not move a row into {table}")
        fs.delete(draft, True)

    def _mine(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("USE_CASE_NAME") == self.use_case.name)

    # ------------------------------------------------------------------------------------------- runs and models
    def runs(self) -> DataFrame:
        return self.read("runs", RUNS)

    def log_run(self, version: str, algorithm: str, metrics: dict, extra: dict, now):
        config = json.dumps(dataclasses.asdict(self.use_case))
        self._append_row("runs", RUNS, (
            self.use_case.name, self.use_case.prefix, self.model_name, version, algorithm, config,
            json.dumps(metrics), json.dumps(extra, default=str), now))

    def past_run(self, version: str | None = None) -> PastRun | None:
        found = latest_run(self.runs(), self.use_case.name, version).first()
        return found and PastRun.of(found)

    @property
    def model_name(self) -> str:
        return f"{self.use_case.prefix or self.use_case.name}_MODEL"

    def _model_table(self, version: str) -> str:
        return f"models/{self.model_name}/{version.upper()}"

    def has_model(self, version: str) -> bool:
        return self.exists(self._model_table(version))

    def versions(self) -> DataFrame:
        """Versions with a logged run, with the time of the newest."""
        return self._mine(self.runs()).groupBy(F.upper("MODEL_VERSION").alias("MODEL_VERSION")).agg(
            F.max("CREATED_AT").alias("CREATED_AT"))

    def refuse_existing(self, version: str):
        if self.has_model(version):
            raise ValueError(f"model version {version} is already registered")

    def save_model(self, model: PipelineModel, version: str):
        self.refuse_existing(version)
        model.write().save(self.path(self._model_table(version)))

    def load_model(self, version: str) -> PipelineModel:
        return PipelineModel.load(self.path(self._model_table(version)))

    # ------------------------------------------------------------------------------------------------- contract
    def save_contract(self, contract: Contract, version: str, now: Column):
        """Replaces the contract of this version; other versions stay."""
        frame = contract.to_frame(self.spark, self.use_case.name, version, now)
        write_partitions(frame.coalesce(1), self.path("contracts"), ["USE_CASE_NAME", "MODEL_VERSION"])

    def contracts(self) -> DataFrame:
        return self.read("contracts", CONTRACTS)

    def contract(self, version: str) -> Contract:
        found = Contract.from_frame(newest_contract(self.contracts(), self.use_case.name, version))
        if not found.features:
            raise ValueError(f"no feature contract for {self.use_case.name} / {version}")
        return found

    # -------------------------------------------------------------------------------------- scores, labels, monitor
    def write_scores(self, scored: DataFrame, run_id: str, watermark: str | None) -> tuple[int, object]:
        """Writes the run's partition, still invisible; returns its (rows, newest watermark), read back from the files."""
        tagged = scored.withColumns({"USE_CASE_NAME": F.lit(self.use_case.name), "RUN_ID": F.lit(run_id)})
        write_partitions(tagged, self.path("scores"), ["USE_CASE_NAME", "RUN_ID"])
        self._written[run_id] = tagged.schema
        written = self.run_scores(run_id)
        if watermark is None:
            return written.count(), None
        bounds = batch_bounds(written, watermark).first()
        return bounds["N_ROWS"], bounds["NEW_WATERMARK"]

    def run_scores(self, run_id: str) -> DataFrame:
        """One run's rows, committed or not."""
        schema = self._written.get(run_id) or self.scores_schema()
        return self._mine(self.read("scores", schema)).where(F.col("RUN_ID") == run_id)

    def scores_schema(self) -> T.StructType:
        """Columns of all committed runs, the newest scoring run's first: a run that lacks one has NULL there.

        One row per distinct schema reaches the driver; runs of one model version share theirs.
        """
        known = self.commits().where("SCHEMA_JSON IS NOT NULL").groupBy("SCHEMA_JSON").agg(
            F.min(F.col("KIND") == "SEED").alias("SEED"), F.max(F.struct("UPDATED_AT", "RUN_ID")).alias("AT"))
        rows = known.orderBy("SEED", F.desc("AT")).collect()
        if not rows:
            raise ValueError(f"{self.use_case.name} has no committed scores yet")
        fields: dict[str, T.StructField] = {}
        for row in rows:
            for f in T.StructType.fromJson(json.loads(row["SCHEMA_JSON"])).fields:
                fields.setdefault(f.name.upper(), f)
        return T.StructType(list(fields.values()))

    def newest_batch(self) -> DataFrame:
        """Monitor rows of the newest committed scoring run; its id prunes the partitions of scores and labels."""
        runs = self.commits().where("SCHEMA_JSON IS NOT NULL AND KIND <> 'SEED'")
        newest = runs.orderBy(F.desc("UPDATED_AT"), F.desc("RUN_ID")).select("RUN_ID").first()
        return self.monitor().where(F.col("RUN_ID") == (newest["RUN_ID"] if newest else "seed"))

    def has_scores(self) -> bool:
        return not self.commits().where("SCHEMA_JSON IS NOT NULL").isEmpty()

    def commits(self) -> DataFrame:
        return self._mine(self.read("commits", COMMITS))

    def commit(self, run_id: str, last_record_ts, now, kind: str = "SCORE"):
        schema = self._written.get(run_id)
        self._append_row("commits", COMMITS, (self.use_case.name, run_id, last_record_ts, now, kind, schema and schema.json()))

    def turn(self) -> tuple[datetime | None, int]:
        """What the next batch run replaces: (watermark, resets so far). A commit its writer left half done is completed first."""
        while True:
            turn = self.watermark(), self.resets()
            claim = self._claim(turn)
            if not self.exists(claim):
                return turn
            done = json.loads(self.spark.read.text(self.path(claim), wholetext=True).first()[0])
            if self.commits().where(F.col("RUN_ID") == done["run_id"]).isEmpty():
                times = [done[k] and datetime.fromisoformat(done[k]) for k in ("last_record_ts", "now")]
                self._append_row("commits", COMMITS, (self.use_case.name, done["run_id"], *times, "SCORE", done["schema"]))
            elif (self.watermark(), self.resets()) == turn:
                raise RuntimeError(f"run {done['run_id']} replaced the watermark {turn[0]}, but its commit is not the newest")

    def commit_once(self, run_id: str, turn: tuple[datetime | None, int], last_record_ts: datetime, now: datetime) -> bool:
        """Commits a batch run unless another one has replaced this watermark: of any number of writers exactly one gets True."""
        schema = self._written.get(run_id)
        claim = {"run_id": run_id, "last_record_ts": last_record_ts and last_record_ts.isoformat(), "now": now.isoformat(),
                 "schema": schema and schema.json()}
        if not create_once(self.spark, self.path(self._claim(turn)), json.dumps(claim)):
            return False
        self.commit(run_id, last_record_ts, now)
        return True

    def _claim(self, turn: tuple[datetime | None, int]) -> str:
        text = json.dumps([self.use_case.name, turn[0] and turn[0].isoformat(), turn[1]])
        return f"claims/{hashlib.sha256(text.encode()).hexdigest()}"

    def drop_run(self, run_id: str):
        """Removes the partitions of a run; readers at work would miss its files while they list the table."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for pattern in (f"scores/USE_CASE_NAME=*/RUN_ID={run_id}", f"business/RUN_ID={run_id}"):
            path = hadoop.Path(self.path(pattern))
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for found in fs.globStatus(path) or ():
                fs.delete(found.getPath(), True)

    def drop_uncommitted(self) -> list[str]:
        """Removes the batch runs that crashed before their commit or lost their turn; to be called while no run is at work."""
        self.turn()
        held = self._mine(self.read("scores", "USE_CASE_NAME string, RUN_ID string")).select("RUN_ID").distinct()
        gone = held.where(F.col("RUN_ID").startswith("run-")).join(self.commits().select("RUN_ID"), "RUN_ID", "left_anti")
        lost = sorted(r["RUN_ID"] for r in gone.collect())
        for run_id in lost:
            self.drop_run(run_id)
        return lost

    def watermark(self):
        row = current_watermark(self.commits()).first()
        return row and row["LAST_RECORD_TS"]

    def reset_watermark(self, to, now):
        self.commit(f"reset-{now:%Y%m%d%H%M%S%f}", to, now, "RESET")

    def resets(self) -> int:
        return self.commits().where("KIND = 'RESET'").count()

    def scores(self) -> DataFrame:
        """Committed scores that were not rolled back. Partition pruning skips uncommitted runs."""
        rows = self._mine(self.read("scores", self.scores_schema()))
        rows = rows.join(self.commits().select("RUN_ID").distinct(), "RUN_ID", "left_semi")
        if self.exists("removed"):
            gone = self.read("removed", REMOVED).select("RUN_ID", "FEED_ROW_ID", "MODEL_VERSION")
            rows = rows.join(gone, ["RUN_ID", "FEED_ROW_ID", "MODEL_VERSION"], "left_anti")
        return rows

    def scored_ids(self) -> DataFrame:
        """FEED_ROW_ID of every committed score, rolled back or not."""
        if not self.has_scores():
            return self.spark.createDataFrame([], "FEED_ROW_ID string")
        rows = self._mine(self.read("scores", "FEED_ROW_ID string, USE_CASE_NAME string, RUN_ID string"))
        return rows.join(self.commits().select("RUN_ID").distinct(), "RUN_ID", "left_semi").select("FEED_ROW_ID")

    def late_rows(self) -> DataFrame:
        """The side table of feed rows that came too late for a stream; its columns are those of the feed, one partition per call."""
        if not self.exists("late"):
            return self.spark.createDataFrame([], "FEED_ROW_ID string, USE_CASE_NAME string, LATE_RUN string")
        found = self.spark.read.option("mergeSchema", True).parquet(self.path("late"))
        return self._mine(found.withColumns({c: F.col(c).cast("string") for c in ("USE_CASE_NAME", "LATE_RUN")}))

    def write_late(self, rows: DataFrame, name: str) -> int:
        """Writes (and on a repeated call overwrites) one partition of late rows; returns its rows."""
        tagged = rows.withColumns({"USE_CASE_NAME": F.lit(self.use_case.name), "LATE_RUN": F.lit(name)})
        write_partitions(tagged, self.path("late"), ["USE_CASE_NAME", "LATE_RUN"])
        written = self.read("late", "USE_CASE_NAME string, LATE_RUN string")
        return self._mine(written).where(F.col("LATE_RUN") == name).count()

    def labels_schema(self) -> str:
        return (f"FEED_ROW_ID string, ACTUAL_LABEL {LABEL_TYPE[self.use_case.task]}, LABELED_AT timestamp_ntz, "
                f"N_ROWS bigint, LABEL_BATCH string, USE_CASE_NAME string, RUN_ID string")

    def labels(self) -> DataFrame:
        return self._mine(self.read("labels", self.labels_schema())).drop("USE_CASE_NAME", "N_ROWS", "LABEL_BATCH")

    def monitor(self) -> DataFrame:
        """Scores with their label, NULL while none has arrived. Rows with the same id in a run share one label."""
        return self.scores().join(self.labels(), ["RUN_ID", "FEED_ROW_ID"], "left")

    def add_labels(self, updates: DataFrame, now: Column) -> int:
        """Appends (RUN_ID, FEED_ROW_ID, GT_LABEL) of rows that have no label yet; returns the monitor rows labeled."""
        batch = uuid.uuid4().hex
        fresh = updates.groupBy("RUN_ID", "FEED_ROW_ID").agg(F.first("GT_LABEL").alias("ACTUAL_LABEL"), F.count("*").alias("N_ROWS"))
        fresh = fresh.join(self.labels().select("RUN_ID", "FEED_ROW_ID"), ["RUN_ID", "FEED_ROW_ID"], "left_anti")
        rows = fresh.select("FEED_ROW_ID", "ACTUAL_LABEL", now.cast("timestamp_ntz").alias("LABELED_AT"), "N_ROWS",
                            F.lit(batch).alias("LABEL_BATCH"), F.lit(self.use_case.name).alias("USE_CASE_NAME"), "RUN_ID")
        rows.hint("rebalance", "RUN_ID").write.mode("append").partitionBy("USE_CASE_NAME", "RUN_ID").parquet(self.path("labels"))
        return added(self.read("labels", self.labels_schema()), "LABEL_BATCH", batch, "N_ROWS")

    def roll_back(self, version: str) -> int:
        """Takes the unlabeled rows of a version out of the monitor; labeled ones stay."""
        batch = uuid.uuid4().hex
        gone = unlabeled_rows(self.monitor(), version).groupBy("FEED_ROW_ID", "MODEL_VERSION", "RUN_ID").agg(
            F.count("*").alias("N_ROWS"))
        gone.withColumn("ROLLBACK", F.lit(batch)).write.mode("append").parquet(self.path("removed"))
        return added(self.read("removed", REMOVED), "ROLLBACK", batch, "N_ROWS")

    # ------------------------------------------------------------------------------------------------- baselines
    def save_baseline(self, baseline: DataFrame, version: str):
        tagged = baseline.withColumns({"USE_CASE_NAME": F.lit(self.use_case.name), "MODEL_VERSION": F.lit(version)})
        write_partitions(tagged, self.path("baselines"), ["USE_CASE_NAME", "MODEL_VERSION"])

    def baseline(self, version: str) -> DataFrame:
        return self._mine(self.read_any("baselines")).where(F.col("MODEL_VERSION") == version)

    def seed_monitor(self, baseline: DataFrame, now_value, now: Column):
        """Starts the monitor as a labeled copy of the baseline, once; an existing monitor keeps its history."""
        if self.has_scores():
            return
        self.write_scores(baseline.drop("ACTUAL_LABEL"), "seed", None)
        self.add_labels(baseline.select(F.lit("seed").alias("RUN_ID"), "FEED_ROW_ID", F.col("ACTUAL_LABEL").alias("GT_LABEL")), now)
        self.commit("seed", None, now_value, "SEED")

    # -------------------------------------------------------------------------------------------- business table
    def add_business(self, rows: DataFrame, run_id: str):
        write_partitions(rows.withColumn("RUN_ID", F.lit(run_id)), self.path("business"), ["RUN_ID"])

    def business(self, key: str) -> DataFrame:
        """Newest committed row per key."""
        rows = self.read_any("business")
        rows = rows.join(self.commits().select("RUN_ID").distinct(), "RUN_ID", "left_semi")
        return latest_per_key(rows, [key], "SYS_UPD_DT", ["RUN_ID"]).drop("RUN_ID")

    # ------------------------------------------------------------------------------------------------------- log
    def log(self, procedure: str, n_rows: int, status: str, message: str, now):
        """One status row; a failure to log never reaches the caller."""
        try:
            self._append_row("log", LOG, (now, self.use_case.name, procedure, int(n_rows), status, str(message)))
        except Exception as e:  # noqa: BLE001
            print(f"could not write to the scoring log: {e}")

    def log_rows(self, n: int = 5) -> DataFrame:
        return self._mine(self.read("log", LOG)).orderBy(F.desc("RUN_TS")).limit(n)


# ------------------------------------------------------------------------------------------- table-level operators

def write_partitions(df: DataFrame, path: str, partitions: Sequence[str]):
    """Overwrites exactly the partitions the rows belong to."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with this text; False where it exists. The text is complete when the name appears: a finished file is given
    the name, by a hard link on a local disk, else by a rename that does not replace (atomic on HDFS)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target, draft = hadoop.Path(path), hadoop.Path(f"{path}-{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            nio = jvm.java.nio.file
            nio.Files.createLink(*[jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)])
        else:
            no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
            hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(draft, target, no_options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)


def added(table: DataFrame, batch_column: str, batch: str, rows: str) -> int:
    """Monitor rows one append stands for."""
    return table.where(F.col(batch_column) == batch).agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]


def latest_run(runs: DataFrame, use_case: str, version: str | None = None) -> DataFrame:
    """The newest run of a use case, optionally of one version; equal times go to the higher version."""
    rows = runs.where(F.col("USE_CASE_NAME") == use_case)
    if version:
        rows = rows.where(F.col("MODEL_VERSION") == version)
    return rows.orderBy(F.desc("CREATED_AT"), F.desc("MODEL_VERSION")).limit(1)


def newest_contract(contracts: DataFrame, use_case: str, version: str) -> DataFrame:
    """Rows of the newest batch of one version's contract."""
    rows = contracts.where((F.col("USE_CASE_NAME") == use_case) & (F.col("MODEL_VERSION") == version))
    newest = rows.agg(F.max("CREATED_AT").alias("at")).scalar()
    return rows.where(F.col("CREATED_AT") == newest)


def current_watermark(commits: DataFrame) -> DataFrame:
    return commits.where("LAST_RECORD_TS IS NOT NULL").orderBy(F.desc("UPDATED_AT"), F.desc("RUN_ID")).limit(1)


def unlabeled_rows(monitor: DataFrame, version: str) -> DataFrame:
    return monitor.where(F.col("ACTUAL_LABEL").isNull() & (F.col("MODEL_VERSION") == version))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], stamp: Column, stamp_column: str = "SYS_UPD_DT") -> DataFrame:
    """Target with the source's rows: matched rows take the source's columns and keep the others, new rows are added,
    both get the stamp. The source holds one row per key."""
    keys = list(keys)
    fresh = source.select(*keys, F.struct(*[c for c in source.columns if c not in keys]).alias("_NEW"))
    joined = target.join(fresh, keys, "full_outer")
    hit = F.col("_NEW").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return col(c)
        if c == stamp_column:
            return F.when(hit, stamp).otherwise(col(c)).alias(c)
        if c in source.columns:
            return F.when(hit, F.col("_NEW").getField(c)).otherwise(col(c)).alias(c)
        return col(c)

    return joined.select(*[value(c) for c in target.columns])


def recast_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows with text timestamps as TIMESTAMP_NTZ; unreadable text is NULL."""
    return df.withColumns({c: col(c).try_cast("timestamp_ntz") for c in columns})
