"""Streams: jobs in, guides and votes out, progress and completed files."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from guideloom.functions.sequences import normalise_sequence
from guideloom.operators.targets import validate_jobs
from guideloom.sources.staging import remove, reread
from guideloom.streaming import keyed

JOB_SCHEMA = "job_id string, sequence string, genome string, submitted_at timestamp"


def stream_jobs(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Job requests as they arrive, as JSON lines, with their sequences normalised."""
    rows = spark.readStream.schema(JOB_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return rows.withColumn("sequence", normalise_sequence(F.col("sequence")))


def in_slices(score: Callable[[DataFrame], DataFrame], most: int, folder: str) -> Callable[[DataFrame], DataFrame]:
    """score, run for at most `most` jobs at a time, one run after the other; the rows of each run are staged in folder. jobs: with a job_id that is not null.

    Jobs are numbered in parts by hash, and the sums of the parts before give the rest, so no task orders all of them."""
    part = F.pmod(F.xxhash64("job_id"), F.lit(256))

    def scored(jobs: DataFrame) -> DataFrame:
        if (runs := -(-jobs.count() // most)) < 2:
            return score(jobs)
        counts = jobs.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = F.broadcast(counts.select("part", before.alias("before")))  # 256 rows at most
        here = F.row_number().over(Window.partitionBy("part").orderBy("job_id")) - 1
        numbered = jobs.withColumn("part", part).withColumn("here", here).join(counts, "part").withColumn("slice", F.floor((F.col("before") + F.col("here")) / most))
        numbered = reread(numbered.drop("part", "here", "before"), f"{folder}/slices")
        return reduce(DataFrame.unionByName, [reread(score(numbered.filter(F.col("slice") == k).drop("slice")), f"{folder}/scored") for k in range(runs)])

    return scored


def _apart(jobs: DataFrame, score: Callable[[DataFrame], DataFrame], folder: str, bit: int = 0) -> tuple[list[DataFrame], list[DataFrame]]:
    """(rows of the jobs that can be scored, the others with their error): halves by a bit of the id's hash, halved again where they fail."""
    good, dead = [], []
    for half in (0, 1):
        part = jobs.filter(F.shiftrightunsigned(F.xxhash64("job_id"), bit).bitwiseAND(F.lit(1)) == half)
        if not (some := part.limit(2).count()):
            continue
        try:
            good.append(reread(score(part), f"{folder}/scored"))
        except PySparkException as error:
            if some == 1 or bit == 63:
                dead.append(part.withColumn("error", F.lit(str(error)[:1000])))
            else:
                found = _apart(part, score, folder, bit + 1)
                good, dead = good + found[0], dead + found[1]
    return good, dead


def _scored(jobs: DataFrame, score: Callable[[DataFrame], DataFrame], tries: int, folder: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """(rows of the jobs that can be scored, the others with their error). When all jobs fail at once, single ones are tried, the first by id and then the last, in `tries` runs altogether. If none succeeds, the fault is not theirs and the error goes on; else those that fail are set apart."""
    try:
        return [reread(score(jobs), f"{folder}/scored")], []
    except PySparkException as error:
        if tries < 2:
            raise
        ends = jobs.agg(F.min("job_id"), F.max("job_id")).first()
        for k in range(tries - 1):
            try:
                reread(score(jobs.filter(F.col("job_id") == ends[k % 2])), f"{folder}/probe")
                return _apart(jobs, score, folder)
            except PySparkException:
                continue
        raise error


def start_scoring(jobs: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, rejects: str, checkpoint: str, trigger: dict | None = None, max_length: int = 20_000, max_age: str | None = None, dead_letters: str | None = None, tries: int = 3, keep_days: float = 14, max_jobs: int | None = None) -> StreamingQuery:
    """Each micro-batch through the batch functions. A job id counts once in keep_days, by keyed state, so redelivery is harmless and no earlier output is read. A batch that runs again replaces its own part under run=.../batch=..., the run being that of the checkpoint: a new checkpoint replaces nothing. Rejected jobs, among them those without an id, go to their own path. Rows of score keep their job_id.

    max_jobs: the most jobs that one run of score gets, however many a file or a batch holds; see in_slices.
    max_age: jobs submitted longer ago than this interval when their batch runs are rejected as expired.
    dead_letters: where jobs that cannot be scored go with their error, and with the number of the try (attempt). score may say so by rows whose column `error` is not null: their job is tried again in a later batch, until `tries` tries are over (the count is in state, what failed comes back through checkpoint/feedback). Delivered again after that, it is tried again. An exception is a fault of all jobs or of a few: if single jobs cannot be scored either (see _scored), the stream stops with the error, nothing becomes a dead letter, and a restart has all jobs again; else those that fail are set apart, and go to the dead letters at once. Without dead_letters, any exception ends the stream."""
    spark, trigger, feedback = jobs.sparkSession, trigger or {"processingTime": "10 seconds"}, f"{checkpoint}/feedback"
    spark.createDataFrame([], keyed.FEEDBACK).write.mode("append").parquet(feedback)
    back = spark.readStream.schema(keyed.FEEDBACK).option("recursiveFileLookup", "true").parquet(feedback)

    def write(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        save = lambda rows, folder: rows.write.mode("overwrite").parquet(f"{folder}/run={run}/batch={number}")
        folder = f"batch-{run}-{number}"  # what the steps share; gone when the outputs are written
        once = reread(batch, f"{folder}/jobs")  # the outputs agree on the jobs, and the stream's source is read once
        old = F.coalesce(F.col("submitted_at") < F.current_timestamp() - F.expr(f"INTERVAL {max_age}"), F.lit(False)) if max_age else F.lit(False)
        accepted, rejected = validate_jobs(once.filter("job_id is not null").withColumn("expired", old), max_length)
        late = accepted.filter("expired").withColumn("reject_reason", F.lit("expired"))
        nameless = once.filter("job_id is null").withColumn("reject_reason", F.lit("no job id"))
        save(rejected.unionByName(late).drop("expired").unionByName(nameless).drop("attempt"), rejects)
        accepted = reread(accepted.filter("not expired").drop("expired"), f"{folder}/accepted")
        requests, attempts = accepted.drop("attempt"), accepted.select("job_id", "attempt")
        run_score = in_slices(score, max_jobs, folder) if max_jobs else score
        if not dead_letters:
            save(run_score(requests), path)
            return remove(spark, folder)
        good, dead = _scored(requests, run_score, tries, folder)
        dead = [d.join(attempts, "job_id") for d in dead]
        found = reduce(DataFrame.unionByName, good) if good else requests.limit(0).select("job_id")
        failed = accepted.limit(0).withColumn("error", F.lit(""))
        if "error" in found.columns:
            errors = found.filter("error is not null").groupBy("job_id").agg(F.min("error").alias("error"))
            failed = reread(accepted.join(errors, "job_id"), f"{folder}/failed")
            found = found.join(errors.select("job_id"), "job_id", "left_anti").drop("error")
        over = F.col("attempt") >= tries
        gone = reduce(DataFrame.unionByName, dead, failed.filter(over))
        again = failed.filter(~over).withColumn("feedback", F.lit("failed")).unionByName(gone.withColumn("feedback", F.lit("dead")))
        save(gone, dead_letters)
        save(again.select("job_id", "sequence", "genome", "submitted_at", "attempt", "feedback"), feedback)
        save(found, path)
        remove(spark, folder)

    with keyed.state_settings(spark, trigger):
        return keyed.counted_deliveries(jobs, back, keep_days).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def without_redelivery(events: DataFrame, keys: list[str], time_col: str = "ts", watermark: str = "30 minutes") -> DataFrame:
    """Each key once; state older than the watermark is dropped."""
    return events.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(keys)


def stream_progress(events: DataFrame, time_col: str = "ts", watermark: str = "30 minutes") -> DataFrame:
    """Counters of each job, for update or complete mode. events: (job_id, target_id, stage) and their time, stage: guide, ontarget or offtarget.

    Redelivery counts once: each (job, target, stage) is known until the watermark passes it, and what comes later than the watermark is dropped. What stays for ever is three counters a job."""
    once = without_redelivery(events.select("job_id", "target_id", "stage", F.col(time_col).cast("timestamp").alias(time_col)), ["job_id", "target_id", "stage"], time_col, watermark)
    count = lambda s: F.count(F.when(F.col("stage") == s, 1))
    return once.groupBy("job_id").agg(count("guide").alias("num_guides"), count("ontarget").alias("num_scored_ontarget"), count("offtarget").alias("num_scored_offtarget"))


def stream_file_status(parts: DataFrame, plan: DataFrame) -> DataFrame:
    """Complete files as their parts arrive, for update mode. parts: (filename, part), plan: (filename, parts_per_file); parts outside the plan do not count."""
    known = parts.join(plan.select("filename", "parts_per_file").distinct(), "filename").filter("part between 1 and parts_per_file")
    found = known.groupBy("filename", "parts_per_file").agg(F.size(F.collect_set("part")).alias("n_present"))
    return found.filter("n_present = parts_per_file")


def stream_genome_status(parts: DataFrame, plan: DataFrame) -> DataFrame:
    """Genomes all of whose files are complete, as parts arrive, for update mode. plan: (genome, filename, parts_per_file).

    One aggregation by genome, whose state is its parts so far; parts outside the plan do not count."""
    files = plan.select("genome", "filename", "parts_per_file").distinct()
    totals = files.groupBy("genome").agg(F.count("*").alias("num_files"), F.sum("parts_per_file").alias("num_parts"))
    known = parts.join(files.join(totals, "genome"), "filename").filter("part between 1 and parts_per_file")
    found = known.groupBy("genome", "num_files", "num_parts").agg(F.size(F.collect_set(F.struct("filename", "part"))).alias("n_present"))
    return found.filter("n_present = num_parts").drop("n_present")


def start_index_jobs(genomes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """An index job for each complete genome, once: a batch that runs again replaces its own part, and genomes of earlier batches are left out when their parts come again."""

    def write(batch: DataFrame, number: int) -> None:
        new = batch
        if number:
            known = batch.sparkSession.read.schema("genome string, batch long").parquet(path).filter(F.col("batch") < number)
            new = batch.join(known.select("genome"), "genome", "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return genomes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()
