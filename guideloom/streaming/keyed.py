"""Keyed state of streams: deliveries that count once, jobs that wait for an index, uploads that complete or expire.

State is bounded by time: whatever stands in it has a timer or a lifetime by the clock. Clock
time is used, not event time, since a job or part that comes late must not be dropped. With
the trigger availableNow, timers fire when there is something new to read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400_000


@contextmanager
def state_settings(spark: SparkSession, trigger: dict, partitions: int | None = None) -> Iterator[None]:
    """What a stream with such state needs when it starts; the session has its own settings again afterwards. A stream that is to end must not run batches for the clock alone."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": PROVIDER, "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    if trigger.get("availableNow") or trigger.get("once"):
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Deliveries(StatefulProcessor):
    """Each job id once, and again after a failure. State: the number of tries of each id, for `keep` milliseconds."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle) -> None:
        self.tried = handle.getValueState("tried", "attempt int", self.keep)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.tried.get()[0] if self.tried.exists() else None
        was = known
        for r in sorted(rows, key=lambda r: r["feedback"] is None):  # what became of earlier tries comes first
            attempt = None
            if r["job_id"] is None:
                attempt = 1
            elif r["feedback"] == "dead":
                known = None
            elif r["feedback"] == "failed":
                if known == r["attempt"]:
                    attempt = known = known + 1
            elif known is None:
                attempt = known = 1
            if attempt:
                yield Row(job_id=r["job_id"], sequence=r["sequence"], genome=r["genome"], submitted_at=r["submitted_at"], attempt=attempt)
        if known is None:
            self.tried.clear()
        elif known != was:
            self.tried.update((known,))


FEEDBACK = "job_id string, sequence string, genome string, submitted_at timestamp, attempt int, feedback string"


def counted_deliveries(jobs: DataFrame, feedback: DataFrame, keep_days: float = 14) -> DataFrame:
    """(job_id, sequence, genome, submitted_at, attempt): jobs as they are first delivered, and those whose failure came back, with the number of the try. A job whose feedback says dead is new when it is delivered again. Jobs without an id pass, each."""
    new = jobs.select("job_id", "sequence", "genome", "submitted_at", F.lit(None).cast("int").alias("attempt"), F.lit(None).cast("string").alias("feedback"))
    rows = new.unionByName(feedback.select(new.columns))
    # rows without an id have no state; they are only spread
    key = F.coalesce(F.concat(F.lit("+"), "job_id"), F.concat(F.lit("-"), F.pmod(F.xxhash64("sequence", "genome"), F.lit(64)).cast("string")))
    return rows.withColumn("key", key).groupBy("key").transformWithState(Deliveries(int(keep_days * DAY)), "job_id string, sequence string, genome string, submitted_at timestamp, attempt int", "append", "processingTime")


class Waiting(StatefulProcessor):
    """Jobs of a genome until its index is ready. State: whether it is, the jobs that wait, and the ids that have gone, for `keep` milliseconds."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle) -> None:
        self.handle = handle
        self.ready = handle.getValueState("ready", "ready boolean")
        self.parked = handle.getMapState("parked", "job_id string", "sequence string, submitted_at timestamp, until long")
        self.gone = handle.getMapState("gone", "job_id string", "outcome string", self.keep)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.ready.update((True,))

    def _out(self, key, job_id, value, outcome: str) -> Row:
        self.gone.updateValue((job_id,), (outcome,))
        return Row(genome=key[0], job_id=job_id, sequence=value[0], submitted_at=value[1], outcome=outcome)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ready, now = self.ready.exists(), timerValues.getCurrentProcessingTimeInMs()
        until, waits = now + self.keep, False
        for r in rows:
            if r["job_id"] is None:
                if not ready:
                    ready = True
                    self.ready.update((True,))
                continue
            job = (r["job_id"],)
            if self.gone.containsKey(job) or self.parked.containsKey(job):
                continue
            if ready:
                yield self._out(key, r["job_id"], (r["sequence"], r["submitted_at"]), "released")
            else:
                self.parked.updateValue(job, (r["sequence"], r["submitted_at"], until))
                waits = True
        if ready:
            yield from self._all(key, None, "released")
        elif waits:
            self.handle.registerTimer(until)

    def _all(self, key, upto: int | None, outcome: str) -> Iterator[Row]:
        """Those that wait no longer than `upto`, or all."""
        for job, value in list(self.parked.iterator()):
            if upto is None or value[2] <= upto:
                self.parked.removeKey(job)
                yield self._out(key, job[0], value, outcome)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._all(key, expiredTimerInfo.getExpiryTimeInMs(), "expired")


def released_jobs(jobs: DataFrame, indexes: DataFrame, known: DataFrame | None = None, keep_days: float = 14, salt: int = 8) -> DataFrame:
    """(genome, job_id, sequence, submitted_at, outcome): each job once, when the index of its genome is ready (released) or after keep_days without one (expired).

    jobs: stream of (job_id, sequence, genome, submitted_at), ids not null. indexes: stream of (genome), one row or more when an index is ready. known: genomes with an index when the stream begins (not a stream). salt: parts of a genome's jobs, as one genome may have most of them; each part is told of the index."""
    parts = F.explode(F.array(*map(F.lit, range(salt))))
    ready = indexes.select("genome", parts.alias("part"), F.lit(None).cast("string").alias("job_id"), F.lit(None).cast("string").alias("sequence"), F.lit(None).cast("timestamp").alias("submitted_at"))
    asked = jobs.filter("job_id is not null").select("genome", F.pmod(F.xxhash64("job_id"), F.lit(salt)).cast("int").alias("part"), "job_id", "sequence", "submitted_at")
    begins = known.select("genome").distinct().select("genome", parts.alias("part")).groupBy("genome", "part") if known is not None else None
    return asked.unionByName(ready).groupBy("genome", "part").transformWithState(Waiting(int(keep_days * DAY)), "genome string, job_id string, sequence string, submitted_at timestamp, outcome string", "append", "processingTime", begins)


#: Groups in which the state of uploads lies. Python asks the state store a few times a key, so keys are groups of files and not files.
BUCKETS = 4096


def _bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int").alias("bucket")


def _packed(rows: list[tuple], schema: pa.Schema) -> bytes:
    """Rows as one value of a state."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in pa.ipc.open_stream(value).read_all().columns), strict=True)


def _of_bits(bits: int) -> bytes:
    return bits.to_bytes((bits.bit_length() + 7) // 8, "little")


class Uploads(StatefulProcessor):
    """The parts of the files of a bucket as bits, of each until all are there or `keep` milliseconds have gone since its first."""

    SCHEMA = pa.schema([("filename", pa.string()), ("bits", pa.binary()), ("parts", pa.int32()), ("until", pa.int64())])

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle) -> None:
        self.handle = handle
        self.files = handle.getValueState("files", "rows binary")

    def _load(self) -> dict[str, tuple[bytes | None, int, int]]:
        value = self.files.get()
        return {name: (bits, parts, until) for name, bits, parts, until in _unpacked(bytes(value[0]))} if value else {}

    def _store(self, files: dict) -> None:
        self.files.update((_packed([(name, *f) for name, f in files.items()], self.SCHEMA),)) if files else self.files.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[str, tuple[int, int]] = {}
        for _, name, part, parts in rows:
            new[name] = (new[name][0] | 1 << (part - 1) if name in new else 1 << (part - 1), parts)
        files, until = self._load(), timerValues.getCurrentProcessingTimeInMs() + self.keep
        if any(name not in files for name in new):
            self.handle.registerTimer(until)
        complete = []
        for name, (bits, parts) in new.items():
            before, _, ends = files.get(name, (b"", parts, until))
            if before is None:
                continue
            bits |= int.from_bytes(before, "little")
            done = bits.bit_count() == parts
            # of a finished file only the mark is kept, so that parts that come again change nothing
            files[name] = (None if done else _of_bits(bits), parts, ends)
            if done:
                complete.append((name, parts))
        self._store(files)
        for name, parts in complete:
            yield Row(filename=name, parts_per_file=parts, n_present=parts, outcome="complete")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        files, upto = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        self._store({name: f for name, f in files.items() if f[2] > upto})
        for name, (bits, parts, until) in files.items():
            if until <= upto and bits is not None:
                yield Row(filename=name, parts_per_file=parts, n_present=int.from_bytes(bits, "little").bit_count(), outcome="expired")


def finished_uploads(parts: DataFrame, plan: DataFrame, keep_days: float = 1, buckets: int = BUCKETS) -> DataFrame:
    """(filename, parts_per_file, n_present, outcome): each file once, when its last part has come (complete) or keep_days after its first (expired); then its state is gone. parts: stream of (filename, part), plan: (filename, parts_per_file); parts outside the plan do not count.

    buckets: groups of files whose state is read and written together; it stays as it is for the life of a checkpoint. The plan is read in every batch."""
    sizes = plan.select(F.col("filename").cast("string").alias("filename"), F.col("parts_per_file").cast("int").alias("parts_per_file")).distinct()
    known = parts.select(F.col("filename").cast("string").alias("filename"), F.col("part").cast("int").alias("part")).join(sizes, "filename").filter("part between 1 and parts_per_file")
    rows = known.select(_bucket("filename", buckets), "filename", "part", "parts_per_file")
    return rows.groupBy("bucket").transformWithState(Uploads(int(keep_days * DAY)), "filename string, parts_per_file int, n_present int, outcome string", "append", "processingTime")


class Genomes(StatefulProcessor):
    """The parts of each file of the genomes of a bucket as bits, of each genome until all files are complete or `keep` milliseconds have gone since its first part."""

    FILES = pa.schema([("genome", pa.string()), ("filename", pa.string()), ("bits", pa.binary()), ("parts", pa.int32())])
    GENOMES = pa.schema([("genome", pa.string()), ("complete", pa.int32()), ("files", pa.int32()), ("until", pa.int64())])

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "genomes binary, files binary")

    def _load(self) -> tuple[dict, dict]:
        """Genomes, and the files of those that are not done."""
        value = self.bucket.get()
        if not value:
            return {}, {}
        genomes = {genome: (complete, files, until) for genome, complete, files, until in _unpacked(bytes(value[0]))}
        files: dict = {}
        for genome, name, bits, parts in _unpacked(bytes(value[1])):
            files.setdefault(genome, {})[name] = (int.from_bytes(bits, "little"), parts)
        return genomes, files

    def _store(self, genomes: dict, files: dict) -> None:
        if genomes:
            open_files = [(genome, name, _of_bits(bits), parts) for genome, of in files.items() for name, (bits, parts) in of.items()]
            self.bucket.update((_packed([(genome, *g) for genome, g in genomes.items()], self.GENOMES), _packed(open_files, self.FILES)))
        else:
            self.bucket.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[str, dict[str, tuple[int, int]]] = {}
        sizes: dict[str, int] = {}
        for _, genome, name, part, parts, n in rows:
            of = new.setdefault(genome, {})
            of[name] = (of[name][0] | 1 << (part - 1) if name in of else 1 << (part - 1), parts)
            sizes[genome] = n
        (genomes, files), until = self._load(), timerValues.getCurrentProcessingTimeInMs() + self.keep
        if any(genome not in genomes for genome in new):
            self.handle.registerTimer(until)
        out = []
        for genome, of in new.items():
            complete, had_files, ends = genomes.get(genome, (0, -1, until))
            if complete == had_files:
                continue
            had = files.setdefault(genome, {})
            for name, (bits, parts) in of.items():
                before = had.get(name, (0, 0))[0]
                bits |= before
                if bits != before:
                    had[name] = (bits, parts)
                    complete += bits.bit_count() == parts  # it was not, or nothing would be new
            genomes[genome] = (complete, sizes[genome], ends)
            if complete == sizes[genome]:
                del files[genome]
                out.append((genome, complete))
        self._store(genomes, files)
        for genome, n in out:
            yield Row(genome=genome, num_files=n, n_complete=n, outcome="complete")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (genomes, files), upto = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        left = {genome: g for genome, g in genomes.items() if g[2] > upto}
        self._store(left, {genome: of for genome, of in files.items() if genome in left})
        for genome, (complete, n, until) in genomes.items():
            if until <= upto and complete != n:
                yield Row(genome=genome, num_files=n, n_complete=complete, outcome="expired")


def finished_genomes(parts: DataFrame, plan: DataFrame, keep_days: float = 7, buckets: int = BUCKETS) -> DataFrame:
    """(genome, num_files, n_complete, outcome): each genome once, when the last part of its last file has come (complete: its index can be built) or keep_days after its first (expired); then its state is gone. parts: stream of (filename, part), plan: (genome, filename, parts_per_file), a file belongs to one genome; parts outside the plan do not count.

    buckets: as in finished_uploads, of genomes with their open files."""
    files = plan.filter("genome is not null").select(F.col("genome").cast("string").alias("genome"), F.col("filename").cast("string").alias("filename"), F.col("parts_per_file").cast("int").alias("parts_per_file")).distinct()
    known = files.withColumn("num_files", F.count("*").over(Window.partitionBy("genome")).cast("int"))
    rows = parts.select(F.col("filename").cast("string").alias("filename"), F.col("part").cast("int").alias("part")).join(known, "filename").filter("part between 1 and parts_per_file")
    rows = rows.select(_bucket("genome", buckets), "genome", "filename", "part", "parts_per_file", "num_files")
    return rows.groupBy("bucket").transformWithState(Genomes(int(keep_days * DAY)), "genome string, num_files int, n_complete int, outcome string", "append", "processingTime")
