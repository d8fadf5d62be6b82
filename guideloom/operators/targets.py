"""From job requests to numbered candidate guides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from guideloom.functions.sequences import GUIDE, SITE, reverse_complement
from guideloom.functions.windows import C, G, Windows, in_arrow, steps, turned_codes

#: A guide of the + strand, or of the - strand as it stands.
EITHER = "(?:CC[ACGT]{21}|[ACGT]{21}GG)"
#: Starts in one chunk of a query.
CHUNK = 256
#: Bases of a job that one task numbers.
BLOCK = 1_000_000
#: Bases of a row whose guides one step of a task compares.
LONGEST_ROW = 16_000_000


def validate_jobs(jobs: DataFrame, max_length: int = 20_000, accession_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejects have reject_reason. Sequences are taken as normalised."""
    seq = F.col("sequence")
    reason = F.when(F.coalesce(F.length(seq), F.lit(0)) == 0, "empty").when(F.length(seq) > max_length, "too long").when(~seq.rlike("^[ATCGatcg]+$"), "alphabet")
    if accession_col:
        reason = F.coalesce(reason, F.when(~F.coalesce(F.col(accession_col).rlike("^G[A-Z]{2}_[0-9]{9}.[0-9]+"), F.lit(False)), "accession"))
    judged = jobs.withColumn("reject_reason", reason)
    return judged.filter("reject_reason is null").drop("reject_reason"), judged.filter("reject_reason is not null")


def scan_targets(jobs: DataFrame) -> DataFrame:
    """Every overlapping guide of both strands: job_id, sequence (23, PAM last), start, end, strand. One row a match; nothing is shuffled."""
    # in short chunks, cut where a guide of either strand starts: only matches become rows, and their places are the lengths of what stands before
    length = F.length("sequence")
    chunks = F.transform(F.sequence(F.lit(0), length - GUIDE, F.lit(CHUNK)), lambda o: F.struct(o.alias("offset"), F.substring("sequence", o + 1, F.lit(CHUNK + GUIDE - 1)).alias("chunk")))
    rows = jobs.filter(length >= GUIDE).select("job_id", F.explode(chunks).alias("c")).select("job_id", "c.offset", "c.chunk", F.split("c.chunk", rf"(?={EITHER})").alias("pieces"))
    ends = F.aggregate("pieces", F.array(F.lit(0)), lambda found, p: F.concat(found, F.array(F.element_at(found, -1) + F.length(p))))
    places = F.filter(ends, lambda s: ((s > 0) | F.col("chunk").rlike(f"^{EITHER}")) & (s < F.length("chunk")))
    cut = rows.select("job_id", "offset", "chunk", F.explode(places).alias("at")).select("job_id", F.substring("chunk", F.col("at") + 1, F.lit(GUIDE)).alias("part"), (F.col("offset") + F.col("at")).cast("long").alias("start"))
    strands = F.array(F.when(F.col("part").endswith("GG"), F.struct(F.lit("+").alias("strand"), F.col("part").alias("sequence"))), F.when(F.col("part").startswith("CC"), F.struct(F.lit("-").alias("strand"), reverse_complement(F.col("part")).alias("sequence"))))
    both = cut.select("job_id", "start", F.explode(F.filter(strands, lambda s: s.isNotNull())).alias("s"))
    return both.select("job_id", "s.sequence", "start", (F.col("start") + GUIDE).alias("end"), "s.strand")


def unique_targets(matches: DataFrame) -> DataFrame:
    """Guides seen once in their job over both strands."""
    once = matches.groupBy("job_id", "sequence").agg(F.count("*").alias("cnt"), F.min("start").alias("start"), F.min("end").alias("end"), F.min(F.col("strand") == "-").alias("minus"))
    return once.filter("cnt = 1").select("job_id", "sequence", "cnt", "start", "end", F.when(F.col("minus"), "-").otherwise("+").alias("strand"))


def unique_targets_by_rows(jobs: DataFrame) -> DataFrame:
    """unique_targets(scan_targets(jobs)) for many jobs: those that are one row of at most LONGEST_ROW bases are scanned and compared there by numpy, so that sequences are shuffled once and their matches never. The others go the general way."""
    rows = jobs.select("job_id", "sequence").withColumn("rows", F.count("*").over(Window.partitionBy("job_id")))
    alone = (F.col("rows") == 1) & (F.length("sequence") <= LONGEST_ROW)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "sequence"):
            w = Windows(batch.column("sequence"), GUIDE)
            (rows, plus), (others, minus) = w.starts((w.at(GUIDE - 2) == G) & (w.at(GUIDE - 1) == G)), w.starts((w.at(0) == C) & (w.at(1) == C))
            row, at = np.concatenate([rows, others]), np.concatenate([plus, minus])
            if not len(at):
                continue
            ends = lambda places, turned: sum((3 - w.bases[at_].astype(np.int64) if turned else w.bases[at_].astype(np.int64)) << 2 * k for k, at_ in enumerate(places))
            code = np.concatenate([w.codes(plus) << 6 | ends([plus + 22, plus + 21, plus + SITE], False), turned_codes(w.codes(minus + 3)) << 6 | ends([minus, minus + 1, minus + 2], True)])
            order = np.lexsort((code, row))
            differs = np.concatenate([[True], (np.diff(code[order]) != 0) | (np.diff(row[order]) != 0), [True]])
            kept = np.sort(order[differs[:-1] & differs[1:]])
            n = int(np.searchsorted(kept, len(plus)))
            start = at[kept] - w.offsets[row[kept]]
            sequences = pa.concat_arrays([w.strings(at[kept[:n]], GUIDE), w.strings(at[kept[n:]], GUIDE, True)])
            yield pa.RecordBatch.from_arrays([batch.column("job_id").take(pa.array(row[kept])), sequences, pa.array(np.ones(len(kept), dtype=np.int64)), pa.array(start), pa.array(start + GUIDE), pa.array(["+"] * n + ["-"] * (len(kept) - n), pa.string())], names=schema.names)

    schema = StructType([StructField("job_id", jobs.schema["job_id"].dataType), StructField("sequence", StringType()), *(StructField(c, LongType()) for c in ("cnt", "start", "end")), StructField("strand", StringType())])
    return in_arrow(rows.filter(alone).select("job_id", "sequence"), scan, schema).unionByName(unique_targets(scan_targets(rows.filter(~alone))))


def number_targets(targets: DataFrame, block: int | None = BLOCK) -> DataFrame:
    """target_id from 0 in each job: + strand by start, then - strand by start.

    block: bases that one task numbers, so that a job of any length is dealt out; counts of blocks give the offsets. None: one task a job, one shuffle less."""
    order = [F.when(F.col("strand") == "+", 0).otherwise(1), F.col("start")]
    if not block:
        numbered = targets.withColumn("target_id", (F.row_number().over(Window.partitionBy("job_id").orderBy(*order)) - 1).cast("long"))
    else:
        placed = targets.withColumn("block", F.floor(F.col("start") / block))
        counts = placed.groupBy("job_id", "strand", "block").count()
        before = F.sum("count").over(Window.partitionBy("job_id").orderBy(order[0], "block").rowsBetween(Window.unboundedPreceding, -1))
        offsets = counts.select("job_id", "strand", "block", F.coalesce(before, F.lit(0)).alias("before"))
        here = F.row_number().over(Window.partitionBy("job_id", "strand", "block").orderBy("start")) - 1
        numbered = placed.withColumn("here", here).join(offsets, ["job_id", "strand", "block"]).withColumn("target_id", (F.col("before") + F.col("here")).cast("long"))
    return numbered.select("job_id", "target_id", "sequence", "cnt", "start", "end", "strand")


def design_guides(jobs: DataFrame, block: int | None = BLOCK, by_rows: bool = False) -> DataFrame:
    """Unique numbered guides of all jobs. jobs: (job_id, sequence). by_rows: for many jobs, see unique_targets_by_rows."""
    return number_targets(unique_targets_by_rows(jobs) if by_rows else unique_targets(scan_targets(jobs)), block)
