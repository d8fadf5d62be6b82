"""Registered queries: every operator over whole tables. Prose stands in for DNA (see functions.sequences.text_to_dna)."""

from __future__ import annotations

import time
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from guideloom.functions import sequences, votes
from guideloom.operators import acquisition, efficiency, results, sites, specificity, targets
from guideloom.sources import blocked, fasta, tables
from guideloom.sources.staging import reread, scratch, spread
from guideloom.streaming import keyed, streams

#: Fixed values of the stand-in tables.
GENOMES = ("de", "en", "es", "fr")
STRUCTURE = "." * 28 + "(" * 4 + "." * 4 + ")" * 4 + "." * 3 + ")" * 4 + "." * 21 + "(" * 4 + "." * 4 + ")" * 4 + "(" * 7 + "." * 3 + ")" * 7 + "." * 3
SVM = {"weights": [(i * 7) % 11 - 5 for i in range(80)], "intercept": -1}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    genome = F.element_at(F.array(*map(F.lit, GENOMES)), (F.col("item_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("job_id"), sequences.text_to_dna(F.col("text")).alias("sequence"), genome.alias("genome"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("genome"), F.col("doc_id").cast("string").alias("contig"), sequences.text_to_dna(F.col("text")).alias("seq"))


def guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique numbered guides of all jobs."""
    return targets.design_guides(jobs(spark, sf_dir))


def guides_by_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guides of whole documents taken as jobs, numbered block by block."""
    docs = spread(contigs(spark, sf_dir)).select(F.col("contig").alias("job_id"), F.col("seq").alias("sequence"))
    return targets.design_guides(docs, block=1000, by_rows=True)


def normalised_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"))
    return rows.select("doc_id", F.md5(sequences.normalise_sequence(F.col("t")).cast("binary")).alias("sequence_md5"), F.length(sequences.normalise_sequence(F.col("t"))).alias("n"))


def validated_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as requests: DNA for even ids, prose for odd ones; accepted and rejected together."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"), F.when(F.col("doc_id") % 2 == 0, sequences.text_to_dna(F.col("text"))).otherwise(sequences.normalise_sequence(F.col("text"))).alias("sequence"))
    accepted, rejected = targets.validate_jobs(rows, max_length=4000)
    return accepted.select("job_id", F.lit("").alias("reject_reason")).unionByName(rejected.select("job_id", "reject_reason"))


def reverse_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(sequences.reverse_complement(F.col("text")).cast("binary")).alias("rc_md5"))


def parsed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as JSON, every third without a genome, every fifth broken."""
    rows = jobs(spark, sf_dir)
    n = F.col("job_id").cast("long")
    body = F.when(n % 5 == 0, F.concat(F.lit("{"), "sequence")).when(n % 3 == 0, F.to_json(F.struct("sequence"))).otherwise(F.to_json(F.struct("sequence", "genome")))
    return tables.parse_jobs(rows.select("job_id", body.alias("value"))).select("job_id", "sequence", "genome", "reject_reason")


def contig_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.chunk_contigs(contigs(spark, sf_dir), 1000).select("genome", "contig", "chunk_id", "offset", F.length("seq").alias("n"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


def all_sites(spark: SparkSession, sf_dir: str, reverse_slice: str = "protospacer") -> DataFrame:
    return sites.extract_offtargets(sites.chunk_contigs(spread(contigs(spark, sf_dir))), reverse_slice)


def counted_sites(spark: SparkSession, sf_dir: str, reverse_slice: str = "protospacer") -> DataFrame:
    return sites.count_sites(sites.chunk_contigs(spread(contigs(spark, sf_dir))), reverse_slice)


def site_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.packed_lists(sites.chunk_contigs(spread(contigs(spark, sf_dir))), "protospacer")


def site_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.with_letters(counted_sites(spark, sf_dir))


def site_counts_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the - strand cut before it is turned round."""
    return sites.with_letters(counted_sites(spark, sf_dir, "reference"))


def sites_per_contig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.sites_per_contig(all_sites(spark, sf_dir))


def sorted_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.sorted_lists(site_lists(spark, sf_dir))


def site_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.index_of(counted_sites(spark, sf_dir))


def packed_sites(spark: SparkSession, sf_dir: str, recode=None) -> DataFrame:
    return sites.packed_counts(sites.chunk_contigs(spread(contigs(spark, sf_dir))), "protospacer", recode)


def written_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index as scoring jobs find it: written once, read as often as needed. It lies by sites in packed rows, and its keys are made when it is read: five rows a site, or fifteen, are never made."""
    return reread(packed_sites(spark, sf_dir), "site-index")


def slice_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.slice_histogram(site_index(spark, sf_dir))


def fasta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs written as FASTA, 60 bases a line, and read back."""
    path = scratch(spark, "fasta")
    body = F.regexp_replace("seq", "(.{60})", "$1\n")
    contigs(spark, sf_dir).select(F.concat(F.lit(">"), "contig", F.lit("\n"), body)).write.text(path)
    return fasta.read_fasta(spark, path, "all").select("genome", "contig", F.length("seq").alias("n"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


def fasta_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs of each source and language written without headers, a folder each, and read back by their many paths: one contig a file."""
    path = scratch(spark, "fasta-plain")
    rows = contigs(spark, sf_dir).select("genome", F.concat(F.lit("c"), F.col("contig").cast("long") % 10).alias("file"), F.regexp_replace("seq", "(.{60})", "$1\n").alias("value"))
    rows.repartition(8, "genome", "file").sortWithinPartitions("genome", "file", "value").write.partitionBy("genome", "file").text(path)
    files = tables.read_objects(spark, path).filter(F.col("key").endswith(".txt"))
    found = fasta.read_fasta(spark, sorted(r["key"] for r in files.select("key").collect()), "all")  # ten files a language
    name = F.regexp_extract("contig", "genome=([a-z]+)/file=(c[0-9])/", 1), F.regexp_extract("contig", "genome=([a-z]+)/file=(c[0-9])/", 2)
    return found.groupBy(name[0].alias("lang"), name[1].alias("file")).agg(F.count("*").alias("n_contigs"), F.sum(F.length("seq")).alias("n"))


def fasta_gzipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through gzipped files, which are read whole and then spread."""
    path = scratch(spark, "fasta-gz")
    contigs(spark, sf_dir).select(F.concat(F.lit(">"), "contig", F.lit("\n"), F.lower("seq"))).write.option("compression", "gzip").text(path)
    return fasta.read_fasta(spark, path, "all", partitions=spark.sparkContext.defaultParallelism).select("genome", "contig", F.length("seq").alias("n"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


def fasta_blocked_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs through blocked gzip, in three files, each read by as many tasks as it has byte ranges."""
    path = scratch(spark, "fasta-blocked")
    rows = contigs(spark, sf_dir).select("contig", F.concat(F.lit(">"), "contig", F.lit("\n"), F.regexp_replace("seq", "(.{60})", "$1\n")).alias("value"))
    blocked.write_blocked(rows.repartition(3, "contig").select("value"), path)
    pieces = fasta.read_fasta_lines(spark, path, "all", blocked=True, headers=True)
    whole = pieces.groupBy("genome", "file", "record", "contig").agg(F.array_join(F.sort_array(F.collect_list(F.struct("offset", "seq")))["seq"], "").alias("seq"))
    return whole.select("genome", "contig", F.length("seq").alias("n"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


def fasta_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of written FASTA made from its lines, 60 bases each."""
    path = scratch(spark, "fasta-lines")
    contigs(spark, sf_dir).select(F.concat(F.lit(">"), "contig", F.lit("\n"), F.regexp_replace("seq", "(.{60})", "$1\n"))).write.text(path)
    return sites.chunk_lines(fasta.read_fasta_lines(spark, path, "all"), 1000).select("genome", "contig", "chunk_id", "offset", F.length("seq").alias("n"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


def written_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of sites, a line each, as later jobs read it."""
    path = scratch(spark, "sites")
    fasta.write_site_lists(site_lists(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("site"))


def written_site_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of each genome in its own folder, with the place of each site among the lines of its files in order."""
    path = scratch(spark, "site-lists")
    fasta.write_site_lists(site_lists(spark, sf_dir), path)
    lines = spark.read.text(path).select("genome", F.col("_metadata.file_name").alias("file"), F.col("value").alias("site"))
    # equal sites are neighbours in order, so the first and last of a file say whether files are in order
    return lines.groupBy("genome", "file").agg(F.min("site").alias("first"), F.max("site").alias("last"), F.count("*").alias("n")).withColumn("in_order", F.coalesce(F.col("first") >= F.lag("last").over(Window.partitionBy("genome").orderBy("file")), F.lit(True))).groupBy("genome").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("in_order").alias("in_order"))


def written_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guides written by job in three writes that share all their buckets; every third job is written twice."""
    path, found = scratch(spark, "targets"), guides(spark, sf_dir)
    n = F.col("job_id").cast("long")
    stale = found.filter(n % 3 == 0).withColumn("target_id", F.lit(-1).cast("long"))
    for rows in (stale, found.filter(n % 2 == 0), found.filter(n % 2 == 1)):
        tables.write_targets(rows, path, buckets=4)
    return spark.read.parquet(path).select(found.columns)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of the files of each genome, from an inventory of written contigs."""
    path = scratch(spark, "genomes")
    contigs(spark, sf_dir).select("genome", "seq").write.partitionBy("genome").text(path)
    files = tables.read_objects(spark, path).filter(F.col("key").endswith(".txt"))
    return files.groupBy(F.regexp_extract("key", "genome=([a-z]+)/", 1).alias("genome")).agg(F.sum("size").alias("size"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct guides of the jobs and their sites with at most four mismatches."""
    ours = specificity.with_genome(guides(spark, sf_dir), jobs(spark, sf_dir)).select("genome", sequences.encode2bit(F.substring("sequence", 1, 20)).alias("guide_code")).distinct()
    return specificity.neighbours(ours, written_index(spark, sf_dir)).select("genome", "guide_code", "code", "n", "mismatches")


def neighbours_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours = specificity.with_genome(guides(spark, sf_dir), jobs(spark, sf_dir)).select("genome", sequences.encode2bit(F.substring("sequence", 1, 20)).alias("guide_code")).distinct()
    return specificity.neighbours(ours, written_index(spark, sf_dir), salt=4, max_broadcast=0).select("genome", "guide_code", "code", "n", "mismatches")


def neighbours_by_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by finer keys: two of six parts of a site."""
    ours = specificity.with_genome(guides(spark, sf_dir), jobs(spark, sf_dir)).select("genome", sequences.encode2bit(F.substring("sequence", 1, 20)).alias("guide_code")).distinct()
    return specificity.neighbours(ours, written_index(spark, sf_dir), keys="pairs").select("genome", "guide_code", "code", "n", "mismatches")


def _distinct_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return specificity.with_genome(guides(spark, sf_dir), jobs(spark, sf_dir)).select("genome", sequences.encode2bit(F.substring("sequence", 1, 20)).alias("guide_code")).distinct()


def neighbours_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same against an index that lies in buckets by its key: only the guides are shuffled."""
    name = f"site_index_{uuid.uuid4().hex}"
    sites.write_site_index(sites.packed_index(packed_sites(spark, sf_dir)), name, int(spark.conf.get("spark.sql.shuffle.partitions")), scratch(spark, "bucketed-index"))
    return specificity.neighbours(_distinct_guides(spark, sf_dir), spark.table(name), max_broadcast=0).select("genome", "guide_code", "code", "n", "mismatches")


def neighbours_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by arrays of codes, without a row for each candidate pair."""
    return specificity.neighbours_in_blocks(_distinct_guides(spark, sf_dir), written_index(spark, sf_dir)).select("genome", "guide_code", "code", "n", "mismatches")


def neighbours_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of which a third share their first four bases, as in a genome of repeats: the hot buckets are found by the histogram and dealt out."""
    written = reread(packed_sites(spark, sf_dir, lambda codes: np.where(codes % 3 == 0, codes % (1 << 32), codes)), "skewed-index")
    index = sites.packed_index(written)
    return specificity.neighbours(_distinct_guides(spark, sf_dir), index, hot=specificity.hot_slices(index, 1000)).select("genome", "guide_code", "code", "n", "mismatches")


def specific_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guides of all jobs and whether they are specific, by rounds that leave out those already decided."""
    ours = reread(_distinct_guides(spark, sf_dir), "guide-codes")
    return specificity.specific_guides(ours, written_index(spark, sf_dir))


def specificity_scores(spark: SparkSession, sf_dir: str, found: DataFrame | None = None) -> DataFrame:
    return specificity.score_specificity(found or guides(spark, sf_dir), jobs(spark, sf_dir), written_index(spark, sf_dir)).withColumn("score", F.round("score", 6))


def orphan_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guides whose job is not among those of one genome."""
    return specificity.orphans(guides(spark, sf_dir), jobs(spark, sf_dir).filter("genome <> 'en'")).select("job_id", "target_id")


def sequence_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("sequence")
    return guides(spark, sf_dir).select("job_id", "target_id", votes.chopchop(seq).alias("chopchop"), votes.no_poly_t(seq).alias("no_poly_t"), F.round(votes.at_fraction(seq), 6).alias("at_fraction"), votes.at_in_range(seq).alias("at_in_range"), votes.fold_eligible(seq).alias("fold_eligible"), votes.fold_input(seq).alias("fold_input"))


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guides(spark, sf_dir).select("job_id", "target_id", F.array_join(F.transform(votes.one_hot80(F.col("sequence")), lambda b: b.cast("string")), "").alias("bits"))


def fold_table(found: DataFrame) -> DataFrame:
    """Made-up foldings of guides: energy and structure from their codes, some echoes broken."""
    code = sequences.encode2bit(F.col("guide20"))
    rna = F.translate(votes.fold_input(F.col("sequence")), "T", "U")
    rows = found.withColumn("guide20", F.substring("sequence", 1, 20)).groupBy("guide20").agg(F.min("sequence").alias("sequence"))
    line = F.concat(F.when(code % 2 == 0, STRUCTURE).otherwise("." * 100), F.lit(" ("), F.format_string("%.1f", -(code % 400) / 10), F.lit(")"))
    return rows.select("guide20", F.when(code % 7 == 0, F.concat(F.lit("GA"), F.substring(rna, 3, 98))).otherwise(rna).alias("rna"), line.alias("structure_line"))


def fold_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = guides(spark, sf_dir)
    return efficiency.attach_fold(found, fold_table(found)).select("job_id", "target_id", "fold_ok")


def consensus(spark: SparkSession, sf_dir: str, found: DataFrame | None = None) -> DataFrame:
    found = found or guides(spark, sf_dir)
    return efficiency.score_efficiency(found, fold_table(found), SVM)


def guide_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guides with votes, score and labels, by job and number."""
    found = reread(guides(spark, sf_dir), "guides")  # read by all steps
    rows = results.guide_results(found, consensus(spark, sf_dir, found), specificity_scores(spark, sf_dir, found))
    return rows.orderBy("job_id", "target_id")


def job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the user of one job sees: the job with the most guides, the first of them."""
    found = guide_results(spark, sf_dir)
    job = found.groupBy("job_id").count().orderBy(F.desc("count"), "job_id").first()["job_id"]
    return results.job_results(found, job)


#: Fixed values of the stand-in model: support vectors as bits, their coefficients, gamma and intercept.
RBF = {"support_vectors": [[int((i * k) % 7 < 2) for i in range(80)] for k in (3, 5, 8)], "dual_coef": [1.0, -1.5, 0.75], "gamma": 0.03125, "intercept": -0.0625}


def rbf_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return efficiency.svm_vote(guides(spark, sf_dir), RBF).select("job_id", "target_id", "sgrnascorer")


def plugged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plug-in model over batches of guides: here the count of A and T."""
    return efficiency.score_with(guides(spark, sf_dir).select("job_id", "target_id", "sequence"), lambda batch: batch[["job_id", "target_id"]].assign(at=batch["sequence"].str.count("[AT]").astype("int64")), "job_id string, target_id long, at long")


def recommended_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.recommended_guides(guide_results(spark, sf_dir)).select("job_id", "target_id", "sequence", "consensus", "score")


def results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.results_json(guides(spark, sf_dir).join(consensus(spark, sf_dir).select("job_id", "target_id", "consensus"), ["job_id", "target_id"]))


def decoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guides as scoring messages, with broken ones among them, decoded."""
    found = specificity.with_genome(guides(spark, sf_dir), jobs(spark, sf_dir))
    broken = table(spark, sf_dir, "benchmark").select(F.concat(F.lit('{"default": "'), F.col("item_id"), F.lit('"}')).alias("body"))
    return tables.decode_messages(tables.encode_messages(found, F.col("genome")).unionByName(broken))


def score_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.when(F.col("event_type") == "signup", "guide").when(F.col("event_type") == "view", "ontarget").when(F.col("event_type").isin("click", "purchase"), "offtarget")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), (F.col("event_id") % 20).alias("target_id"), stage.alias("stage"), "ts", "value").filter("stage is not null")


def job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_events(spark, sf_dir)
    of = lambda s, c: rows.filter(F.col("stage") == s).select("job_id", "target_id", F.col("stage").alias(c))
    return results.job_progress(of("guide", "g").distinct(), of("ontarget", "consensus"), of("offtarget", "score"))


def planned_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.plan_parts(remote_files(spark, sf_dir))


def remote_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filename"), F.floor(F.col("o_totalprice") * 1000).cast("long").alias("file_size"))


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("filename"), F.col("l_linenumber").cast("int").alias("part"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("etag"))


def file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.file_status(planned_parts(spark, sf_dir), part_records(spark, sf_dir))


def part_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = acquisition.part_lists(part_records(spark, sf_dir))
    return rows.select("filename", F.array_join(F.transform("parts", lambda p: F.concat_ws("=", p["part"].cast("string"), p["etag"])), ",").alias("parts"))


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return acquisition.latest_by_key(rows, ["user_id", "event_type"], "ts").select("user_id", "event_type", "event_id", "value")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory made of documents: FASTA of each source, and one or both index files of some."""
    docs = table(spark, sf_dir, "documents")
    number = F.substring("source", 4, 9).cast("int")
    fa = docs.filter(number % 5 != 4).select(F.concat("source", F.lit("/fasta/"), "doc_id", F.lit("_genomic.fna")).alias("key"), F.col("n_chars").alias("size"))
    totals = docs.groupBy("source").agg((F.sum("n_chars") * 4000).alias("size"))
    index = lambda e, every: totals.filter(number % every == 0).select(F.concat("source", F.lit("/issl/"), "source", F.lit(e)).alias("key"), "size")
    return fa.unionByName(index(".issl", 2)).unionByName(index(".offtargets", 3))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.lit("src"), (F.col("item_id") % 25).cast("string")).alias("genome"))


def genome_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.genome_sizes(objects(spark, sf_dir), limit_mb=0.1).withColumn("index_mb", F.round("index_mb", 6))


def missing_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.missing_indexes(table(spark, sf_dir, "documents").select(F.col("source").alias("genome")), objects(spark, sf_dir))


def routed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.route_jobs(routed(spark, sf_dir), objects(spark, sf_dir))


def genome_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = table(spark, sf_dir, "documents").select(F.col("source").alias("genome"), F.concat("doc_id", F.lit("_genomic.fna")).alias("file_name"))
    return acquisition.genome_status(plan, objects(spark, sf_dir).filter("size > 300"))


def accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("lab_"), "p_partkey")).otherwise(F.concat(F.lit("GCA_"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(".1")))
    return table(spark, sf_dir, "part").select(name.alias("accession"))


def custom_genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.custom_genomes(accessions(spark, sf_dir).select(F.concat("accession", F.lit("/fasta/x.fa")).alias("key")))


def archive_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accessions(spark, sf_dir).filter(votes.is_public_accession(F.col("accession"))).select("accession", votes.archive_path(F.col("accession")).alias("path"))


def genome_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("o_orderkey") % 3 == 0, "_genomic.fna.gz").when(F.col("o_orderkey") % 3 == 1, "_cds_from_genomic.fna.gz").otherwise("_report.txt")
    return table(spark, sf_dir, "orders").select(F.concat(F.col("o_orderkey").cast("string"), end).alias("file_name")).filter(votes.is_genome_file(F.col("file_name")))


def _drained(stream: DataFrame, name: str) -> DataFrame:
    """All that a stateful stream has to say, in complete mode."""
    spark, path = stream.sparkSession, scratch(stream.sparkSession, name)
    schema = stream.schema
    query = stream.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).option("checkpointLocation", scratch(spark, f"{name}-state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(path)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque*")


def streamed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """job_progress from a stream of events."""
    stage = F.when(F.col("event_type") == "signup", "guide").when(F.col("event_type") == "view", "ontarget").when(F.col("event_type").isin("click", "purchase"), "offtarget")
    rows = _stream(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), (F.col("event_id") % 20).alias("target_id"), stage.alias("stage"), "ts").filter("stage is not null")
    return _drained(streams.stream_progress(rows), "progress")


def streamed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete files from a stream of part records."""
    rows = _stream(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("filename"), F.col("l_linenumber").cast("int").alias("part"))
    return _drained(streams.stream_file_status(rows, planned_parts(spark, sf_dir)), "files").select("filename", "n_present")


def streamed_index_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files, two a genome: genomes whose parts have all come, half of the records at first and then all of them again."""
    path, out, state = (scratch(spark, f"genomes-{part}") for part in ("parts", "jobs", "state"))
    plan = acquisition.plan_parts(table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 2).cast("string").alias("genome"), F.col("o_orderkey").alias("filename"), F.floor(F.col("o_totalprice") * 1000).cast("long").alias("file_size")))
    records = part_records(spark, sf_dir).select("filename", "part")
    for delivered in (records.filter("filename % 4 < 2"), records):
        delivered.write.mode("append").parquet(path)
        parts = spark.readStream.schema(records.schema).parquet(path)
        streams.start_index_jobs(streams.stream_genome_status(parts, plan), out, state, {"availableNow": True}).awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").schema("genome string, num_files long, num_parts long").parquet(out)


def settled_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a stream puts each job: every fifth is too old, and every seventh cannot be scored."""
    path, out, rejects, dead, state = (scratch(spark, f"settled-{part}") for part in ("requests", "rows", "rejects", "dead", "state"))
    n = F.col("job_id").cast("long")
    submitted = F.when(n % 5 == 0, F.lit("2024-01-01T00:00:00Z").cast("timestamp")).otherwise(F.current_timestamp())
    jobs(spark, sf_dir).withColumn("submitted_at", submitted).write.json(path)

    def score(accepted: DataFrame) -> DataFrame:
        broken = F.when(n % 7 == 0, F.raise_error(F.lit("no score"))).otherwise(F.length("sequence"))
        return accepted.select("job_id", broken.alias("bases"))

    streams.start_scoring(streams.stream_jobs(spark, path), score, out, rejects, state, {"availableNow": True}, max_age="1 day", dead_letters=dead, tries=2).awaitTermination()
    read = lambda folder, state: spark.read.option("recursiveFileLookup", "true").schema("job_id string").parquet(folder).select("job_id", F.lit(state).alias("state"))
    return read(out, "scored").unionByName(read(rejects, "rejected")).unionByName(read(dead, "dead"))


def _scored_stream(spark: SparkSession, sf_dir: str, name: str, score, schema, **options) -> DataFrame:
    """Jobs that arrive as JSON lines, some of them again in a later batch, scored as they come."""
    path, out, rejects, state = (scratch(spark, f"{name}-{part}") for part in ("requests", "rows", "rejects", "state"))
    requests = jobs(spark, sf_dir).withColumn("submitted_at", F.lit("2024-01-01T00:00:00Z").cast("timestamp"))
    for delivered in (requests, requests.filter("cast(job_id AS long) % 3 = 0")):
        delivered.write.mode("append").json(path)
        streams.start_scoring(streams.stream_jobs(spark, path), score, out, rejects, state, {"availableNow": True}, **options).awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(out)


def streamed_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_stream(spark, sf_dir, "guides", targets.design_guides, guides(spark, sf_dir).schema)


def sliced_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with at most ten jobs in each run of the scorer."""
    return _scored_stream(spark, sf_dir, "sliced", targets.design_guides, guides(spark, sf_dir).schema, max_jobs=10)


def streamed_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The efficiency votes of jobs as they arrive."""

    def score(accepted: DataFrame) -> DataFrame:
        found = targets.design_guides(accepted)
        return efficiency.score_efficiency(found, fold_table(found), SVM)

    return _scored_stream(spark, sf_dir, "consensus", score, consensus(spark, sf_dir).schema)


def streamed_specificity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The off-target scores of jobs as they arrive, against an index written before."""
    index = written_index(spark, sf_dir)
    score = lambda accepted: specificity.score_specificity(targets.design_guides(accepted), accepted, index)
    schema = specificity.score_specificity(guides(spark, sf_dir), jobs(spark, sf_dir), index).schema
    return _scored_stream(spark, sf_dir, "specificity", score, schema).withColumn("score", F.round("score", 6))


def _rounds(spark: SparkSession, name: str, stream: DataFrame, deliveries, column: str = "round") -> DataFrame:
    """What a stateful stream writes after each delivery, with the number of the delivery."""
    out, state = (scratch(spark, f"{name}-{part}") for part in ("rows", "state"))
    for number, deliver in enumerate(deliveries):
        deliver()
        with keyed.state_settings(spark, {"availableNow": True}):
            save = lambda batch, k, number=number: batch.write.mode("overwrite").parquet(f"{out}/{column}={number}/batch={k}")
            query = stream.writeStream.foreachBatch(save).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in stream.schema)}, {column} int, batch long").parquet(out).drop("batch")


def released_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as jobs for the genome of their source, in three rounds, half of a round's again in the next: which round lets each go. Some genomes have an index at the start, others get it in one of the rounds, before, with or after their jobs, and some never do."""
    asked, ready = (scratch(spark, f"waiting-{part}") for part in ("jobs", "indexes"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("doc_id").cast("string").alias("job_id"), sequences.text_to_dna(F.col("text")).alias("sequence"), F.col("source").alias("genome"), F.lit("2024-01-01T00:00:00Z").cast("timestamp").alias("submitted_at"))
    sources = docs.select("genome", F.substring("genome", 4, 9).cast("int").alias("k")).distinct()
    jobs_of, indexes_of = docs.drop("doc_id"), sources.select("genome")

    def delivery(number: int):
        def deliver() -> None:
            again = (F.col("doc_id") % 3 == number - 1) & (F.col("doc_id") % 2 == 0)
            docs.filter((F.col("doc_id") % 3 == number) | again).drop("doc_id").write.mode("append").parquet(asked)
            sources.filter(F.col("k") % 4 == number).select("genome").write.mode("append").parquet(ready)

        return deliver

    read = lambda path, like: spark.readStream.schema(like.schema).parquet(path)
    jobs_of.limit(0).write.parquet(asked), indexes_of.limit(0).write.parquet(ready)
    stream = keyed.released_jobs(read(asked, jobs_of), read(ready, indexes_of), known=sources.filter("k % 5 = 0"))
    return _rounds(spark, "waiting", stream, [delivery(k) for k in range(3)]).select("job_id", "genome", F.length("sequence").alias("n"), "outcome", "round")


def expired_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files whose parts come in two deliveries, the second with all of the first again: each file once, complete or expired with what it had."""
    path = scratch(spark, "uploads")
    records = part_records(spark, sf_dir).select(F.col("filename").cast("string").alias("filename"), "part")
    none = spark.createDataFrame([("-1", 1)], "filename string, part int")  # the clock goes on

    def delivery(rows: DataFrame):
        def deliver() -> None:
            time.sleep(0.5)
            rows.write.mode("append").parquet(path)

        return deliver

    records.limit(0).write.parquet(path)
    plan = reread(planned_parts(spark, sf_dir).select("filename", "parts_per_file").distinct(), "upload-plan")  # read in every batch
    stream = keyed.finished_uploads(spark.readStream.schema(records.schema).parquet(path), plan, keep_days=0.4 / 86_400)
    return _rounds(spark, "uploads", stream, [delivery(records.filter("part % 2 = 1")), delivery(records), delivery(none)]).drop("round")


def expired_genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files, two a genome, delivered as in expired_uploads: each genome once, complete or expired with its complete files."""
    path = scratch(spark, "genome-parts")
    plan = planned_parts(spark, sf_dir).select(F.floor(F.col("filename") / 2).cast("string").alias("genome"), F.col("filename").cast("string").alias("filename"), "parts_per_file").distinct()
    plan = reread(plan, "genome-plan")  # read in every batch
    records = part_records(spark, sf_dir).select(F.col("filename").cast("string").alias("filename"), "part")
    none = spark.createDataFrame([("-1", 1)], "filename string, part int")  # the clock goes on

    def delivery(rows: DataFrame):
        def deliver() -> None:
            time.sleep(0.5)
            rows.write.mode("append").parquet(path)

        return deliver

    records.limit(0).write.parquet(path)
    stream = keyed.finished_genomes(spark.readStream.schema(records.schema).parquet(path), plan, keep_days=0.4 / 86_400)
    return _rounds(spark, "genomes", stream, [delivery(records.filter("part % 2 = 1")), delivery(records), delivery(none)]).drop("round")


def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as requests, some of them broken, without an id, or no DNA: how often each id is rejected, and why."""
    path, out, rejects, state = (scratch(spark, f"rejected-{part}") for part in ("requests", "rows", "rejects", "state"))
    n, text = F.col("doc_id"), sequences.text_to_dna(F.col("text"))
    job, body = n.cast("string").alias("job_id"), F.when(n % 5 == 2, F.col("text")).otherwise(text).alias("sequence")
    line = F.when(n % 5 == 0, F.to_json(F.struct(body))).when(n % 5 == 1, F.concat(F.lit('{"job_id": "'), job, F.lit("', broken"))).otherwise(F.to_json(F.struct(job, body)))
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(path)
    streams.start_scoring(streams.stream_jobs(spark, path), lambda jobs: jobs.select("job_id", F.length("sequence").alias("n")), out, rejects, state, {"availableNow": True}, max_length=4000).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", "true").schema("job_id string, reject_reason string").parquet(rejects)
    return rows.groupBy("job_id", "reject_reason").agg(F.count("*").alias("n"))


def retried_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs whose scoring says that it failed: every seventh always, every eleventh at the first try. Where each ends."""
    path, out, rejects, dead, state = (scratch(spark, f"retried-{part}") for part in ("requests", "rows", "rejects", "dead", "state"))
    jobs(spark, sf_dir).withColumn("submitted_at", F.lit("2024-01-01T00:00:00Z").cast("timestamp")).write.json(path)
    n = F.col("job_id").cast("long")
    for number in range(4):
        fails = (n % 7 == 0) | (n % 11 == 0) if number == 0 else n % 7 == 0
        score = lambda accepted, fails=fails: accepted.select("job_id", F.length("sequence").alias("bases"), F.when(fails, "no score").alias("error"))
        streams.start_scoring(streams.stream_jobs(spark, path), score, out, rejects, state, {"availableNow": True}, dead_letters=dead, tries=3).awaitTermination()
    read = lambda folder, columns: spark.read.option("recursiveFileLookup", "true").schema(columns).parquet(folder)
    scored = read(out, "job_id string, bases int").select("job_id", F.lit("scored").alias("state"), "bases", F.lit(None).cast("int").alias("attempt"))
    return scored.unionByName(read(dead, "job_id string, sequence string, attempt int").select("job_id", F.lit("dead").alias("state"), F.length("sequence").alias("bases"), "attempt"))


QUERIES = {
    f.__name__: f
    for f in (
        normalised_jobs, validated_jobs, reverse_complements, parsed_requests, guides, guides_by_blocks, contig_chunks, site_counts, site_counts_reference, sites_per_contig, sorted_sites, site_index, slice_histogram, fasta_round_trip, fasta_gzipped, fasta_blocked_gzip, fasta_chunks, fasta_headerless, written_sites, written_site_lists, written_targets, inventory,
        neighbours, neighbours_salted, neighbours_by_pairs, neighbours_bucketed, neighbours_in_blocks, neighbours_skewed, specific_guides, specificity_scores, orphan_targets, sequence_votes, one_hot, fold_verdicts, consensus, guide_results, recommended_guides, results_json, decoded_messages, job_progress, job_results, rbf_votes, plugged_scores,
        planned_parts, file_status, part_lists, latest_events, genome_sizes, missing_indexes, routed_jobs, genome_status, custom_genomes, archive_paths, genome_files, streamed_progress, streamed_files, streamed_index_jobs, settled_jobs, released_jobs, expired_uploads, expired_genomes, rejected_requests, retried_jobs, streamed_guides, sliced_guides, streamed_consensus, streamed_specificity,
    )
}
