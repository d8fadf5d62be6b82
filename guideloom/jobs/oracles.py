"""DuckDB SQL of the registered queries, by plain means: starts enumerated one by one, near sites by comparing all of a genome."""

from __future__ import annotations

from guideloom.functions.sequences import IUPAC, IUPAC_COMPLEMENT
from guideloom.functions.votes import FOLDED, ONE_HOT, SCAFFOLD
from guideloom.jobs.queries import RBF, STRUCTURE, SVM
from guideloom.operators.specificity import WEIGHTS


def dna(text: str) -> str:
    return f"translate(lower(regexp_replace({text}, '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"


def rc(seq: str) -> str:
    return f"reverse(translate({seq}, '{IUPAC}', '{IUPAC_COMPLEMENT}'))"


def code(site: str) -> str:
    return f"list_sum(list_transform(range(0, 20), lambda i: ((strpos('ACGT', substr({site}, i + 1, 1)) - 1)::BIGINT << (2 * (19 - i)))))::BIGINT"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


JOBS = f"jobs AS (SELECT item_id::VARCHAR AS job_id, {dna('text')} AS sequence, (['de', 'en', 'es', 'fr'])[item_id % 4 + 1] AS genome FROM benchmark)"
CONTIGS = f"contigs AS (SELECT lang AS genome, doc_id::VARCHAR AS contig, {dna('text')} AS seq FROM documents)"
DOCUMENT_JOBS = f"jobs AS (SELECT doc_id::VARCHAR AS job_id, {dna('text')} AS sequence FROM documents)"
GUIDES = f"""part AS (SELECT job_id, s AS start, substr(sequence, s + 1, 23) AS p FROM (SELECT job_id, sequence, unnest(range(0, greatest(length(sequence) - 22, 0))) AS s FROM jobs)),
m AS (SELECT job_id, start, '+' AS strand, p AS sequence FROM part WHERE regexp_full_match(p, '[ACGT]{{21}}GG')
      UNION ALL SELECT job_id, start, '-', {rc('p')} FROM part WHERE regexp_full_match(p, 'CC[ACGT]{{21}}')),
u AS (SELECT job_id, sequence, count(*) AS cnt, min(start) AS start, min(strand) AS strand FROM m GROUP BY job_id, sequence HAVING count(*) = 1),
guides AS (SELECT job_id, row_number() OVER (PARTITION BY job_id ORDER BY strand = '-', start) - 1 AS target_id, sequence, cnt, start, start + 23 AS "end", strand FROM u)"""


def sites(minus: str) -> str:
    return f"""sp AS (SELECT genome, contig, substr(seq, s + 1, 23) AS p FROM (SELECT genome, contig, seq, unnest(range(0, greatest(length(seq) - 22, 0))) AS s FROM contigs)),
sites AS (SELECT genome, contig, substr(p, 1, 20) AS site FROM sp WHERE regexp_full_match(p, '[ACG][ACGT]{{20}}[AG]G')
          UNION ALL SELECT genome, contig, {minus} AS site FROM sp WHERE regexp_full_match(p, 'C[CT][ACGT]{{20}}[TGC]')),
counted AS (SELECT genome, site, count(*) AS n FROM sites GROUP BY genome, site),
coded AS (SELECT genome, site, {code('site')} AS code, n FROM counted)"""


PROTOSPACER, REFERENCE = sites(f"substr({rc('p')}, 1, 20)"), sites(rc("substr(p, 1, 20)"))
SLICED = "sliced AS (SELECT genome, k::INTEGER AS slice_no, ((code >> (8 * (4 - k))) & 255)::INTEGER AS slice_val, code, n FROM coded, range(0, 5) r(k))"
OURS = f"ours AS (SELECT DISTINCT genome, {code('substr(g.sequence, 1, 20)')} AS guide_code FROM guides g JOIN jobs USING (job_id))"
NEAR = """near AS (SELECT * FROM (SELECT o.genome, guide_code, code, n, (xor(guide_code, code) | (xor(guide_code, code) >> 1)) & 366503875925 AS mask FROM ours o JOIN coded c ON o.genome = c.genome) WHERE bit_count(mask) <= 4)"""
HITS = f"""placed AS (SELECT *, list_filter(range(1, 21), lambda p: (mask >> (2 * (20 - p))) & 1 = 1) AS ps FROM near),
hits AS (SELECT genome, guide_code, n, len(ps) AS mm, CASE WHEN len(ps) > 0 THEN 100.0::DOUBLE * list_aggregate(list_transform(ps, lambda p: 1 - ([{', '.join(map(str, WEIGHTS))}])[p]::DOUBLE), 'product')
         / (CASE WHEN len(ps) > 1 THEN (19 - (ps[-1] - ps[1])::DOUBLE / (len(ps) - 1)) / 19 * 4 + 1 ELSE 1 END) / (len(ps) * len(ps)) ELSE 0 END AS hit FROM placed),
summed AS (SELECT genome, guide_code, sum(CASE WHEN mm = 0 THEN n ELSE 0 END)::BIGINT AS n_exact, sum(hit * n) AS total FROM hits GROUP BY genome, guide_code),
scores AS (SELECT g.job_id, g.target_id, coalesce(s.n_exact, 0)::BIGINT AS n_exact, CASE WHEN j.genome IN (SELECT genome FROM coded) THEN round(10000.0 / (100.0 + coalesce(s.total, 0)), 6) END AS score
           FROM guides g JOIN jobs j USING (job_id) LEFT JOIN summed s ON s.genome = j.genome AND s.guide_code = {code('substr(g.sequence, 1, 20)')})"""
FOLD = f"""fold20 AS (SELECT guide20, min(sequence) AS sequence, {code('guide20')} AS code FROM (SELECT substr(sequence, 1, 20) AS guide20, sequence FROM guides) GROUP BY guide20),
fold AS (SELECT guide20, CASE WHEN code % 7 = 0 THEN 'GA' || substr(rna, 3, 98) ELSE rna END AS rna, CASE WHEN code % 2 = 0 THEN '{STRUCTURE}' ELSE '{"." * 100}' END || ' (' || printf('%.1f', -(code % 400) / 10.0) || ')' AS line
         FROM (SELECT *, translate('G' || substr(sequence, 2, 19) || '{SCAFFOLD}', 'T', 'U') AS rna FROM fold20)),
verdict AS (SELECT g.*, coalesce(NOT ((sequence LIKE '%GG' AND sequence LIKE 'T%') OR (sequence LIKE 'CC%' AND sequence LIKE '%A'))
         AND translate(substr(rna, 2, 19), 'U', 'T') = substr(sequence, 2, 19) AND substr(sequence, 1, 1) IN ('C', 'A', translate(substr(rna, 1, 1), 'U', 'T'))
         AND CASE WHEN regexp_matches(line, '{FOLDED}') THEN try_cast(regexp_extract(line, '{FOLDED}', 1) AS DOUBLE) >= -30 ELSE try_cast(regexp_extract(line, '\\s\\((.+)\\)', 1) AS DOUBLE) > -18 END, false) AS fold_ok
         FROM guides g LEFT JOIN fold ON guide20 = substr(sequence, 1, 20))"""
AT = "length(regexp_replace(sequence, '[^AT]', '', 'g')) / 23.0"
BITS = "array_to_string(list_transform(range(1, 21), lambda i: (map {" + ", ".join(f"'{k}': '{v}'" for k, v in ONE_HOT.items()) + "})[substr(sequence, i, 1)]), '')"
CONSENSUS = f"""voted AS (SELECT job_id, target_id, substr(sequence, 20, 1) = 'G' AS chopchop, NOT contains(sequence, 'TTTT') AND {AT} BETWEEN 0.2 AND 0.65 AND fold_ok AS mm10db,
         list_sum(list_transform(range(1, 81), lambda i: substr({BITS}, i, 1)::INTEGER * ({SVM['weights']})[i])) + {SVM['intercept']} >= 0 AS sgrnascorer FROM verdict),
consensus AS (SELECT *, concat_ws(',', chopchop::INTEGER, mm10db::INTEGER, sgrnascorer::INTEGER) AS consensus FROM voted)"""
RESULTS = """results AS (SELECT g.*, consensus, score, chopchop::INTEGER + mm10db::INTEGER + sgrnascorer::INTEGER >= 2 AS efficient, score >= 75 AS specific,
         concat_ws(' ', CASE WHEN chopchop THEN 'chopchop' END, CASE WHEN mm10db THEN 'mm10db' END, CASE WHEN sgrnascorer THEN 'sgrnascorer' END) AS accepted_by
         FROM guides g JOIN consensus USING (job_id, target_id) JOIN scores USING (job_id, target_id))"""
ALL = (JOBS, CONTIGS, GUIDES, PROTOSPACER, OURS, NEAR, HITS, FOLD, CONSENSUS, RESULTS)
OBJECTS = """d AS (SELECT *, substr(source, 4)::INTEGER AS k FROM documents),
t AS (SELECT source, k, sum(n_chars) * 4000 AS size FROM d GROUP BY source, k),
objects AS (SELECT source || '/fasta/' || doc_id || '_genomic.fna' AS key, n_chars AS size, source AS genome FROM d WHERE k % 5 <> 4
            UNION ALL SELECT source || '/issl/' || source || '.issl', size, source FROM t WHERE k % 2 = 0 UNION ALL SELECT source || '/issl/' || source || '.offtargets', size, source FROM t WHERE k % 3 = 0)"""
EVENTS = "ev AS (SELECT DISTINCT user_id AS job_id, event_id % 20 AS target_id, CASE event_type WHEN 'signup' THEN 'guide' WHEN 'view' THEN 'ontarget' WHEN 'click' THEN 'offtarget' WHEN 'purchase' THEN 'offtarget' END AS stage FROM events)"
FILES = "files AS (SELECT o_orderkey AS filename, floor(o_totalprice * 1000)::BIGINT AS file_size FROM orders)"
PLAN = """plan AS (SELECT filename, file_size, parts_per_file::INTEGER AS parts_per_file, unnest(range(1, parts_per_file + 1))::INTEGER AS part FROM (SELECT *, greatest(ceil(file_size / 50000000.0), 1)::BIGINT AS parts_per_file FROM files))"""
ACCESSIONS = "acc AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'lab_' || p_partkey ELSE 'GCA_' || lpad(p_partkey::VARCHAR, 9, '0') || '.1' END AS accession FROM part)"

ORACLES = {
    "normalised_jobs": "SELECT doc_id, md5(s) AS sequence_md5, length(s) AS n FROM (SELECT doc_id, regexp_replace(text, '[\\r\\n ]', '', 'g') AS s FROM documents)",
    "validated_jobs": f"SELECT job_id, CASE WHEN length(s) = 0 THEN 'empty' WHEN length(s) > 4000 THEN 'too long' WHEN NOT regexp_full_match(s, '[ATCGatcg]+') THEN 'alphabet' ELSE '' END AS reject_reason FROM (SELECT doc_id AS job_id, CASE WHEN doc_id % 2 = 0 THEN {dna('text')} ELSE regexp_replace(text, '[\\r\\n ]', '', 'g') END AS s FROM documents)",
    "reverse_complements": f"SELECT doc_id, md5({rc('text')}) AS rc_md5 FROM documents",
    "parsed_requests": with_(JOBS) + "SELECT job_id, CASE WHEN job_id::BIGINT % 5 <> 0 THEN sequence END AS sequence, CASE WHEN job_id::BIGINT % 5 <> 0 AND job_id::BIGINT % 3 <> 0 THEN genome END AS genome, CASE WHEN job_id::BIGINT % 5 = 0 THEN 'bad json' WHEN job_id::BIGINT % 3 = 0 THEN 'no genome' END AS reject_reason FROM jobs",
    "guides": with_(JOBS, GUIDES) + "SELECT * FROM guides",
    "guides_by_blocks": with_(DOCUMENT_JOBS, GUIDES) + "SELECT * FROM guides",
    "contig_chunks": with_(CONTIGS) + "SELECT genome, contig, chunk_id, chunk_id * 1000 AS \"offset\", length(s) AS n, md5(s) AS seq_md5 FROM (SELECT genome, contig, k AS chunk_id, substr(seq, k * 1000 + 1, 1022) AS s FROM (SELECT *, unnest(range(0, (length(seq) + 999) // 1000)) AS k FROM contigs))",
    "site_counts": with_(CONTIGS, PROTOSPACER) + "SELECT genome, site, code, n FROM coded",
    "site_counts_reference": with_(CONTIGS, REFERENCE) + "SELECT genome, site, code, n FROM coded",
    "sites_per_contig": with_(CONTIGS, PROTOSPACER) + "SELECT genome, contig, count(*) AS n_sites FROM sites GROUP BY genome, contig",
    "sorted_sites": with_(CONTIGS, PROTOSPACER) + "SELECT genome, site FROM sites ORDER BY genome, site",
    "site_index": with_(CONTIGS, PROTOSPACER, SLICED) + "SELECT * FROM sliced",
    "slice_histogram": with_(CONTIGS, PROTOSPACER, SLICED) + "SELECT genome, slice_no, slice_val, count(*) AS n_sites, sum(n)::BIGINT AS n_places FROM sliced GROUP BY genome, slice_no, slice_val",
    "fasta_round_trip": with_(CONTIGS) + "SELECT 'all' AS genome, contig, length(seq) AS n, md5(seq) AS seq_md5 FROM contigs",
    "neighbours": with_(JOBS, CONTIGS, GUIDES, PROTOSPACER, OURS, NEAR) + "SELECT genome, guide_code, code, n, bit_count(mask)::INTEGER AS mismatches FROM near",
    "specificity_scores": with_(JOBS, CONTIGS, GUIDES, PROTOSPACER, OURS, NEAR, HITS) + "SELECT * FROM scores",
    "orphan_targets": with_(JOBS, GUIDES) + "SELECT job_id, target_id FROM guides JOIN jobs USING (job_id) WHERE genome = 'en'",
    "sequence_votes": with_(JOBS, GUIDES) + f"SELECT job_id, target_id, substr(sequence, 20, 1) = 'G' AS chopchop, NOT contains(sequence, 'TTTT') AS no_poly_t, round({AT}, 6) AS at_fraction, {AT} BETWEEN 0.2 AND 0.65 AS at_in_range, NOT ((sequence LIKE '%GG' AND sequence LIKE 'T%') OR (sequence LIKE 'CC%' AND sequence LIKE '%A')) AS fold_eligible, 'G' || substr(sequence, 2, 19) || '{SCAFFOLD}' AS fold_input FROM guides",
    "one_hot": with_(JOBS, GUIDES) + f"SELECT job_id, target_id, {BITS} AS bits FROM guides",
    "fold_verdicts": with_(JOBS, GUIDES, FOLD) + "SELECT job_id, target_id, fold_ok FROM verdict",
    "consensus": with_(JOBS, GUIDES, FOLD, CONSENSUS) + "SELECT * FROM consensus",
    "guide_results": with_(*ALL) + "SELECT * FROM results ORDER BY job_id, target_id",
    "recommended_guides": with_(*ALL) + "SELECT job_id, target_id, sequence, consensus, score FROM results WHERE efficient AND specific",
    "results_json": with_(JOBS, GUIDES, FOLD, CONSENSUS) + "SELECT job_id, to_json({'recordsTotal': count(*), 'data': list({'target_id': target_id, 'sequence': sequence, 'start': start, 'end': \"end\", 'strand': strand, 'consensus': consensus} ORDER BY target_id)})::VARCHAR AS body FROM guides JOIN consensus USING (job_id, target_id) GROUP BY job_id",
    "decoded_messages": with_(JOBS, GUIDES) + "SELECT job_id, target_id, g.sequence, genome FROM guides g JOIN jobs USING (job_id)",
    "job_progress": with_(EVENTS) + "SELECT g.job_id, count(*) AS num_guides, count(a.stage) AS num_scored_ontarget, count(b.stage) AS num_scored_offtarget FROM ev g LEFT JOIN ev a ON a.job_id = g.job_id AND a.target_id = g.target_id AND a.stage = 'ontarget' LEFT JOIN ev b ON b.job_id = g.job_id AND b.target_id = g.target_id AND b.stage = 'offtarget' WHERE g.stage = 'guide' GROUP BY g.job_id",
    "planned_parts": with_(FILES, PLAN) + "SELECT filename, file_size, parts_per_file, part, (part - 1) * 50000000::BIGINT AS start_byte, least(part * 50000000::BIGINT - 1, file_size - 1) AS end_byte, file_size > 50000000 AS multipart FROM plan",
    "file_status": with_(FILES, PLAN) + "SELECT filename, count(*) AS n_planned, count(l.k) AS n_present, count(*) = count(l.k) AS complete FROM plan LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_linenumber AS p FROM lineitem) l ON l.k = filename AND l.p = part GROUP BY filename",
    "part_lists": "SELECT filename, string_agg(part || '=' || etag, ',' ORDER BY part) AS parts FROM (SELECT l_orderkey AS filename, l_linenumber AS part, max(concat_ws('-', l_orderkey, l_linenumber, l_partkey)) AS etag FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY filename",
    "latest_events": "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "genome_sizes": with_(OBJECTS) + "SELECT genome, fasta_bytes, index_mb, CASE WHEN fasta_bytes < 1 THEN 'missing' WHEN fasta_bytes / 1048576.0 > 0.1 THEN 'too large' ELSE 'ok' END AS status FROM (SELECT genome, sum(CASE WHEN contains(key, '.fna') THEN size ELSE 0 END)::BIGINT AS fasta_bytes, round(sum(CASE WHEN ends_with(key, '.issl') THEN size ELSE 0 END)::DOUBLE / 1048576, 6) AS index_mb FROM objects GROUP BY genome)",
    "missing_indexes": with_(OBJECTS) + "SELECT genome, key FROM (SELECT DISTINCT source AS genome, source || '/issl/' || source || e AS key FROM documents, (VALUES ('.issl'), ('.offtargets')) v(e)) WHERE key NOT IN (SELECT key FROM objects)",
    "routed_jobs": with_(OBJECTS) + "SELECT item_id, j.genome, CASE WHEN coalesce(fasta, 0) <= 0 THEN 'download' WHEN indexes = 2 THEN 'scan' ELSE 'index' END AS route FROM (SELECT item_id, 'src' || item_id % 25 AS genome FROM benchmark) j LEFT JOIN (SELECT genome, sum(CASE WHEN contains(key, '/fasta/') THEN size ELSE 0 END) AS fasta, count(DISTINCT CASE WHEN contains(key, '/issl/') THEN key END) AS indexes FROM objects GROUP BY genome) s ON s.genome = j.genome",
    "genome_status": with_(OBJECTS) + "SELECT source AS genome, count(*) AS num_files, count(CASE WHEN k % 5 <> 4 AND n_chars > 300 THEN 1 END) AS files_present, count(*) = count(CASE WHEN k % 5 <> 4 AND n_chars > 300 THEN 1 END) AS complete FROM d GROUP BY source",
    "custom_genomes": with_(ACCESSIONS) + "SELECT DISTINCT accession AS genome FROM acc WHERE NOT regexp_full_match(accession, '(GCA|GCF)_\\d{9}\\.\\d+')",
    "archive_paths": with_(ACCESSIONS) + "SELECT accession, '/genomes/all/' || substr(accession, 1, 3) || '/' || substr(accession, 5, 3) || '/' || substr(accession, 8, 3) || '/' || substr(accession, 11, 3) AS path FROM acc WHERE regexp_full_match(accession, '(GCA|GCF)_\\d{9}\\.\\d+')",
    "genome_files": "SELECT o_orderkey || '_genomic.fna.gz' AS file_name FROM orders WHERE o_orderkey % 3 = 0",
    "streamed_progress": with_(EVENTS) + "SELECT job_id, count(CASE WHEN stage = 'guide' THEN 1 END) AS num_guides, count(CASE WHEN stage = 'ontarget' THEN 1 END) AS num_scored_ontarget, count(CASE WHEN stage = 'offtarget' THEN 1 END) AS num_scored_offtarget FROM ev WHERE stage IS NOT NULL GROUP BY job_id",
    "streamed_files": with_(FILES, PLAN) + "SELECT filename, count(l.k)::INTEGER AS n_present FROM plan LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_linenumber AS p FROM lineitem) l ON l.k = filename AND l.p = part GROUP BY filename HAVING count(*) = count(l.k)",
    "streamed_guides": with_(JOBS, GUIDES) + "SELECT * FROM guides",
}
for same, as_ in {"neighbours_salted": "neighbours", "neighbours_by_pairs": "neighbours", "neighbours_bucketed": "neighbours", "neighbours_in_blocks": "neighbours", "fasta_gzipped": "fasta_round_trip", "fasta_blocked_gzip": "fasta_round_trip", "written_targets": "guides", "sliced_guides": "guides", "streamed_consensus": "consensus", "streamed_specificity": "specificity_scores"}.items():
    ORACLES[same] = ORACLES[as_]
_VECTORS = [(c, "".join(map(str, v))) for c, v in zip(RBF["dual_coef"], RBF["support_vectors"], strict=True)]
_KERNELS = " + ".join(f"{c}::DOUBLE * exp(-{RBF['gamma']}::DOUBLE * list_sum(list_transform(range(1, 81), lambda i: CASE WHEN substr(bits, i, 1) = substr('{v}', i, 1) THEN 0 ELSE 1 END)))" for c, v in _VECTORS)
ORACLES["fasta_chunks"] = ORACLES["contig_chunks"].replace("SELECT genome, contig, chunk_id,", "SELECT 'all' AS genome, contig, chunk_id,")
ORACLES |= {
    "streamed_index_jobs": with_(FILES, PLAN) + "SELECT genome, count(DISTINCT filename) AS num_files, count(*) AS num_parts FROM (SELECT (filename // 2)::VARCHAR AS genome, filename, part FROM plan) LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_linenumber AS p FROM lineitem) l ON l.k = filename AND l.p = part GROUP BY genome HAVING count(*) = count(l.k)",
    "settled_jobs": "SELECT item_id::VARCHAR AS job_id, CASE WHEN item_id % 5 = 0 THEN 'rejected' WHEN item_id % 7 = 0 THEN 'dead' ELSE 'scored' END AS state FROM benchmark",
    "written_sites": with_(CONTIGS, PROTOSPACER) + "SELECT site FROM sites",
    "inventory": with_(CONTIGS) + "SELECT genome, sum(length(seq) + 1)::BIGINT AS size FROM contigs GROUP BY genome",
    "job_results": with_(*ALL) + "SELECT * FROM results WHERE job_id = (SELECT job_id FROM results GROUP BY job_id ORDER BY count(*) DESC, job_id LIMIT 1) ORDER BY target_id",
    "rbf_votes": with_(JOBS, GUIDES) + f"SELECT job_id, target_id, {_KERNELS} + {RBF['intercept']}::DOUBLE >= 0 AS sgrnascorer FROM (SELECT *, {BITS} AS bits FROM guides)",
    "plugged_scores": with_(JOBS, GUIDES) + "SELECT job_id, target_id, length(regexp_replace(sequence, '[^AT]', '', 'g'))::BIGINT AS at FROM guides",
    "released_jobs": f"SELECT job_id, genome, n, 'released' AS outcome, greatest(round, CASE WHEN k % 5 = 0 THEN 0 ELSE k % 4 END)::INTEGER AS round FROM (SELECT doc_id::VARCHAR AS job_id, source AS genome, length({dna('text')}) AS n, (doc_id % 3)::INTEGER AS round, substr(source, 4)::INTEGER AS k FROM documents) WHERE k % 5 = 0 OR k % 4 <> 3",
    "expired_uploads": with_(FILES, PLAN) + "SELECT filename::VARCHAR AS filename, count(*)::INTEGER AS parts_per_file, count(l.k)::INTEGER AS n_present, CASE WHEN count(*) = count(l.k) THEN 'complete' ELSE 'expired' END AS outcome FROM plan LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_linenumber AS p FROM lineitem) l ON l.k = filename AND l.p = part GROUP BY filename HAVING count(l.k) > 0",
    "rejected_requests": f"SELECT job_id, reason AS reject_reason, count(*) AS n FROM (SELECT CASE WHEN doc_id % 5 > 1 THEN doc_id::VARCHAR END AS job_id, CASE WHEN doc_id % 5 < 2 THEN 'no job id' WHEN length(s) = 0 THEN 'empty' WHEN length(s) > 4000 THEN 'too long' WHEN NOT regexp_full_match(s, '[ATCGatcg]+') THEN 'alphabet' END AS reason FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 2 THEN regexp_replace(text, '[\\r\\n ]', '', 'g') ELSE {dna('text')} END AS s FROM documents)) WHERE reason IS NOT NULL GROUP BY job_id, reason",
    "retried_jobs": with_(JOBS) + "SELECT job_id, CASE WHEN job_id::BIGINT % 7 = 0 THEN 'dead' ELSE 'scored' END AS state, length(sequence)::INTEGER AS bases, CASE WHEN job_id::BIGINT % 7 = 0 THEN 3 END::INTEGER AS attempt FROM jobs",
    "neighbours_skewed": with_(JOBS, CONTIGS, GUIDES, PROTOSPACER.replace("coded AS (SELECT", "even AS (SELECT"), "coded AS (SELECT genome, CASE WHEN code % 3 = 0 THEN code % 4294967296 ELSE code END AS code, sum(n)::BIGINT AS n FROM even GROUP BY ALL)", OURS, NEAR) + "SELECT genome, guide_code, code, n, bit_count(mask)::INTEGER AS mismatches FROM near",
    "specific_guides": with_(JOBS, CONTIGS, GUIDES, PROTOSPACER, OURS, NEAR, HITS) + "SELECT genome, guide_code, 10000.0 / (100.0 + coalesce(total, 0)) >= 75 AS specific FROM ours LEFT JOIN summed USING (genome, guide_code)",
    "written_site_lists": with_(CONTIGS, PROTOSPACER) + "SELECT genome, count(*) AS n, min(site) AS first, max(site) AS last, true AS in_order FROM sites GROUP BY genome",
    "fasta_headerless": with_(CONTIGS) + "SELECT genome AS lang, 'c' || contig::BIGINT % 10 AS file, 1::BIGINT AS n_contigs, sum(length(seq))::BIGINT AS n FROM contigs GROUP BY ALL",
    "expired_genomes": with_(FILES, PLAN) + "SELECT genome, count(*)::INTEGER AS num_files, count(*) FILTER (n = parts)::INTEGER AS n_complete, CASE WHEN count(*) = count(*) FILTER (n = parts) THEN 'complete' ELSE 'expired' END AS outcome FROM (SELECT (filename // 2)::VARCHAR AS genome, count(*) AS parts, count(l.k) AS n FROM plan LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_linenumber AS p FROM lineitem) l ON l.k = filename AND l.p = part GROUP BY filename) GROUP BY genome HAVING sum(n) > 0",
}
