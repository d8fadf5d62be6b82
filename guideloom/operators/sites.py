"""Off-target sites of genomes and their slice index."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guideloom.functions.sequences import GUIDE, SITE, encode2bit
from guideloom.functions.windows import A, C, G, T, Windows, in_arrow, steps, strings_of, turned_codes

#: Sites in one batch that a task gives.
STEP_ROWS = 1 << 16
#: A site of 20 bases is five slices of four.
SLICES, SLICE_BITS = 5, 8
#: Bases of the six parts whose pairs are finer keys.
PARTS = (4, 4, 3, 3, 3, 3)


def chunk_contigs(contigs: DataFrame, size: int = 1_000_000) -> DataFrame:
    """(genome, contig, chunk_id, offset, seq): each start of a site lies in one chunk; chunks overlap by 22 bases."""
    length = F.length("seq")
    # cut before the rows are made, so that none of them carries its contig; no filter, which would be pushed down and make seq a second time
    cut = F.transform(F.sequence(F.lit(0), length - 1, F.lit(size)), lambda o: F.struct((o / size).cast("long").alias("chunk_id"), o.cast("long").alias("offset"), F.substring("seq", o + 1, F.lit(size + GUIDE - 1)).alias("seq")))
    return contigs.select("genome", "contig", F.explode(F.when(length > 0, cut)).alias("c")).select("genome", "contig", "c.*")


def chunk_lines(lines: DataFrame, size: int = 1_000_000) -> DataFrame:
    """The same chunks from the lines of read_fasta_lines, so that no row ever holds more than a line or a chunk."""
    n, most = F.length("seq"), size + GUIDE - 1
    first, last = F.greatest(F.floor((F.col("offset") - (GUIDE - 1)) / size), F.lit(0)), F.floor((F.col("offset") + n - 1) / size)

    def piece(k):
        start = F.greatest(k * size, F.col("offset"))
        end = F.least(k * size + most, F.col("offset") + n)
        return F.struct(k.alias("chunk_id"), start.alias("start"), F.substring("seq", (start - F.col("offset") + 1).cast("int"), (end - start).cast("int")).alias("part"))

    rows = lines.select("genome", "file", "record", "contig", F.explode(F.transform(F.sequence(first, last), piece)).alias("p")).select("genome", "file", "record", "contig", "p.*")
    whole = rows.groupBy("genome", "file", "record", "contig", "chunk_id").agg(F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
    return whole.select("genome", "contig", "chunk_id", (F.col("chunk_id") * size).alias("offset"), F.array_join("parts.part", "").alias("seq"))


def _places(batch: pa.RecordBatch, before: int) -> tuple[Windows, tuple, tuple]:
    """The windows of chunks, and where sites lie in them: sequence numbers and starts of the + strand, then of the - strand, `before` bases behind the start of their window."""
    w = Windows(batch.column("seq"), GUIDE)
    last = w.at(GUIDE - 1)
    # [ACG] N{20} [AG]G, and C[CT] N{20} [TGC] turned round
    plus = w.starts((last == G) & ((w.at(GUIDE - 2) == G) | (w.at(GUIDE - 2) == A)) & (w.at(0) < T))
    rows, minus = w.starts((w.at(0) == C) & ((w.at(1) == C) | (w.at(1) == T)) & (last > A))
    return w, plus, (rows, minus + before)


def _before(reverse_slice: str) -> int:
    if reverse_slice not in ("reference", "protospacer"):
        raise ValueError(reverse_slice)
    return 0 if reverse_slice == "reference" else GUIDE - SITE


def extract_offtargets(chunks: DataFrame, reverse_slice: str = "reference") -> DataFrame:
    """(genome, contig, site), duplicates kept. On the - strand, `reference` cuts 20 bases before it turns them round and so keeps the PAM side; `protospacer` cuts the 20 bases of the guide."""
    before = _before(reverse_slice)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "seq"):
            w, (rows, plus), (others, minus) = _places(batch, before)
            found = pa.concat_arrays([w.strings(plus, SITE), w.strings(minus, SITE, True)])
            of = pa.array(np.concatenate([rows, others]))
            for i in range(0, len(found), STEP_ROWS):
                part = of.slice(i, STEP_ROWS)
                yield pa.RecordBatch.from_arrays([batch.column("genome").take(part), batch.column("contig").take(part), found.slice(i, STEP_ROWS)], names=["genome", "contig", "site"])

    return in_arrow(chunks.select(F.col("genome").cast("string"), F.col("contig").cast("string"), "seq"), scan, "genome string, contig string, site string")


#: Parts into which the codes of a genome are dealt by hash, so that a group is one of its thousandths.
CODE_BUCKETS = 1024
#: Bits of the first five bases, by which codes are dealt where their order matters.
FIRST_BITS = 10


def _by_hash(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int32) & (CODE_BUCKETS - 1)


def _by_order(codes: np.ndarray) -> np.ndarray:
    return (codes >> 2 * SITE - FIRST_BITS).astype(np.int32)


def _dealt_codes(chunks: DataFrame, reverse_slice: str, recode: Callable[[np.ndarray], np.ndarray] | None = None, bucket_of: Callable[[np.ndarray], np.ndarray] = _by_hash) -> DataFrame:
    """(genome, bucket, codes, ns): the sites of extract_offtargets. Each step of a task counts its own codes; what is shuffled are arrays of distinct codes, one for each genome and bucket of codes."""
    before = _before(reverse_slice)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "seq"):
            w, (rows, plus), (others, minus) = _places(batch, before)
            if not len(plus) + len(minus):
                continue
            codes, genomes = np.concatenate([w.codes(plus), turned_codes(w.codes(minus))]), batch.column("genome").dictionary_encode("encode")
            codes = recode(codes) if recode else codes
            of = genomes.indices.to_numpy()[np.concatenate([rows, others])]
            for k, genome in enumerate(genomes.dictionary.to_pylist()):
                distinct, n = np.unique(codes[of == k], return_counts=True)
                if not len(distinct):
                    continue
                bucket = bucket_of(distinct)
                order = np.argsort(bucket, kind="stable")
                first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                ends = np.append(first, len(order))
                yield pa.RecordBatch.from_arrays([pa.array([genome] * len(first), pa.string()), pa.array(bucket[order][first]), _packed(distinct[order], ends), _packed(n[order].astype(np.int32), ends)], names=["genome", "bucket", "codes", "ns"])

    return in_arrow(chunks.select(F.col("genome").cast("string"), "seq"), scan, "genome string, bucket int, codes binary, ns binary")


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of an array, each as the bytes of one row."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array | pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    """The numbers of packed rows, one row after another."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _added(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and their counts, of packed rows of one bucket."""
    codes, ns = unpacked(found.column("codes")), unpacked(found.column("ns"), np.int32)
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(ns[order].astype(np.int64), first)


def count_sites(chunks: DataFrame, reverse_slice: str = "reference") -> DataFrame:
    """(genome, code, n) of the sites of extract_offtargets."""

    def add(found: pa.Table) -> pa.Table:
        codes, ns = _added(found)
        return pa.table({"genome": pa.array([found.column("genome")[0].as_py()] * len(codes), pa.string()), "code": codes, "n": ns})

    return _dealt_codes(chunks, reverse_slice).groupBy("genome", "bucket").applyInArrow(add, "genome string, code long, n long")


#: Sites in one packed row.
PACKED_SITES = 1 << 16


def packed_counts(chunks: DataFrame, reverse_slice: str = "reference", recode: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(genome, codes, ns): the rows of count_sites as arrays of eight-byte numbers, at most PACKED_SITES a row; what the neighbour join reads. recode: what the codes become before they are counted."""

    def add(found: pa.Table) -> pa.Table:
        codes, ns = _added(found)
        ends = np.append(np.arange(0, len(codes), PACKED_SITES), len(codes))
        return pa.table({"genome": pa.array([found.column("genome")[0].as_py()] * (len(ends) - 1), pa.string()), "codes": _packed(codes, ends), "ns": _packed(ns, ends)})

    return _dealt_codes(chunks, reverse_slice, recode).groupBy("genome", "bucket").applyInArrow(add, "genome string, codes binary, ns binary")


def packed_lists(chunks: DataFrame, reverse_slice: str = "reference") -> DataFrame:
    """(genome, bucket, part, codes, ns): the sites of extract_offtargets, duplicates counted, in order of these columns and then of codes within a row, which is the order of their letters. A row holds at most PACKED_SITES places, so a site found more often fills several rows, and rows can be dealt out whatever they hold."""

    def add(found: pa.Table) -> pa.Table:
        codes, ns = _added(found)
        upto = np.cumsum(ns)
        full = np.append(np.arange(PACKED_SITES, upto[-1], PACKED_SITES), upto[-1])
        cuts = np.union1d(upto, full)
        ends, n = np.append(0, np.searchsorted(cuts, full, side="right")), len(full)
        columns = [pa.array([found.column("genome")[0].as_py()] * n, pa.string()), pa.array([found.column("bucket")[0].as_py()] * n, pa.int32()), np.arange(n, dtype=np.int32)]
        return pa.table([*columns, _packed(codes[np.searchsorted(upto, cuts)], ends), _packed(np.diff(cuts, prepend=0), ends)], names=["genome", "bucket", "part", "codes", "ns"])

    return _dealt_codes(chunks, reverse_slice, bucket_of=_by_order).groupBy("genome", "bucket").applyInArrow(add, "genome string, bucket int, part int, codes binary, ns binary")


def places_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The number of each packed row, and the letters of its sites: a line a place."""
    for k in range(batch.num_rows):
        codes, ns = (unpacked(batch.column(c).slice(k, 1)) for c in ("codes", "ns"))
        yield k, letters_of(np.repeat(codes, ns))


def sorted_lists(lists: DataFrame) -> DataFrame:
    """sorted_sites from packed lists: what is put in order are packed rows, and the sites are made from them."""

    def sites(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, letters in places_of(batch):
                yield pa.RecordBatch.from_arrays([pa.repeat(batch.column("genome")[k], len(letters)), strings_of(letters)], names=["genome", "site"])

    return in_arrow(lists.orderBy("genome", "bucket", "part").select("genome", "codes", "ns"), sites, "genome string, site string")


def sorted_sites(sites: DataFrame) -> DataFrame:
    """(genome, site) in order, duplicates kept."""
    return sites.select("genome", "site").orderBy("genome", "site")


def site_counts(sites: DataFrame) -> DataFrame:
    """(genome, site, code, n). Codes of eight bytes are shuffled, after partial counts."""
    return with_letters(sites.select("genome", encode2bit(F.col("site")).alias("code")).groupBy("genome", "code").agg(F.count("*").alias("n")))


def with_letters(counted: DataFrame) -> DataFrame:
    """(genome, site, code, n) from (genome, code, n)."""
    return counted.select("genome", _decoded(F.col("code")).alias("site"), "code", "n")


#: The four letters of a byte of a code.
QUADS = tuple("".join("ACGT"[byte >> k & 3] for k in (6, 4, 2, 0)) for byte in range(256))
_QUADS = np.frombuffer("".join(QUADS).encode(), dtype=np.uint32)


def letters_of(codes: np.ndarray) -> np.ndarray:
    """The letters of codes, a row each, by the same look-ups."""
    return np.take(_QUADS, codes.astype("<i8").view(np.uint8).reshape(-1, 8)[:, SLICES - 1 :: -1]).view(np.uint8)


def _decoded(code: Column) -> Column:
    """decode2bit by bytes: five look-ups."""
    quads = F.array(*map(F.lit, QUADS))
    return F.concat(*(F.get(quads, F.shiftright(code, 8 * (SLICES - 1 - s)).bitwiseAND(F.lit(255)).cast("int")) for s in range(SLICES)))


def sites_per_contig(sites: DataFrame) -> DataFrame:
    return sites.groupBy("genome", "contig").agg(F.count("*").alias("n_sites"))


def keys_of(keys: str) -> list[list[tuple[int, int]]]:
    """The join keys of a code, each as stretches (lowest bit, bits). slices: five of eight bits; four mismatches leave one of them whole. pairs: two of six parts, 15 keys of 12 to 16 bits; four mismatches leave two parts whole, and a key meets far fewer sites."""
    if keys == "slices":
        return [[(SLICE_BITS * (SLICES - 1 - s), SLICE_BITS)] for s in range(SLICES)]
    if keys == "pairs":
        ends = [2 * e for e in accumulate(PARTS)]
        parts = [(2 * SITE - end, 2 * n) for end, n in zip(ends, PARTS, strict=True)]
        return [list(pair) for pair in combinations(parts, 2)]
    raise ValueError(keys)


def _key_value(code: str, stretches: list[tuple[int, int]]) -> str:
    """The bits of the stretches one after another."""
    out, at = [], 0
    for low, bits in reversed(stretches):
        out.append(f"shiftleft(shiftright({code}, {low}) & {(1 << bits) - 1}L, {at})")
        at += bits
    return f"cast({' | '.join(out)} AS int)"


def key_values(codes: np.ndarray, stretches: list[tuple[int, int]]) -> np.ndarray:
    """_key_value of arrays."""
    out, at = np.zeros(len(codes), dtype=np.int64), 0
    for low, bits in reversed(stretches):
        out |= (codes >> low & (1 << bits) - 1) << at
        at += bits
    return out


def sliced(rows: DataFrame, code: str = "code", keys: str = "slices") -> DataFrame:
    """A row for each key of each row: slice_no and slice_val of its code."""
    values = [F.expr(_key_value(code, k)) for k in keys_of(keys)]
    return rows.select("*", F.posexplode(F.array(*values)).alias("slice_no", "slice_val"))


def build_site_index(sites: DataFrame, keys: str = "slices") -> DataFrame:
    """(genome, slice_no, slice_val, code, n): what the neighbour join reads."""
    return index_of(site_counts(sites), keys)


def index_of(counted: DataFrame, keys: str = "slices") -> DataFrame:
    """The same from (genome, code, n)."""
    return sliced(counted.select("genome", "code", "n"), keys=keys).select("genome", "slice_no", "slice_val", "code", "n")


def packed_index(packed: DataFrame, keys: str = "slices") -> DataFrame:
    """(genome, slice_no, slice_val, codes, ns) from packed counts: index_of with the sites of a key in arrays, as many rows for each key as there are batches."""
    every = keys_of(keys)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("genome").dictionary_encode("encode")
            for g, genome in enumerate(of.dictionary.to_pylist()):
                own = batch.filter(pa.array(of.indices.to_numpy() == g))
                codes, ns = unpacked(own.column("codes")), unpacked(own.column("ns"))
                for k, stretches in enumerate(every):
                    values = key_values(codes, stretches).astype(np.uint16)
                    order = np.argsort(values, kind="stable")
                    values = values[order].astype(np.int32)
                    first = np.flatnonzero(np.diff(values, prepend=-1))
                    ends = np.append(first, len(values))
                    yield pa.RecordBatch.from_arrays([pa.array([genome] * len(first), pa.string()), pa.array(np.full(len(first), k, dtype=np.int32)), pa.array(values[first]), _packed(codes[order], ends), _packed(ns[order], ends)], names=["genome", "slice_no", "slice_val", "codes", "ns"])

    return in_arrow(packed.select("genome", "codes", "ns"), deal, "genome string, slice_no int, slice_val int, codes binary, ns binary")


def write_site_index(index: DataFrame, table: str, buckets: int = 512, path: str | None = None) -> None:
    """The index as a table bucketed by the join key, one file a bucket, so that later joins shuffle the guides alone. For that it needs as many buckets at least as such a join has shuffle partitions."""
    key = ["genome", "slice_no", "slice_val"]
    rows = index.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).mode("overwrite")
    (rows.option("path", path) if path else rows).saveAsTable(table)


def slice_histogram(index: DataFrame) -> DataFrame:
    """Sites in each bucket of the index: where a join would be skewed."""
    return index.groupBy("genome", "slice_no", "slice_val").agg(F.count("*").alias("n_sites"), F.sum("n").alias("n_places"))
