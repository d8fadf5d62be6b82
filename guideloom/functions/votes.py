"""Column functions of the efficiency votes and of the labels drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scaffold RNA, pattern of a well-folded guide with its energy, pattern of the energy alone.
SCAFFOLD = "GUUUUAGAGCUAGAAAUAGCAAGUUAAAAUAAGGCUAGUCCGUUAUCAACUUGAAAAAGUGGCACCGAGUCGGUGCUUUU"
FOLDED = r".{28}\({4}\.{4}\){4}\.{3}\){4}.{21}\({4}\.{4}\){4}\({7}\.{3}\){7}\.{3}\s\((.+)\)"
ENERGY = r"\s\((.+)\)"
#: Four-bit codes of the letters.
ONE_HOT = {"A": "0001", "C": "0010", "T": "0100", "G": "1000", "K": "1100", "M": "0011", "R": "1001", "Y": "0110", "S": "1010", "W": "0101", "B": "1110", "V": "1011", "H": "0111", "D": "1101", "N": "1111"}
TOOLS = ("chopchop", "mm10db", "sgrnascorer")


def chopchop(seq: Column) -> Column:
    return F.substring(seq, 20, 1) == "G"


def no_poly_t(seq: Column) -> Column:
    return ~F.contains(seq, F.lit("TTTT"))


def at_fraction(seq: Column) -> Column:
    """Share of A and T in all 23 bases."""
    return F.length(F.regexp_replace(seq, "[^AT]", "")) / F.length(seq)


def at_in_range(seq: Column, low: float = 0.20, high: float = 0.65) -> Column:
    return at_fraction(seq).between(low, high)


def fold_eligible(seq: Column) -> Column:
    """False for guides that would start with T on the + strand or end with A on the - strand."""
    return ~((seq.endswith("GG") & seq.startswith("T")) | (seq.startswith("CC") & seq.endswith("A")))


def fold_input(seq: Column) -> Column:
    return F.concat(F.lit("G"), F.substring(seq, 2, 19), F.lit(SCAFFOLD))


def fold_verdict(line: Column, low: float = -30, high: float = -18) -> Column:
    """Well-folded: energy of at least low. Otherwise: energy above high. Unreadable or missing: false."""
    folded = F.trim(F.regexp_extract(line, FOLDED, 1))
    other = F.trim(F.regexp_extract(line, ENERGY, 1))
    return F.coalesce(F.when(folded != "", folded.try_cast("double") >= low).otherwise(other.try_cast("double") > high), F.lit(False))


def fold_echo_ok(seq: Column, rna: Column) -> Column:
    """Whether the folded RNA is that of the guide: bases 2 to 20 agree, and the guide starts with the echoed base, C or A."""
    dna = F.translate(F.substring(rna, 1, 20), "U", "T")
    same = F.substring(dna, 2, 19) == F.substring(seq, 2, 19)
    return F.coalesce(same & ((F.substring(seq, 1, 1) == F.substring(dna, 1, 1)) | F.substring(seq, 1, 1).isin("C", "A")), F.lit(False))


def mm10db(seq: Column, fold_ok: Column) -> Column:
    return no_poly_t(seq) & at_in_range(seq) & F.coalesce(fold_ok, F.lit(False))


def one_hot80(seq: Column) -> Column:
    """Four ints for each of the first 20 bases."""
    coded = F.substring(seq, 1, 20)
    codes = F.create_map(*[F.lit(x) for pair in ONE_HOT.items() for x in pair])
    bits = F.array_join(F.transform(F.split(coded, ""), lambda c: F.element_at(codes, c)), "")
    return F.transform(F.split(bits, ""), lambda b: b.cast("int"))


def linear_decision(features: Column, weights: Sequence[float], intercept: float) -> Column:
    return F.aggregate(F.zip_with(features, F.array(*map(F.lit, map(float, weights))), lambda x, w: x * w), F.lit(0.0), lambda a, b: a + b) + F.lit(float(intercept))


def consensus_string(*votes: Column) -> Column:
    return F.concat_ws(",", *[v.cast("int").cast("string") for v in votes])


def votes_of(consensus: Column) -> Column:
    return F.aggregate(F.split(consensus, ","), F.lit(0), lambda a, v: a + v.cast("int"))


def efficient(consensus: Column, least: int = 2) -> Column:
    """Null while there is no consensus."""
    return F.when(F.length(consensus) > 0, votes_of(consensus) >= least)


def specific(score: Column, least: float = 75) -> Column:
    return score >= least


def accepted_by(consensus: Column) -> Column:
    """Names of the tools that voted yes; the third name stands for the third vote."""
    vote = F.split(consensus, ",")
    return F.concat_ws(" ", *[F.when(F.get(vote, F.lit(i)) == "1", F.lit(t)) for i, t in enumerate(TOOLS)])


def is_public_accession(name: Column) -> Column:
    return name.rlike(r"^(GCA|GCF)_\d{9}\.\d+$")


def archive_path(accession: Column) -> Column:
    part = lambda a: F.substring(accession, a, 3)
    return F.concat_ws("/", F.lit("/genomes/all"), part(1), part(5), part(8), part(11))


def is_genome_file(name: Column) -> Column:
    return F.contains(name, F.lit("genomic.fna")) & ~F.contains(name, F.lit("from_genomic"))
