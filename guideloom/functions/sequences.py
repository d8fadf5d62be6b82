"""Column functions on nucleotide strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC letters and their complements, case kept.
IUPAC = "acgtrymkbdhvACGTRYMKBDHV"
IUPAC_COMPLEMENT = "tgcayrkmvhdbTGCAYRKMVHDB"
#: Length of a guide with its PAM, and without.
GUIDE, SITE = 23, 20


def normalise_sequence(seq: Column, upper: bool = False) -> Column:
    """Without line ends and blanks; case is kept unless upper."""
    out = F.regexp_replace(seq, r"[\r\n ]", "")
    return F.upper(out) if upper else out


def reverse_complement(seq: Column) -> Column:
    """Letters outside IUPAC's twelve pairs (N, S, W and others) stay as they are."""
    return F.reverse(F.translate(seq, IUPAC, IUPAC_COMPLEMENT))


def encode2bit(site: Column) -> Column:
    """A 20-mer of ACGT as a 40-bit number, two bits a base, first base highest. Null for other letters or lengths."""
    code = F.conv(F.translate(site, "ACGT", "0123"), 4, 10).cast("long")
    return F.when(site.rlike("^[ACGT]{20}$"), code)


def decode2bit(code: Column) -> Column:
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), SITE, "0"), "0123", "ACGT")


def text_to_dna(text: Column) -> Column:
    """Letters a to z of a text as A, C, G, T in turn: a stand-in for DNA in tables that hold prose."""
    return F.translate(F.lower(F.regexp_replace(text, "[^A-Za-z]", "")), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
