"""Language identification by compression.

For each language a raw-content dictionary is made of texts of that language; a text
belongs to the language whose dictionary lets zstandard encode it in the fewest bytes. All
of the text counts, block by block, lower-cased and with each run of other characters than
letters as one blank. A margin between the best two that is narrow at the fast level is
looked at again at a stronger one; what then stays narrow is marked as rejected.

The dictionaries come from a bounded sample: at most `texts` documents a language, those
that come first in a seeded order, each cut to its share of `dictionary_bytes`.
That is the only bound; every document is judged on its whole text.

Defined cases: a null text or one without a letter is `und` with score 0; ties go to the
first language in code point order; rows without a language are never learned from; with
nothing to learn from every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import in_arrow, slices, texts_of, uniform

TEXTS, DICTIONARY_BYTES, BLOCK_BYTES = 64, 48_000, 2048
#: Level of every text, and of texts with a narrow margin.
LEVEL, SECOND_LEVEL = -1, 9
NARROW, MIN_MARGIN = 0.03, 0.005


def letters_only(texts: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(texts), r"\PL+", " "), " ")


def learn(docs: DataFrame, may_learn: Column, texts: int = TEXTS, dictionary_bytes: int = DICTIONARY_BYTES, seed: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """The dictionary of each language. At most `texts` documents a language reach the driver, each cut to its share."""
    share = dictionary_bytes // texts
    known = docs.filter(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.substring(F.col(text_col), 1, share).alias("part"), uniform(seed, F.col(id_col), F.col(lang_col)).alias("draw"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "part"))
    rows = known.withColumn("n", first).filter(F.col("n") <= texts).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("n", "part"))).alias("parts")).collect()
    return {r["lang"]: " ".join(letters_only(pa.array([p["part"] for p in r["parts"]])).to_pylist()).encode()[:dictionary_bytes] for r in sorted(rows, key=lambda r: r["lang"])}


@lru_cache(maxsize=8)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, raw in dictionaries:
        content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False))
    return made


def sizes(raw: bytes, compressors: list[zstandard.ZstdCompressor], block: int = BLOCK_BYTES) -> np.ndarray:
    """Bytes of the encoded text with each dictionary: the sum over all its blocks."""
    parts = [raw[a : a + block] for a in range(0, len(raw), block)]
    return np.array([sum(len(c.compress(p)) for p in parts) for c in compressors])


def margin(cost: np.ndarray) -> float:
    """How much smaller the best is than the second best, as a share; 1 for a single language."""
    best, *rest = np.sort(cost).tolist()
    return 1 - best / rest[0] if rest else 1.0


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, lang_pred, score (share of bytes saved against the mean of the other languages), rejected (the margin is narrow, or und)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(c) for c in keep])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
    trained = tuple(sorted(dictionaries.items()))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [k for k, _ in trained]
        quick, strong = _compressors(trained, LEVEL), _compressors(trained, SECOND_LEVEL)
        for batch in slices(batches, "_text"):
            langs, scores, rejected = [], [], []
            for text in letters_only(texts_of(batch, "_text")).to_pylist():
                if not names or not text:
                    langs.append("und"), scores.append(0.0), rejected.append(True)
                    continue
                raw = text.encode()
                cost = sizes(raw, quick)
                if margin(cost) < NARROW:
                    cost = sizes(raw, strong)
                best = int(cost.argmin())
                others = np.delete(cost, best)
                langs.append(names[best])
                scores.append(float(np.clip(1 - cost[best] / others.mean(), 0, 1)) if len(others) else 1.0)
                rejected.append(margin(cost) < min_margin)
            carried = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if f.name != "_text"}
            carried |= {"lang_pred": pa.array(langs, type=pa.string()), "score": pa.array(scores, type=pa.float64()), "rejected": pa.array(rejected, type=pa.bool_())}
            yield pa.RecordBatch.from_arrays(list(carried.values()), names=list(carried))

    return in_arrow(rows, judge, f"{fields}, lang_pred string, score double, rejected boolean")
