"""Quality rules: tokeniser fertility beside the usual counts.

Each word of a text (a run without ASCII white space) is encoded on its own with a public
vocabulary that falls back to bytes. Three measures of the whole text follow: characters
per token, the share of byte-fallback tokens among all tokens, and the entropy of the
token distribution in bits. Short texts say less, so the lower bound on characters per token
sinks with the root of the word count; the share of the highest entropy falls with the length
of a text, so its bound follows the line of good texts. A text whose measures leave the band of its language (or,
where the language has no band, of its main script) is rejected, as are very short texts
and texts that repeat themselves.

One pass, no shuffle. A batch encodes each of its distinct words once.

Defined cases: a null or empty text has no words and is rejected as too short; a null or
unknown language takes the band of the script; a very long text is one slice of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WordTokens, flat_words, gather, in_arrow, slices, sums, texts_of

SYMBOLS = r"[#*$%&|<>]"
#: Usual characters per token and the width below it, most characters per token, most byte-fallback share, least entropy share (of the highest possible) of one token and its fall with the logarithm of the tokens.
#: Medians and lines of least squares of 1652 documents labelled good (sf0.1, crc32 of the id even), six standard errors (0.6 over the root of the words) and four deviations of the entropy share (0.045) below.
BANDS = {
    "en": (2.219, 3.6, 8.0, 0.02, 1.158, 0.0759),
    "de": (2.243, 3.6, 8.0, 0.02, 1.160, 0.0786),
    "fr": (1.981, 3.6, 8.0, 0.02, 1.151, 0.0781),
    "es": (1.938, 3.6, 8.0, 0.02, 1.147, 0.0761),
}
#: The same by script, for languages without a band. There are no labels, so they are wide: half the characters per token of a plain sentence of the script (the first article of the declaration of human rights) with this vocabulary, and byte fallback in scripts that it does not cover.
SCRIPT_BANDS = {
    "Latin": (1.2, 2.0, 8.0, 0.05, 0.30, 0.0),
    "Cyrillic": (1.07, 2.0, 8.0, 0.05, 0.30, 0.0),
    "Greek": (0.43, 1.0, 8.0, 0.05, 0.25, 0.0),
    "Arabic": (0.46, 1.0, 8.0, 0.20, 0.25, 0.0),
    "Hebrew": (0.41, 1.0, 8.0, 0.20, 0.25, 0.0),
    "Devanagari": (0.39, 1.0, 6.0, 0.40, 0.25, 0.0),
    "Thai": (0.49, 1.0, 6.0, 0.40, 0.25, 0.0),
    "Han": (0.49, 1.0, 3.0, 0.60, 0.25, 0.0),
    "Kana": (0.47, 1.0, 3.0, 0.60, 0.25, 0.0),
    "Hangul": (0.35, 1.0, 3.0, 0.60, 0.25, 0.0),
    "other": (0.25, 2.0, 6.0, 0.75, 0.25, 0.0),
}
#: Character classes of the scripts named above.
LETTERS = {"Kana": r"\p{Hiragana}\p{Katakana}"} | {s: rf"\p{{{s}}}" for s in SCRIPT_BANDS if s not in ("Kana", "other")}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Byte pieces of the vocabulary have these ids.
BYTE_IDS = (3, 258)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_token", "byte_share", "token_entropy")


@cache
def _word_tokens(path: str) -> WordTokens:
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = pieces.encode(words, num_threads=1)
        lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        return lengths, np.fromiter(chain.from_iterable(coded), dtype=np.int64, count=int(lengths.sum()))

    return WordTokens(encode)


def repeated_windows(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """True for each word inside a window of three words that stands twice or more in its row."""
    inside = np.zeros(len(row), dtype=bool)
    if len(row) < 3:
        return inside
    start = np.flatnonzero(row[2:] == row[:-2])
    size = np.int64(code.max()) + 1
    pair = np.unique(code[start] * size + code[start + 1], return_inverse=True)[1]  # exact numbers, no hashes
    triple = np.unique(pair * size + code[start + 2], return_inverse=True)[1]
    _, same, times = np.unique(triple * (np.int64(row.max()) + 1) + row[start], return_inverse=True, return_counts=True)
    twice = start[times[same] > 1]
    for k in range(3):
        inside[twice + k] = True
    return inside


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """For each text, its lines with a word that equal an earlier line."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
    row, code = row[full], lines.filter(pa.array(full)).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(row):
        return np.zeros(len(texts), dtype=np.int64)
    first = np.unique(row * (code.max() + 1) + code, return_index=True)[1]
    return sums(row, None, len(texts)) - sums(row[first], None, len(texts))


def measure(texts: pa.Array, vocabulary: str) -> dict[str, np.ndarray]:
    """Counts and fertility of each text."""
    n = len(texts)
    row, words = flat_words(texts)
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False)
    symbols = pc.count_substring_regex(words.dictionary, SYMBOLS).to_numpy(zero_copy_only=False)
    out = {"n_words": sums(row, None, n), "word_chars": sums(row, chars[code], n), "n_symbols": sums(row, symbols[code], n), "n_dup_lines": duplicate_lines(texts), "n_repeat_words": sums(row, repeated_windows(row, code), n)}

    starts, lengths, flat = _word_tokens(vocabulary).look_up(words.dictionary)
    tokens = flat[gather(starts[code], lengths[code])]
    of = np.repeat(row, lengths[code])
    n_tokens = sums(of, None, n)
    fallback = sums(of, (tokens >= BYTE_IDS[0]) & (tokens <= BYTE_IDS[1]), n)
    keys, times = np.unique((of << 20) | tokens, return_counts=True)
    at_least = np.maximum(n_tokens, 1)
    share = times / at_least[keys >> 20]
    out["chars_per_token"] = out["word_chars"] / at_least
    out["byte_share"] = fallback / at_least
    out["token_entropy"] = np.bincount(keys >> 20, weights=-share * np.log2(share), minlength=n).astype(np.float64)
    out["n_tokens"] = n_tokens
    return out


def main_script(texts: pa.Array) -> list[str]:
    """The script of most letters, if it has at least half of them; else other. Ties go to the first in order."""
    count = lambda keep: pc.utf8_length(pc.replace_substring_regex(texts, keep, "")).to_numpy(zero_copy_only=False)
    letters = count(r"\PL+")
    each = np.stack([count(f"[^{c}]+") for c in LETTERS.values()])
    names, best = np.array(list(LETTERS)), each.argmax(axis=0)
    return np.where((2 * each.max(axis=0) >= letters) & (letters > 0), names[best], "other").tolist()


def fit_bands(docs: DataFrame, good: Column, errors: float = 6.0, deviations: float = 4.0, high: float = 8.0, byte: float = 0.02, **options) -> dict[str, tuple[float, ...]]:
    """Bands by language from documents known to be good, as those in BANDS were made: the median of characters per token, `errors` standard errors below it, and the line of the entropy share over the logarithm of the tokens, `deviations` deviations below it. One aggregation over all of them; a row a language reaches the driver."""
    lang = F.col(options.get("lang_col", "lang"))
    rows = quality(docs.filter(good & lang.isNotNull()), script_bands=SCRIPT_BANDS, **options).filter("not base_failed")
    tokens = F.log(F.greatest(F.col("word_chars") / F.col("chars_per_token"), F.lit(2.0)))
    rows = rows.select("lang", F.sqrt("n_words").alias("root"), "chars_per_token", tokens.alias("x"), (F.col("token_entropy") * math.log(2) / tokens).alias("y"))
    usual = rows.groupBy("lang").agg(F.percentile("chars_per_token", 0.5).alias("usual"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("start"))
    off = rows.join(F.broadcast(usual), "lang").groupBy("lang", "usual", "slope", "start").agg(F.sqrt(F.avg(F.pow((F.col("chars_per_token") - F.col("usual")) * F.col("root"), 2))).alias("width"), F.sqrt(F.avg(F.pow(F.col("y") - F.col("start") - F.col("slope") * F.col("x"), 2))).alias("spread"))
    return {r["lang"]: (r["usual"], errors * r["width"], high, byte, r["start"] - deviations * r["spread"], -r["slope"]) for r in off.collect() if r["slope"] is not None}


def verdicts(texts: pa.Array, langs: list[str | None], bands: dict, script_bands: dict, vocabulary: str, min_words: int, max_repeat_percent: int) -> dict:
    """Counts, measures, band, base_failed and kept of each text."""
    m = measure(texts, vocabulary)
    m["base_failed"] = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"])
    names = langs if all(x in bands for x in langs) else [x if x in bands else s for x, s in zip(langs, main_script(texts), strict=True)]
    usual, width, high, byte, entropy, fall = np.array([bands.get(x) or script_bands[x] for x in names]).reshape(-1, 6).T
    top = np.log2(np.maximum(m["n_tokens"], 2))
    low = usual - width / np.sqrt(np.maximum(m["n_words"], 1))
    least = entropy - fall * np.log(np.maximum(m["n_tokens"], 2))
    good = (m["chars_per_token"] >= low) & (m["chars_per_token"] <= high) & (m["byte_share"] <= byte) & (m["token_entropy"] >= least * top)
    return m | {"kept": ~m["base_failed"] & good, "band": names}


def quality(docs: DataFrame, bands: dict = BANDS, script_bands: dict = SCRIPT_BANDS, vocabulary: str | None = None, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row a document: doc_id, lang, the counts, base_failed, kept, the measures and the band used."""
    vocabulary = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    lang = F.col(lang_col) if lang_col else F.lit(None)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), lang.cast("string").alias("_lang"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}, lang string", *[f"{c} long" for c in COUNTS], "base_failed boolean, kept boolean, band string", *[f"{c} double" for c in MEASURES]])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            v = verdicts(texts_of(batch, "_text"), batch.column("_lang").to_pylist(), bands, script_bands, vocabulary, min_words, max_repeat_percent)
            names = [*COUNTS, "base_failed", "kept", "band", *MEASURES]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_lang"), *[pa.array(v[c]) for c in names]], names=["doc_id", "lang", *names])
        _word_tokens(vocabulary).forget()

    return in_arrow(rows, judge, schema)


def kept_documents(docs: DataFrame, bands: dict = BANDS, script_bands: dict = SCRIPT_BANDS, vocabulary: str | None = None, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that the rules keep; columns as in docs."""
    vocabulary = vocabulary or public_tokenizers.path("piece_bpe_32k.model")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            v = verdicts(texts_of(batch, text_col), batch.column(lang_col).to_pylist(), bands, script_bands, vocabulary, min_words, max_repeat_percent)
            yield batch.filter(pa.array(v["kept"]))
        _word_tokens(vocabulary).forget()

    return in_arrow(docs, keep, docs.schema)
