"""Language identification by compression.

One raw-content zstandard dictionary per language is cut from a bounded
sample of labelled documents.  A text is compressed with each dictionary;
the language whose dictionary explains it in the fewest bytes wins.  Texts
are compressed in pieces of at most ``PIECE`` bytes: whole, a text teaches
the compressor its own language, and the gap between dictionaries shrinks
with its length.  The gap is the bytes saved against the runner-up, less
those that other dictionaries save on single pieces, as a share of the
runner-up; it is 0 if other dictionaries win more than ``MAX_OTHER`` of the
pieces by more than ``min_margin``.  A text is rejected unless its gap
passes ``min_margin``: texts in a language that was not learnt, mixed texts
and near-ties do not.  ``margin`` is what the gap has beyond
``min_margin``, 0 if nothing.

Defined cases: a null text or one without a letter is ``und`` with score 0
and rejected; no labelled rows at all make every text ``und``; equal sizes
go to the language that is first by code point (margin 0, rejected);
repeated rows are answered alike; rows with a null id are classified, and
take part in fitting like any other id.
"""

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoria.llm.common import ALNUM, col

__all__ = ["fit", "identify", "SAMPLE_DOCS", "SAMPLE_CHARS", "MIN_MARGIN"]

#: Bounds of the fitting sample: documents per language, characters of each.
SAMPLE_DOCS = 512
SAMPLE_CHARS = 3000
#: A text is rejected unless its gap is more than this share of the second best size.
MIN_MARGIN = 0.08
#: Bytes of letters that are compressed at once.
PIECE = 250
#: Share of the pieces that may clearly be in other languages.
MAX_OTHER = 0.25
LEVEL = 5
#: Lower-cased letters of a UTF-8 text; digits, marks and layout become one space.
LETTERS = bytes(0x20 if 0x30 <= b <= 0x39 else b for b in ALNUM)


def fit(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """A dictionary per language from the rows where ``train`` holds.

    The sample is drawn by the hash of the id: ``sample_docs`` documents of
    each language, ``sample_chars`` characters of each, so it does not depend
    on row order; the driver receives at most languages x ``sample_docs`` x
    ``sample_chars`` characters.  The languages are taken to be few (one row
    each is broadcast).
    """
    rows = docs.where(train & col(lang_col).isNotNull() & col(text_col).isNotNull()).select(
        col(lang_col).cast("string").alias("lang"), F.xxhash64(col(id_col)).alias("h"), col(text_col).alias("text"))
    # thin out by hash first: some four times the sample of a language is left, whatever its size, so no
    # task ranks a whole language (ids only: the texts are not read here)
    n = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    thin = rows.select("lang", "h").join(F.broadcast(n), "lang").where(
        F.pmod("h", F.lit(1 << 31)) < F.least(F.lit(1.0), 4.0 * sample_docs / F.col("n")) * (1 << 31))
    order = Window.partitionBy("lang").orderBy("h")
    picks = thin.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs)
    picks = picks.select("lang", "h").distinct()
    got = rows.join(F.broadcast(picks), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(
        F.min(F.substring("text", 1, sample_chars)).alias("text"))
    parts: dict[str, list[bytes]] = {}
    for r in sorted(got.collect(), key=lambda r: (r["lang"], r["h"])):
        parts.setdefault(r["lang"], []).append(_letters(r["text"]))
    return {k: b" ".join(v) for k, v in sorted(parts.items())}


def identify(text: Column, model: dict[str, bytes], *, min_margin: float = MIN_MARGIN, level: int = LEVEL) -> Column:
    """struct(lang string, score double, margin double, rejected boolean) of a text column."""
    schema = "lang string, score double, margin double, rejected boolean"

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs = list(model)
        makers = []
        for lang in langs:
            d = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            makers.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False))
        for texts in batches:
            out = [_best(t, langs, makers, min_margin) for t in texts]
            yield pd.DataFrame(out, columns=["lang", "score", "margin", "rejected"])

    return F.pandas_udf(run, schema)(text)


def _letters(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(LETTERS).split())


def _pieces(data: bytes) -> list[bytes]:
    """Pieces of nearly equal length, at most ``PIECE`` bytes each."""
    step = -(-len(data) // max(1, -(-len(data) // PIECE)))
    return [data[i:i + step] for i in range(0, len(data), step)] or [data]


def _best(text, langs, makers, min_margin):
    if text is None or not langs or not any(map(str.isalpha, text)):
        return "und", 0.0, 0.0, True
    pieces = _pieces(_letters(text))
    by_piece = [[len(m.compress(x)) for x in pieces] for m in makers]
    sizes = list(map(sum, by_piece))
    best = min(range(len(sizes)), key=sizes.__getitem__)
    if len(sizes) == 1:
        return langs[best], 1.0, 1.0, False
    second = min(s for i, s in enumerate(sizes) if i != best)
    least = list(map(min, zip(*by_piece)))
    gap = max(0.0, (second - 2 * sizes[best] + sum(least)) / second)
    if sum(x < (1 - min_margin) * own for x, own in zip(least, by_piece[best])) > MAX_OTHER * len(pieces):
        gap = 0.0
    margin = max(0.0, gap - min_margin)
    # the score saturates: a tenth fewer bytes is as sure as it gets here
    return langs[best], min(1.0, gap / 0.1), margin, margin <= 0
