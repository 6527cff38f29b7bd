"""Language of a text by compression: the language whose sample dictionary makes it smallest.

``fit`` takes, for each language, ``sample_docs`` labelled documents (those with the smallest hash of their id) and from each
an excerpt of ``excerpt_chars`` characters at a hashed place; their letters, lower-cased, end to end, are a zstandard raw-content
dictionary. So a fit holds at most ``languages * sample_docs * excerpt_chars`` characters, whatever the corpus: this bound is a
parameter of the fit, and ``max_languages`` is checked.

``classify`` reads whole texts: the letters of a text are cut into blocks, every block is compressed once with every dictionary,
and the sizes are summed, so a long text costs its length and no more memory. The language with the fewest bytes wins, the
smaller name in a tie. ``score`` is a logistic of the lead over the second, in bytes. A text is rejected if it has no letters
(``und``) or if its lead is below ``min_lead`` bytes or ``min_margin`` of the second size.

Nulls and empty texts are ``und``, score 0, rejected. Output columns that clash with an input column replace it.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.llm.common import freed

UNKNOWN = "und"
SAMPLE_DOCS, EXCERPT_CHARS, MAX_LANGUAGES = 400, 400, 500
BLOCK_CHARS = 1500
LEVEL = 6
MIN_LEAD, MIN_MARGIN = 2, 0.01
NOT_LETTERS = re.compile(r"[\W\d_]+")
OUTPUT = (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("margin", T.DoubleType()), ("rejected", T.BooleanType()))


def letters(text: str | None) -> str:
    """The lower-cased letters of a text, with one space for anything else between them."""
    return NOT_LETTERS.sub(" ", (text or "").lower()).strip()


def fit(
    labelled: DataFrame, *, id_column: str = "doc_id", column: str = "text", label: str = "lang",
    sample_docs: int = SAMPLE_DOCS, excerpt_chars: int = EXCERPT_CHARS, max_languages: int = MAX_LANGUAGES,
) -> dict[str, bytes]:
    """Dictionary per language. The sample is chosen on ids and labels alone; only the chosen documents' texts are read."""
    known = labelled.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(label).count().limit(max_languages + 1).collect()}
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    names = sorted(counts)
    chance = F.xxhash64(F.col(id_column).cast("string"), F.lit("sample"))
    # Hashes below this hold about four times the wanted rows of a language, so few rows meet to be ranked.
    bounds = {n: int(-2**63 + 2**64 * (4 * sample_docs / k)) if k > 4 * sample_docs else 2**63 - 1 for n, k in counts.items()}
    shares = F.create_map(*(x for n in names for x in (F.lit(n), F.lit(bounds[n]).cast("long")))) if names else None
    ranked = known.select(F.col(id_column).alias("_id"), F.col(label).alias("_lang"), chance.alias("_h"))
    ranked = ranked.where(F.col("_h") <= shares[F.col("_lang")]) if names else ranked
    chosen = ranked.withColumn("_n", F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_id"))).where(F.col("_n") <= sample_docs)
    # At most languages * sample_docs ids: the bound above.
    wanted = F.broadcast(chosen.select("_id", "_lang", "_h"))
    room = F.greatest(F.lit(1), F.length(column) - excerpt_chars + 1)
    excerpt = F.col(column).substr((F.pmod(F.col("_h"), room) + 1).cast("int"), F.lit(excerpt_chars))
    rows = known.join(wanted, (F.col(id_column) == F.col("_id")) & (F.col(label) == F.col("_lang"))).select("_lang", "_h", excerpt.alias("t")).limit(2 * sample_docs * max_languages)
    parts: dict[str, list] = {name: [] for name in names}
    for row in rows.collect():
        parts[row["_lang"]].append((row["_h"], letters(row["t"])))
    return {name: " ".join(t for _, t in sorted(found) if t).encode() for name, found in sorted(parts.items())}


class Compressors:
    """One compressor per language, its dictionary prepared once."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(n for n, d in dictionaries.items() if d)
        self.tools = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        blocks = [text[i:i + BLOCK_CHARS].encode() for i in range(0, len(text), BLOCK_CHARS)]
        return [sum(len(tool.compress(block)) for block in blocks) for tool in self.tools]

    def judge(self, text: str | None, min_lead: int, min_margin: float) -> tuple[str, float, float, bool]:
        text = letters(text)
        if not text or not self.names:
            return UNKNOWN, 0.0, 0.0, True
        ranked = sorted(zip(self.sizes(text), self.names))
        if len(ranked) == 1:
            return ranked[0][1], 1.0, 1.0, False
        lead = ranked[1][0] - ranked[0][0]
        margin = lead / ranked[1][0]
        return ranked[0][1], 1 / (1 + math.exp(-min(50.0, lead / 2))), margin, lead < min_lead or margin < min_margin


def classify(docs: DataFrame, dictionaries: dict[str, bytes], *, column: str = "text", min_lead: int = MIN_LEAD, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The documents with ``lang_pred``, ``score``, ``margin`` and ``rejected``."""
    names = [n for n in docs.columns if n not in dict(OUTPUT)]
    docs = docs.select(*names)
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def judge(batches):
        tools = Compressors(held.value)
        for batch in batches:
            found = [tools.judge(t.as_py(), min_lead, min_margin) for t in batch.column(column)]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], names=[*names, *dict(OUTPUT)])

    return docs.mapInArrow(freed(judge), T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in OUTPUT)]))


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """True in the fold that is never learned from; a null id is learned from by nobody."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(folds)) == fold, F.lit(True))
