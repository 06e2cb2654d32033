"""Language identification by cross-parsing entropy.

Learning: per language a bounded sample of labelled text is collected; its
bytes are the model. Predicting: every Python worker builds one suffix
automaton per language from its sample, once. The bytes of a text are then
parsed greedily: a phrase is the longest match that starts where the last one
ended and occurs anywhere in the sample of the language (a byte that the sample
lacks is a phrase of its own). The parse starts anew every ``WINDOW`` bytes, so
that the windows of many texts are parsed in step. A phrase costs a pointer of log2(sample length)
bits, so samples of unlike length compare; the language with the fewest bits
wins, ties go to the smaller name. ``score`` is the share of the winner among
the probabilities 2^-bits of all languages.

Letters are lower-cased; each run of other characters counts as one space.
The whole text is parsed, in UTF-8, so any script has an alphabet of at most
256. A step per byte and language is all the work there is: n bytes in L
languages cost n x L table lookups.

The sample is the bound of the model (driver, closure and each worker):
``SAMPLE_BYTES`` per language and ``TOTAL_BYTES`` in all, of at most
``MAX_LANGUAGES`` languages (those with most rows). Rows are picked by a hash
of id and text, about ``SAMPLE_ROWS`` a language; pieces of ``PIECE_BYTES`` of
the picked texts, from anywhere in them, are kept by their hash.

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is every row where nothing was learned; null ids are not held out
and never learned from; repeated texts count once in the sample; equal texts
get equal results; an empty table gives an empty result; of extra columns the
caller's are kept by ``predict``, those with a result's name are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import pieces, read_table, ship_package, stored

HELD_OUT = 2
UNDETERMINED = "und"
SAMPLE_BYTES = 1 << 14
TOTAL_BYTES = 1 << 19
MAX_LANGUAGES = 256
SAMPLE_ROWS = 1000
PIECE_BYTES = 256
#: Bytes that stand between pieces; no normalised text holds it.
GAP = b"\n"
#: After a window; no UTF-8 text holds it.
END = 0xFF
WINDOW = 512
#: Bytes of text that are parsed in step.
LOT_BYTES = 1 << 20

_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str | None) -> bytes:
    """Lower-case letters, other runs as one space, in UTF-8; empty without a letter."""
    return _OTHER.sub(" ", (text or "").lower()).strip().encode("utf-8", "replace")


class Automaton:
    """The minimal automaton of all substrings of ``data``, as one table.

    ``column`` maps each byte to a column (bytes that the data lacks share one,
    ``END`` has its own). A state is the offset of its row, the start state is 0.
    ``table[state + column]`` is four times the next state plus the phrases that
    end there: where no substring goes on, the match ends and the byte begins the
    next one, or is a phrase of its own."""

    def __init__(self, data: bytes):
        step: list[dict] = [{}]
        link, length, last = [-1], [0], 0
        for b in data:
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and b not in step[p]:
                step[p][b] = new
                p = link[p]
            if p >= 0:
                q = step[p][b]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(step)
                    step.append(dict(step[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and step[p].get(b) == q:
                        step[p][b] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        known = sorted(set(data))
        width = len(known) + 2
        self.column = np.zeros(256, np.int32)
        self.column[known] = np.arange(1, width - 1)
        self.column[END] = width - 1
        first = np.zeros(width, np.int64)  # a match that begins with the byte
        for b, to in step[0].items():
            first[self.column[b]] = to * width
        lone = (first == 0).astype(np.int64)
        lone[-1] = 0
        table = np.tile(first * 4 + lone + 1, (len(step), 1))
        table[0] -= 1  # no match to end at the start
        for i, out in enumerate(step):
            for b, to in out.items():
                table[i, self.column[b]] = to * width * 4
        self.table = table.ravel().astype(np.int32)

    def phrases(self, windows: np.ndarray) -> np.ndarray:
        """Phrases of each column of ``windows``, all parsed in step."""
        state = np.zeros(windows.shape[1], np.int32)
        n = np.zeros(windows.shape[1], np.int64)
        for row in self.column[windows]:
            found = self.table.take(state + row)
            n += found & 3
            state = found >> 2
        return n


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all texts as columns of bytes that end with ``END``, and
    the number of the text of each."""
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), -(-sizes // WINDOW))
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)[owner]
    starts = ends - sizes[owner] + (np.arange(len(owner)) - np.searchsorted(owner, owner)) * WINDOW
    at = starts + np.arange(WINDOW + 1)[:, None]
    inside = (at < ends) & (at < starts + WINDOW)
    return np.where(inside, data.take(np.minimum(at, max(len(data) - 1, 0))), END).astype(np.uint8), owner


_BUILT: dict[str, list] = {}


class Model:
    """Samples by language, in the order of names."""

    def __init__(self, samples: dict[str, bytes]):
        self.samples = dict(sorted(samples.items()))
        self.key = hashlib.sha256(repr(self.samples).encode()).hexdigest()

    def parsers(self) -> list[tuple[str, Automaton, float]]:
        """(language, automaton, bits a phrase), built once per process."""
        if self.key not in _BUILT:
            _BUILT.clear()
            _BUILT[self.key] = [(lang, Automaton(s), math.log2(len(s) + 2)) for lang, s in self.samples.items()]
        return _BUILT[self.key]

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text (row) in each language (column)."""
        parsers = self.parsers()
        total = np.zeros((len(texts), len(parsers)))
        lot, size = [], 0
        for i, t in enumerate(texts):
            for at in range(0, len(t), LOT_BYTES):  # a very long text is parsed in several lots
                lot.append((i, t[at:at + LOT_BYTES]))
                size += len(lot[-1][1]) + WINDOW
                if size >= LOT_BYTES:
                    self._add(total, lot, parsers)
                    lot, size = [], 0
        if lot:
            self._add(total, lot, parsers)
        return total

    def _add(self, total: np.ndarray, lot: list[tuple[int, bytes]], parsers) -> None:
        windows, owner = windows_of([t for _, t in lot])
        text = np.array([i for i, _ in lot])[owner]
        for j, (_, found, cost) in enumerate(parsers):
            np.add.at(total[:, j], text, found.phrases(windows) * cost)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        data = [normalised(t) for t in texts]
        if not self.samples:
            return [UNDETERMINED] * len(data), [0.0] * len(data)
        bits, names = self.bits(data), list(self.samples)
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
        return ([names[k] if d else UNDETERMINED for k, d in zip(best.tolist(), data)],
                [v if d else 0.0 for v, d in zip(share.tolist(), data)])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES, total_bytes: int = TOTAL_BYTES,
        max_languages: int = MAX_LANGUAGES, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows of (doc_id, text, lang) that are not held out."""
    ship_package(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    langs = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
                   .orderBy(F.desc("n_rows"), "lang").limit(max_languages), "languages")
    n = langs.count()
    if not n:
        return Model({})
    most = max(1, min(sample_bytes, total_bytes // n) // PIECE_BYTES)
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * sample_rows / F.col("n_rows")
    picked = (rows.where("text is not null").select("doc_id", "text", "lang").join(F.broadcast(langs), "lang")
              .where(share).select("lang", "text").distinct())

    def cut(batches):
        least: dict[str, dict[bytes, bytes]] = {}
        for b in pieces(batches, "text"):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data, kept = normalised(text), least.setdefault(lang, {})
                for at in range(0, len(data), PIECE_BYTES):
                    piece = data[at:at + PIECE_BYTES]
                    kept[hashlib.blake2b(piece, digest_size=8).digest()] = piece
                if len(kept) > 4 * most:
                    least[lang] = {h: kept[h] for h in sorted(kept)[:most]}
        flat = [(lang, h, kept[h]) for lang, kept in least.items() for h in sorted(kept)[:most]]
        for at in range(0, len(flat), 1024):
            part = flat[at:at + 1024]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.string()),
                                              *(pa.array([r[i] for r in part], pa.binary()) for i in (1, 2))],
                                             ["lang", "h", "piece"])

    found = picked.mapInArrow(cut, "lang string, h binary, piece binary").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    samples: dict[str, list[bytes]] = {}
    for r in found.withColumn("place", place).where(F.col("place") <= most).orderBy("lang", "place").collect():
        samples.setdefault(r["lang"], []).append(bytes(r["piece"]))
    return Model({lang: GAP.join(parts) for lang, parts in samples.items()})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced)."""
    ship_package(docs.sparkSession)
    src = docs.drop(*(c for c in docs.columns if c.lower() in ("lang_pred", "score")))
    schema = StructType([*src.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    at = src.columns.index("text")

    def run(batches):
        for b in pieces(batches, "text"):
            lang, score = model.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [f.name for f in schema.fields])

    return src.mapInArrow(run, schema)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
