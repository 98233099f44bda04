"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is the number of n-grams of one to three letters that occur in
both, divided by the geometric mean of the numbers that occur in each. Landmark texts
span a Nyström approximation of it, in which one ridge regression per language separates
it from the rest. As the kernel is linear in the presence vectors, landmarks and
regression fold into one matrix, and a batch of texts is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.llm.memory import give_back

UNDETERMINED = "und"
GAP = 1  # code of runs of anything but letters; a letter's code is its code point
CODE_BITS = 21
MAX_N = 3  # so many codes fill an int64
#: Bounds of the labelled sample: texts of a language, languages, characters of a text.
TEXTS_PER_LANGUAGE = 600
LANGUAGES = 256
SAMPLE_CHARS = 20_000
LANDMARKS_PER_LANGUAGE = 64
RIDGE = 1e-3
#: A text is foreign when the share of its n-grams that the landmarks know is less than this
#: part of a low quantile of that share among the labelled texts.
KNOWN_PART, KNOWN_QUANTILE = 0.6, 0.01
#: Texts scored together, and characters of a text looked at together.
ROWS = 256
CHARS = 1_000_000


@dataclass
class Model:
    """What a fit learns; without any labelled text there are no languages."""

    languages: list[str] = field(default_factory=list)
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    least_known: float = 0.0  # share of known n-grams below which a text is foreign


class Presence:
    """Texts to the codes of the n-grams that occur in them.

    Every letter of any script has its own code, unless ``alphabet`` names the only ones
    that count as letters. Codes are at least 1, so n-grams of different lengths differ.
    """

    def __init__(self, alphabet: str | None = None):
        points = np.arange(0x110000)
        letters = np.fromiter((chr(i).isalpha() for i in points), bool, 0x110000) if alphabet is None else np.isin(points, [ord(c) for c in alphabet])
        self.code = np.where(letters, points, GAP)

    def codes(self, text: str) -> Iterator[np.ndarray]:
        """Letter codes of the whole text, runs of gaps as one, in overlapping chunks."""
        text, code = f" {text} ", np.zeros(0, np.int64)
        for at in range(0, len(text), CHARS):
            more = self.code[np.frombuffer(text[at : at + CHARS].lower().encode("utf-32-le", "replace"), "<u4")]
            code = np.concatenate((code[len(code) - MAX_N + 1 :] if len(code) >= MAX_N else code, more))
            code = code[np.concatenate(([True], (code[1:] != GAP) | (code[:-1] != GAP)))]
            yield code

    @staticmethod
    def grams(code: np.ndarray) -> list[np.ndarray]:
        found, current = [code], code
        for n in range(1, MAX_N):
            current = (current[:-1] << CODE_BITS) | code[n:]
            found.append(current)
        return found


def held_out(id: Column, folds: int = 5) -> Column:
    """Documents that a fit must not see: crc32 of the id as text is divisible by ``folds``."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def training_sample(docs: DataFrame, id: str, text: str, lang: str, texts: int, languages: int, chars: int, seed: int) -> list:
    """At most ``languages * texts`` rows of at most ``chars`` characters, chosen by hash.

    Rows that agree in id, language and text hash count once. A longer text gives a
    stretch that starts at a place the hash chooses.
    """
    hashed = F.xxhash64(F.col(text))
    order = F.xxhash64(F.lit(seed), F.col(id), hashed)  # of the row: an id with many texts neither fills nor empties the sample
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id).isNotNull() & ~held_out(F.col(id)))
    common = usable.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "lang").limit(languages)
    keys = usable.select(F.col(id).alias("id"), F.col(lang).alias("lang"), order.alias("rank"), hashed.alias("hash"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "id", "hash"))
    near = F.pmod("rank", F.lit(1 << 32)) * F.col("count") <= F.lit(float(1 << 32)) * (4 * texts)  # about four times too many are ranked
    ranked = keys.join(F.broadcast(common), "lang").where(near).distinct()
    chosen = ranked.withColumn("n", first).where(F.col("n") <= texts).select("id", "lang", "hash")
    room = F.greatest(F.length(F.col(text)) - chars, F.lit(0)) + 1
    start = (F.pmod(order, room) + 1).cast("int")
    rows = usable.select(F.col(id).alias("id"), F.col(lang).alias("lang"), hashed.alias("hash"), F.substr(F.col(text), start, F.lit(chars)).alias("text"), order.alias("rank"))
    found = rows.join(F.broadcast(chosen), ["id", "lang", "hash"])
    return found.groupBy("id", "lang", "hash", "rank").agg(F.min("text").alias("text")).collect()


def fit_sample(rows: list[tuple[str, str]], landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """Model of ``(lang, text)`` rows, in a fixed order; the first of a language are landmarks."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model()
    presence = Presence()
    found = [np.unique(np.concatenate([g for code in presence.codes(text) for g in presence.grams(code)])) for _, text in rows]
    chosen = [i for lang in languages for i in [j for j, r in enumerate(rows) if r[0] == lang][:landmarks]]
    grams = np.unique(np.concatenate([found[i] for i in chosen]))
    vectors = np.zeros((len(rows), len(grams)), np.float32)
    for i, have in enumerate(found):
        vectors[i, np.searchsorted(grams, np.intersect1d(have, grams, assume_unique=True))] = 1
    known = vectors.sum(1) / np.maximum([len(have) for have in found], 1)
    unseen = np.delete(known, chosen) if len(chosen) < len(rows) else known  # landmarks know all of their own
    least_known = KNOWN_PART * float(np.quantile(unseen, KNOWN_QUANTILE))
    vectors /= np.sqrt(np.maximum(vectors.sum(1, keepdims=True), 1))
    marks = vectors[chosen]
    values, basis = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values[-1]
    root = basis[:, keep] / np.sqrt(values[keep])  # Nyström features are kernel rows times this
    features = (vectors @ marks.T) @ root
    sides = np.where(np.array([r[0] for r in rows])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    share = np.array([[1 / max((sides[:, k] == s).sum(), 1) for s in sides[:, k]] for k in range(len(languages))])
    columns = []
    for k in range(len(languages)):  # both sides of a regression weigh the same
        weighted = features * share[k][:, None]
        columns.append(np.linalg.solve(weighted.T @ features + ridge * np.eye(features.shape[1]), weighted.T @ sides[:, k]))
    return Model(languages, grams, (marks.T @ (root @ np.stack(columns, 1))).astype(np.float32), least_known)


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 0, texts: int = TEXTS_PER_LANGUAGE, languages: int = LANGUAGES, chars: int = SAMPLE_CHARS, **options) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    rows = training_sample(docs, id, text, lang, texts, languages, chars, seed)
    ordered = sorted(rows, key=lambda r: (r["rank"], r["id"], r["lang"], r["text"]))
    return fit_sample([(r["lang"], r["text"]) for r in ordered], **options)


_SCORERS: dict[int, tuple] = {}


def score_texts(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text, from its whole length."""
    return [found[:2] for found in scored(model, texts)]


def scored(model: Model, texts: list[str | None]) -> list[tuple[str, float, float]]:
    """Language, score and share of the known n-grams of each text, from its whole length.

    Of a text beyond ``CHARS`` characters each stretch counts its own distinct n-grams.
    """
    if id(model) not in _SCORERS:
        _SCORERS[id(model)] = (model, Presence())
    _, presence = _SCORERS[id(model)]
    vectors, lettered = np.zeros((len(texts), len(model.grams)), np.float32), np.zeros(len(texts), bool)
    known, total = np.zeros(len(texts)), np.zeros(len(texts))
    for i, text in enumerate(texts):
        for code in presence.codes(text or ""):
            lettered[i] |= bool((code != GAP).any())
            if len(model.grams):
                for grams in map(np.unique, presence.grams(code)):
                    at = np.minimum(np.searchsorted(model.grams, grams), len(model.grams) - 1)
                    at = at[model.grams[at] == grams]
                    vectors[i, at] = 1
                    known[i] += len(at)
                    total[i] += len(grams)
    if not model.languages:
        return [(UNDETERMINED, 0.0, 0.0)] * len(texts)
    values = (vectors @ model.weights) / np.sqrt(np.maximum(vectors.sum(1, keepdims=True), 1))
    best = values.argmax(1)
    sure = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1)
    share = known / np.maximum(total, 1)
    return [(model.languages[b], float(s), float(k)) if ok else (UNDETERMINED, 0.0, 0.0) for b, s, k, ok in zip(best, sure, share, lettered)]


def predict(docs: DataFrame, model: Model, text: str = "text", shares: bool = False) -> DataFrame:
    """``row, lang_pred, score`` where ``row`` holds all columns of ``docs``.

    With ``shares`` also ``known``, the share of the text's distinct n-grams that occur in
    a landmark. A text with less than ``model.least_known`` is in none of the languages,
    whichever of them comes nearest.

    Null texts, texts without a letter, and all texts under a model without languages are
    ``und`` with score 0. The score is 1 where a regression is sure and 0.5 where it is
    undecided. Repeated rows are all scored; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,known:double>")
    def score(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        learned = shared.value
        for texts in arrays:
            found = [f for at in range(0, len(texts), ROWS) for f in scored(learned, texts.slice(at, ROWS).to_pylist())]
            types = (pa.string(), pa.float64(), pa.float64())
            yield pa.StructArray.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], ["lang_pred", "score", "known"])
        texts = found = None
        give_back()

    # only the text goes to Python, and the other columns wait for the result
    found = docs.select(F.struct("*").alias("row"), score(F.col(text)).alias("found"))
    return found.select("row", "found.lang_pred", "found.score", *(["found.known"] if shares else []))
