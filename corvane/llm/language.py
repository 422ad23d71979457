"""Language identification in two steps: the family first, then the languages within it.

Texts are lower-cased and described by hashed byte n-grams of lengths 1 to 3, anything but
letters counting as a space. A linear support vector machine per family picks the family;
within it one machine for each pair of languages votes, so closely related languages are
told apart by what differs between just these. The machines are fitted on a bounded sample
of each language's texts (``TRAIN_PER_LANG``, chosen by a hash of the id); prediction is one
pass over all whole texts without a shuffle.

Nulls and edge cases: a null text or one without a letter is ``und`` with score 0. Rows with a
null language or id are not learned from. Repeated rows are predicted each for itself. With no
language learned every text is ``und``. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import texts

BUCKETS = 1 << 12
TRAIN_PER_LANG = 800
ROUNDS = 150
RATE = 0.3
MARGIN_DECAY = 1e-5
UNKNOWN = "und"

# Families of language codes. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz",
    "indic": "hi ur bn mr ne pa gu",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

LETTER = regex.compile(r"\p{L}")
# Bytes of n-grams: ASCII letters and all parts of other characters; the rest is a space.
_SHOWN = np.where(texts.ALNUM & ~((np.arange(256) >= 0x30) & (np.arange(256) <= 0x39)), np.arange(256), 0x20).astype(np.uint32)


@dataclass
class Machine:
    """One linear machine: positive for ``yes``, negative for ``no``."""

    yes: str
    no: str
    weights: np.ndarray
    bias: float

    def margins(self, features: np.ndarray) -> np.ndarray:
        return np.einsum("nd,d->n", features, self.weights) + self.bias


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    families: list[Machine] = field(default_factory=list)
    pairs: list[Machine] = field(default_factory=list)

    def predict(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language of each row, and how sure it is between 0 and 1."""
        n = len(features)
        names = sorted({FAMILY_OF.get(x, x) for x in self.langs})
        members = {f: [x for x in self.langs if FAMILY_OF.get(x, x) == f] for f in names}
        margins = {m.yes: m.margins(features) for m in self.families}
        by_family = np.stack([margins.get(f, np.zeros(n)) for f in names])
        picked = by_family.argmax(axis=0)
        sure = _logistic(2 * by_family.max(axis=0)) if len(names) > 1 else np.ones(n)
        lang, score = np.empty(n, object), np.zeros(n)
        for i, family in enumerate(names):
            rows = np.flatnonzero(picked == i)
            langs = members[family]
            votes, strength = np.zeros((len(langs), len(rows))), np.zeros((len(langs), len(rows)))
            for m in self.pairs:
                if m.yes in langs and m.no in langs:
                    p = _logistic(2 * m.margins(features[rows]))
                    for x, share in ((m.yes, p), (m.no, 1 - p)):
                        votes[langs.index(x)] += share > 0.5
                        strength[langs.index(x)] += share / (len(langs) - 1)
            best = (votes + 0.5 * strength).argmax(axis=0)
            lang[rows] = np.array(langs, object)[best]
            score[rows] = sure[rows] * (strength[best, np.arange(len(rows))] if len(langs) > 1 else 1)
        return lang, score


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _features(column: pa.Array) -> np.ndarray:
    """Square roots of n-gram counts, each row of length 1."""
    block = texts.text_block(pc.utf8_lower(pc.fill_null(column, "")))
    shown = _SHOWN[block.data]
    owner = np.repeat(np.arange(len(block)), np.diff(block.offsets)) * BUCKETS
    counts = np.zeros(len(block) * BUCKETS, np.int64)
    code = np.zeros(len(shown), np.uint32)
    for n in (1, 2, 3):
        code = code[: len(shown) - n + 1] * np.uint32(0x01000193) + shown[n - 1 :]
        if not len(code):
            break
        place = (code * np.uint32(0x9E3779B1)) >> np.uint32(20)
        inside = owner[: len(code)] == owner[n - 1 :]
        counts += np.bincount((owner[: len(code)] + place)[inside], minlength=len(counts))
    features = np.sqrt(counts.reshape(len(block), BUCKETS).astype(np.float32))
    return features / np.maximum(np.linalg.norm(features, axis=1, keepdims=True), 1e-9)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, _ in texts.blocks(batches, size=2 << 20):
        for begin in range(0, len(rows), 1000):
            yield rows.slice(begin, 1000)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _parts(batches):
        packed = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in _features(rows["text"]).astype(np.float16)]
        yield pa.RecordBatch.from_arrays([rows["lang"], pa.array(packed, pa.binary())], ["lang", "features"])


def _machine(yes: str, no: str, features: np.ndarray, wanted: np.ndarray) -> Machine:
    """Squared hinge loss, both sides weighing the same, by accelerated descent."""
    y = np.where(wanted, 1.0, -1.0)
    weight = np.where(wanted, 0.5 / max(1, wanted.sum()), 0.5 / max(1, (~wanted).sum()))
    w, b, before, b_before = np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS), 0.0
    for step in range(ROUNDS):
        pull = step / (step + 3)
        at, b_at = w + pull * (w - before), b + pull * (b - b_before)
        short = np.maximum(0, 1 - y * (np.einsum("nd,d->n", features, at) + b_at)) * y * weight
        before, b_before = w, b
        w = at * (1 - MARGIN_DECAY) + RATE * np.einsum("n,nd->d", short, features)
        b = b_at + RATE * short.sum()
    return Machine(yes, no, w.astype(np.float32), float(b))


def fit(documents: DataFrame, per_lang: int = TRAIN_PER_LANG) -> Model:
    """The model for ``documents (doc_id, text, lang)``, of which a sample by the id's hash is used."""
    rows = documents.where("lang is not null and doc_id is not null and text is not null").selectExpr(
        "doc_id", "cast(text as string) as text", "cast(lang as string) as lang"
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model()
    # Rounded up, so that a language of however many documents keeps a share.
    ranges = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, math.ceil(min(1.0, per_lang / n) * (1 << 40)))])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < ranges[F.col("lang")])
    sample = chosen.select("text", "lang").mapInArrow(_described, "lang string, features binary").collect()
    sample.sort(key=lambda r: (r.lang, r.features))
    features = np.stack([np.frombuffer(pa.decompress(r.features, 2 * BUCKETS, codec="zstd", asbytes=True), np.float16) for r in sample])
    features, lang = features.astype(np.float32), np.array([r.lang for r in sample], object)
    langs = sorted(set(lang))
    family = np.array([FAMILY_OF.get(x, x) for x in lang], object)
    names = sorted(set(family))
    model = Model(langs)
    if len(names) > 1:
        model.families = [_machine(f, "", features, family == f) for f in names]
    for f in names:
        for a, b in combinations([x for x in langs if FAMILY_OF.get(x, x) == f], 2):
            both = (lang == a) | (lang == b)
            model.pairs.append(_machine(a, b, features[both], lang[both] == a))
    return model


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row of ``documents (doc_id, text)``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # fixed size per pair of languages

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(batches):
            model = shared.value
            known = np.array([bool(model.langs and x.is_valid and LETTER.search(x.as_py())) for x in rows["text"]], bool)
            lang, score = np.full(len(rows), UNKNOWN, object), np.zeros(len(rows))
            if known.any():
                lang[known], score[known] = model.predict(_features(rows["text"].filter(pa.array(known))))
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(predicted, "doc_id bigint, lang_pred string, score double")
