"""Language ID by hierarchical discrimination with linear support vector machines.

A text's features are hashed byte 2-grams and 3-grams of its lower-cased form,
square roots of counts scaled to length 1.  One-versus-rest machines choose the
language family; within it, one-versus-one machines separate the languages by
votes, ties by summed margins.  Families come from a table of ISO 639-1 codes;
a label outside the table is a family of its own.

The machines are fitted on a bounded sample: ``SAMPLE`` documents in all, the
same share for every language, those with the smallest hash of id and text
(squared hinge loss, full-batch accelerated gradient steps).  Prediction reads every
text whole and sends one copy of the weights to each task.

Machines only tell learned languages apart, so a text in none of them still
gets one.  The ``fit``, given if asked for, judges that: the mean log
probability of the n-grams of the text's letters under each language's own,
smoothed, in spreads from the median of that language's sample.  A spread is
what chance gives a text of this length, no less than the sample shows between
its 10% quantile and its median (1.28 normal deviations), so single wrong
labels move nothing.  The best language's value counts.

Defined results: a null text or one without a letter is ``und`` with score and fit 0;
without any labelled document all are ``und``; of more than ``MOST_LABELS`` label values
the most frequent are learned (ties: in name order); input columns named like an output
are replaced by it; with one language every other
text gets it with score 1; null labels teach nothing; rows stay as they are,
repeated or not; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import giving_back, replacing, text_slices

SAMPLE = 2400  # documents the machines are fitted on, at most
MOST_LABELS = 100  # languages learned, at most: those with the most documents
DIM = 4096  # hashed features
UND = "und"

# Families of ISO 639-1 codes.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca co es fr gl it la oc pt ro rm sc",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt ti",
    "sinitic": "zh",
    "austronesian": "id jv mg mi ms su tl",
    "dravidian": "kn ml ta te",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower(), f"only {lang}")


def features(text: str) -> np.ndarray:
    """Hashed byte 2- and 3-gram features of a whole text, of length 1."""
    b = np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)
    counts = np.zeros(DIM)
    for start in range(0, len(b), 1 << 20):  # bounded temporaries for long texts
        c = b[start:start + (1 << 20) + 2].astype(np.uint32)
        last = start + (1 << 20) >= len(b)
        pairs = c[:-1] * np.uint32(256) + c[1:]
        if not last:
            pairs = pairs[:-1]
        triples = (c[:-2] * np.uint32(65536) + c[1:-1] * np.uint32(256) + c[2:]) | np.uint32(1 << 24)
        for g in (pairs, triples):
            counts += np.bincount((g * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM)
    x = np.sqrt(counts)
    return x / max(np.linalg.norm(x), 1e-12)


def letters(text: str) -> str:
    return " ".join(regex.findall(r"\p{L}+", text))


def grams(text: str) -> int:
    """How many n-grams ``features`` counts."""
    return 2 * len(f" {text.lower()} ".encode()) - 3


def fit_machine(x: np.ndarray, y: np.ndarray, strength: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights (last: bias) of a squared-hinge machine; y holds -1 and 1.

    Both sides weigh the same, however many rows they have."""
    kind = x.dtype  # one precision throughout: no hidden copies of x
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = v = np.zeros(x.shape[1] + 1)
    rate = 1.0 / (2 * 2.0 + strength)  # rows, with a 1 for the bias, have length sqrt(2)
    for i in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v[:-1].astype(kind) + v[-1]))
        pull = weight * y * slack
        step = v - rate * (strength * v - 2 * np.append(pull.astype(kind) @ x, pull.sum()))
        v = step + i / (i + 3) * (step - w)
        w = step
    return w


@dataclass(frozen=True)
class Model:
    """Machines as columns of ``weights`` (DIM + 1 rows), families first."""

    families: tuple  # names
    members: tuple  # languages of each family
    weights: np.ndarray
    logs: np.ndarray | None = None  # log probability of each feature, a column per language
    scale: np.ndarray | None = None  # its mean, variance, median n-grams; median and spread of the sample

    def fit(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The best language's fit per row of letter features of ``n`` n-grams."""
        if self.logs is None:
            return np.zeros(len(x))
        mean, var, usual, middle, spread = self.scale
        off = (np.square(x) @ self.logs - mean) / np.sqrt(var * (1 / n[:, None] + 1 / usual))
        return ((off - middle) / spread).max(axis=1)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        """(language, score) per row of features."""
        if not self.families:
            return [(UND, 0.0)] * len(x)
        margins = x @ self.weights[:-1] + self.weights[-1]
        surety = 1 / (1 + np.exp(-4 * np.clip(margins, -20, 20)))
        out, first = [], {}
        at = len(self.families) if len(self.families) > 1 else 0
        for f, langs in enumerate(self.members):
            first[f] = at
            at += len(langs) * (len(langs) - 1) // 2
        for row, sure in zip(margins, surety):
            f = int(np.argmax(row[:len(self.families)])) if len(self.families) > 1 else 0
            score = float(sure[f]) if len(self.families) > 1 else 1.0
            langs = self.members[f]
            votes, total, pair = [0] * len(langs), [0.0] * len(langs), first[f]
            for a, b in combinations(range(len(langs)), 2):
                m = float(row[pair])
                votes[a if m >= 0 else b] += 1
                total[a] += m
                total[b] -= m
                pair += 1
            best = max(range(len(langs)), key=lambda i: (votes[i], total[i], -i))
            pair = first[f]
            for a, b in combinations(range(len(langs)), 2):
                if best in (a, b):
                    p = float(sure[pair])
                    score = min(score, p if best == a else 1 - p)
                pair += 1
            out.append((langs[best], score))
        return out


def fit_model(x: np.ndarray, langs: list[str]) -> Model:
    by_family: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        by_family.setdefault(family_of(lang), []).append(lang)
    names = sorted(by_family)
    families = np.array([family_of(lang) for lang in langs])
    labels = np.array(langs)
    machines = []
    if len(names) > 1:
        machines += [fit_machine(x, np.where(families == f, 1.0, -1.0)) for f in names]
    for f in names:
        for a, b in combinations(by_family[f], 2):
            at = (labels == a) | (labels == b)
            machines.append(fit_machine(x[at], np.where(labels[at] == a, 1.0, -1.0)))
    weights = np.stack(machines, axis=1) if machines else np.zeros((DIM + 1, 1))
    return Model(tuple(names), tuple(tuple(by_family[f]) for f in names), weights)


def fit_scales(x: np.ndarray, n: np.ndarray, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``logs`` and ``scale`` of a model from letter features of ``n`` n-grams."""
    labels, logs, scale = np.array(langs), [], []
    for lang in sorted(set(langs)):
        at = labels == lang
        share, size = np.square(x[at], dtype=np.float64), n[at]
        seen = share.sum(axis=0) / len(share)
        p = (seen + 5e-5) / (seen + 5e-5).sum()
        log = np.log(p)
        mean, usual = p @ log, np.median(size)
        var = max(p @ (log - mean) ** 2, 1e-12)
        off = (share @ log - mean) / np.sqrt(var * (1 / size + 1 / usual))
        middle = np.median(off)
        logs.append(log)
        scale.append((mean, var, usual, middle, max(1.0, (middle - np.quantile(off, 0.1)) / 1.28)))
    return np.stack(logs, axis=1), np.array(scale).T


LETTER = r"\p{L}"


def packed(x: np.ndarray) -> bytes:
    """Features in single precision, compressed: most are zeros or few different values."""
    return zlib.compress(x.astype(np.float32).tobytes(), 1)


def unpacked(rows: list[bytes]) -> np.ndarray:
    out = np.empty((len(rows), DIM), np.float32)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(zlib.decompress(row), np.float32)
    return out


def _sampled(batches, fits: bool):
    for batch in batches:
        for part in text_slices(batch, "text"):
            texts = part.column("text").to_pylist()
            x = [packed(features(t)) for t in texts]
            out = {"lang": part.column("lang"), "x": pa.array(x, pa.binary())}
            if fits:
                texts = [letters(t) for t in texts]
                out["own"] = pa.array([packed(features(t)) for t in texts], pa.binary())
                out["n"] = pa.array([grams(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict(out)


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", fits: bool = False) -> Model:
    """Fit on at most ``sample`` of the documents with a text and a label;
    with ``fits`` the model also tells how well a text fits (``Model.fit``)."""
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()
                       & F.regexp_like(F.col(text_col), F.lit(LETTER)))
    keys = known.select(F.col(lang_col).alias("lang"), key.alias("key"))
    counts = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LABELS)
    counts = {r["lang"]: r["n"] for r in counts.collect()}
    if not counts:
        return Model((), (), np.zeros((DIM + 1, 1)))
    share = max(2, sample // len(counts))
    # the smallest hashes lie below a cutoff that leaves several times the share of a
    # language; without the rows above it no task ranks a whole language
    cutoff = {lang: min(2**63 - 1, -2**63 + int(2**64 * min(1.0, (4 * share + 100) / c))) for lang, c in counts.items()}
    below = F.create_map(*(F.lit(x) for pair in cutoff.items() for x in pair))[F.col("lang")]
    w = Window.partitionBy("lang").orderBy("key")
    chosen = keys.where(F.col("lang").isin(list(counts)) & (F.col("key") <= below)).withColumn(
        "rank", F.row_number().over(w)).where(F.col("rank") <= share)
    # at most ``sample`` rows, so the broadcast and the result are bounded
    texts = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), key.alias("key")).join(
        F.broadcast(chosen.select("lang", "key").distinct()), ["lang", "key"], "left_semi")
    rows = (texts.dropDuplicates(["lang", "key"]).select("lang", "text")
            .mapInArrow(lambda it: giving_back(_sampled(it, fits)),
                        "lang string, x binary" + ", own binary, n long" * fits).collect())
    # rows stay compressed on the driver; one matrix of features is there at a time
    rows = sorted(rows, key=lambda r: (r["lang"], hashlib.sha256(zlib.decompress(r["x"])).digest()))
    langs = [r["lang"] for r in rows]
    model = fit_model(unpacked([r["x"] for r in rows]), langs)
    if fits:
        logs, scale = fit_scales(unpacked([r["own"] for r in rows]), np.array([r["n"] for r in rows]), langs)
        model = replace(model, logs=logs, scale=scale)
    return model


def _predicted(batches, model: Model, text: str, names: tuple):
    fits = len(names) > 2
    letter = regex.compile(LETTER).search
    for batch in batches:
        for part in text_slices(batch, text):
            texts = part.column(text).to_pylist()
            some = [i for i, t in enumerate(texts) if t and letter(t)]
            langs, scores, suits = [UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            for a in range(0, len(some), 256):
                at = some[a:a + 256]
                for i, (lang, score) in zip(at, model.predict(np.stack([features(texts[i]) for i in at]))):
                    langs[i], scores[i] = lang, score
                if fits:
                    own = [letters(texts[i]) for i in at]
                    found = model.fit(np.stack([features(t) for t in own]), np.array([grams(t) for t in own]))
                    for i, suit in zip(at, found.tolist()):
                        suits[i] = suit
            told = [pa.array(langs), pa.array(scores), pa.array(suits)][:len(names)]
            yield pa.RecordBatch.from_arrays([*part.columns, *told], names=[*part.schema.names, *names])


def predict(docs: DataFrame, model: Model, text_col: str = "text",
            out: tuple = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language, a score from 0 to 1 and, if
    ``out`` has a third name, the fit (of a model trained with ``fits``)."""
    docs = replacing(docs, text_col, *out)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        f"`{out[0]}` string", *(f"`{name}` double" for name in out[1:])])
    return docs.mapInArrow(lambda it: giving_back(_predicted(it, model, text_col, out)), schema)
