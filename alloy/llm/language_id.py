"""Language identification: averaged hashed subword embeddings, linear softmax.

Subwords are the byte n-grams of lower-cased words with their boundaries,
hashed into a fixed number of buckets.  A text's features are the mean of
its subwords' embeddings; a linear layer gives a score for each language.
Embeddings and layer are trained by stochastic gradient descent in numpy on
a bounded sample, then a temperature and a rejection threshold are fitted on
a part of the sample that the descent has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from alloy.llm.common import map_arrow, pick

BUCKETS = 1 << 15
DIM = 16
SIZES = (1, 2, 3, 4)
SEED = 9
UNKNOWN = "und"

_BLANK = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    embedding: np.ndarray  # (buckets, dim)
    layer: np.ndarray  # (dim, languages)
    temperature: float = 1.0
    threshold: float = 0.0


def buckets(text: str, count: int = BUCKETS) -> np.ndarray:
    """The bucket of every subword of the whole text; ``count`` is a power of two."""
    words = text.lower().encode("utf-8", "replace").translate(_BLANK).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    gap = b == 0x20
    inner = np.concatenate([[0], np.cumsum(gap)])  # blanks before each place
    out = []
    h = np.zeros(len(b), np.uint64)
    for n in range(1, max(SIZES) + 1):
        m = len(b) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(1_099_511_628_211) + b[n - 1:] + np.uint64(n)
        if n in SIZES:
            # no blank but at the ends, and not only blanks
            ok = inner[n - 1:n - 1 + m] - inner[1:m + 1] == 0 if n > 2 else np.ones(m, bool)
            ok = ok & ~(gap[:m] & gap[n - 1:])
            x = h[ok]
            out.append(((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40))
    return (np.concatenate(out) & np.uint64(count - 1)).astype(np.int64) if out else np.zeros(0, np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(text: str, count: int) -> np.ndarray:
    """Share of each bucket among the text's subwords."""
    x = np.bincount(buckets(text, count), minlength=count).astype(np.float32)
    return x / max(1.0, float(x.sum()))


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def scores(model: Model, text: str) -> np.ndarray:
    """Logits of the languages."""
    return features(text, len(model.embedding)) @ model.embedding @ model.layer


def pieces(text: str, rng: np.random.Generator) -> list[str]:
    """The text and two runs of its words, so that short texts are learned too."""
    words = text.split()
    out = [text]
    for n in (6, 25):
        if len(words) > n:
            at = int(rng.integers(len(words) - n))
            out.append(" ".join(words[at:at + n]))
    return out


def train(texts: list[str], langs: list[str], count: int = BUCKETS, dim: int = DIM,
          epochs: int = 4, rate: float = 0.5, precision: float = 0.99) -> Model:
    """Stochastic gradient descent on four fifths of the sample, calibration on the rest.

    The same sample in the same order gives the same model.
    """
    rng = np.random.default_rng(SEED)
    known = tuple(sorted(set(langs)))
    if not known:
        return Model((), np.zeros((count, dim), np.float32), np.zeros((dim, 0), np.float32))
    place = {x: i for i, x in enumerate(known)}
    held = rng.random(len(texts)) < 0.2
    held &= len(texts) >= 20
    seen = [(np.unique(buckets(p, count), return_counts=True), place[lang])
            for t, lang, h in zip(texts, langs, held, strict=True) if not h for p in pieces(t, rng)]
    seen = [((i, (c / c.sum()).astype(np.float32)), y) for (i, c), y in seen if len(i)]
    e = ((rng.random((count, dim)) - 0.5) / dim).astype(np.float32)
    w = np.zeros((dim, len(known)), np.float32)
    steps, step = max(1, epochs * len(seen)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(seen)):
            (i, c), y = seen[k]
            lr = rate * (1 - step / steps)
            step += 1
            h = c @ e[i]
            g = softmax(h @ w)
            g[y] -= 1
            back = w @ g
            w -= lr * np.outer(h, g)
            # the mean's gradient spreads over its subwords; scaled up as each is a small share of it
            e[i] -= (lr * 10) * np.outer(c, back)
    model = Model(known, e, w)
    check = [(scores(model, p), place[lang]) for t, lang, h in zip(texts, langs, held, strict=True) if h
             for p in pieces(t, rng)]
    if not check:
        return model
    z, y = np.array([a for a, _ in check]), np.array([b for _, b in check])
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(z / temperature)
    return Model(known, e, w, temperature, _threshold(p.max(axis=1), p.argmax(axis=1) == y, precision))


def _threshold(score: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The lowest score from which on answers are right in ``precision`` of the cases."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.nonzero(share >= precision)[0]
    return float(score[order][good[-1]]) if len(good) else 1.0


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 4 is 2; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = 800,
                    max_docs: int = 6_000, max_chars: int = 20_000) -> tuple[list[str], list[str]]:
    """A bounded sample of labelled documents, the same on every run.

    Of every language about ``per_language`` documents of up to ``max_chars``
    characters, drawn by the hash of doc_id, or fewer so that all come to
    about ``max_docs``; held-out documents and those without id, text or
    language are left out.  No language is left out: more than ``max_docs`` of
    them raise an error.
    """
    rows = pick(docs, "doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = sorted(rows.groupBy("lang").count().limit(max_docs + 1).collect(), key=lambda r: (-r["count"], r["lang"]))
    if not counts:
        return [], []
    if len(counts) > max_docs:
        raise ValueError(f"more languages than documents in the sample ({max_docs}): raise max_docs")
    each = max(1, min(per_language, max_docs // len(counts)))
    part = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rates = rows.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, each / r["count"])) for r in counts], "lang string, rate double")
    drawn = (rows.join(F.broadcast(rates), "lang").where(part < F.col("rate"))  # max_docs rows at most
             .where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
             .select("doc_id", "text", "lang").orderBy("doc_id", "lang", "text")
             .limit(2 * each * len(counts)).collect())
    drawn = [r for r in drawn if has_letter(r["text"])]
    return [r["text"] for r in drawn], [r["lang"] for r in drawn]


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                lang, score = [], []
                for text in batch.column(1).to_pylist():
                    if not model.languages or not has_letter(text):
                        lang.append(UNKNOWN)
                        score.append(0.0)
                        continue
                    p = softmax(scores(model, text).astype(np.float64) / model.temperature)
                    k = int(p.argmax())
                    lang.append(model.languages[k])
                    score.append(float(p[k]))
                yield pa.record_batch(
                    [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array([s < model.threshold or x == UNKNOWN for s, x in zip(score, lang, strict=True)])],
                    ["doc_id", "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected.

    The whole text is read and nothing else.  ``und`` with score 0 for a NULL
    text, one without a letter, or a model that has learned no language.
    ``rejected``: the score is under the calibrated threshold.  Rows are
    independent; repeated rows repeat their result.
    """
    return map_arrow(pick(docs, "doc_id", "text"), _predict(model),
                     "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, per_language: int = 800) -> DataFrame:
    """Train on the sample of ``docs`` and predict all of it: doc_id, held_out, lang_pred, score, rejected."""
    model = train(*training_sample(docs, per_language))
    return predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
