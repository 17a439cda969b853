"""Toxicity by compression distance: which of two zstandard dictionaries shortens a window more.

**Dictionaries.** Two are trained on labelled text: one on ordinary windows, one on the passages that set toxic
documents apart. A passage is the beginning of a word: it counts if far more toxic than ordinary documents
hold it (``LEAST_Z`` standard errors, ``LEAST_LIFT`` times, in a share ``LEAST_SHARE`` of toxic ones); then the
extension that most of these documents share and the fewest ordinary ones hold is taken. The compressor for ordinary text knows the ordinary dictionary, the
one for toxic text both, so their lengths differ by what the toxic dictionary alone explains.

**Score.** A text is cut into windows of ``WINDOW`` words, each compressed once with either. Windows that the toxic
dictionary shortens by some bytes are evidence; a logistic curve over their number and size, fitted on labelled
documents and shifted so that the best F1 lies at ``THRESHOLD``, gives a score from 0 to 1. Null, empty and blank
texts have no window and get the curve's value for no evidence.

**Sample.** Training reads at most about ``TRAIN_DOCS`` documents per label, chosen by the hash of their id. Whole texts are
used; scoring covers all windows of every text. Without labels of both kinds, or where no passage sets toxic
documents apart, there is no evidence: every score is then the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.workspace import stage

TRAIN_DOCS = 1500
# A list of so many ids is sent to all tasks; a longer one, from a larger sample asked for, is joined by shuffle.
MOST_LISTED = 200_000
WINDOW = 12
LONGEST_WORD = 128
LEAST_Z, LEAST_LIFT, LEAST_SHARE, SAME_DOCS = 3.0, 20.0, 0.03, 0.9
PASSAGE = range(4, 7)
# The compressor looks for no match in the last bytes of its input.
TAIL = b"\n" + bytes(range(1, 9))
# Stands between passages in the toxic dictionary, so that no text matches across two of them.
APART = b"\0\0"
ORDINARY_BYTES, TOXIC_BYTES = 2048, 4096
THRESHOLD = 0.3
GAINS = (1, 2, 3, 4)


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The whole text in windows of ``size`` words; words without end are cut."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if any(len(word) > LONGEST_WORD for word in words):
        words = [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    return [b" " + b" ".join(words[i : i + size]) + b" " + TAIL for i in range(0, len(words), size)]


def passages(text: str | None) -> set[str]:
    """Beginnings of the words of a text."""
    found = set()
    for word in set((text or "").lower().split()):
        found.update(word[:k] for k in PASSAGE if k <= len(word))
    return found


def telling_passages(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Word beginnings that set toxic documents apart, the most common first, none the beginning of another."""
    inside, outside = Counter(), Counter()
    for text in toxic:
        inside.update(passages(text))
    for text in ordinary:
        outside.update(passages(text))
    least = max(3, LEAST_SHARE * len(toxic))
    kept = {}
    for passage, n in inside.items():
        if n >= least:
            m = outside[passage]
            lift = (n + 0.5) / (len(toxic) + 1) * (len(ordinary) + 1) / (m + 0.5)
            if lift >= LEAST_LIFT and math.log(lift) / math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5)) >= LEAST_Z:
                kept[passage] = n
    chosen: list[str] = []
    for passage in sorted(kept, key=lambda p: (-kept[p], len(p), p)):
        if any(passage.startswith(c[: PASSAGE[0]]) for c in chosen):
            continue
        longer = [p for p in kept if p.startswith(passage) and kept[p] >= SAME_DOCS * kept[passage]]
        chosen.append(min(longer, key=lambda p: (outside[p], len(p), p)))
    return chosen


def train_dictionary(samples: list[bytes], size: int, must: list[bytes] = ()) -> bytes:
    """Dictionary content for ``samples``; plain concatenation where there are too few to train on."""
    import zstandard

    try:
        trained = zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()
    except (zstandard.ZstdError, ValueError):
        trained = b"".join(dict.fromkeys(samples))[-size:]
    return trained + b"".join(APART + m for m in must if m not in trained) + APART


@dataclass
class Model:
    """Two dictionaries and the curve; a few kilobytes."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    base: float = 0.0

    def compressors(self):
        import zstandard

        def build(content: bytes):
            settings = zstandard.ZstdCompressionParameters.from_level(
                3, strategy=zstandard.STRATEGY_LAZY2, min_match=5, window_log=14, chain_log=12, hash_log=12,
                search_log=4, target_length=32, write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)

        return build(self.ordinary), build(self.toxic + self.ordinary)

    def features(self, texts: list, compressors=None) -> np.ndarray:
        """Per text: log of the numbers of windows whose length the toxic dictionary changes by some bytes, and the most changed."""
        ordinary, toxic = compressors or self.compressors()
        cut = [windows(text) for text in texts]
        flat = [window for each in cut for window in each]
        out = np.zeros((len(texts), len(GAINS) + 2))
        if not flat:
            return out
        gains = np.abs(_lengths(ordinary, flat) - _lengths(toxic, flat))
        start = 0
        for row, each in zip(out, cut):
            own = gains[start : start + len(each)]
            start += len(each)
            if len(own):
                row[: len(GAINS)] = np.log1p([(own >= g).sum() for g in GAINS])
                row[len(GAINS)] = own.max() / 4
                row[len(GAINS) + 1] = np.sort(own)[-2:].sum() / 8 if len(own) > 1 else own.max() / 8
        return out

    def scores(self, texts: list, compressors=None) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.base)
        return _curve(self.features(texts, compressors), np.array(self.weights))


def _lengths(compressor, parts: list[bytes]) -> np.ndarray:
    out = np.empty(len(parts), dtype=np.int64)
    for start in range(0, len(parts), 4096):
        found = compressor.multi_compress_to_buffer(parts[start : start + 4096], threads=0)
        out[start : start + len(found)] = [len(found[i]) for i in range(len(found))]
    return out


def _curve(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[1:] + weights[0], -30, 30)))


def _fit_curve(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge, then shifted so that the best F1 lies at the threshold."""
    x = np.column_stack([np.ones(len(features)), features])
    ridge, weights = np.diag([1e-3] + [1e-1] * features.shape[1]), np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    at = x @ weights
    cuts = np.unique(at)
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    cuts = np.quantile(cuts, np.linspace(0, 1, 400)) if len(cuts) > 400 else cuts
    f1 = [2 * (labels[at >= c].sum()) / max(1, (at >= c).sum() + labels.sum()) for c in cuts]
    best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
    weights[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - cuts[best[len(best) // 2]]
    return weights


def fit(toxic: list[str], ordinary: list[str], base: float | None = None) -> Model:
    """Dictionaries from all given texts; the curve from the same texts' window lengths. ``base``: share of toxic labels."""
    base = len(toxic) / max(1, len(toxic) + len(ordinary)) if base is None else base
    telling = [b" " + passage.encode() for passage in telling_passages(toxic, ordinary)] if toxic and ordinary else []
    if not telling:
        return Model(base=base)
    held = Counter()
    plain = [w for text in ordinary for w in windows(text)]
    stride = max(1, len(plain) // 20_000)
    model = Model(train_dictionary(plain[::stride], ORDINARY_BYTES), base=base)
    for text in toxic:
        data = b" " + b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split())
        held.update(p for p in telling if p in data)
    samples = [p + APART for p in telling for _ in range(held[p])]
    model.toxic = train_dictionary(samples, TOXIC_BYTES, telling)
    labels = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    model.weights = _fit_curve(model.features([*toxic, *ordinary]), labels).tolist()
    return model


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, bound: int) -> DataFrame:
    """About ``bound`` documents of each label by the hash of their id, so the sample never depends on row order.

    The chosen ids are written and counted first: about two times ``bound`` of them, so they are sent to the texts.
    """
    labels = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(key, F.col(label).alias("__toxic"))
    sizes = {row[0]: row[1] for row in labels.groupBy("__toxic").count().collect()}
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("__toxic") == 1, bound / max(1, sizes.get(1, 0))).otherwise(bound / max(1, sizes.get(0, 0)))
    chosen = labels.where(draw < share).groupBy(key).agg(F.max("__toxic").alias("__toxic"))
    chosen = stage(chosen, "toxicity-sample", compact=True)
    listed = F.broadcast(chosen) if chosen.count() <= MOST_LISTED else chosen
    return docs.where(F.col(text).isNotNull()).join(listed, key).select(F.col(text).alias("text"), "__toxic")


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    bound: int = TRAIN_DOCS,
) -> Model:
    """Fit on a bounded sample of labelled documents. ``docs`` should hold training rows only."""
    rows = training_rows(docs, labels, text, key, label, bound).toPandas()
    rows = rows.sort_values(["__toxic", "text"])
    share = labels.where(F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    return fit(rows.text[rows["__toxic"] == 1].tolist(), rows.text[rows["__toxic"] == 0].tolist(), share)


def score(model: Model, text: Column | str) -> Column:
    """Score column of a text column."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = model.compressors() if model.weights else None
        for texts in batches:
            parts = [model.scores(texts[i : i + 256].tolist(), compressors) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return scores(text)
