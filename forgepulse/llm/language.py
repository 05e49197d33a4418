"""Language identification by nearest centroids of TF-IDF n-gram vectors."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 4096
CLUSTERS = 4
# Labelled documents of each language that are learned from, about.
SAMPLE_PER_LANGUAGE = 500
# Lengths, in characters, of the passages that rejection is calibrated on.
PASSAGES = (16, 64, 256, 1024, 4096)
# Parts the texts are learned from by turns; the passages of each are compared with the others.
FOLDS = 4
# A text is too far if this part of shuffled passages like it come nearer, unless its cosine
# is above KEPT of what all but LOWEST of real passages like it reach.
NOISE = 0.8
KEPT, LOWEST = 0.5, 0.05
UNKNOWN = "und"
SEED = 42
# Bytes of a text counted at a time.
CHUNK = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
_DRAWN = pa.schema([("lang", pa.string()), ("tf", pa.binary()), ("passages", pa.list_(pa.string()))])
# Everything of ASCII but letters is a space; a run of spaces counts as one below.
_FOLDED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def counts(text: str) -> np.ndarray:
    """The text's byte trigrams, lower-cased and hashed to DIMENSIONS, counted."""
    plain = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_FOLDED).split())
    data = np.frombuffer(b" " + plain + b" ", dtype=np.uint8)
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    for at in range(0, max(1, len(data) - 2), CHUNK):
        part = data[at:at + CHUNK + 2].astype(np.uint32)
        code = part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]
        total += np.bincount(code * np.uint32(2654435761) >> shift, minlength=DIMENSIONS)
    return total


@dataclass
class Model:
    """Languages with the unit centroids of their clusters, and the least cosine of a text by
    the logarithm of its number of different n-grams."""

    idf: np.ndarray
    centroids: np.ndarray
    labels: list[str]
    sizes: list[float] = field(default_factory=lambda: [0.0])
    limits: list[float] = field(default_factory=lambda: [0.0])

    def weigh(self, tf: np.ndarray) -> np.ndarray:
        """Unit vectors of logarithmic counts weighed by rarity; zero without n-grams."""
        vectors = (np.log1p(tf) * self.idf).astype(np.float32)
        norms = np.linalg.norm(vectors, axis=-1, keepdims=True)
        return vectors / np.where(norms > 0, norms, 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The language, the cosine of the nearest centroid, and whether it is too far."""
        if not text or not _LETTER.search(text) or not self.labels:
            return UNKNOWN, 0.0, True
        tf = counts(text)
        cosines = self.centroids @ self.weigh(tf)
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.labels[best], score, score <= self.limit(np.count_nonzero(tf))

    def limit(self, different: int) -> float:
        """The cosine up to which a text with so many different n-grams is too far."""
        return float(np.interp(np.log(max(1, different)), self.sizes, self.limits))


def clustered(vectors: np.ndarray, clusters: int = CLUSTERS, rounds: int = 12) -> np.ndarray:
    """Unit centroids by spherical k-means from far-apart first members; same rows, same
    result."""
    mean = vectors.mean(axis=0)
    chosen = [int(np.argmax(vectors @ mean))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(clusters, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([
            vectors[own == k].sum(axis=0) if (own == k).any() else centroids[k]
            for k in range(len(centroids))
        ])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = sums / np.where(norms > 0, norms, 1)
    return centroids


def passages(text: str) -> list[str]:
    """A passage of the text for each length it has, at a place its checksum gives."""
    place = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    starts = [(place % (len(text) - size + 1), size) for size in PASSAGES if size <= len(text)]
    return [text[at:at + size] for at, size in starts]


def shuffled(text: str) -> str:
    """The text's characters in another order, the same for the same text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    mixed = np.random.default_rng(len(text)).permutation(codes)
    return mixed.tobytes().decode("utf-32-le", "surrogatepass")


def learned(labels: Sequence[str], tf: np.ndarray, clusters: int) -> Model:
    """Weights and centroids, without limits."""
    seen = (tf > 0).sum(axis=0)
    idf = np.log((1 + len(tf)) / (1 + seen)) + 1
    model = Model(idf.astype(np.float32), np.zeros((0, DIMENSIONS), np.float32), [])
    own = np.array(labels, dtype=object)
    parts = []
    for label in sorted(set(labels)):
        centroids = clustered(model.weigh(tf[own == label]), clusters)
        parts.append(centroids)
        model.labels += [label] * len(centroids)
    if parts:
        model.centroids = np.concatenate(parts)
    return model


def fit(
    labels: Sequence[str], tf: np.ndarray, texts: Sequence[Sequence[str]], clusters: int = CLUSTERS
) -> Model:
    """A model of counted texts, with limits from the passages of each.

    A passage is compared with centroids learned without its text, and so is the same
    passage shuffled, which has its letters but no language. The limit for texts of about
    so many different n-grams lies where most shuffled passages stay under it, and well
    under nearly all real ones, so that short texts, whose cosines are small, are kept.
    """
    model = learned(labels, tf, clusters)
    found: dict[int, list[tuple[int, float, float]]] = {size: [] for size in PASSAGES}
    fold = np.arange(len(tf)) % FOLDS
    for part in range(FOLDS):
        rest = [label for label, at in zip(labels, fold, strict=True) if at != part]
        others = learned(rest, tf[fold != part], clusters)
        if not others.labels:
            continue
        for size, rows in found.items():
            real = [
                x for at in np.flatnonzero(fold == part) if labels[at] in others.labels
                for x in texts[at] if len(x) == size and _LETTER.search(x)
            ]
            if real:
                counted = np.stack([counts(x) for x in real])
                noise = np.stack([counts(shuffled(x)) for x in real])
                near, far = (
                    (others.weigh(x) @ others.centroids.T).max(axis=1) for x in (counted, noise)
                )
                rows += zip((counted > 0).sum(axis=1), near, far, strict=True)
    for rows in found.values():
        if rows:
            different, near, far = (np.array(column, dtype=float) for column in zip(*rows, strict=True))
            model.sizes.append(max(model.sizes[-1], float(np.log(np.median(different)))))
            model.limits.append(
                max(0.0, min(float(np.quantile(far, NOISE)), KEPT * float(np.quantile(near, LOWEST))))
            )
    return model


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(
        F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False)
    )


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model of the labelled documents that aren't held out, from a bounded sample.

    From each language about `per_language` different texts are drawn by a hash of the
    text, all where it has no more; copies are counted once. Their n-grams are counted in
    the executors; the driver gets packed counts and passages of bounded length.
    """
    labelled = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("lang", "text")
    different = F.approx_count_distinct(F.xxhash64("text"))
    sizes = {
        row.lang: max(1, row.n) for row in labelled.groupBy("lang").agg(different.alias("n")).collect()
    }
    if not sizes:
        return fit([], np.zeros((0, DIMENSIONS), np.int64), [])
    limits = F.create_map(*[
        F.lit(x) for lang, n in sorted(sizes.items())
        for x in (lang, int(min(1.0, per_language / n) * (1 << 30)))
    ])
    spread = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(1 << 30))
    chosen = labelled.where(spread <= limits[F.col("lang")])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"lang": lang, "tf": zlib.compress(counts(text).astype("<u8").tobytes(), 1),
                 "passages": passages(text)}
                for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True)
                if _LETTER.search(text)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_DRAWN)

    # Twice the expected number is more than a draw by hash can bring, but for copies.
    rows = (
        chosen.mapInArrow(vectors, "lang string, tf binary, passages array<string>").dropDuplicates()
        .limit(2 * per_language * len(sizes)).collect()
    )
    rows.sort(key=lambda row: (row.lang, bytes(row.tf), row.passages))
    tf = np.frombuffer(b"".join(zlib.decompress(row.tf) for row in rows), dtype="<u8")
    return fit(
        [row.lang for row in rows], tf.reshape(len(rows), DIMENSIONS).astype(np.int64),
        [row.passages for row in rows],
    )


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All rows of `docs` with `lang_pred`, `score` and `rejected`; columns so named are replaced.

    A text is compared by cosine with several centroids per language; the nearest decides.
    It is rejected if even that is as far as shuffled text with as many n-grams. Null texts
    and texts without a letter are `und`, score 0, and rejected. Without a model given,
    one is learned from `docs`; without labels everything is `und`. Rows with the same
    text get the same prediction: nothing but the text is looked at.
    """
    model = train(docs) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(
                [sent.value.predict(text) for text in batch], columns=["lang_pred", "score", "rejected"]
            )

    return docs.withColumn("_found", predicted(F.col("text"))).withColumns({
        name: F.col(f"_found.{name}") for name in ("lang_pred", "score", "rejected")
    }).drop("_found")
