"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of character 1-, 2- and 3-grams (lower case,
every non-letter is a blank), hashed into ``DIMS`` cells and scaled to length 1.
Each language has several centroids (spherical k-means on its training texts).
A text gets the language of the centroid with the highest cosine.

A short text fills few cells, so even in its own language its cosine is about
sqrt(g / (g + HALF_GRAMS)) of a long one's, g being its n-grams.  A text is
*rejected* when its cosine, divided by that, is below the centroid's own limit: a
share (``reject_share``) of the 5 % quantile of the same value over the training
texts nearest to the centroid (over all of the language, for a centroid with
fewer than ``_OWN_TEXTS``), at most 1.

* The n-gram document frequencies cover every training document.
* The centroids are fitted on a bounded sample: about ``sample_per_lang``
  training documents of each language, chosen by a hash of the id and the text
  (all of them when there are fewer).  With at most ``max_languages`` languages
  the model is at most ``max_languages * clusters * DIMS`` floats, so it is
  small enough to send to every task.
* Prediction reads only the text, in Arrow batches, and whole texts.

Defined results: a text that is null or has no letter gives ``und``, score 0,
rejected.  A null language is never learnt; with nothing to learn from, every
text is ``und``.  Repeated rows are predicted alike; an empty table gives an
empty result; ties go to the language that sorts first.  Columns of the input
whose names clash with the result columns are replaced by the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcast.llm.textops import code_points, letter_table, mix
from callcast.session import ship_package

DIMS = 4096
#: Characters worked on at once: about 100 bytes each while their n-grams are hashed.
_CHUNK_CHARS = 1 << 17
#: Documents whose vectors are held at once: DIMS * 4 bytes each.
_CHUNK_DOCS = 128
#: N-grams at which half of the squared cosine is reached (fitted to texts of the test tables, cut to 20 to 640 characters).
HALF_GRAMS = 150
#: Training texts that a centroid needs for a limit of its own.
_OWN_TEXTS = 20


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray
    limits: np.ndarray


def _chunks(texts: list[str]):
    """Runs of texts with bounded characters and number (one text may exceed the bound alone)."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if i > start and (chars + len(t) > _CHUNK_CHARS or i - start >= _CHUNK_DOCS):
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def _small(batches):
    """The same rows in batches of at most _CHUNK_DOCS, so that a worker holds few texts beside the batch that it was sent, and sends back small ones."""
    for batch in batches:
        for a in range(0, batch.num_rows, _CHUNK_DOCS):
            yield batch.slice(a, _CHUNK_DOCS)


def count_matrix(texts: list[str]) -> np.ndarray:
    """One row per text: how often each hashed 1-, 2- and 3-gram occurs."""
    codes, off = code_points([f" {t.lower()} " for t in texts])
    low = np.where(letter_table()[codes], codes, 0).astype(np.uint64)
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    with np.errstate(over="ignore"):
        uni = low
        bi = np.zeros_like(low)
        bi[1:] = low[:-1] * np.uint64(0x1F0003) + low[1:]
        tri = np.zeros_like(low)
        tri[2:] = bi[1:-1] * np.uint64(0x1F0003) + low[2:]
        cells = [(mix(g * np.uint64(4) + np.uint64(n)) >> np.uint64(52)).astype(np.int64) for n, g in ((1, uni), (2, bi), (3, tri))]
    full = [uni != 0, (bi != 0), (tri != 0)]
    for i in range(len(texts)):
        a, b = off[i], off[i + 1]
        for n in range(3):
            s = a + n
            if s < b:
                out[i] += np.bincount(cells[n][s:b][full[n][s:b]], minlength=DIMS).astype(np.float32)
    return out


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = counts * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def _has_letter(counts: np.ndarray) -> np.ndarray:
    return counts.any(axis=1)


def reach(counts: np.ndarray) -> np.ndarray:
    """Share of a long text's cosine that a text with so many n-grams has."""
    grams = np.maximum(counts.sum(axis=1), 1)
    return np.sqrt(grams / (grams + HALF_GRAMS))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most ``k`` unit centroids; starts from the rows farthest from those chosen before."""
    centers = [x.mean(axis=0)]
    for _ in range(k - 1):
        sims = np.max(x @ (np.array(centers) / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)).T, axis=1)
        far = int(np.argmin(sims))
        if sims[far] > 0.999:
            break
        centers.append(x[far])
    c = np.array(centers)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        new = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def document_frequencies(train: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Documents that hold each cell, over all training rows; one array of DIMS per task."""

    def count(batches):
        df, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in _small(batches):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in _chunks(texts):
                c = count_matrix(texts[a:b])
                df += (c > 0).sum(axis=0)
                n += int(_has_letter(c).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS)), pa.array(np.concatenate([[n], df]))], names=["cell", "df"])

    rows = train.select(text).mapInArrow(count, "cell long, df long").groupBy("cell").agg(F.sum("df").alias("df")).collect()
    df, n = np.zeros(DIMS), 0
    for r in rows:  # DIMS + 1 rows
        if r.cell < 0:
            n = r.df
        else:
            df[r.cell] = r.df
    return df, n


def fit(
    train: DataFrame,
    text: str = "text",
    lang: str = "lang",
    row_key: Column | None = None,
    clusters: int = 4,
    sample_per_lang: int = 400,
    reject_share: float = 0.55,
    max_languages: int = 512,
) -> Model:
    """Learn from every row of ``train`` whose language is not null (see the module text for the sample)."""
    ship_package(train.sparkSession)
    train = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    key = row_key if row_key is not None else F.lit(0)
    train = train.select(F.col(text).alias("text"), F.col(lang).alias("lang"), key.alias("row_key"))
    sizes = {r.lang: r.n for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than max_languages={max_languages} languages")
    df, n = document_frequencies(train, "text")
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    if not sizes:
        return Model(idf, [], np.zeros((0, DIMS), np.float32), np.zeros(0))
    draw = F.pmod(F.xxhash64("row_key", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample_per_lang / v))) for k, v in sorted(sizes.items())])
    sample = train.where(draw < share).select("lang", "text")

    def cluster(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(pdf["text"])[: 2 * sample_per_lang]
        counts = np.concatenate([count_matrix(texts[a:b]) for a, b in _chunks(texts)])
        counts = counts[_has_letter(counts)]
        x = unit_vectors(counts, idf)
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "low": []})
        c = spherical_kmeans(x, clusters)
        sims = x @ c.T
        near, own = sims.max(axis=1) / reach(counts), sims.argmax(axis=1)
        texts_of = [near[own == j] if (own == j).sum() >= _OWN_TEXTS else near for j in range(len(c))]
        low = [min(1.0, float(np.quantile(v, 0.05))) for v in texts_of]
        return pd.DataFrame({"lang": [key[0]] * len(c), "centroid": [r.tolist() for r in c], "low": low})

    rows = sorted(sample.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, low double").collect(), key=lambda r: (r.lang, r.centroid))
    return Model(
        idf,
        [r.lang for r in rows],
        np.array([r.centroid for r in rows], dtype=np.float32).reshape(len(rows), DIMS),
        np.array([r.low * reject_share for r in rows]),
    )


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected; other columns pass unchanged."""
    spark = docs.sparkSession
    ship_package(spark)
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    sent = spark.sparkContext.broadcast(model)
    at = kept.index(text)

    def run(batches):
        m = sent.value
        for batch in _small(batches):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            lang, score, out = [], [], []
            for a, b in _chunks(texts):
                counts = count_matrix(texts[a:b])
                ok = _has_letter(counts)
                if not m.langs:
                    ok &= False
                    best, cos = np.zeros(b - a, int), np.zeros(b - a)
                else:
                    sims = unit_vectors(counts, m.idf) @ m.centroids.T
                    best = sims.argmax(axis=1)
                    cos = np.clip(sims.max(axis=1), 0, 1)
                lang += [m.langs[j] if o else "und" for j, o in zip(best, ok)]
                score += [float(s) if o else 0.0 for s, o in zip(cos, ok)]
                out += [not o or bool(s < m.limits[j] * r) for j, s, o, r in zip(best, cos, ok, reach(counts))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """One document in five is never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, **params) -> DataFrame:
    """Fit on the documents that are not held out (null ids are not learnt from) and predict all."""
    train = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    model = fit(train, row_key=F.col("doc_id"), **params)
    return predict(docs, model)
