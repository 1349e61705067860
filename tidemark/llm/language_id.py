"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 in ``DIM`` dimensions, made from
its code point and a seed. A letter trigram binds its letters' vectors: the
first is permuted (rotated) twice, the second once, and the three are
multiplied. A text bundles (adds up) the vectors of all its trigrams; a
language prototype bundles those of all its training texts. The prediction is
the language whose centred prototype has the largest cosine with the text. A text
in another script, or of random letters, is as far from every prototype, before centring, as
random vectors are: that tells what is like no learned language.

Training sums vectors within each task before anything is shuffled: one row a
task, language and dimension. Only the prototypes, ``DIM`` numbers a language,
reach the driver and go out with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import held_out, read_documents, small_batches

DIM = 512
SEED = 7
HELD_OUT = 5           # documents whose crc32 leaves 0 by this are not learned from
MAX_LANGUAGES = 4096   # bound on what the driver holds; a corpus with more is refused
UNKNOWN = "und"

# A text is like a language if its cosine with the language's prototype is so many standard deviations
# of that of random vectors, 1 / sqrt(dim). Text of few trigrams is less like any language.
SIGMAS = 4.5
FEW, FEW_SIGMAS = 20, 2.5

CHARS = 1 << 19        # characters handled at once
CACHED = 1 << 15       # trigram vectors a worker keeps
SPACE = 32


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Codebook:
    """Vectors of letters and trigrams, made on demand from the seed."""

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed = dim, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((1024, dim), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            bits = np.random.default_rng([self.seed, c]).integers(0, 2, self.dim, np.int8)
            self.letters[c] = bits * 2 - 1
        return self.letters[c]

    def positions(self, trigrams: np.ndarray) -> np.ndarray:
        """Where the vectors of these packed trigrams are in ``vectors``."""
        if len(self.rows) + len(trigrams) > CACHED:
            self.rows = {}
        out = np.empty(len(trigrams), np.int64)
        for i, t in enumerate(trigrams.tolist()):
            at = self.rows.get(t)
            if at is None:
                at = self.rows[t] = len(self.rows)
                if at >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                a, b, c = t >> 42, t >> 21 & 0x1FFFFF, t & 0x1FFFFF
                self.vectors[at] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
            out[i] = at
        return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, packed trigram) of all letter trigrams of lower-cased texts;
    runs of other characters are one space at a word's edge."""
    points = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    of = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    c = np.concatenate(points)
    c = np.where(_is_letter()[c], c, SPACE)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE) | (of[1:] != of[:-1])
    c, of = c[keep].astype(np.int64), of[keep]
    if len(c) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    good = (of[2:] == of[:-2]) & (c[1:-1] != SPACE)
    return of[2:][good], ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[good]


def _in_pieces(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) with about CHARS characters in each piece."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1])
        if size >= CHARS:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _bundle(book: Codebook, found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the vectors of distinct trigrams by their weights."""
    total = np.zeros(book.dim, np.float64)
    for at in range(0, len(found), 8192):   # a bounded share of the codebook at a time
        rows = book.positions(found[at:at + 8192])
        total += weights[at:at + 8192].astype(np.float32) @ book.vectors[rows].astype(np.float32)
    return total


def learn(labelled: DataFrame, dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototypes by language from (text, lang) rows; rows with a null are skipped."""
    small_batches(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, sums = Codebook(dim, seed), {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()),
                 pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "vector"])

        for b in batches:
            langs = b.column(1).to_pylist()
            for first, texts in _in_pieces(b.column(0).to_pylist()):
                of, grams = trigrams(texts)
                names = {}
                number = np.array([names.setdefault(langs[first + i], len(names)) for i in range(len(texts))], np.int64)
                for lang, k in names.items():
                    found, n = np.unique(grams[number[of] == k], return_counts=True)
                    sums[lang] = sums.get(lang, 0) + _bundle(book, found, n)
            if len(sums) > 256:
                yield out()
                sums = {}
        if sums:
            yield out()

    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    partial = rows.mapInArrow(run, "lang string, vector array<double>")
    summed = (partial.select("lang", F.posexplode("vector").alias("at", "x"))
              .groupBy("lang", "at").agg(F.sum("x").alias("x"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))
              .select("lang", F.col("v.x").alias("v")).limit(MAX_LANGUAGES + 1).collect())
    if len(summed) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r.lang: np.array(r.v) for r in sorted(summed, key=lambda r: r.lang)}


def centred(prototypes: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their unit prototypes less what all share, and the shared part."""
    names = [k for k, v in prototypes.items() if np.linalg.norm(v) > 0]
    if not names:
        return [], np.zeros((0, DIM)), np.zeros(DIM)
    unit = np.stack([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names])
    shared = unit.mean(axis=0) if len(names) > 1 else np.zeros(unit.shape[1])
    unit = unit - shared
    norm = np.linalg.norm(unit, axis=1, keepdims=True)
    return names, unit / np.where(norm > 0, norm, 1), shared


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIM, seed: int = SEED,
            keep: list[Column] | None = None, with_like: bool = False) -> DataFrame:
    """``keep`` columns with lang_pred and score (cosine, 0 to 1) and, if asked for, ``like``:
    whether the text is like any learned language at all. A text
    that is null or without a letter is ``und`` with score 0, and so is
    every text where no language was learned. Of equal cosines the first
    language by name wins."""
    small_batches(docs.sparkSession)
    names, unit, shared = centred(prototypes)
    whole = np.stack([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]) if names else unit
    columns = keep or [F.col("doc_id")]
    kept = docs.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(dim, seed)
        for b in batches:
            langs, scores, like = [], [], []
            for _, texts in _in_pieces(b.column(b.num_columns - 1).to_pylist()):
                of, grams = trigrams(texts)
                found, back = np.unique(grams, return_inverse=True)
                pairs, n = np.unique(of * max(1, len(found)) + back, return_counts=True)
                edges = np.searchsorted(pairs, np.arange(len(texts) + 1) * max(1, len(found)))
                for i in range(len(texts)):
                    mine = slice(edges[i], edges[i + 1])
                    if edges[i] == edges[i + 1] or not names:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        like.append(False)
                        continue
                    v = _bundle(book, found[pairs[mine] - i * len(found)], n[mine])
                    v = v / max(np.linalg.norm(v), 1e-9)
                    sigmas = SIGMAS if n[mine].sum() >= FEW else FEW_SIGMAS
                    like.append(bool((whole @ v).max() > sigmas / np.sqrt(dim)))
                    v = v - shared
                    cosine = unit @ v / max(np.linalg.norm(v), 1e-9)
                    best = int(np.argmax(cosine))
                    langs.append(names[best])
                    scores.append(float(min(1.0, max(0.0, cosine[best]))))
            cols = [*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(like, pa.bool_())] * with_like,
                                             [*b.schema.names[:-1], "lang_pred", "score"] + ["like"] * with_like)

    schema = T.StructType(kept.schema.fields).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    if with_like:
        schema = schema.add("like", T.BooleanType())
    return docs.select(*columns, F.col("text").alias("__text")).mapInArrow(run, schema)


def train(docs: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes from the documents that are not held out."""
    return learn(docs.filter(~held_out(HELD_OUT, 0)).select("text", "lang"))


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a language that was learned, with its columns;
    rejected are texts without a letter and those like no learned language: in a script that
    was not learned, or of random letters."""
    row = F.struct("*").alias("row")
    return predict(docs, train(docs), keep=[row], with_like=True).filter("like").select("row.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    docs = read_documents(spark, sf_dir)
    return predict(docs, train(docs), keep=[F.col("doc_id"), held_out(HELD_OUT, 0).alias("held_out")])
