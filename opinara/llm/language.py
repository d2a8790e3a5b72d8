"""Language identification by character models with interpolated Kneser-Ney smoothing.

Letters are lowered and mapped to 63 classes (a-z their own, every other letter one of 37), anything
else separates words. Four-grams of all learning documents are counted per language: per batch first,
then over the corpus. There are at most 2^24 of them for a language, whatever the corpus, so the
models fit in memory; from them follow the continuation counts of the lower orders, the discounts and
the smoothed probabilities. The four-grams of all languages stand in one sorted array with a row of
log-probabilities each; unseen ones back off to trigrams. A text gets the language of the lowest
cross-entropy per symbol.

The score estimates that the answer is right: a logistic curve over the lead of the best language,
fitted on at most ``SAMPLE`` learning documents. ``reject`` turns answers that score less into
``und``; by default nothing with letters is rejected.

Defined results: null, empty or letterless text is ``und`` with score 0; documents without language,
or with null or repeated doc_ids, are scored like any other; without learning documents every answer
is ``und``; ties go to the first language by name; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
SAMPLE = 4000
BITS = 6
ORDER = 4
CHUNK = 1_000_000
_GRAMS = 1 << (BITS * ORDER)


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of every code point: 0 for no letter, 1-26 for a-z, 27-63 for other letters."""
    table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    classes = np.where(table, 27 + np.arange(0x110000) % 37, 0).astype(np.uint8)
    classes[97:123] = np.arange(1, 27)
    return classes


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Four-gram codes at every letter and word end of the texts, and how many each text has."""
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "replace"), np.uint32)
    symbols = letter_classes()[points]
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    before = np.concatenate([[0], np.cumsum(keep)])
    counts = np.diff(before[np.concatenate([[0], ends])])
    symbols = symbols[keep].astype(np.uint32)
    starts = np.cumsum(counts) - counts
    starts = starts[counts > 0]
    codes = symbols.copy()
    for back in range(1, ORDER):
        earlier = np.zeros_like(symbols)
        earlier[back:] = symbols[:-back]
        for step in range(back):  # nothing of the text before
            at = starts + step
            earlier[at[at < len(earlier)]] = 0
        codes |= earlier << np.uint32(BITS * back)
    return codes, counts


def _pieces(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Rows with their text last, a few million characters at a time."""
    part, size = [], 0
    for row in rows:
        if part and size + len(row[-1]) > CHUNK:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row[-1])
    if part:
        yield part


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list[tuple]] = {}
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang, text in zip(langs, texts, strict=True):
            by_lang.setdefault(lang, []).append((text or "",))
        for lang, rows in by_lang.items():
            found, times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            for part in _pieces(rows):
                own, n = np.unique(grams([r[0] for r in part])[0], return_counts=True)
                both = np.concatenate([found, own])
                found, place = np.unique(both, return_inverse=True)
                times = np.bincount(place, np.concatenate([times, n]), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(times)],
                names=["lang", "gram", "times"],
            )


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning, by their id; none without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learning(docs: DataFrame) -> DataFrame:
    own = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return own.where(~held_out(F.col("doc_id")))


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, times`` over all learning documents."""
    parts = learning(docs).select("lang", "text").mapInArrow(_count, "lang string, gram bigint, times bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("times").alias("times"))


@dataclass
class Models:
    """Log-probabilities of all languages: of seen four-grams, of trigrams, and of backing off."""

    languages: list[str]
    known: np.ndarray
    seen: np.ndarray
    trigrams: np.ndarray
    backoff: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol of each text under each language, and the number of symbols."""
        codes, counts = grams(texts)
        out = np.full((len(texts), len(self.languages)), np.inf)
        if len(codes) and self.languages:
            at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
            value = self.seen[at]
            miss = np.flatnonzero(self.known[at] != codes)
            context, rest = codes[miss] >> np.uint32(BITS), codes[miss] & np.uint32((1 << BITS * 3) - 1)
            value[miss] = self.backoff[context] + self.trigrams[rest]
            has = counts > 0
            starts = (np.cumsum(counts) - counts)[has]
            out[has] = -np.add.reduceat(value, starts, axis=0, dtype=np.float64) / counts[has, None]
        return out, counts

    def lead(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language by number, its lead in standard units, and whether there are symbols."""
        entropy, counts = self.entropies(texts)
        if not self.languages:
            return np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts), bool)
        best = entropy.argmin(axis=1)
        ranked = np.sort(entropy, axis=1)
        with np.errstate(invalid="ignore"):  # texts without letters have no entropy
            gap = ranked[:, 1] - ranked[:, 0] if ranked.shape[1] > 1 else np.ones(len(texts))
        lead = np.where(counts > 0, np.nan_to_num(gap) * np.sqrt(counts), 0)
        return best, np.minimum(lead, 50), counts > 0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        best, lead, real = self.lead(texts)
        score = np.where(real, 1 / (1 + np.exp(-np.clip(self.slope * lead + self.offset, -30, 30))), 0.0)
        return [self.languages[b] if r else UNKNOWN for b, r in zip(best, real, strict=True)], score


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def _smoothed(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Interpolated probabilities of all codes of one order from (continuation) counts."""
    by_context = counts.reshape(-1, 1 << BITS)
    total = by_context.sum(axis=1, keepdims=True)
    kinds = (by_context > 0).sum(axis=1, keepdims=True)
    d = _discount(counts)
    below = np.tile(lower, len(by_context) * (1 << BITS) // len(lower)).reshape(by_context.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.maximum(by_context - d, 0) / total + d * kinds / total * below
    return np.where(total > 0, p, below).reshape(-1)


def smooth(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models from each language's four-gram codes and how often they occur."""
    languages = sorted(counts)
    known = np.unique(np.concatenate([np.zeros(1, np.uint32), *[g for g, _ in counts.values()]]))
    shape = (1 << BITS * 3, len(languages))
    seen = np.zeros((len(known), len(languages)), np.float32)
    trigrams, backoff = np.zeros(shape, np.float32), np.zeros(shape, np.float32)
    low = (1 << BITS * 3) - 1
    for l, lang in enumerate(languages):
        gram, times = counts[lang]
        order = np.argsort(gram)
        gram, times = gram[order], times[order].astype(np.float64)
        # Continuation counts: how many kinds of symbols stand before a shorter gram.
        three = np.bincount(gram & low, minlength=low + 1).astype(np.float64)
        two = (three.reshape(1 << BITS, -1) > 0).sum(axis=0).astype(np.float64)
        one = (two.reshape(1 << BITS, -1) > 0).sum(axis=0).astype(np.float64)
        p1 = _smoothed(one, np.full(1 << BITS, 1 / (1 << BITS)))
        p3 = _smoothed(three, _smoothed(two, p1))
        context = gram >> BITS
        total = np.bincount(context, times, low + 1)
        kinds = np.bincount(context, minlength=low + 1)
        d = _discount(times)
        weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        at = np.minimum(np.searchsorted(gram, known), len(gram) - 1)
        own = np.where(gram[at] == known, times[at], 0.0)
        ctx = known >> BITS
        p4 = np.maximum(own - d, 0) / np.maximum(total[ctx], 1) + weight[ctx] * p3[known & low]
        seen[:, l], trigrams[:, l], backoff[:, l] = np.log(p4), np.log(p3), np.log(weight)
    return Models(languages, known, seen, trigrams, backoff)


def _by_language(table: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Four-gram codes and how often they occur, per language."""
    names = pa.compute.unique(table.column("lang")).to_pylist()
    out = {}
    for name in names:
        own = table.filter(pa.compute.equal(table.column("lang"), name))
        out[name] = own.column("gram").to_numpy().astype(np.uint32), own.column("times").to_numpy()
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> Models:
    """Models from all learning documents; the score's curve from at most ``sample`` of them."""
    # At most 2^24 rows per language (63 letter classes and the gap, four in a row).
    table = gram_counts(docs).toArrow().combine_chunks()
    models = smooth(_by_language(table))
    del table
    # Ids are drawn first, so that only the drawn texts travel.
    known = learning(docs).where(F.col("doc_id").isNotNull())
    draw = F.md5(F.col("doc_id").cast("string"))
    drawn = known.select(F.col("doc_id").alias("_id"), draw.alias("_draw")).orderBy("_draw").limit(sample)
    rows = (
        known.select("doc_id", "lang", "text")
        .join(F.broadcast(drawn.select("_id").distinct()), F.col("doc_id") == F.col("_id"))
        .select("lang", "text")
        .limit(4 * sample)
        .collect()
    )
    x, y = np.zeros(0), np.zeros(0, bool)
    for part in _pieces([(r["lang"], r["text"]) for r in rows]):
        best, lead, real = models.lead([text for _, text in part])
        right = np.array([models.languages[b] == lang for b, (lang, _) in zip(best, part, strict=True)])
        x, y = np.append(x, lead[real]), np.append(y, right[real])
    if len(y):
        right, wrong = y.sum(), (~y).sum()
        target = np.where(y, (right + 1) / (right + 2), 1 / (wrong + 2))
        features, ab = np.stack([x, np.ones_like(x)], 1), np.array([1.0, 0.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(features @ ab, -30, 30)))
            hess = (features * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ features + 0.01 * np.eye(2)
            ab = ab - np.clip(np.linalg.solve(hess, features.T @ (p - target) + 0.01 * ab), -1, 1)
        models.slope, models.offset = float(max(ab[0], 1e-3)), float(ab[1])
    return models


def identify(docs: DataFrame, models: Models, reject: float = 0.0) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    kind = dict(docs.dtypes)["doc_id"]
    shipped = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            names, scores = [], [np.zeros(0)]
            for part in _pieces([(t or "",) for t in batch.column("text").to_pylist()]):
                found, score = own.predict([r[0] for r in part])
                names += [n if s >= reject else UNKNOWN for n, s in zip(found, score, strict=True)]
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                names=["doc_id", "lang_pred", "score"],
            )

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
