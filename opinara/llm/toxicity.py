"""Toxicity by a support vector machine over a gap-weighted subsequence kernel.

A text is split at white space into stretches; letters are folded to a small alphabet and anything
else inside a stretch is skipped, so ``i.d.i.o.t`` reads like the plain word; runs of single letters
are joined. Two stretches are compared by the subsequences of four letters they share over at most
five places, a gap costing ``DECAY``: one inserted or missing letter leaves most of them.

Only documents are labelled, so the machine is trained as a multi-instance one: each toxic document
of the bounded sample gives its most toxic stretch, clean ones give their most suspicious stretches
and others, and both are drawn again with the new machine. The kernel is approximated through
Nystrom landmarks. As the machine is linear over the subsequences, its landmarks fold into one weight
per subsequence, a table of fixed size. A document is judged by its three worst stretches and how many
it has: chance finds in a long clean text stand alone.

Defined results: null or empty text has no stretch and gets the score of the least suspicious kind;
without labelled rows of both classes every score is 0; repeated documents score alike; an empty
table gives no rows; labels that disagree count as toxic; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.shared import scratch

SAMPLE = 3000  # labelled documents per class the machine is fitted on
LANDMARKS = 256
ROUNDS = 3
COST = 200.0
DECAY = 0.7
EDGE = 27
WORST = 3  # stretches per document that the calibration sees
FLOOR = -3.0
CHUNK_BYTES = 1_000_000
BATCH_ROWS = 500  # whole documents that travel to a Python worker at a time
PLAIN = 4  # random stretches per clean document
_SIZE = 32
# The places of a subsequence's letters after the first, and its weight.
PATTERNS = (((1, 2, 3), DECAY**3), ((1, 2, 4), DECAY**4), ((1, 3, 4), DECAY**4), ((2, 3, 4), DECAY**4))


def _classes() -> np.ndarray:
    """Byte to letter class: 0 is skipped, EDGE ends a stretch; accents fold to the plain letter."""
    table = np.zeros(256, np.uint8)
    for i in range(26):
        table[65 + i] = table[97 + i] = i + 1
    for b in (9, 10, 11, 12, 13, 32):
        table[b] = EDGE
    # Second byte of the Latin-1 letters in UTF-8, upper and lower case; of other letters, any class.
    table[128:192] = 28 + np.arange(64) % 4
    folded = {"a": range(6), "c": (7,), "e": range(8, 12), "i": range(12, 16), "n": (17,),
              "o": range(18, 23), "u": range(25, 29), "y": (29,), "s": (31,)}
    for letter, places in folded.items():
        for p in places:
            table[128 + p] = ord(letter) - 96
            if letter != "s":
                table[160 + p] = ord(letter) - 96
    return table


CLASSES = _classes()


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letter classes of all texts, one EDGE around each stretch, and the text of each place."""
    joined = b"\n" + b"\n".join(texts) + b"\n"
    codes = CLASSES[np.frombuffer(joined, np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(ends, prepend=0))
    owner = np.append(np.int32(0), owner)
    breaks = np.zeros(len(codes), bool)
    breaks[0] = breaks[ends] = True
    keep = codes > 0
    codes, owner, breaks = codes[keep], owner[keep], breaks[keep]
    edge = codes == EDGE
    # An edge between two single letters of one text is skipped, and so is an edge after an edge.
    if len(codes) > 4:
        lone = np.zeros(len(codes), bool)
        lone[2:-2] = edge[2:-2] & edge[:-4] & edge[4:] & ~edge[1:-3] & ~edge[3:-1] & ~breaks[2:-2]
        codes, owner, edge = codes[~lone], owner[~lone], edge[~lone]
    again = edge.copy()
    again[1:] &= edge[:-1]
    again[:1] = False
    return codes[~again], owner[~again]


def stretch_scores(
    codes: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Start and machine value (without bias) of each stretch; only whole stretches count."""
    n = len(codes) - 1
    edges = np.flatnonzero(codes == EDGE)
    if len(edges) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    starts, lengths = edges[:-1], np.diff(edges)
    room = np.repeat(edges[1:], lengths) - np.arange(edges[0], n)  # places up to the next edge
    first = codes[edges[0] : n].astype(np.int32) << 15
    padded = np.concatenate([codes[edges[0] :], np.zeros(4, np.uint8)]).astype(np.int32)
    total = np.zeros(len(first), np.float32)
    square = np.zeros(len(first), np.float32)
    size = len(first)
    for (i, j, k), w in PATTERNS:
        code = first | (padded[i : i + size] << 10) | (padded[j : j + size] << 5) | padded[k : k + size]
        valid = room >= k
        total += np.where(valid, weights[code], 0) * np.float32(w)
        square += valid * np.float32(w * w)
    at = starts - edges[0]
    norm = np.sqrt(np.add.reduceat(square, at))
    value = np.add.reduceat(total, at) / np.maximum(norm, 1e-9)
    return starts, np.where(norm > 0, value, np.float32(FLOOR))


def subsequences(word: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of one stretch's subsequences, divided by their norm."""
    c = np.frombuffer(bytes([EDGE]) + word + bytes([EDGE]), np.uint8).astype(np.int64)
    codes, weights = [], []
    for (i, j, k), w in PATTERNS:
        m = len(c) - k
        if m > 0:
            codes.append(c[:m] << 15 | c[i : i + m] << 10 | c[j : j + m] << 5 | c[k : k + m])
            weights.append(np.full(m, w))
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0)
    code, weight = np.concatenate(codes), np.concatenate(weights)
    return code, weight / np.sqrt((weight * weight).sum())


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts a few megabytes at a time, with the place of the first of each chunk."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) < CHUNK_BYTES):
            size += len(texts[hi])
            hi += 1
        yield lo, texts[lo:hi]
        lo = hi


def _ranked(
    texts: list[bytes], weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letter classes; text, value and first place of each stretch, the worst of a text first."""
    codes, owner = encode(texts)
    starts, values = stretch_scores(codes, weights)
    # The edge before a stretch may belong to the text before it; its first letter does not.
    own = owner[np.minimum(starts + 1, len(owner) - 1)]
    real = values > FLOOR
    own, values, starts = own[real], values[real], starts[real]
    order = np.lexsort((-values, own))
    return codes, own[order], values[order], starts[order] + 1


def worst_stretches(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Per text the values of its WORST worst stretches, and the logarithm of how many it has."""
    out = np.full((len(texts), WORST + 1), FLOOR)
    out[:, -1] = 0
    for lo, part in chunks(texts):
        _, own, values, _ = _ranked(part, weights)
        has, first, counts = np.unique(own, return_index=True, return_counts=True)
        for k in range(WORST):
            deep = counts > k
            out[lo + has[deep], k] = np.maximum(values[first[deep] + k], FLOOR)
        out[lo + has, -1] = np.log(counts)
    return out


def worst_words(texts: list[bytes], weights: np.ndarray) -> dict[int, bytes]:
    """The worst stretch of each text that has one."""
    found = {}
    for lo, part in chunks(texts):
        codes, own, _, places = _ranked(part, weights)
        edges, raw = np.flatnonzero(codes == EDGE), codes.tobytes()
        has, first = np.unique(own, return_index=True)
        ends = edges[np.searchsorted(edges, places[first])]
        for t, a, b in zip(has.tolist(), places[first].tolist(), ends.tolist(), strict=True):
            found[lo + t] = raw[a:b]
    return found


@dataclass
class Machine:
    """Weight per subsequence, and the calibration of the worst stretches' values."""

    weights: np.ndarray
    slope: np.ndarray | None

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.slope is None:
            return np.zeros(len(texts))
        x = worst_stretches(texts, self.weights)
        return 1 / (1 + np.exp(-np.clip(x @ self.slope[:-1] + self.slope[-1], -30, 30)))


def _words(codes: np.ndarray, owner: np.ndarray, n: int) -> list[list[bytes]]:
    """The distinct stretches of each text."""
    found: list[set[bytes]] = [set() for _ in range(n)]
    edges = np.flatnonzero(codes == EDGE)
    raw = codes.tobytes()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a > 1:
            found[owner[a + 1]].add(raw[a + 1 : b])
    return [sorted(f) for f in found]


class Landmarks:
    """The subsequences of some stretches as a table: those that occur x landmarks."""

    def __init__(self, kinds: list[bytes]):
        parts = [subsequences(k) for k in kinds]
        self.codes = np.unique(np.concatenate([c for c, _ in parts]))
        self.row = np.full(_SIZE**4, len(self.codes), np.int32)  # others: the last row, all zero
        self.row[self.codes] = np.arange(len(self.codes))
        self.table = np.zeros((len(self.codes) + 1, len(kinds)))
        for c, (code, weight) in enumerate(parts):
            np.add.at(self.table[:, c], self.row[code], weight)

    def kernel(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]))
        for r, word in enumerate(words):
            code, weight = subsequences(word)
            out[r] = weight @ self.table[self.row[code]]
        return out

    def folded(self, alpha: np.ndarray) -> np.ndarray:
        """One weight per subsequence for the machine ``kernel @ alpha``."""
        weights = np.zeros(_SIZE**4, np.float32)
        weights[self.codes] = self.table[:-1] @ alpha
        return weights


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 300) -> np.ndarray:
    """Squared-hinge machine by accelerated gradient; the last column of x is the bias."""
    w, v, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    reach = 1 + 2 * np.linalg.norm(x * np.sqrt(cost)[:, None], 2) ** 2
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        step = v - (v - 2 * x.T @ (cost * y * slack)) / reach
        nxt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, v, t = step, step + (t - 1) / nxt * (step - w), nxt
    return w


def _calibrate(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic fit of the worst stretches' values, towards smoothed labels."""
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.hstack([x, np.ones((len(x), 1))])
    slope = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ slope, -30, 30)))
        grad = x.T @ (p - target) + 0.1 * slope
        hess = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        slope = slope - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return slope


def _runs(word: bytes) -> np.ndarray:
    """Codes of the runs of four letters, edges included."""
    c = np.frombuffer(bytes([EDGE]) + word + bytes([EDGE]), np.uint8).astype(np.int64)
    return c[:-3] << 15 | c[1:-2] << 10 | c[2:-1] << 5 | c[3:]


def fit(texts: list[bytes], labels: list[int], seed: int = 1) -> Machine:
    """The machine for a bounded sample of labelled texts."""
    label = np.array(labels, np.float64)
    if not (label == 1).any() or not (label == 0).any():
        return Machine(np.zeros(_SIZE**4, np.float32), None)
    rng = np.random.default_rng(seed)
    # First guess: how much likelier a run of four letters is in toxic documents.
    seen = np.zeros((2, _SIZE**4), np.float32)
    plain: list[bytes] = []
    for lo, part in chunks(texts):
        for t, words in enumerate(_words(*encode(part), len(part)), lo):
            if words:
                seen[int(label[t]), np.unique(np.concatenate([_runs(w) for w in words]))] += 1
                if label[t] == 0:
                    plain += [words[i] for i in rng.integers(0, len(words), PLAIN)]
    n = np.array([(label == 0).sum(), (label == 1).sum()])
    guess = np.log((np.maximum(seen[1] - 1, 0) + 0.3) / (n[1] + 1)) - np.log((seen[0] + 1) / (n[0] + 1))
    weights = np.where(seen[1] > 1, np.maximum(guess, 0), 0).astype(np.float32)
    del seen, guess
    for _ in range(ROUNDS):
        worst = worst_words(texts, weights)
        bad = [w for t, w in worst.items() if label[t] == 1]
        hard = [w for t, w in worst.items() if label[t] == 0]
        if not bad or not hard:
            break
        times = Counter(bad)
        kinds = sorted(times, key=lambda w: (-times[w], w))[: LANDMARKS // 2]
        others = sorted(set(hard + plain) - set(kinds))
        kinds += [others[i] for i in rng.permutation(len(others))[: LANDMARKS - len(kinds)]]
        landmarks = Landmarks(kinds)
        value, vector = np.linalg.eigh(landmarks.kernel(kinds))
        root = vector / np.sqrt(np.maximum(value, 1e-3)) @ vector.T
        x = landmarks.kernel(bad + hard + plain) @ root
        x = np.hstack([x, np.ones((len(x), 1))])
        y = np.concatenate([np.ones(len(bad)), -np.ones(len(hard) + len(plain))])
        cost = np.where(y > 0, COST / len(bad), COST / (len(hard) + len(plain)))
        w = _svm(x, y, cost)
        weights = landmarks.folded(root @ w[:-1])
    return Machine(weights, _calibrate(worst_stretches(texts, weights), label))


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning, by their id; none without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fits on at most ``sample`` documents per class, drawn by hash from the rows not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
    )
    drawn = None
    for y in (0, 1):
        part = known.where(F.col("_toxic") == y).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most 2 * sample rows, whatever the size of the tables.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
        .select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), "_toxic")
        .orderBy("doc_id", "text")
        .limit(4 * sample)
        .collect()
    )
    return fit([bytes(r["text"]) for r in rows], [int(r["_toxic"]) for r in rows])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``toxicity``, the score of the whole text."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(machine)  # 4 MB, whatever the corpus
    schema = docs.withColumn("toxicity", F.lit(0.0)).schema
    names = docs.columns
    place = names.index("text")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(place).cast(pa.binary()).to_pylist()]
            column = pa.array(shipped.value.scores(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, column], names=[*names, "toxicity"]
            )

    return docs.mapInArrow(judged, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def clean_documents(docs: DataFrame, machine: Machine, least: float = 0.5) -> DataFrame:
    """The documents that score below ``least``, with the columns of ``docs``.

    Documents travel under new names, so a column called like a working column does no harm; all columns do,
    so they travel ``BATCH_ROWS`` at a time and the result is staged.
    """
    names = docs.columns
    plain = docs.toDF(*[n if n == "text" else f"c{i}" for i, n in enumerate(names)])
    with scratch(docs.sparkSession, arrow_rows=BATCH_ROWS) as result:
        return result(score(plain, machine).where(F.col("toxicity") < least).drop("toxicity").toDF(*names))
