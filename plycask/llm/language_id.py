"""Language identification by a sparse linear model of character n-grams.

Features are hashed n-grams of one to four characters within the lower-cased words of a text (runs of
letters, with a blank before and after); a feature's value is its share of the text's n-grams times its inverse
document frequency.  A multinomial logistic regression learns from them by follow-the-regularised-leader
with an elastic-net penalty, which leaves most weights at exactly zero.  A temperature, fitted on rows
held back from training, then scales the scores so that the probability of the prediction is calibrated.

Every label is learned.  Fitting takes a bounded sample of each (an even share of ``max_train_docs``, but
``min_label_docs`` at least, of texts up to ``max_train_chars``; longer ones are left out, not cut).  A label
without a text that short gives its ``min_label_docs`` shortest.  Predictions read every text whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plycask.llm.words import LONGEST_KEY, freeing, texts_of

UNDETERMINED = "und"
#: A word begins with a letter (not a numeral or a sign that is only used like one); marks belong to the letter before them.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_ORDERS = (1, 2, 3, 4)
#: Odd multipliers, one for each place in an n-gram.
_PLACES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@dataclass(frozen=True)
class Fit:
    """max_train_docs and min_label_docs bound the sample, 1 << bits the features; with so many labels that there were more than max_weights, there are fewer features."""

    max_train_docs: int = 2_000
    min_label_docs: int = 8
    max_train_chars: int = 20_000
    bits: int = 17
    max_weights: int = 1 << 24
    epochs: int = 2
    alpha: float = 0.5
    beta: float = 0.05
    l1: float = 2e-4
    l2: float = 1e-4
    scale: float = 8.0


def ngrams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each word with a blank before and after it, and for each n-gram the word's number."""
    codes = np.frombuffer("".join([f" {word} \n" for word in words]).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 3
    of = np.repeat(np.arange(len(words)), sizes)
    inside = codes != 10
    found, owners = [], []
    total, valid = np.zeros(len(codes), np.uint32), np.ones(len(codes), bool)
    for order in _ORDERS:
        n = len(codes) - order + 1
        if n <= 0:
            break
        total = total[:n] + codes[order - 1 :] * _PLACES[order - 1]
        valid = valid[:n] & inside[order - 1 :]
        x = total[valid] ^ np.uint32(order * 0x632BE5AB & 0xFFFFFFFF)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        found.append((x ^ (x >> np.uint32(13))) >> np.uint32(32 - bits))
        owners.append(of[:n][valid])
    return np.concatenate(found), np.concatenate(owners)


def features_of(text: str, bits: int) -> np.ndarray:
    """Hashed n-grams of a text, repeated ones repeated; none where the text has no letter."""
    words = _LETTERS.findall(text.lower())
    return ngrams(words, bits)[0] if words else np.empty(0, np.uint32)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class LanguageModel:
    """labels; table: a row of weights times inverse document frequency for each feature; bias; temperature."""

    def __init__(self, labels: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, fit: Fit):
        self.labels, self.table, self.bias, self.temperature, self.fit = labels, table, bias, temperature, fit

    @classmethod
    def train(cls, texts: list[str], labels: list[str], fit: Fit = Fit()) -> "LanguageModel":
        """The order of the rows decides nothing but the order of the updates; every fifth row, unless it is the first of its label, is held back for the temperature."""
        names = sorted(set(labels))
        k = len(names)
        fit = replace(fit, bits=max(1, min(fit.bits, (fit.max_weights // k).bit_length() - 1)))
        size = 1 << fit.bits
        number = {name: i for i, name in enumerate(names)}
        rows, targets = [], []
        df = np.zeros(size)
        for text, label in zip(texts, labels, strict=True):
            found, counts = np.unique(features_of(text, fit.bits), return_counts=True)
            if len(found):
                rows.append((found, counts / counts.sum()))
                targets.append(number[label])
                df[found] += 1
        idf = np.log((1 + len(rows)) / (1 + df)) + 1
        rows = [(found, share * idf[found] * fit.scale) for found, share in rows]
        first = {targets[i]: i for i in reversed(range(len(rows)))}
        held = [i for i in range(len(rows)) if i % 5 == 4 and first[targets[i]] != i]
        learn = [i for i in range(len(rows)) if i % 5 != 4 or first[targets[i]] == i]
        z, n = np.zeros((size, k)), np.zeros((size, k))
        z_bias, n_bias, bias = np.zeros(k), np.zeros(k), np.zeros(k)

        def weights(at: np.ndarray | slice) -> np.ndarray:
            zs = z[at]
            w = -(zs - np.sign(zs) * fit.l1) / ((fit.beta + np.sqrt(n[at])) / fit.alpha + fit.l2)
            return np.where(np.abs(zs) <= fit.l1, 0.0, w)

        rng = np.random.default_rng(20)
        for _ in range(fit.epochs):
            for i in rng.permutation(learn):
                found, x = rows[i]
                w = weights(found)
                p = _softmax(x @ w + bias)
                p[targets[i]] -= 1
                g = np.outer(x, p)
                n_now = n[found]
                sigma = (np.sqrt(n_now + g * g) - np.sqrt(n_now)) / fit.alpha
                z[found] += g - sigma * w
                n[found] = n_now + g * g
                # The bias is a coordinate like the others, without a penalty.
                z_bias += p - (np.sqrt(n_bias + p * p) - np.sqrt(n_bias)) / fit.alpha * bias
                n_bias += p * p
                bias = -z_bias / ((fit.beta + np.sqrt(n_bias)) / fit.alpha)
        table = np.empty((size, k), np.float32)
        for at in range(0, size, step := max(1, (1 << 20) // k)):
            table[at : at + step] = weights(slice(at, at + step)) * idf[at : at + step, None] * fit.scale
        scores = np.array([x @ weights(found) + bias for found, x in (rows[i] for i in held)]).reshape(-1, k)
        wanted = np.array([targets[i] for i in held], int)
        return cls(names, table, bias, cls.calibrate(scores, wanted), fit)

    @staticmethod
    def calibrate(scores: np.ndarray, wanted: np.ndarray) -> float:
        """The temperature of least negative log-likelihood, by golden-section search; 1 without rows."""
        if not len(wanted):
            return 1.0

        def loss(log_t: float) -> float:
            p = _softmax(scores / np.exp(log_t))
            return -np.log(p[np.arange(len(wanted)), wanted] + 1e-12).mean()

        low, high, golden = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
        for _ in range(60):
            a, b = high - golden * (high - low), low + golden * (high - low)
            if loss(a) < loss(b):
                high = b
            else:
                low = a
        return float(np.exp((low + high) / 2))

    def predict(self, texts: list[str], memory: "ChunkScores") -> list[tuple[str, float]]:
        """Label and probability of each text."""
        if not self.labels:
            return [(UNDETERMINED, 0.0)] * len(texts)
        found = []
        for text in texts:
            sums = memory.sums(text)
            if not sums[0]:
                found.append((UNDETERMINED, 0.0))
                continue
            p = _softmax((sums[1:] / sums[0] + self.bias) / self.temperature)
            best = int(p.argmax())
            found.append((self.labels[best], float(p[best])))
        return found


class ChunkScores:
    """For chunks of text between blanks: the number of n-grams and the sums of their weights; those seen are remembered, in at most about ``most`` bytes."""

    def __init__(self, model: LanguageModel, most: int = 32 << 20):
        columns = 1 + len(model.labels)
        # Chunks remembered, and chunks scored at a time: fewer where a chunk has many scores.
        self.model, self.limit, self.step = model, max(1, most // (8 * columns + 160)), max(64, (1 << 17) // columns)
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1 << 10, 1 + len(model.labels)))

    def scored(self, chunks: list[str]) -> np.ndarray:
        """A row for each chunk."""
        words, owner = [], []
        for i, chunk in enumerate(chunks):
            for word in _LETTERS.findall(chunk.lower()):
                words.append(word)
                owner.append(i)
        rows = np.zeros((len(chunks), self.rows.shape[1]))
        if words:
            found, of = ngrams(words, self.model.fit.bits)
            of = np.array(owner)[of]
            rows[:, 0] = np.bincount(of, minlength=len(chunks))
            weights = self.model.table[found]
            for label in range(weights.shape[1]):
                rows[:, 1 + label] = np.bincount(of, weights[:, label], len(chunks))
        return rows

    def learn(self, chunks: list[str]) -> None:
        """Scores chunks that are new, all in one go."""
        first = len(self.at)
        if first + len(chunks) > len(self.rows):
            rows = np.zeros((max(2 * len(self.rows), first + len(chunks)), self.rows.shape[1]))
            rows[:first] = self.rows[:first]
            self.rows = rows
        self.rows[first : first + len(chunks)] = self.scored(chunks)
        self.at.update(zip(chunks, range(first, first + len(chunks)), strict=True))

    def sums(self, text: str) -> np.ndarray:
        chunks = text.split()
        total = np.zeros(self.rows.shape[1])
        for start in range(0, len(chunks), self.step):
            total += self._sums(chunks[start : start + self.step])
        return total

    def _sums(self, chunks: list[str]) -> np.ndarray:
        total = np.zeros(self.rows.shape[1])
        if long := [chunk for chunk in chunks if len(chunk) > LONGEST_KEY]:
            for chunk in long:
                total += self.scored([chunk])[0]
            chunks = [chunk for chunk in chunks if len(chunk) <= LONGEST_KEY]
        if len(self.at) > self.limit:
            self.at.clear()
        at = list(map(self.at.get, chunks))
        if None in at:
            self.learn(list(dict.fromkeys(chunk for chunk, i in zip(chunks, at, strict=True) if i is None)))
            at = list(map(self.at.__getitem__, chunks))
        return total + self.rows[at].sum(axis=0)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3


def sample(docs: DataFrame, may_learn: Column, fit: Fit = Fit()) -> list[tuple[str, str]]:
    """Texts and labels to fit on: of each label the rows that come first by a hash of their id, in that order; the shortest where all are too long.

    How many rows a label has tells below which hash its first ones lie, but for a little: only these rows are
    shuffled, so a label that most rows have is no more work for its task than any other.
    """
    known = docs.select("doc_id", "text", "lang").where(may_learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    long = F.length("text") > fit.max_train_chars
    counts = known.groupBy("lang").agg(F.count_if(~long).alias("short"), F.count_if(long).alias("long")).collect()
    if not counts:
        return []
    share = max(1, fit.min_label_docs, fit.max_train_docs // len(counts))
    wanted = {row.lang: min(share, row.short) if row.short else min(row.long, max(1, fit.min_label_docs)) for row in counts}
    found: list = []
    for slack in (12.0, math.inf):  # the second only where ids that repeat made the hashes of a label lie badly
        missing = [row for row in counts if sum(x.lang == row.lang for x in found) < wanted[row.lang]]
        if not missing:
            break
        found = [x for x in found if x.lang not in {row.lang for row in missing}]
        bounds = [(row.lang, not row.short, wanted[row.lang], _below(share + slack * (share**0.5 + 4), row.short)) for row in missing]
        bounds = docs.sparkSession.createDataFrame(bounds, "lang string, of_long boolean, n long, bound long")
        order = Window.partitionBy("lang").orderBy("size", "hash", "doc_id", "text")
        rows = known.join(F.broadcast(bounds), "lang").withColumn("hash", F.xxhash64("doc_id", F.lit(9)))
        rows = rows.where((long == F.col("of_long")) & (F.col("of_long") | (F.col("hash") <= F.col("bound"))))
        rows = rows.withColumn("size", F.when(long, F.length("text")).otherwise(0)).withColumn("place", F.row_number().over(order))
        found += rows.where(F.col("place") <= F.lit(share)).where("place <= n").select("text", "lang", "place").collect()
    return [(row.text, row.lang) for row in sorted(found, key=lambda row: (row.place, row.lang))]


def _below(wanted: float, of: int) -> int:
    """The hash below which about that many lie, of so many."""
    return min(2**63 - 1, int(-(2.0**63) + 2.0**64 * min(1.0, wanted / max(1, of)))) if wanted < of else 2**63 - 1


def train(docs: DataFrame, may_learn: Column, fit: Fit = Fit()) -> LanguageModel:
    """A model of the rows for which may_learn holds; without any it predicts `und` for every text."""
    pairs = sample(docs, may_learn, fit)
    if not pairs:
        return LanguageModel([], np.zeros((1 << fit.bits, 0), np.float32), np.zeros(0), 1.0, fit)
    return LanguageModel.train([text for text, _ in pairs], [label for _, label in pairs], fit)


def predict(docs: DataFrame, model: LanguageModel, columns: list[str]) -> DataFrame:
    """docs' named columns with lang_pred and score for every whole text, `und` and 0 where it is null or has no letter.

    The model, of at most max_weights weights (or two a label), is broadcast.  One narrow stage.  The names lang_pred
    and score must not be among the columns.  An empty table gives no row.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(*dict.fromkeys([*columns, "text"]))
    schema = ", ".join([*(f"`{name}` {kept.schema[name].dataType.simpleString()}" for name in columns), "lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = ChunkScores(shared.value)
        for batch, texts in texts_of(batches):
            found = shared.value.predict(texts, memory)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in columns), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*columns, "lang_pred", "score"],
            )

    return kept.mapInArrow(freeing(run), schema)


def identify(docs: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """The predicted language of every document, learned from those that are not held out.

    Columns: doc_id, held_out (the id's crc32 modulo 3 is 1), lang_pred, score (calibrated, 0 to 1).
    Learns from text and non-null lang of rows that are not held out; lang, source and doc_id are no
    features.  A null doc_id stays null, is not held out and not learned from.  Repeated rows each
    give a row.  Only doc_id, text and lang are read.
    """
    model = train(docs, remainder(F.col("doc_id")) != 1, fit)
    held = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", "text", held), model, ["doc_id", "held_out"])


def reject_unknown(docs: DataFrame, min_score: float = 0.4, fit: Fit = Fit()) -> DataFrame:
    """Documents whose language is determined with at least min_score, with their own columns.

    Learns from all labelled rows.  Texts without a letter go, and so do those that fit no language.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    model = train(docs, F.lit(True), fit)
    own = docs.toDF(*names)
    judged = predict(own.withColumn("text", F.col(names[docs.columns.index("text")])), model, names)
    judged = judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return judged.select(*(F.col(name).alias(own_name) for name, own_name in zip(names, docs.columns, strict=True)))
