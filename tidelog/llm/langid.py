"""Language identification (operator 7).

One interpolated Kneser-Ney character model per language, all kept in arrays sorted by
n-gram hash that hold a column for each language. A text belongs to the language of lowest
cross-entropy per character. Texts whose cross-entropy lies far above that of labelled texts
kept out of training (by a margin that widens for short texts) are rejected.

Texts are folded before: letters in lower case, every run of other characters one space. The models
learn from a bounded sample of labelled rows, at most SAMPLE_ROWS for each
language, chosen by a hash of doc_id among texts of up to SAMPLE_CHARS characters (longer ones only
where a language has too few); every text is scored whole.

A null text, and one without a letter, is `und` with score 0 and is rejected. Without labelled rows nothing is
learned: all texts are `und` with score 0, and those with a letter are accepted. Rows are independent; repeats
and ties in the sample are harmless (the languages' names break ties of predictions). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import small_batches, thrifty

ORDER = 4
DISCOUNT = 0.75
SAMPLE_ROWS = 200
SAMPLE_CHARS = 20_000
#: Size of the alphabet that the uniform model at the bottom spreads over.
ALPHABET = 1 << 16
#: Texts count as this long at most when cross-entropies become a score.
SCORE_CHARS = 50
#: Rejection: standard deviations among texts, and among a text's characters.
TEXT_MARGIN, CHAR_MARGIN, TEXT_SD = 8.0, 4.0, 0.1
#: Share of the sample that calibrates the rejection.
CALIBRATION = 5
#: Characters scored at once.
CHUNK = 500_000
UNDETERMINED = "und"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SPACE = 32


# ---------------------------------------------------------------- folding and hashing


class Folder:
    """Code points to lower-case letters or spaces; tables are made once a process."""

    def __init__(self) -> None:
        self.table = np.full(1 << 16, SPACE, np.uint32)
        for c in range(1 << 16):
            if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
                low = chr(c).lower()
                self.table[c] = ord(low) if len(low) == 1 else c

    def __call__(self, text: str) -> np.ndarray:
        """The folded text after ORDER - 1 spaces."""
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        high = codes > 0xFFFF
        out = self.table[np.where(high, 0, codes)]
        if high.any():
            rare, inverse = np.unique(codes[high], return_inverse=True)
            out[high] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else SPACE for c in rare.tolist()], np.uint32)[inverse]
        space = out == SPACE
        out = out[~(space & np.concatenate(([True], space[:-1])))]
        return np.concatenate((np.full(ORDER - 1, SPACE, np.uint32), out))


_folder: list[Folder] = []


def fold(text: str) -> np.ndarray:
    if not _folder:
        _folder.append(Folder())
    return _folder[0](text)


def gram_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """At index k - 1, the hash of the k characters that end at each position."""
    c = (codes.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
    c ^= c >> np.uint64(32)
    c *= np.uint64(0xD6E8FEB86659FD93)
    out = [c]
    for k in range(1, ORDER):
        h = np.zeros(len(c), np.uint64)
        h[k:] = out[-1][k - 1 : -1] if k == 1 else out[-1][k - 1 : -1]
        h = (h * _MULTIPLIER) ^ c
        out.append(h)
    return out


# ---------------------------------------------------------------- training


@dataclass
class Level:
    """The n-grams of one length: probabilities of their last character, and the weight that a context leaves to the level below."""

    keys: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


@dataclass
class Model:
    languages: list[str]
    levels: list[Level]
    floor: np.ndarray
    #: By language: mean cross-entropy of calibration texts, deviation among texts, deviation among characters.
    mean: np.ndarray | None = None
    text_sd: np.ndarray | None = None
    char_sd: np.ndarray | None = None

    def log_probabilities(self, hashes: list[np.ndarray], at: np.ndarray, k: int = ORDER) -> np.ndarray:
        """For the characters at the given positions, a column for each language."""
        if k == 0:
            return np.broadcast_to(self.floor, (len(at), len(self.languages))).astype(np.float32)
        level, h = self.levels[k - 1], hashes[k - 1][at]
        i = np.minimum(np.searchsorted(level.keys, h), len(level.keys) - 1)
        out = level.logp[i]
        miss = np.flatnonzero(level.keys[i] != h)
        if len(miss):
            rest = at[miss]
            below = self.log_probabilities(hashes, rest, k - 1)
            if k > 1:
                c = hashes[k - 2][rest - 1]
                j = np.minimum(np.searchsorted(level.contexts, c), len(level.contexts) - 1)
                known = level.contexts[j] == c
                below = below + np.where(known[:, None], level.backoff[j], 0)
            out[miss] = below
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy of each text under each language, number of characters scored (0: no letter), and the deviation of the best language's."""
        folded = [fold(t) if t else np.zeros(0, np.uint32) for t in texts]
        n = np.array([max(0, len(f) - ORDER + 1) if (f != SPACE).any() else 0 for f in folded], np.int64)
        total = np.zeros((len(texts), len(self.languages)))
        square = np.zeros_like(total)
        some = np.flatnonzero(n).tolist()
        at = 0
        while at < len(some):
            end, size = at, 0
            while end < len(some) and (end == at or size + n[some[end]] <= CHUNK):
                size += n[some[end]]
                end += 1
            mine = some[at:end]
            codes = np.concatenate([folded[k] for k in mine])
            hashes = gram_hashes(codes)
            lengths = np.array([len(folded[k]) for k in mine])
            begins = np.cumsum(lengths) - lengths
            scored = np.ones(len(codes), bool)
            for s in range(ORDER - 1):
                scored[begins + s] = False
            p = self.log_probabilities(hashes, np.flatnonzero(scored))
            cut = np.cumsum(n[mine]) - n[mine]
            total[mine] = np.add.reduceat(p, cut, axis=0, dtype=np.float64)
            square[mine] = np.add.reduceat(p * p, cut, axis=0, dtype=np.float64)
            at = end
        size = np.maximum(n, 1)[:, None]
        mean = -total / size
        return mean, n, np.sqrt(np.maximum(square / size - mean**2, 0))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and acceptance of each text."""
        if not self.languages:
            letters = np.array([bool(t) and bool((fold(t) != SPACE).any()) for t in texts], bool)
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), letters
        entropy, n, _ = self.entropies(texts)
        best = entropy.argmin(axis=1)
        low = entropy.min(axis=1)
        weight = np.exp(-(entropy - low[:, None]) * np.minimum(n, SCORE_CHARS)[:, None])
        score = np.where(n > 0, 1 / weight.sum(axis=1), 0.0)
        limit = np.full(len(texts), np.inf)
        if self.mean is not None:
            limit = self.mean[best] + TEXT_MARGIN * self.text_sd[best] + CHAR_MARGIN * self.char_sd[best] / np.sqrt(np.maximum(n, 1))
        names = [self.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), n.tolist())]
        return names, score, (n > 0) & (low <= limit)


def _counts(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    folded = [f for t in texts if len(f := fold(t)) >= ORDER]
    codes = np.concatenate(folded) if folded else np.zeros(0, np.uint32)
    lengths = np.array([len(f) for f in folded], np.int64)
    begins = np.cumsum(lengths) - lengths
    scored = np.ones(len(codes), bool)
    for s in range(ORDER - 1):
        scored[begins + s] = False
    return gram_hashes(codes), np.flatnonzero(scored)


def _language_tables(texts: list[str]) -> list[tuple]:
    """For each length: n-grams, their counts (continuation counts below the top), contexts and suffixes, all as hashes."""
    hashes, at = _counts(texts)
    out: list[tuple] = [()] * ORDER
    above: np.ndarray | None = None  # positions of one example of each longer n-gram
    for k in range(ORDER, 0, -1):
        where = at if above is None else above
        keys, example, count = np.unique(hashes[k - 1][where], return_index=True, return_counts=True)
        example = where[example]
        context = hashes[k - 2][example - 1] if k > 1 else np.zeros(len(keys), np.uint64)
        suffix = hashes[k - 2][example] if k > 1 else np.zeros(len(keys), np.uint64)
        out[k - 1] = keys, count.astype(np.float64), context, suffix
        above = example
    return out


def train(samples: dict[str, list[str]]) -> Model:
    """Kneser-Ney models of the samples' languages."""
    languages = sorted(samples)
    tables = {name: _language_tables(samples[name]) for name in languages}
    languages = [name for name in languages if len(tables[name][0][0])]
    floor = np.full(len(languages), -np.log(ALPHABET), np.float32)
    levels: list[Level] = []
    for k in range(1, ORDER + 1):
        every = [tables[name][k - 1] for name in languages]
        keys, index = np.unique(np.concatenate([t[0] for t in every]), return_index=True) if every else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        context = np.concatenate([t[2] for t in every])[index] if every else keys
        suffix = np.concatenate([t[3] for t in every])[index] if every else keys
        contexts = np.unique(context)
        logp = np.empty((len(keys), len(languages)), np.float32)
        backoff = np.zeros((len(contexts), len(languages)), np.float32)
        place = np.searchsorted(contexts, context)
        for l, (own, count, own_context, _) in enumerate(every):
            c = np.searchsorted(contexts, own_context)
            total = np.bincount(c, weights=count, minlength=len(contexts))
            kinds = np.bincount(c, minlength=len(contexts))
            left = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            backoff[:, l] = np.log(left)
            mine = np.zeros(len(keys))
            mine[np.searchsorted(keys, own)] = np.maximum(count - DISCOUNT, 0)
            if k == 1:
                below = np.full(len(keys), 1 / ALPHABET)
            else:
                low = levels[-1]
                below = np.exp(low.logp[np.searchsorted(low.keys, suffix), l].astype(np.float64))
            logp[:, l] = np.log(mine / np.maximum(total[place], 1) + left[place] * below)
        if k == 1 and len(languages):
            floor = floor + backoff[0]
        levels.append(Level(keys, logp, contexts, backoff))
    return Model(languages, levels, floor)


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model of (language, text) rows; every CALIBRATION-th row of a language calibrates the rejection, all others and, in the end, all rows train."""
    by: dict[str, list[str]] = {}
    for name, text in rows:
        by.setdefault(name, []).append(text)
    part = train({name: [t for k, t in enumerate(texts) if k % CALIBRATION or len(texts) < CALIBRATION] for name, texts in by.items()})
    model = train(by)
    if part.languages == model.languages and part.languages:
        figures = [_calibration(part, by[name][::CALIBRATION]) for name in model.languages]
        known = np.array([f for f in figures if f is not None])
        if len(known):
            rows = np.array([f if f is not None else known.max(axis=0) for f in figures])
            model.mean, model.text_sd, model.char_sd = rows.T
    return model


def _calibration(model: Model, texts: list[str]) -> tuple[float, float, float] | None:
    """Mean of texts' lowest cross-entropies, deviation among texts (TEXT_SD at least) and among characters."""
    entropy, n, deviation = model.entropies(texts)
    ok = n > 0
    if not ok.any():
        return None
    low, best, weight = entropy[ok].min(axis=1), entropy[ok].argmin(axis=1), n[ok]
    mean = float(np.average(low, weights=weight))
    text_sd = float(np.sqrt(np.average((low - mean) ** 2, weights=weight)))
    return mean, max(TEXT_SD, text_sd), float(np.average(deviation[ok][np.arange(ok.sum()), best], weights=weight))


# ---------------------------------------------------------------- tables


def held_out():
    """Rows that no model learns from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)).eqNullSafe(2)


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """The bounded training sample: at most SAMPLE_ROWS rows of each language.

    A window's rank limit is applied before its shuffle, so that a language with most rows sends few.
    """
    text = F.col("text").cast("string")
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), (F.length(text) > SAMPLE_CHARS).alias("long"), F.xxhash64("doc_id").alias("draw"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("long", "draw", "doc_id"))
    chosen = known.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS).drop("rank").collect()
    ids = sorted({r.doc_id for r in chosen})
    if not ids:
        return []
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.join(F.broadcast(wanted), "doc_id", "left_semi").collect()  # SAMPLE_ROWS ids a language at most
    return [(r.lang, r.text) for r in sorted(rows, key=lambda r: (r.doc_id, r.lang, r.text))]


def predict(docs: DataFrame, model: Model | None = None, prefix: str = "lang_") -> DataFrame:
    """docs with three columns of that prefix, which replace any of their names: pred, score and accepted. Without a model, one is fitted on docs' labelled rows."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model or fit(sample(docs)))
    more = [T.StructField(f"{prefix}pred", T.StringType()), T.StructField(f"{prefix}score", T.DoubleType()), T.StructField(f"{prefix}accepted", T.BooleanType())]
    docs = docs.drop(*(f.name for f in more))
    schema = T.StructType([*docs.schema.fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, accepted = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())], names=schema.names)

    return docs.mapInArrow(thrifty(run), schema)


def query(docs: DataFrame) -> DataFrame:
    model = fit(sample(docs))
    out = predict(docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out().alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_accepted").alias("accepted"))


def keep_accepted(docs: DataFrame) -> DataFrame:
    """docs without the rows that the models reject."""
    return predict(docs, fit(sample(docs)), "__lang_").where("__lang_accepted").select(*docs.columns)
