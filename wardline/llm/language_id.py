"""Language identification with error-correcting output codes.

Every learned language has a codeword; for each bit a binary naive-Bayes classifier over hashed
character 2- and 3-grams tells the languages with that bit set from those without. A text goes to
the language whose codeword loses least against the margins, reliable bits weighing more.

How far a text may be from its language is learned as well. An eighth of the labelled texts is set aside, a model of
the others places them, and the furthest of them set limits. A text is ``far``, like random letters or an unknown
script, if its mean margins lie LIMIT times further from those of its nearest codeword's language, and if its grams are as
much rarer than a learned language's. A text in two languages has margins between theirs and grams that are known:
it is ambiguous, but not far.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_text, slices, table, unsigned_crc32_mod

DIMENSIONS = 4096
#: Bytes of text whose grams are counted at once: a text's characters take some fifty bytes each meanwhile.
STEP_BYTES = 1 << 20
UNKNOWN = "und"
#: Of the labelled texts set aside this share is near enough, and a text may be LIMIT times as far as they are.
NEAR, LIMIT = 0.999, 1.5
#: A text this far on the way from its language to the next is between them.
BETWEEN = 0.35
#: What texts of one language differ by in their mean margins however long they are, as a share of these.
SPREAD = 0.15
MAX_LANGUAGES = 2048
_LETTERS: list[np.ndarray] = []


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # dimensions x bits
    reliability: np.ndarray  # bits, mean margin between the two sides
    means: np.ndarray  # languages x bits, mean margin of a gram
    spreads: np.ndarray  # languages x bits, variance of it
    known: np.ndarray  # dimensions, logarithm of a gram's share in the language that has it most
    usual: tuple[float, float] = (0.0, 1.0)  # mean of that over the grams of a language, and variance
    limits: tuple[float, float] = (np.inf, np.inf)  # how far a text may be from its language, and how rare its grams


def codewords(n: int) -> np.ndarray:
    """All splits of ``n`` languages in two up to 6 of them, else 12 splits for each doubling."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        splits = itertools.product((1, -1), repeat=n - 1)
        return np.array([(1, *s) for s in splits if -1 in s], dtype=float).T
    bits = 12 * int(np.ceil(np.log2(n)))
    rng = np.random.default_rng(7)
    while True:
        codes = np.where(rng.random((n, bits)) < 0.5, 1.0, -1.0)
        if (np.abs(codes.sum(axis=0)) < n).all():
            return codes


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed 2- and 3-grams (texts x DIMENSIONS), and which texts have letters.

    Texts are lower-cased and every run of other characters is one space. The whole text counts.
    """
    n = len(texts)
    lowered = [" " + t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(n), [len(t) for t in lowered])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of each run of other characters
    keep[0] = True
    some = np.bincount(owner[letter], minlength=n) > 0
    code, who = np.where(letter, codes, 32)[keep], owner[keep]
    with np.errstate(over="ignore"):
        two = code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + code[2:] * np.uint32(0x27D4EB2F)
        shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
        two, three = (two * np.uint32(0x165667B1)) >> shift, (three * np.uint32(0x165667B1)) >> shift
    same2, same3 = who[1:] == who[:-1], who[2:] == who[:-2]
    keys = np.concatenate([(who[:-1] * DIMENSIONS + two)[same2], (who[:-2] * DIMENSIONS + three)[same3]])
    return np.bincount(keys, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS), some


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows that have a language: one pass for sums by language and gram, one over an eighth for the limit.

    What reaches the driver is twice DIMENSIONS numbers per language. Rows with null text teach nothing. Over
    MAX_LANGUAGES languages raise. The eighth is chosen by the texts' hashes; without any such text there is no limit.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, bool], np.ndarray] = {}
        for batch in slices(batches, "text", STEP_BYTES):
            counts, _ = gram_counts(as_text(batch.column("text")))
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            aside = batch.column("aside").to_numpy(zero_copy_only=False)
            for name in sorted(set(langs)):
                for side in (False, True):
                    part = counts[(langs == name) & (aside == side)].sum(axis=0)
                    sums[name, side] = sums.get((name, side), 0) + part
        for (name, side), values in sums.items():
            some = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(some), pa.string()),
                    pa.array([side] * len(some), pa.bool_()),
                    pa.array(some, pa.int64()),
                    pa.array(values[some], pa.int64()),
                ],
                ["lang", "aside", "gram", "n"],
            )

    aside = (F.pmod(F.xxhash64(F.col(text)), F.lit(8)) == 0).alias("aside")
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), aside).where(
        "text is not null and lang is not null"
    )
    languages = [r["lang"] for r in known.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    sums = (
        arrow_map(known, count, "lang string, aside boolean, gram long, n long")
        .groupBy("lang", "aside", "gram")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang", "aside")
        .agg(F.collect_list(F.struct("gram", "n")).alias("grams"))
        .collect()
    )
    raw = np.zeros((2, len(languages), DIMENSIONS))
    for r in sums:
        for g in r["grams"]:
            raw[int(r["aside"]), languages.index(r["lang"]), g["gram"]] = g["n"]
    model = _model(languages, raw.sum(axis=0))
    if not languages or not raw[1].any():
        return model
    trial = _model(languages, raw[0])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", STEP_BYTES):
            counts, some = gram_counts(as_text(batch.column("text")))
            best, second, _ = decode(trial, counts[some])
            _, away, rarer = placed(trial, counts[some], best, second)
            yield pa.RecordBatch.from_pydict({"away": away, "rarer": rarer})

    seen = arrow_map(known.where("aside").select("text"), place, "away double, rarer double")
    limits = seen.agg(*(F.percentile_approx(c, NEAR, 10_000).alias(c) for c in ("away", "rarer"))).first()
    if limits["away"] is not None:
        model.limits = LIMIT * limits["away"], LIMIT * max(limits["rarer"], 1.0)
    return model


def is_far(model: LanguageModel, away: np.ndarray, rarer: np.ndarray) -> np.ndarray:
    return (away > model.limits[0]) & (rarer > model.limits[1])


def _model(languages: list[str], raw: np.ndarray) -> LanguageModel:
    """Classifiers of all bits out of gram counts by language."""
    codes = codewords(len(languages))
    if not languages:
        return LanguageModel([], codes, np.zeros((DIMENSIONS, 1), np.float32), np.ones(1), *np.zeros((2, 0, 1)), np.zeros(DIMENSIONS))
    raw = raw + 0.5
    shares = raw / raw.sum(axis=1, keepdims=True)
    weights = np.zeros((DIMENSIONS, codes.shape[1]))
    for b, side in enumerate(codes.T):
        if (side > 0).any() and (side < 0).any():
            weights[:, b] = np.log(shares[side > 0].mean(axis=0) / shares[side < 0].mean(axis=0))
    margins = shares @ weights  # languages x bits
    reliability = np.maximum((margins * codes).mean(axis=0), 1e-9)
    spreads = shares @ weights**2 - margins**2
    known = np.log(shares.max(axis=0))
    usual = float((shares @ known).mean())
    usual = usual, float((shares @ (known - usual) ** 2).mean())
    weights, reliability = weights.astype(np.float32), reliability / reliability.sum()
    return LanguageModel(languages, codes, weights, reliability, margins, spreads, known, usual)


def placed(
    model: LanguageModel, counts: np.ndarray, best: np.ndarray, second: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How far each text is on the way from its language's mean margins to the second's, 0 to 1; how far it is from its
    language's; and how far its grams are rarer than grams are in any learned language.

    The last two are in standard errors, so they mean the same for short and long texts.
    """
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    margins = counts @ model.weights.astype(float) / total
    off, way = margins - model.means[best], model.means[second] - model.means[best]
    length = np.maximum((way**2).sum(axis=1), 1e-12)
    along = np.clip((off * way).sum(axis=1) / length, 0, 1) * (best != second)
    floor = np.maximum(SPREAD * np.abs(model.means[best]).mean(axis=1, keepdims=True), 1e-6)
    away = np.sqrt((off**2 / (model.spreads[best] / total + floor**2)).mean(axis=1))
    usual, spread = model.usual
    rarer = (usual - counts @ model.known / total[:, 0]) / np.sqrt(spread / total[:, 0] + (SPREAD**2) * spread / 16)
    return along, away, rarer


def decode(model: LanguageModel, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best and second-best language of each row, and the best one's share of the likelihood."""
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    margins = counts @ model.weights.astype(float) / np.sqrt(total)
    margins = np.clip(margins, -30, 30)
    loss = np.zeros((len(counts), len(model.languages)))
    for k, code in enumerate(model.codes):
        loss[:, k] = np.log1p(np.exp(-margins * code)) @ model.reliability
    order = np.argsort(loss, axis=1, kind="stable")
    likely = np.exp(-8 * (loss - loss.min(axis=1, keepdims=True)))
    score = 1 / likely.sum(axis=1)
    return order[:, 0], order[:, min(1, order.shape[1] - 1)], score


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", ambiguous: float = 0.6) -> DataFrame:
    """``(key, lang_pred, score, second, ambiguous, far)`` for every row, by its whole text alone.

    A text that is null or without letters is ``und`` with score 0, and so is every text if no
    language was learned. Ties go to the language first in order. The score is the best language's share of the
    likelihood, at most what is left of the way to the second, and less for a text that is ``far`` from its
    language. Texts with scores below ``ambiguous``, those between two languages and far ones are flagged. Other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", STEP_BYTES):
            counts, some = gram_counts(as_text(batch.column("text")))
            langs, second, score = [None] * len(some), [None] * len(some), np.zeros(len(some))
            far = mixed = ~some
            if model.languages:
                best, next_best, share = decode(model, counts)
                langs = [model.languages[i] for i in best]
                second = [model.languages[i] for i in next_best]
                way, away, rarer = placed(model, counts, best, next_best)
                far, mixed = ~some | is_far(model, away, rarer), ~some | (way > BETWEEN)
                near = np.where(far, np.minimum(1, model.limits[0] / np.maximum(away, 1e-9)), 1.0)
                score = np.where(some, np.minimum(share, 1 - way) * near, 0.0)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "lang_pred": [x if x is not None and s else UNKNOWN for x, s in zip(langs, some)],
                    "score": score,
                    "second": [x if s else None for x, s in zip(second, some)],
                    "ambiguous": (score < ambiguous) | mixed | far,
                    "far": far,
                }
            )

    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, lang_pred string, score double, second string, ambiguous boolean, far boolean"
    return arrow_map(picked, run, schema).withColumnRenamed("key", key)


def recognised(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``predict`` gives a language: the same decoding.

    ``und`` rows go, and so do rows far from every language. Texts between two languages stay: clean ones are among
    them. If no language was learned, nothing can be told and all rows stay.
    """
    if not model.languages:
        return docs
    known = np.array([name != UNKNOWN for name in model.languages])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, STEP_BYTES):
            counts, some = gram_counts(as_text(batch.column(text)))
            best, second, _ = decode(model, counts)
            _, away, rarer = placed(model, counts, best, second)
            yield batch.filter(pa.array(some & known[best] & ~is_far(model, away, rarer)))

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those whose crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held = unsigned_crc32_mod(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "second", "ambiguous", "far")
