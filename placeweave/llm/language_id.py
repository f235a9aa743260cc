"""Language identification of mixed documents (operator 4).

Learning counts byte trigrams of words for each language.  A document is taken as
words drawn from a mixture of languages: expectation maximisation estimates the
proportions from each word's trigram likelihoods, for the likeliest single
language and for all nested sets of the languages with the largest proportions;
each document keeps the set of the best penalised likelihood (BIC).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.shared import released
from placeweave.llm.text_arrays import _SEPARATOR, blocks, text_buffer, words

BINS = 1 << 14
UNKNOWN = "und"
SMOOTHING = 0.5


def _word_trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of every byte of a word, first bin of every word, row of every word)."""
    starts, ends, row = words(raw, offsets)
    clean = np.where(_SEPARATOR[raw], np.uint8(32), raw)
    before = np.concatenate([[np.uint8(32)], clean[:-1]])
    after = np.concatenate([clean[1:], [np.uint8(32)]])
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    before[edges] = 32
    after[edges - 1] = 32
    mixed = before.astype(np.uint32) * np.uint32(2654435761) + clean.astype(np.uint32) * np.uint32(40503 * 65537) + after.astype(np.uint32) * np.uint32(2246822519)
    mixed ^= mixed >> np.uint32(15)
    bins = (mixed * np.uint32(2654435769)) >> np.uint32(32 - 14)
    return bins[~_SEPARATOR[raw]].astype(np.int32), np.concatenate([[0], np.cumsum(ends - starts)[:-1]]).astype(np.int64) if len(starts) else starts, row


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_buffer(pc.utf8_lower(column.fill_null("")))


class LanguageModel:
    """Log-probabilities of trigram bins, a row for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        self.logp = np.log((counts + SMOOTHING) / (total + SMOOTHING * BINS)).astype(np.float32) if len(languages) else counts


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count trigrams of all rows with a language.

    What reaches the driver is one number for each language and bin (BINS bins),
    however many documents there are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            raw_all, offsets_all = _lowered(batch.column(0))
            labels = batch.column(1).to_pylist()
            for first, last in blocks(offsets_all):
                base = offsets_all[first]
                raw = raw_all[base : offsets_all[last]]
                if not len(raw):
                    continue
                bins, starts, row = _word_trigrams(raw, offsets_all[first : last + 1] - base)
                if not len(starts):
                    continue
                own = labels[first:last]
                names = sorted(set(own))
                code = np.array([names.index(x) for x in own])
                size = np.diff(np.append(starts, len(bins)))
                flat = np.bincount(np.repeat(code[row], size) * BINS + bins, minlength=len(names) * BINS).reshape(-1, BINS)
                for k, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + flat[k]
        for name, c in sums.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(c[some])], names=["lang", "bin", "n"])

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, F.col(lang).cast("string"))
    found = rows.mapInArrow(released(count), "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((len(languages), BINS))
    if languages:
        code = {x: k for k, x in enumerate(languages)}
        at = np.array([code[x] for x in found.column("lang").to_pylist()])
        counts[at, found.column("bin").to_numpy()] = found.column("n").to_numpy()
    return LanguageModel(languages, counts)


def _mixture(like: np.ndarray, row: np.ndarray, at: np.ndarray, n: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) and log-likelihood after EM; like: words x languages."""
    share = np.full((len(n), like.shape[1]), 1.0 / like.shape[1], dtype=np.float32)
    for _ in range(steps):
        part = like * share[row]
        whole = part.sum(axis=1)
        part /= np.maximum(whole, 1e-30)[:, None]
        share = (np.add.reduceat(part, at, axis=0) / n[:, None]).astype(np.float32)
    whole = (like * share[row]).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(whole, 1e-30)).astype(np.float64), at)


def proportions(model: LanguageModel, raw: np.ndarray, offsets: np.ndarray, steps: int) -> np.ndarray:
    """Language proportions (rows x languages); 0 throughout where a row has no word."""
    rows, languages = len(offsets) - 1, len(model.languages)
    out = np.zeros((rows, languages), dtype=np.float32)
    if not len(raw) or not languages:
        return out
    bins, starts, row = _word_trigrams(raw, offsets)
    if not len(starts):
        return out
    score = np.stack([np.add.reduceat(model.logp[k][bins], starts) for k in range(languages)], axis=1)
    docs, at, row = np.unique(row, return_index=True, return_inverse=True)
    n = np.diff(np.append(at, len(row)))
    like = np.exp(score - score.max(axis=1, keepdims=True))
    peak = np.add.reduceat(score.max(axis=1).astype(np.float64), at)
    single = np.add.reduceat(score.astype(np.float64), at, axis=0)
    best = np.zeros((len(docs), languages), dtype=np.float32)
    best[np.arange(len(docs)), single.argmax(axis=1)] = 1
    cost = -2 * single.max(axis=1)
    share, _ = _mixture(like, row, at, n, steps)
    order = np.argsort(-share, axis=1, kind="stable")
    for size in range(2, languages + 1):
        chosen = order[:, :size]
        part, log = _mixture(np.take_along_axis(like, chosen[row], axis=1), row, at, n, steps)
        now = -2 * (log + peak) + (size - 1) * np.log(n)
        better = now < cost
        cost = np.where(better, now, cost)
        fresh = np.zeros_like(best)
        np.put_along_axis(fresh, chosen, part, axis=1)
        best[better] = fresh[better]
    out[docs] = best
    return out


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", steps: int = 8) -> DataFrame:
    """``docs`` with lang_pred and score added: the main language and its proportion.

    A null text, one without a letter, and any text if nothing was learned, give
    ``und`` with score 0.  Ties go to the language first by name.  A row's answer
    depends on its text and the model alone, whatever stands beside it; so repeated rows agree; columns of ``docs`` named like an added
    one are replaced.  Only the text is read for the prediction; a text may mix any
    number of the learned languages.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNKNOWN], dtype=object)
        for batch in batches:
            column = batch.column(place)
            raw, offsets = _lowered(column)
            best, score = np.full(len(column), len(names) - 1), np.zeros(len(column))
            for first, last in blocks(offsets):
                base = offsets[first]
                share = proportions(known, raw[base : offsets[last]], offsets[first : last + 1] - base, steps)
                if share.shape[1]:
                    some = share.max(axis=1) > 0
                    best[first:last] = np.where(some, share.argmax(axis=1), len(names) - 1)
                    score[first:last] = share.max(axis=1)
            letters = pc.match_substring_regex(column.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
            best = np.where(letters, best, len(names) - 1)
            score = np.where(letters & (best < len(names) - 1), np.clip(score, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[best], pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(released(run), schema)


def held_out(id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
