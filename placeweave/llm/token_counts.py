"""Token counts with a whole-token shortcut (operator 2).

Which vocabulary strings encode alone as one token is proved once on the driver,
by encoding every string of the vocabulary; the table is as large as the
vocabulary.  In the tasks a text is split into pre-tokens as the tokenizer splits
it; proven ones count one directly, only the rest is merged by the library, each
distinct string once while it stays in a bounded cache.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.text_arrays import blocks, text_buffer

#: Strings of a worker's cache; beyond them strings are merged each time they come.
CACHE = 1 << 18
#: Longer strings are not kept, so a worker's cache has a bounded number of bytes.
LONGEST = 64
#: The split pattern of byte-level BPE vocabularies of this family (a fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def proven_whole(path: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and that encode alone as one token."""
    tokenizer = load_tokenizer(path)
    pattern, special = regex.compile(PRE_TOKEN), set(special_strings(tokenizer))
    texts = {tokenizer.decode([i], skip_special_tokens=False) for i in tokenizer.get_vocab().values()}
    texts = [t for t in texts if t and t not in special and "�" not in t and pattern.fullmatch(t) and pattern.findall(t) == [t]]
    coded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, coded, strict=True) if len(e) == 1)


def check_split(path: str, normalizers: list[str], pattern: str | None) -> None:
    """Raise ValueError unless the file normalises and splits as the caller's rules do.

    ``pattern``: that of its Split step; None for a byte-level step with its own pattern.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    steps = lambda x, key: [] if x is None else x[key] if x["type"] == "Sequence" else [x]
    found = [x["type"] for x in steps(told.get("normalizer"), "normalizers")]
    splits = steps(told.get("pre_tokenizer"), "pretokenizers")
    own = [x["pattern"]["Regex"] for x in splits if x["type"] == "Split" and "Regex" in x["pattern"]]
    bytes_only = [x for x in splits if x["type"] == "ByteLevel" and not x["add_prefix_space"] and x["use_regex"] == (pattern is None)]
    if found != normalizers or len(bytes_only) != 1 or own != ([pattern] if pattern else []) or told["model"]["type"] != "BPE":
        raise ValueError(f"{path} does not split texts as this operator does")


class _Counter:
    """Counts of one worker; kept between its tasks."""

    def __init__(self, path: str, whole: frozenset[str]) -> None:
        self.tokenizer = load_tokenizer(path)
        self.whole = whole
        self.pattern = regex.compile(PRE_TOKEN)
        special = special_strings(self.tokenizer)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.extra: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        found, rests = [], []
        for text in texts:
            parts = [text]
            n = 0
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                n = len(parts) - 1
            tokens = list(chain.from_iterable(map(self.pattern.findall, parts))) if len(parts) > 1 else self.pattern.findall(text)
            rests.append(list(filterfalse(self.whole.__contains__, tokens)))
            found.append(n + len(tokens) - len(rests[-1]))
        unknown = list(set(chain.from_iterable(rests)).difference(self.extra))
        coded = map(len, self.tokenizer.encode_batch(unknown, add_special_tokens=False))
        room = max(0, CACHE - len(self.extra))
        late: dict[str, int] = {}
        for k, (word, n) in enumerate(zip(unknown, coded, strict=True)):
            (self.extra if k < room and len(word) < LONGEST else late)[word] = n
        known = self.extra
        if late:
            return [n + sum(known[w] if w in known else late[w] for w in rest) for n, rest in zip(found, rests, strict=True)]
        return [n + sum(map(known.__getitem__, rest)) for n, rest in zip(found, rests, strict=True)]


_counters: dict[str, _Counter] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 512, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit), one for each row of ``docs``.

    ``path``: a byte-level BPE file of the tokenizers library whose pre-tokenizer
    splits by PRE_TOKEN, else ValueError; ``n_tokens`` is what the library gives without added
    special tokens, special strings inside a text counted as it does by default.
    A null text is an empty one: no bytes, no tokens.  Null and repeated ids are
    passed through; further columns are ignored.
    """
    check_split(path, [], None)
    shared = docs.sparkSession.sparkContext.broadcast(proven_whole(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = _Counter(path, shared.value)
        counter = _counters[path]
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            column = batch.column(1).fill_null("")
            for first, last in blocks(offsets):
                n = counter.count(column.slice(first, last - first).to_pylist())
                sizes = np.diff(offsets[first : last + 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(sizes), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                    names=[id, "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(F.col(id).cast("long").alias(id), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{id}` long, n_bytes long, n_tokens long, over_limit boolean")
