"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector binds its letters' vectors, each
permuted by its place, by multiplication; a text's vector bundles (adds) those of all its n-grams;
a language's prototype bundles those of all its training texts. A document gets the language whose
prototype has the largest cosine with its vector. Prototypes are sums of whole numbers, so they
don't depend on how the rows are dealt out.

Letters are folded to lower case; a to z have a vector each, any other letter shares one of the
remaining ``SLOTS``; everything that isn't a letter counts as one space. Whole texts are read, in
pieces. Only prototypes, one row of ``dim`` numbers for each language, come to the driver: their
number is checked against ``MAX_LANGS``.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text
if there is nothing to learn from; equal cosines go to the first language by code point; the score
is the cosine, not below 0. Each row gets its own result, whatever its id; rows with a null language
teach nothing. Other columns are ignored by ``predict`` and kept by ``identified``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptnorm.llm.common import texts

DIM, NGRAM, SLOTS, SEED = 1024, 3, 64, 31
#: Languages that a prototype can be held for: 8 MB for each thousand.
MAX_LANGS = 10_000
UNKNOWN = "und"
_PIECE = 1 << 18


class Space:
    """Letter slots and the vectors of n-grams."""

    def __init__(self, dim: int = DIM, n: int = NGRAM, slots: int = SLOTS, seed: int = SEED):
        self.n, self.slots, self.dim = n, slots, dim
        letters = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (slots, dim))
        self.shifted = [np.roll(letters, n - 1 - i, axis=1) for i in range(n)]      # permuted by place
        self.slot = np.array([self._slot(c) for c in range(1 << 16)], np.uint8)

    def _slot(self, code: int) -> int:
        c = chr(code)
        if not c.isalpha():
            return 0
        code = ord(c.lower()[0])
        return code - 96 if 97 <= code <= 122 else 27 + code * 40503 % (self.slots - 27)

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Codes and counts of the n-grams of a text, None if it has no letter. Runs of other
        characters are one space, and one space stands at either end."""
        total, tail, any_letter = None, np.zeros(1, np.uint8), False
        for i in range(0, len(text), _PIECE):
            codes = np.frombuffer(text[i:i + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
            far = codes > 0xFFFF
            if far.any():
                slots = self.slot[np.where(far, 0, codes)]
                kinds, back = np.unique(codes[far], return_inverse=True)
                slots[far] = np.array([self._slot(int(c)) for c in kinds], np.uint8)[back]
            else:
                slots = self.slot[codes]
            any_letter |= bool(slots.any())
            seq = np.concatenate([tail, slots, *([np.zeros(1, np.uint8)] if i + _PIECE >= len(text) else [])])
            seq = seq[np.concatenate([[True], (seq[1:] != 0) | (seq[:-1] != 0)])]
            if len(seq) >= self.n:
                code = np.zeros(len(seq) - self.n + 1, np.int64)
                for j in range(self.n):
                    code = code * self.slots + seq[j:j + len(code)]
                if total is None and i + _PIECE >= len(text):
                    return np.unique(code, return_counts=True) if any_letter else None
                total = np.zeros(self.slots ** self.n, np.int64) if total is None else total
                total += np.bincount(code, minlength=len(total))
            tail = seq[1 - self.n:] if self.n > 1 else seq[:0]
        if not any_letter:
            return None
        grams = np.flatnonzero(total)
        return grams, total[grams]

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        out = self.shifted[-1][grams % self.slots]
        for i in range(self.n - 2, -1, -1):
            grams = grams // self.slots
            out = out * self.shifted[i][grams % self.slots]
        return out

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(self.dim)
        for i in range(0, len(grams), 2048):
            part = counts[i:i + 2048]
            kind = np.float32 if part.sum() < 1 << 24 else np.float64       # exact either way
            out += part.astype(kind) @ self.vectors(grams[i:i + 2048]).astype(kind)
        return out


def _learn(space_of: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(*space_of)
        sums: dict[str, np.ndarray] = {}

        def result() -> pa.RecordBatch:
            vectors = []
            for total in sums.values():
                grams = np.flatnonzero(total)
                vectors.append(np.rint(space.bundle(grams, total[grams])).astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(vectors, pa.list_(pa.int64()))],
                                              names=["lang", "bundle"])

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                if found := space.counts(text.as_py()):
                    if lang not in sums:
                        if len(sums) >= 64:      # so many dense counts are held at once
                            yield result()
                            sums.clear()
                        sums[lang] = np.zeros(space.slots ** space.n, np.int64)
                    sums[lang][found[0]] += found[1]
        if sums:
            yield result()
    return run


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM, n: int = NGRAM,
               slots: int = SLOTS, seed: int = SEED) -> list[tuple[str, np.ndarray]]:
    """(language, unit prototype) by code point, learned from all rows with a text and a language."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    parts = rows.mapInArrow(_learn((dim, n, slots, seed)), "lang string, bundle array<bigint>")
    sums = parts.select("lang", F.posexplode("bundle").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    found = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("xs")) \
        .limit(MAX_LANGS + 1).collect()          # dim numbers for each language
    if len(found) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    out = []
    for r in sorted(found, key=lambda r: r["lang"]):
        x = np.array([y["x"] for y in r["xs"]], float)
        out.append((r["lang"], x / max(np.linalg.norm(x), 1e-9)))
    return out


def _predict(known: list[tuple[str, np.ndarray]], space_of: tuple, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(*space_of)
        table = np.array([x for _, x in known])
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                found = space.counts(text.as_py() or "") if known else None
                if found is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                x = space.bundle(*found)
                cosines = table @ (x / max(np.linalg.norm(x), 1e-9))
                best = int(np.argmax(cosines))
                langs.append(known[best][0])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(carry))),
                                              pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*carry, "__lang", "__score"])
    return run


def _mapped(docs: DataFrame, carry: list[str], text_col: str, known, dim: int, n: int, slots: int, seed: int) -> DataFrame:
    docs = texts(docs, text_col)
    names = [f"c{i}" for i in range(len(carry))]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    rows = docs.select(*(F.col(f"`{c}`").alias(x) for c, x in zip(carry, names, strict=True)), F.col(f"`{text_col}`").alias("text"))
    schema = ", ".join(f"{x} {kinds[c]}" for c, x in zip(carry, names, strict=True))
    out = rows.mapInArrow(_predict(known, (dim, n, slots, seed), names), f"{schema}, __lang string, __score double")
    return out.select(*(F.col(x).alias(c) for c, x in zip(carry, names, strict=True)), "__lang", "__score")


def predict(docs: DataFrame, known: list[tuple[str, np.ndarray]], id_col: str = "doc_id", text_col: str = "text",
            dim: int = DIM, n: int = NGRAM, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """One row per document: id, lang_pred, score."""
    return _mapped(docs, [id_col], text_col, known, dim, n, slots, seed) \
        .withColumnsRenamed({"__lang": "lang_pred", "__score": "score"})


def identified(docs: DataFrame, known: list[tuple[str, np.ndarray]], text_col: str = "text", least: float = 0.0,
               dim: int = DIM, n: int = NGRAM, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """The rows in a known language, whole: those that are ``und`` or score below ``least`` go."""
    out = _mapped(docs, docs.columns, text_col, known, dim, n, slots, seed)
    return out.filter((F.col("__lang") != UNKNOWN) & (F.col("__score") >= least)).drop("__lang", "__score")
