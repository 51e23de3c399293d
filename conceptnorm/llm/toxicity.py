"""Toxicity by compression distance, with two zstandard dictionaries.

One dictionary is made of toxic text and one of ordinary text. A document is cut into windows of
each length of ``WINDOWS``; each is compressed with either dictionary, and the bytes that the toxic one saves are its
margin. The document's score is a logistic function of how many of its windows of each length, and what share of
them, reach each margin. Its weights, and the margin from which a long window counts as toxic, are
calibrated together.

zstandard's own trainer keeps what is frequent, which is much the same in both classes. So each
dictionary is the trained content of a sample of ordinary text, which both share, and the words,
beginnings of words and phrases that set its class apart, being found in many more of its documents. The
shared part lies at the same distance in both, so a window's lengths differ only by what sets the
classes apart. For single words the shared part is last, which disturbs their lengths least; for longer
windows the class's part is, as phrases are found there only where the search for matches begins.

Labels are learned from a bounded sample: up to ``SAMPLE`` labelled documents of each class, those
of least hash. Two thirds make the dictionaries, the rest calibrates threshold and score. All
documents are scored, whole, in a map without a shuffle.

Defined results: a null, empty or wordless text has no windows and gets the score of such a text;
without labels of both classes every score is 0; each row gets its own score; a document with
several labels is toxic if one of them says so, and of several texts with its id the first by code point is
learned from. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptnorm.llm.words import Words, slices

#: Labelled documents of each class that are learned from, at most.
SAMPLE = 3000
#: Windows of so many words, one beginning after so many, from short to long; a margin of so many bytes or more.
WINDOWS, MARGINS = ((1, 1), (10, 5)), 16
#: Margins of words met before are kept in a task, so many (9 bytes each, and as much while some are added).
KEPT = 1 << 21
#: Windows that are compressed at once.
AT_ONCE = 1 << 16
#: The trainer gets windows of so many words.
TRAINED = 10
#: Beginnings of words are looked at with so many characters.
BEGINNINGS = range(4, 9)
#: A window is stored as it is unless it gets some bytes shorter, and then its lengths tell nothing.
#: So each comes after the end of the shared part, which either dictionary makes a few bytes of.
#: As no match begins in the last eight bytes, some of that text comes after it too.
LEAD_BYTES = 64
SHARED_BYTES, CLASS_BYTES = 16 << 10, 16 << 10
#: Phrases have up to so many words.
PHRASE = 3
#: A word, beginning or phrase sets a class apart if so many times the other's share of documents hold it,
#: and if the log-likelihood ratio of that is no accident among all there are.
TIMES, LEAST_G = 4.0, 30.0
RIDGE = 0.3


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    lead: bytes = b""                # stands before each window
    tail: bytes = b""                # and after it
    margin: int = 1                  # from which on a window counts as toxic
    weights: tuple[float, ...] = (0.0,) * (2 * MARGINS * len(WINDOWS) + 1)
    words: tuple[bytes, bytes] | None = None     # the two dictionaries for single words, if they are others

    def score(self, counts: np.ndarray) -> float:
        return self.scores(counts[None, :])[0]

    def scores(self, counts: np.ndarray) -> list[float]:
        weights = np.array(self.weights)
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, float(x @ weights))))) for x in features(counts)]


def features(counts: np.ndarray) -> np.ndarray:
    """1, and for each length logarithms of how many windows reach each margin, and what share in
    percent: all 0 without windows. counts: by document, length and margin."""
    reach = np.cumsum(counts[:, :, ::-1], axis=2)[:, :, ::-1].astype(float)
    share = 100 * reach / np.maximum(reach[:, :, :1], 1)
    both = np.log1p(np.concatenate([reach[:, :, 1:], share[:, :, 1:]], axis=2))
    return np.concatenate([np.ones((len(counts), 1)), both.reshape(len(counts), -1)], axis=1)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=17, hash_log=17, search_log=5, min_match=4, target_length=32, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=0, write_checksum=0, write_dict_id=0)
    made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=made, compression_params=how)


class _Margin:
    """Margins of windows, from 0 (or less) to MARGINS (or more). Many are compressed with one dictionary and then
    with the other, so that its tables stay in the processor's cache."""

    def __init__(self, model: Model, ordinary: bytes, toxic: bytes):
        self.lead, self.tail = model.lead, model.tail
        self.one, self.other = _compressor(ordinary).compress, _compressor(toxic).compress

    def of(self, words: Words, data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the windows from word ``begin`` to word ``end``."""
        out = np.zeros(len(begin), np.int8)
        for i in range(0, len(begin), AT_ONCE):
            part = slice(i, i + AT_ONCE)
            places = zip(words.starts[begin[part]].tolist(), words.ends[end[part]].tolist(), strict=True)
            parts = [b"".join((self.lead, data[a:b], self.tail)) for a, b in places]
            lengths = list(map(len, map(self.one, parts)))
            out[part] = np.clip(np.array(lengths) - np.array(list(map(len, map(self.other, parts)))), 0, MARGINS)
        return out


class _WordMargin(_Margin):
    """The same of single words, by their hashes; those met before are kept."""

    kept, margin = np.zeros(0, np.uint64), np.zeros(0, np.int8)

    def of(self, words: Words, data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        hashes, first, back = np.unique(words.hashes()[begin], return_index=True, return_inverse=True)
        place = np.searchsorted(self.kept, hashes)
        there = place < len(self.kept)
        there[there] = self.kept[place[there]] == hashes[there]
        found = np.zeros(len(hashes), np.int8)
        found[there] = self.margin[place[there]]
        new = np.flatnonzero(~there)
        found[new] = super().of(words, data, begin[first[new]], end[first[new]])
        if len(self.kept) + len(new) > KEPT:
            self.kept, self.margin = hashes[:KEPT], found[:KEPT]
        else:
            self.kept, self.margin = np.insert(self.kept, place[new], hashes[new]), np.insert(self.margin, place[new], found[new])
        return found[back]


def margin_of(model: Model) -> tuple[_Margin, _Margin]:
    """The margins of windows, and those of words."""
    return _Margin(model, model.ordinary, model.toxic), _WordMargin(model, *(model.words or (model.ordinary, model.toxic)))


def margins(model: Model, column: pa.Array, of: tuple | None = None) -> Iterator[np.ndarray]:
    """For each text, by length of the windows, how many have each margin. of: from ``margin_of``, if there already."""
    of = of or margin_of(model)
    words = Words(column)
    data, n = words.data.tobytes(), len(words.counts)
    counts = []
    for size, step in WINDOWS:
        # the last window is the first that reaches the end
        number = np.where(words.counts > 0, 1 - np.minimum(0, size - words.counts) // step, 0)
        row = np.repeat(np.arange(n), number)
        begin = words.first[row] + step * (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number))
        end = np.minimum(begin + size, words.first[row + 1]) - 1
        found = of[size == 1].of(words, data, begin, end)
        counts.append(np.bincount(row * (MARGINS + 1) + found, minlength=n * (MARGINS + 1)).reshape(n, MARGINS + 1))
    yield from np.stack(counts, axis=1)


def _parts(word: str) -> set[str]:
    return {f" {word} "} | {f" {word[:n]}" for n in BEGINNINGS if n < len(word)}


def _phrases(words: list[str]) -> set[str]:
    return {f" {' '.join(words[i:i + n])} " for n in range(2, PHRASE + 1) for i in range(len(words) - n + 1)}


def _bucket(phrase: str) -> int:
    return zlib.crc32(phrase.encode()) & 0xFFFFF


def _apart(own: list[list[str]], other: list[list[str]]) -> bytes:
    """The words, beginnings and phrases that set a class apart, the most telling at the end, CLASS_BYTES at most."""
    share = len(own) / (len(own) + len(other))
    # phrases are counted if their bucket has as many as tell something
    least = LEAST_G / (2 * math.log(1 / share))
    buckets = np.zeros(1 << 20, np.int32)
    for doc in own:
        buckets[list({_bucket(x) for x in _phrases(doc)})] += 1

    def counted(docs: list[list[str]]) -> Counter:
        return Counter(x for doc in docs for x in {p for w in set(doc) for p in _parts(w)} | {p for p in _phrases(doc) if buckets[_bucket(p)] >= least})

    here, there = counted(own), counted(other)
    found = {}
    for part, n in here.items():
        m = there[part]
        g = 2 * (n * math.log(n / (share * (n + m))) + (m * math.log(m / ((1 - share) * (n + m))) if m else 0))
        if g >= LEAST_G and n * len(other) >= TIMES * m * len(own):
            found[part] = g
    # a phrase that a shorter one, or a word of it, says as well isn't needed
    for part in sorted(found, key=len):
        words = part.split()
        if len(words) > 1 and part in found:
            inner = (f" {' '.join(words[i:i + n])} " for n in range(1, len(words)) for i in range(len(words) - n + 1))
            if any(found[part] <= 1.1 * found.get(x, 0) for x in inner):
                del found[part]
    # a beginning that a longer one says as well, or better, isn't needed
    for part in sorted((x for x in found if len(x.split()) == 1), key=len, reverse=True):
        for n in BEGINNINGS:
            short = part[:n + 1]
            if short != part and found.get(short, math.inf) <= 1.1 * found.get(part, 0):
                del found[short]
    out, size = [], 0
    for part in sorted(found, key=lambda x: (-found[x], x)):
        if size + len(part.encode()) > CLASS_BYTES:
            break
        out.append(part.encode())
        size += len(out[-1])
    return b"".join(reversed(out))


def _words(text: str) -> list[str]:
    words = Words(pa.array([text], pa.string()))
    return [words.text(i, 1).decode() for i in range(len(words.starts))]


def _trained(docs: list[list[str]], size: int) -> bytes:
    """zstandard's dictionary of the documents' windows."""
    windows = [" ".join(words[i:i + TRAINED]).encode() for words in docs for i in range(0, len(words), TRAINED)]
    try:
        return zstandard.train_dictionary(size, windows, level=3).as_bytes()
    except zstandard.ZstdError:      # too little text to train on
        return b" ".join(windows)[-size:]


def dictionaries(samples: list[tuple[str, int]], plain: bool = False) -> Model:
    """samples: (text, 1 if toxic else 0). plain: each dictionary as zstandard's trainer makes it of
    its class's windows, without more."""
    docs = [[_words(text or "") for text, y in samples if y == k] for k in (0, 1)]
    if plain:
        return Model(*(_trained(own, SHARED_BYTES + CLASS_BYTES) for own in docs))
    shared = _trained(docs[0], SHARED_BYTES)
    # filled up, so the shared part is as far in both
    longest = max(map(len, apart := [_apart(docs[k], docs[1 - k]) for k in (0, 1)]))
    apart = [bytes(longest - len(part)) + part for part in apart]
    return Model(*(shared + part for part in apart), shared[-LEAD_BYTES:] + b" ", b" " + shared[-LEAD_BYTES:-LEAD_BYTES + 16],
                 words=tuple(part + shared for part in apart))


def calibrate(model: Model, counts: np.ndarray, labels: np.ndarray, odds: float | None = None) -> Model:
    """Choose the margin that tells the classes apart best, and fit the logistic score. odds: of the
    toxic among all labelled documents, to which the sample's are corrected."""
    best = -1.0
    for margin in range(1, MARGINS + 1):
        x = counts[:, -1, margin:].sum(axis=1)
        order = np.sort(x[labels == 0])
        low, high = (np.searchsorted(order, x[labels == 1], side) for side in ("left", "right"))
        area = float((low + high).mean()) / 2 / max(1, len(order))
        if area > best + 1e-9:
            best, model.margin = area, margin
    design = features(counts)
    w, ridge = np.zeros(design.shape[1]), np.eye(design.shape[1]) * RIDGE
    ridge[0, 0] = 1e-6
    for _ in range(100):             # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (labels - p) - ridge @ w)
        w += step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    if odds:
        w[0] += math.log(odds * (1 - labels.mean()) / labels.mean())
    model.weights = tuple(map(float, w))
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model | None:
    """Fit on the documents that ``labels`` (id, 0 or 1) names; None if a class is missing."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna() \
        .groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("doc_id"))
    number = {r["y"]: r["count"] for r in known.groupBy("y").count().filter("y IN (0, 1)").collect()}
    picked = known.filter("y = 0").orderBy("h", "doc_id").limit(sample).unionByName(
        known.filter("y = 1").orderBy("h", "doc_id").limit(sample)).collect()      # ids: 2 * sample at most
    if len({r["y"] for r in picked}) < 2:
        return None
    spark = docs.sparkSession
    ids = spark.createDataFrame([(r["doc_id"], r["y"], i % 3) for i, r in enumerate(picked)],
                                f"doc_id {labels.schema[id_col].dataType.simpleString()}, y int, part int")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"), F.first("part").alias("part"))
    made = [(r["text"], r["y"]) for r in rows.filter("part < 2").select("text", "y").orderBy("doc_id").toLocalIterator()]
    if len({y for _, y in made}) < 2:
        return None
    model = dictionaries(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = margin_of(model)
        for batch in batches:
            found = [x.tolist() for x in margins(model, batch.column("text"), of)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.list_(pa.int64())))], names=["y", "counts"])

    rest = rows.filter("part = 2").select("text", "y").mapInArrow(run, "y int, counts array<array<bigint>>").collect()
    if len({r["y"] for r in rest}) < 2:
        return None
    return calibrate(model, np.array([r["counts"] for r in rest]), np.array([float(r["y"]) for r in rest]), number[1] / number[0])


def scores(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_windows (long ones), n_toxic (those over the threshold), score."""
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = docs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = margin_of(model) if model else None
        for whole in batches:
            for batch in slices(whole, "__text"):
                none = np.zeros(batch.num_rows, np.int64)
                if not model:
                    found = none, none, none.astype(float)
                else:
                    counts = np.array(list(margins(model, batch.column(1), of)))
                    found = counts[:, -1].sum(axis=1), counts[:, -1, model.margin:].sum(axis=1), model.scores(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.float64()), strict=True))],
                    names=["id", "n_windows", "n_toxic", "score"])

    return docs.mapInArrow(run, f"id {kind}, n_windows bigint, n_toxic bigint, score double").withColumnRenamed("id", id_col)
