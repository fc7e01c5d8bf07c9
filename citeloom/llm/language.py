"""Language identification of mixed texts: scripts narrow the candidates, then Viterbi labels the words.

A word's script (a range of code points) says which languages can be meant: those that have at least a hundredth of their
own letters of the training texts in the script, or all if none has. So a language's share of the texts doesn't matter. Among them a word gets a score for each language, the mean over
the gram lengths of the log probabilities of its byte grams with word boundaries. Viterbi over the words of a text, with a
penalty for each switch, labels every word; equal labels in a row are spans. The language of a text is the one with most
letters, and the score is its share of them.

The model is fitted on a bounded sample: about `PER_LANGUAGE` documents of each language, chosen by a hash of doc_id from
those that aren't held out. Language, source and doc_id are never inputs of a prediction.

Defined cases: null texts and texts without a letter are `und` with score 0; null languages aren't learned; if nothing is
learned, all is `und`; a null doc_id isn't held out; ties go to the language that sorts first; repeated rows are
labelled one by one; empty tables give no rows; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, shuffle_width, slices, table

#: Training documents of each language, about.
PER_LANGUAGE = 2_000
GRAMS = (2, 3, 4, 5)
SLOTS = 1 << 17
#: Log probability that a change of language costs.
SWITCH = 8.0
#: Share of a language's letters that are of a script it can be meant by, at least.
CANDIDATE_SHARE = 0.01
WORD = re.compile(r"[^\W\d_]+")
_KEPT_WORDS = 1 << 19

#: First code points of script ranges, by Unicode blocks.
_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
)
SCRIPTS = sorted({name for _, name in _RANGES})
_STARTS = [start for start, _ in _RANGES]
_SCRIPT = [SCRIPTS.index(name) for _, name in _RANGES]


def script_of(word: str) -> int:
    """Number of the script of the word's first letter that isn't Latin, or of its first letter."""
    if word.isascii():
        return _SCRIPT[0]
    kinds = [_SCRIPT[bisect_right(_STARTS, ord(c)) - 1] for c in word]
    return next((k for k in kinds if k != _SCRIPT[0]), kinds[0])


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all grams of the words, and the word of each."""
    data = np.frombuffer((" " + " ".join(words) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    space = data == 32
    word = np.cumsum(space) - 1
    slots, owners = [], []
    codes = data.astype(np.uint64)
    for n in GRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        h = np.full(size, np.uint64(n))
        for k in range(n):
            h = (h ^ codes[k : k + size]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        whole = np.ones(size, bool)
        for k in range(1, n - 1):
            whole &= ~space[k : k + size]
        whole &= word[:size] < len(words)
        at = np.flatnonzero(whole)
        slots.append((h[at] % np.uint64(SLOTS)).astype(np.int64))
        owners.append(word[at])
    return np.concatenate(slots), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    #: log probability by slot and language
    table: np.ndarray
    #: by script: which languages can be meant
    candidates: np.ndarray


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """From each language's gram counts and letters by script."""
    languages = sorted(counts)
    grams = np.array([counts[x][0] for x in languages], np.float64).reshape(len(languages), SLOTS)
    letters = np.array([counts[x][1] for x in languages], np.float64).reshape(len(languages), len(SCRIPTS))
    chance = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * SLOTS))
    share = letters / np.maximum(1, letters.sum(axis=1, keepdims=True))
    candidates = share.T >= CANDIDATE_SHARE
    candidates[~candidates.any(axis=1)] = True
    return Model(languages, np.ascontiguousarray(chance.T.astype(np.float32)), candidates)


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Labels of the words of texts that lie end to end; all texts go forward together, the longest first."""
    n, kinds = scores.shape
    labels = np.zeros(n, np.int16)
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order) or kinds == 1:
        return labels
    first, lengths = starts[order], lengths[order]
    back = np.empty((n, kinds), np.int16)
    value = scores[first].astype(np.float64)
    alive = len(order) - np.searchsorted(lengths[::-1], np.arange(lengths[0] + 1), "right")
    own = np.arange(kinds, dtype=np.int16)
    ends = np.empty(len(order), np.int16)
    for step in range(1, lengths[0]):
        live = alive[step]
        if live < len(value):
            ends[live : len(value)] = value[live:].argmax(axis=1)
            value = value[:live]
        best = value.argmax(axis=1)
        moved = value[np.arange(live), best] - penalty
        stay = value >= moved[:, None]
        at = first[:live] + step
        back[at] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, moved[:, None]) + scores[at]
    ends[: len(value)] = value.argmax(axis=1)
    last = first + lengths - 1
    labels[last] = ends
    for step in range(lengths[0] - 1, 0, -1):
        at = first[: alive[step]] + step
        labels[at - 1] = back[at, labels[at]]
    return labels


class Labeller:
    """Scores words once, and labels texts."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, int] = {}
        self.scores = np.empty((1024, len(model.languages)), np.float32)

    def _learn(self, words: list[str]) -> None:
        slots, owners = grams_of(words)
        can = self.model.candidates[[script_of(w) for w in words]]
        out = np.empty((len(words), len(self.model.languages)), np.float32)
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(owners, self.model.table[slots, k], len(words)) / len(GRAMS)
        out[~can] = -1e6
        at, need = len(self.known), len(self.known) + len(words)
        if need > len(self.scores):
            more = np.empty((max(need, 2 * len(self.scores)), out.shape[1]), np.float32)
            more[:at] = self.scores[:at]
            self.scores = more
        self.scores[at:need] = out
        self.known.update(zip(words, range(at, need), strict=True))

    def label(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Labels of all words end to end, and each text's first word."""
        flat = [w for t in texts for w in t]
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64) if texts else np.empty(0, np.int64)
        if len(self.known) > _KEPT_WORDS:
            self.known, self.scores = {}, np.empty((1024, self.scores.shape[1]), np.float32)
        new = list(dict.fromkeys(w for w in flat if w not in self.known))
        for at in range(0, len(new), 50_000):
            self._learn(new[at : at + 50_000])
        index = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        return viterbi(self.scores[index], starts), starts


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, *, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from about `per_language` documents of each language that aren't held out."""
    known = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    shares = docs.sparkSession.createDataFrame([(x, min(1.0, per_language / n)) for x, n in sorted(sizes.items())], "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_003)) / 1_000_003.0
    sample = known.join(F.broadcast(shares), "lang").where(place < F.col("share")).select("lang", "text")  # a row a language

    def count(batches):
        sums: dict[str, list[np.ndarray]] = {}
        for whole in batches:
            for batch in slices(whole):
                texts: dict[str, list[str]] = {}
                for lang, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    texts.setdefault(lang, []).extend(WORD.findall(text.lower()))
                for lang, words in texts.items():
                    mine = sums.setdefault(lang, [np.zeros(SLOTS, np.int64), np.zeros(len(SCRIPTS), np.int64)])
                    for at in range(0, len(words), 100_000):
                        part = words[at : at + 100_000]
                        mine[0] += np.bincount(grams_of(part)[0], minlength=SLOTS)
                        mine[1] += np.bincount([script_of(w) for w in part], list(map(len, part)), len(SCRIPTS)).astype(np.int64)
        if sums:
            data = [zlib.compress(b"".join(x.tobytes() for x in v), 1) for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(data, pa.binary())], names=["lang", "counts"])

    def add(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sums[lang] = sums.get(lang, 0) + np.frombuffer(zlib.decompress(data), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())], names=["lang", "counts"])

    schema = "lang string, counts binary"
    width = max(1, min(len(sizes), shuffle_width(docs.sparkSession)))
    rows = sample.mapInArrow(count, schema).repartition(width, "lang").mapInArrow(add, schema).collect()
    whole = {r["lang"]: np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in rows}
    return fit({lang: (x[:SLOTS], x[SLOTS:]) for lang, x in whole.items()})


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())]))


def identified(docs: DataFrame, model: Model, *, keep: list[str], text: str = "text", spans: bool = False) -> DataFrame:
    """Columns `keep` of docs with lang_pred, score and, if asked for, lang_spans in code points (word start to word end)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def setup():
        languages = shared.value.languages
        labeller = Labeller(shared.value)

        def run(texts):
            values = [t or "" for t in texts.to_pylist()]
            words = [WORD.findall(t.lower()) if languages else [] for t in values]
            words = [w if any(map(str.isalpha, w)) or any(c.isalpha() for x in w for c in x) else [] for w in words]
            labels, starts = labeller.label(words)
            size = np.fromiter((len(w) for t in words for w in t), np.float64, len(labels))
            owner = np.repeat(np.arange(len(words)), [len(t) for t in words])
            kinds = max(1, len(languages))
            mass = np.bincount(owner * kinds + labels, size, len(words) * kinds).reshape(len(words), kinds)
            total = mass.sum(axis=1)
            best = mass.argmax(axis=1)
            names = [languages[b] if t else "und" for b, t in zip(best.tolist(), total.tolist(), strict=True)]
            score = np.where(total > 0, mass[np.arange(len(words)), best] / np.maximum(total, 1), 0.0)
            out = [pa.array(names, pa.string()), pa.array(score, pa.float64())]
            if spans:
                out.append(pa.array([_spans(t, w, labels[s : s + len(w)].tolist(), languages) for t, w, s in zip(values, words, starts.tolist(), strict=True)], spans_type))
            return out

        return run

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return arrow_map(docs, [text], keep, fields + [T.StructField("lang_spans", SPANS)] * spans, setup)


def _spans(text: str, words: list[str], labels: list[int], languages: list[str]) -> list[dict]:
    out: list[dict] = []
    places = list(WORD.finditer(text)) if words else []
    if len(places) != len(words):  # lower-casing can change where words end
        places = list(WORD.finditer(text.lower()))
    for place, label in zip(places, labels, strict=True):
        if out and out[-1]["lang"] == languages[label]:
            out[-1]["end"] = place.end()
        else:
            out.append({"start": place.start(), "end": place.end(), "lang": languages[label]})
    return out


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = identified(documents, fitted(documents), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
