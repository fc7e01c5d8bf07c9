"""op8 and op9: the machine's identity, cases, and held-out accuracy."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from citeloom.llm import language as lg
from citeloom.llm import quality as ql

from .helpers import documents, words

DATA = "/root/testdata/sf0.01"


def test_sum_of_squares_identity():
    r = np.random.default_rng(1)
    machine = ql.Machine(0.3, r.normal(size=ql.SLOTS), r.normal(size=(ql.SLOTS, ql.FACTORS)))
    made = [ql.features(words(n, n), None) for n in (0, 1, 30)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s, _ in made])[:-1]])
    raw = machine.raw(np.concatenate([s for s, _ in made]), np.concatenate([v for _, v in made]), starts)
    for got, (s, v) in zip(raw, made):
        pairs = sum(machine.factors[s[i]] @ machine.factors[s[j]] * v[i] * v[j] for i in range(len(s)) for j in range(i + 1, len(s)))
        assert abs(got - (0.3 + (machine.linear[s] * v).sum() + pairs)) < 1e-3


def test_quality_held_out(spark):
    found = ql.op8_quality(spark, DATA)
    rows = found.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    ranked = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert ranked > 0.95
    assert np.mean([r.predicted == 1 for r in rows if r.quality == 1]) > 0.98
    assert found.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_quality_ignores_names_and_held_out_labels(spark):
    rows = [(k, words(40, k) if k % 2 else "JUNK!! " * 30, "en", "s") for k in range(60)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    machine = ql.fitted(docs, labels)
    a = {r.doc_id: r.quality_score for r in ql.scored(docs, machine, keep=["doc_id"]).collect()}
    renamed = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("yy"))
    flipped = labels.withColumn("quality", F.when(ql.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    b = {r.doc_id: r.quality_score for r in ql.scored(renamed, ql.fitted(renamed, flipped), keep=["doc_id"]).collect()}
    assert a == b
    assert np.mean([(s >= 0.5) == bool(k % 2) for k, s in a.items()]) > 0.95


def test_quality_cases(spark):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, None), (2, ""), (None, "a b"), (3, "x " * 100_000), (3, "y")], extra=True)
    scores = [r.quality_score for r in ql.scored(docs, ql.fitted(docs, labels), keep=["doc_id"]).collect()]
    assert scores == [0.5] * 5
    assert ql.scored(documents(spark, []), ql.fitted(docs, labels), keep=["doc_id"]).collect() == []


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = lg.op9_language(spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_few_documents(spark):
    """A few dozen short documents beside large languages of the same script: far less than a hundredth of its letters."""
    r = np.random.default_rng(4)
    sounds = {"aa": "bdgkst", "bb": "flmnrz", "rare": "hjpqvx"}
    text = lambda lang, n: " ".join("".join(r.choice(list(sounds[lang] + "aeiou"), 6)) for _ in range(n))
    rows = [(k, text("aa" if k % 2 else "bb", 300), "aa" if k % 2 else "bb") for k in range(300)]
    rows += [(k, text("rare", 8), "rare") for k in range(300, 336)]
    docs = documents(spark, rows)
    found = lg.identified(docs, lg.fitted(docs), keep=["doc_id", "lang"]).where(lg.held_out(F.col("doc_id"))).collect()
    assert sum(x.lang == "rare" for x in found) > 5 and all(x.lang_pred == x.lang for x in found)


def plain_viterbi(scores, penalty):
    value, back = scores[0].astype(float), []
    for s in scores[1:]:
        moves = value[:, None] - penalty * (1 - np.eye(len(value)))
        back.append(moves.argmax(axis=0))
        value = moves.max(axis=0) + s
    out = [int(value.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1], value.max()


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_of_many_texts(seed):
    r = np.random.default_rng(seed)
    lengths = [0, 1, 2, 7, 30, 3, 0, 12]
    scores = r.normal(0, 3, (sum(lengths), 4)).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    labels = lg.viterbi(scores, starts, 4.0)

    def worth(path, part):
        return sum(part[k, p] for k, p in enumerate(path)) - 4.0 * sum(a != b for a, b in zip(path, path[1:]))

    for s, n in zip(starts, lengths):
        if n:
            _, best = plain_viterbi(scores[s : s + n], 4.0)
            assert abs(worth(labels[s : s + n].tolist(), scores[s : s + n]) - best) < 1e-3


def test_language_cases_and_spans(spark):
    train = [(k, "the house and the river with this that " * 5, "en") for k in range(40)] + [(100 + k, "der hund und die katze nicht auf einem " * 5, "de") for k in range(40)]
    train += [(200 + k, "это дом и река " * 5, "ru") for k in range(10)]
    model = lg.fitted(documents(spark, train))
    assert model.languages == ["de", "en", "ru"]
    mixed = "the house and the river with this, der hund und die katze nicht"
    docs = documents(spark, [(1, None), (2, ""), (3, "123 !!"), (4, mixed), (5, "река"), (None, "the house"), (6, "the house and " * 20_000), (6, "der hund")], extra=True)
    found = lg.identified(docs.drop("score"), model, keep=["doc_id"], spans=True).collect()
    by = {(r.doc_id, r.lang_pred): r for r in found}
    assert set(by) == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "ru"), (None, "en"), (6, "en"), (6, "de")}
    spans = by[4, "en"].lang_spans
    assert [s.lang for s in spans] == ["en", "de"] and mixed[spans[1].start : spans[1].end] == "der hund und die katze nicht"
    assert by[1, "und"].score == 0
    empty = lg.fitted(documents(spark, [(1, "x", None)]))
    assert [r.lang_pred for r in lg.identified(docs, empty, keep=["doc_id"]).collect()] == ["und"] * 8
    assert lg.identified(documents(spark, []), model, keep=["doc_id"]).collect() == []
