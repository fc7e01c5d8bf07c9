"""op2 against brute force, and its parts."""

import hashlib
import random

import pytest

from citeloom.llm import suffix_dedup as sd

from .helpers import documents


def brute(rows):
    """doc_id -> (n_bytes, removed spans, kept hash) by holding every 100-byte string."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for doc_id, text in order:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            part = data[at : at + 100]
            if part in seen:
                gone[at : at + 100] = b"\x01" * 100
            else:
                seen.add(part)
        spans, at = 0, 0
        for k in range(len(data)):
            spans += gone[k] and not (k and gone[k - 1])
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out


def found(spark, rows, **more):
    got = sd.repeated_strings(documents(spark, rows, **more)).collect()
    return {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), r.kept_sha256) for r in got}


def corpus(seed: int):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randrange(1, 9)))
    base = [" ".join(word() for _ in range(r.randrange(5, 200))) for _ in range(12)]
    line = " ".join(word() for _ in range(40))
    rows = [(k, t) for k, t in enumerate(base)]
    for k in range(12, 60):
        kind, text = r.randrange(6), r.choice(base)
        if kind == 0:
            pass
        elif kind == 1:
            cut = r.randrange(len(text))
            text = text[cut:] + word() + text[:cut]
        elif kind == 2:
            text = word() + line + word() + text[: r.randrange(len(text))]
        elif kind == 3:
            text = (r.choice(["ab", "a", "xyz "]) * 300)[: r.randrange(80, 400)]
        elif kind == 4:
            text = text[:99]
        else:
            text = line + line + text[::-1]
        rows.append((k, text))
    rows += [(100, None), (101, ""), (102, "a" * 100), (103, "a" * 101), (104, "é" * 120)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 3)
    rows = corpus(4)
    of_range = sd._repeated_grams
    assert of_range.__globals__["HOT"] == 3
    # in tasks the module is loaded anew, so the pieces are tested here without Spark
    data = [(t or "").encode() for _, t in rows]
    number, place, first, last, _ = (c.tolist() for c in sd.anchors(data))
    for n, p, f, l in zip(number, place, first, last):
        windows = {(head - b, head - b + 100) for _, head, begin, end in sd._zone_pieces(data[n], p, f, l, True) for b in range(head - end, head - begin + 1)}
        assert windows == {(s, s + 100) for s in range(f, l + 1)}
        for suffix, head, begin, end in sd._zone_pieces(data[n], p, f, l, True):
            right = suffix[-1]
            assert suffix[1 + right : -1][::-1] + suffix[1 : 1 + right] == data[n][begin : end + 100]


def test_every_window_has_an_anchor():
    rows = corpus(5)
    data = [(t or "").encode() for _, t in rows]
    number, place, first, last, _ = (c.tolist() for c in sd.anchors(data))
    seen = {}
    for n, p, f, l in zip(number, place, first, last):
        for s in range(f, l + 1):
            assert (n, s) not in seen and s <= p <= s + sd.PLACES - 1
            seen[n, s] = p - s
    assert set(seen) == {(n, s) for n, d in enumerate(data) for s in range(len(d) - 99)}
    by_bytes = {}
    for (n, s), at in seen.items():
        assert by_bytes.setdefault(data[n][s : s + 100], at) == at


def test_loser_tree():
    r = random.Random(6)
    for size in (1, 2, 3, 7, 8, 20):
        lists = [sorted(bytes(r.choice(b"ab") for _ in range(r.randrange(1, 30))) for _ in range(r.randrange(0, 40))) for _ in range(size)]
        runs = [sd.Run(*sd.front_coded(x), [k]) for k, x in enumerate(lists)]
        got = [(s, lcp) for s, lcp, _, _ in sd.merged(runs)]
        want = sorted(s for x in lists for s in x)
        assert [s for s, _ in got] == want
        assert [n for _, n in got[1:]] == [sd.common_prefix(a, b, 0) for a, b in zip(want, want[1:])]


def test_cases(spark):
    text = "".join(random.Random(7).choices("abcdefgh ", k=300))
    rows = [(5, text), (None, text), (3, text[50:250]), (9, None), (10, "")]
    assert found(spark, rows, extra=True) == brute(rows)
    # repeated rows are one document
    got = sd.repeated_strings(documents(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, sum(s.end - s.start for s in r.removed)) for r in got) == [(1, 0), (1, 0), (2, 300)]
    assert sd.repeated_strings(documents(spark, [])).collect() == []


def test_nothing_repeats(spark):
    """No hash range has a repeated gram; then some have one."""
    letters = lambda seed, n: "".join(random.Random(seed).choices("abcdefghijklmnop ", k=n))
    for rows in ([(1, letters(1, 200))], [(1, letters(1, 300)), (2, letters(2, 300))], [(1, letters(1, 300)), (2, letters(2, 300) + letters(1, 120))]):
        assert found(spark, rows) == brute(rows)


def test_texts_without_a_doc_id(spark):
    """They are told apart by the whole text; one that repeats nothing loses nothing."""
    r = random.Random(12)
    letters = lambda n: "".join(r.choices("abcdefghijklmnop ", k=n))
    shared = letters(150)
    rows = [(None, letters(130 + k)) for k in range(300)] + [(1, letters(50) + shared), (None, letters(40) + shared), (4, letters(120)), (4, letters(125))]
    got = sd.repeated_strings(documents(spark, rows)).collect()
    assert sorted(sum(s.end - s.start for s in g.removed) for g in got) == [0] * 303 + [150]
    assert [g.n_bytes for g in got if g.removed] == [190]


def test_many_repeated_rows(spark):
    """A document in very many rows is packed once a task and returned as often as it came."""
    text = "".join(random.Random(13).choices("abcdefgh ", k=200))
    rows = [(1, text)] * 3000 + [(2, text)] + [(None, text)] * 500
    got = sd.repeated_strings(documents(spark, rows)).collect()
    assert sorted((g.doc_id or 0, sum(s.end - s.start for s in g.removed)) for g in got) == [(0, 200)] * 500 + [(1, 0)] * 3000 + [(2, 200)]


def test_hot_gram_is_sent_once_a_home():
    """All zones of a line have one gram; a home sends it with a count, and a range answers with one row a home."""
    import pickle

    import pyarrow as pa

    line = b"".join(random.Random(14).choices([b"a", b"b", b"c", b" "], k=130))
    table = lambda home: pa.table({"home": [home], "payload": [sd.packed(list(range(2000)), [b"%d" % k + line for k in range(2000)], [1] * 2000)]})
    sent = [sd._send_grams(1)(table(h)) for h in (3, 8, 9)]
    sizes = [sum(len(pickle.loads(p)[1]) for p in s.column("payload").to_pylist()) for s in sent]
    assert max(sizes) < 2500 * 2  # a few grams a document over its own number, and those of the line once
    answers = list(sd._repeated_grams(b for s in sent for b in s.to_batches()))
    rows = [(h, *pickle.loads(p)) for b in answers for h, p in zip(*[c.to_pylist() for c in b.columns])]
    assert sorted(r[0] for r in rows) == [3, 8, 9]
    assert 6000 > sd.HOT and any(x for r in rows for x in r[3])


def test_very_common_line(spark):
    """A line in more documents than HOT, between other bytes; its zones are cut into pieces."""
    r = random.Random(9)
    line = "".join(r.choices("abcdefgh ", k=140))
    text = lambda n: "".join(r.choices("ijklmnop ", k=n))
    near = [text(9) for _ in range(6)]
    rows = [(k, text(r.randrange(0, 60)) + r.choice(near) + line + r.choice(near) + text(r.randrange(0, 60))) for k in range(sd.HOT + 400)]
    assert found(spark, rows) == brute(rows)


def test_long_texts(spark):
    """A repeat across the bound of two stretches of a text of some megabytes, and no stretch longer than it should be."""
    import pyarrow as pa

    r = random.Random(15)
    letters = lambda n: "".join(r.choices("abcdefghijklmnop ", k=n))
    part, bound = letters(500), sd.HASHED_BYTES
    text = letters(100) + part + letters(bound - 850) + part + letters(bound + 1000)
    got = sd.repeated_strings(documents(spark, [(1, text), (2, letters(50) + part[:150] + "z")])).collect()
    assert {g.doc_id: [(s.start, s.end) for s in g.removed] for g in got} == {1: [(bound - 250, bound + 250)], 2: [(50, 200)]}
    packed = pa.table({"payload": [sd.packed([1, 2], [text.encode(), b"a" * (bound + 99)], [1, 1])]})
    parts = [x for b in sd._batches(packed) for x in b]
    assert max(len(data) for _, data, _ in parts) <= bound + 99 and [at for _, _, at in parts] == [0, bound, 2 * bound, 0]


def test_texts_of_one_id(spark):
    """Very many different texts under one id are spread over homes."""
    r = random.Random(16)
    line = "".join(r.choices("abcdefgh ", k=120))
    rows = [(7, f"{k} {line}") for k in range(400)]
    got = sd.repeated_strings(documents(spark, rows)).collect()
    assert len(got) == 400 and sum(bool(g.removed) for g in got) == 399
