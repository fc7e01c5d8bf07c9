"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

A byte goes if a 100-byte string that covers it also starts earlier: in a document of smaller doc_id, or before in the same
one. Sorting all suffixes would move the text a hundred times, so the suffixes are those at anchors. The anchor of a window
of 100 bytes is the leftmost of its 69 grams of 32 bytes with the least hash. It depends on the window's bytes only, so equal
windows have equal anchors; neighbouring windows mostly share theirs. The bytes of an anchor's windows are its zone.

1. Homes (hash groups of documents) send the hashes of their different grams with counts, and learn which occur twice.
2. A home sends the suffixes of anchors with such a gram: from the anchor on to the zone's end, then the zone's
   bytes before the anchor backwards. Equal zones meet there first: only the earliest goes on, the others are removed
   at once. What goes on is a sorted run, front-coded: length of the common prefix with the suffix before, then the rest.
3. Runs of one hash range are merged by a loser tree. A node keeps the prefix length that a suffix shares with the last
   winner, longer ones win without a look at the text, and equal ones are compared from that length on only. The merged
   prefix lengths show equal zones and, at gram length, the groups of zones in which single windows can still be equal.
4. Those windows are grouped by their bytes, and all but the earliest are removed. Homes join the removed ranges.

Hot grams, such as those of a line that a third of all documents have, would put all their zones into one group. Their
zones are cut into pieces of eight windows, and a piece goes where the hash of the 93 bytes common to its windows sends it.

Defined cases: null is the empty text; texts under 100 bytes have nothing to remove; a null doc_id comes after all others;
repeated rows (equal doc_id and text) are one document and have equal results; different texts under one doc_id, or
without one, are told apart and ordered by a hash of 128 bits of the text; a doc_id counts as a long, and one that can't
be cast to it as null; texts of any length are hashed in stretches, and only the text itself has to fit a task; empty tables
give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_width, slices, table

LENGTH = 100
GRAM = 32
PLACES = LENGTH - GRAM + 1
#: Occurrences beyond which a gram's zones are cut into pieces.
HOT = 4096
PIECE = 8
#: Bytes of text for each home, and for each hash range.
HOME_BYTES = 8 << 20
SHARE_BYTES = 16 << 20
#: Bytes of text whose grams are hashed at a time; the arrays are about 50 times as large.
HASHED_BYTES = 2 << 20
#: Suffixes that a home sorts as one run.
RUN_ROWS = 1 << 18
_LAST = 2**63 - 1
_C = 0x9E3779B97F4A7C15


def packed(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, protocol=5))


def unpacked(data: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place on."""
    h = _mixed((data.astype(np.uint64) + np.uint64(1)) * np.uint64(_C))
    factor, step = _C, 1
    while step < GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor & (2**64 - 1)
        step *= 2
    return _mixed(h)


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For texts laid end to end: text number, anchor, first and last window start (places in the text) and gram hash."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    h = gram_hashes(data)
    # 32 bits of hash over 32 bits of place: of equal ones the leftmost is least, in any batch of texts
    low = np.uint64(0xFFFFFFFF)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= PLACES:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < PLACES:
        key = np.minimum(key[: len(key) - (PLACES - width)], key[PLACES - width :])
    at = (key & low).astype(np.int64)  # the anchor of each window
    turn = np.zeros(len(at) + 1, np.int8)
    whole = lengths >= LENGTH
    np.add.at(turn, starts[:-1][whole], 1)
    np.add.at(turn, starts[1:][whole] - LENGTH + 1, -1)
    inside = np.cumsum(turn[:-1], dtype=np.int32) > 0
    window = np.flatnonzero(inside)
    if not len(window):
        return none, none, none, none, none.astype(np.uint64)
    own = at[window]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)]))
    first, last, place = window[new], window[np.concatenate([new[1:], [len(window)]]) - 1], own[new]
    number = np.searchsorted(starts, place, "right") - 1
    base = starts[number]
    return number, place - base, first - base, last - base, h[place]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes needn't be looked at."""
    most = min(len(a), len(b))
    at = known
    while at < most:
        step = min(24, most - at)
        x = int.from_bytes(a[at : at + step], "big") ^ int.from_bytes(b[at : at + step], "big")
        if x:
            return at + (8 * step - x.bit_length()) // 8
        at += step
    return most


class Run:
    """A front-coded sorted run, decoded one suffix at a time."""

    def __init__(self, shared: bytes, rest_sizes: bytes, rest: bytes, owner: list) -> None:
        self.shared, self.sizes, self.rest, self.owner = shared, rest_sizes, rest, owner
        self.at = self.byte = 0
        self.suffix = b""
        self.lcp = 0

    def advance(self) -> bool:
        """The next suffix, with lcp the prefix that it shares with the one before."""
        if self.at == len(self.shared):
            return False
        self.lcp = self.shared[self.at]
        end = self.byte + self.sizes[self.at]
        self.suffix = self.suffix[: self.lcp] + self.rest[self.byte : end]
        self.byte = end
        self.at += 1
        return True


def front_coded(suffixes: list[bytes]) -> tuple[bytes, bytes, bytes]:
    shared, rest, before = bytearray(), [], b""
    for s in suffixes:
        n = common_prefix(before, s, 0)
        shared.append(n)
        rest.append(s[n:])
        before = s
    return bytes(shared), bytes(map(len, rest)), b"".join(rest)


def merged(runs: list[Run]) -> Iterator[tuple[bytes, int, Run, int]]:
    """(suffix, prefix shared with the suffix before, run, place in the run) in order, by a loser tree.

    Each leaf's lcp is the prefix that its suffix shares with the last winner. On the path of a winner all losers were
    beaten by it, so their lcp stays valid, and the greater lcp is the smaller suffix.
    """
    live = [r for r in runs if r.advance()]
    if not live:
        return
    size = 1
    while size < len(live):
        size *= 2
    leaves: list[Run | None] = [*live, *[None] * (size - len(live))]
    lcp = [0] * size

    def beats(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's lcp is then with the winner."""
        x, y = leaves[a], leaves[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        s, t = x.suffix, y.suffix
        n = common_prefix(s, t, lcp[a])
        if n == len(s) or (n < len(t) and s[n] < t[n]):
            lcp[b] = n
            return a, b
        lcp[a] = n
        return b, a

    tree = [0] * size
    level = list(range(size))
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for k in range(0, len(level), 2):
            win, lose = beats(level[k], level[k + 1])
            tree[node + k // 2] = lose
            up.append(win)
        level = up
    win = level[0]
    while (run := leaves[win]) is not None:
        yield run.suffix, lcp[win], run, run.at - 1
        if run.advance():
            lcp[win] = run.lcp
        else:
            leaves[win] = None
        node = (win + size) // 2
        while node:
            win, tree[node] = beats(win, tree[node])
            node //= 2


def _gram_keys(h: np.ndarray, width: int) -> np.ndarray:
    """The hash range of each gram, and 32 bits of its hash below."""
    return (((h >> np.uint64(32)) % np.uint64(width)) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def _send_grams(width: int):
    """Homes: rows (range, payload) of their different grams with counts, so that a hot one is sent once a home."""

    def run(texts: pa.Table) -> pa.Table:
        home = texts.column("home")[0].as_py()
        found, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for batch in _batches(texts):
            keys, often = np.unique(_gram_keys(anchors([data for _, data, _ in batch])[4], width), return_counts=True)
            found.append(keys)
            counts.append(often)
        keys, where = np.unique(np.concatenate(found), return_inverse=True)
        often = np.bincount(where, np.concatenate(counts), len(keys)).astype(np.uint32)
        of = (keys >> np.uint64(32)).astype(np.int64)
        ranges, firsts = np.unique(of, return_index=True)
        rows = [pickle.dumps((home, keys[lo:hi].astype(np.uint32), often[lo:hi]), protocol=5) for lo, hi in zip(firsts, [*firsts[1:], len(keys)])]
        return pa.table({"range": pa.array(ranges, pa.int32()), "payload": pa.array(rows, pa.binary())})

    return run


def _by_key(batches) -> Iterator[tuple[int, list[bytes]]]:
    """Payloads of each key; rows come sorted by key."""
    key, hold = None, []
    for batch in batches:
        for k, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if k != key and hold:
                yield key, hold
                hold = []
            key = k
            hold.append(payload)
    if hold:
        yield key, hold


def _repeated_grams(batches):
    """Rows (home, payload): the grams of a home that occur twice anywhere, as (range, marks, hot)."""
    for of, payloads in _by_key(batches):
        homes, marks, counts = zip(*map(pickle.loads, payloads), strict=True)
        _, where = np.unique(np.concatenate(marks), return_inverse=True)
        often = np.bincount(where, np.concatenate(counts))[where]
        rows = []
        for home, mine, n in zip(homes, marks, np.split(often, np.cumsum([len(m) for m in marks])[:-1]), strict=True):
            keep = n > 1
            if keep.any():
                rows.append((home, pickle.dumps((of, mine[keep], n[keep] > HOT), protocol=5)))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["home", "payload"])


def _pack_texts(batches):
    """Rows (home, payload): a task's documents of each home, as (ids, texts, copies). Repeated rows are packed once."""
    hold: dict[int, dict[tuple, int]] = {}
    size = 0

    def flush():
        for home, rows in hold.items():
            payload = packed([i for i, _ in rows], [t for _, t in rows], list(rows.values()))
            yield pa.RecordBatch.from_arrays([pa.array([home], pa.int32()), pa.array([payload], pa.binary())], names=["home", "payload"])
        hold.clear()

    for whole in batches:
        for batch in slices(whole):
            for home, i, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                row = i, (text or "").encode("utf-8", "surrogatepass")
                mine = hold.setdefault(home, {})
                if row not in mine:
                    size += len(row[1])
                mine[row] = mine.get(row, 0) + 1
            if size > 4 * SHARE_BYTES:
                yield from flush()
                size = 0
    yield from flush()


def _documents(texts: pa.Table) -> Iterator[tuple[int | None, tuple[int, bytes], bytes, int]]:
    """(doc_id, key, text, copies). Keys order documents and tell texts apart; a document can come from several tasks."""
    for payload in texts.column("payload").to_pylist():
        for i, data, copies in zip(*unpacked(payload), strict=True):
            yield i, (_LAST if i is None else i, xxhash.xxh3_128_digest(data)), data, copies


def _batches(texts: pa.Table) -> Iterator[list[tuple[tuple[int, bytes], bytes, int]]]:
    """(key, stretch, place) of a home's different documents, about HASHED_BYTES at a time. Stretches of a longer text overlap
    by a window less a byte, so each window is in one of them."""
    done: set[tuple[int, bytes]] = set()
    batch, size = [], 0
    for _, key, data, _ in _documents(texts):
        if key not in done:
            done.add(key)
            for at in range(0, max(1, len(data) - LENGTH + 1), HASHED_BYTES):
                part = data[at : at + HASHED_BYTES + LENGTH - 1] if len(data) > HASHED_BYTES else data
                batch.append((key, part, at))
                size += len(part)
                if size >= HASHED_BYTES:
                    yield batch
                    batch, size = [], 0
    yield batch


def _zone_pieces(data: bytes, place: int, first: int, last: int, hot: bool) -> Iterator[tuple[bytes, int, int, int]]:
    """(suffix, place, first window, last window). The suffix says by its first byte how much all its windows share."""
    if not hot:
        right = data[place : last + LENGTH]
        yield bytes([GRAM]) + right + data[first:place][::-1] + bytes([len(right)]), place, first, last
        return
    low = place - last
    while low <= place - first:
        near = low - low % PIECE
        high = min(place - first, near + PIECE - 1)
        head, begin, end = place - near, place - high, place - low
        right = data[head : end + LENGTH]
        yield bytes([LENGTH - PIECE + 1]) + right + data[begin:head][::-1] + bytes([len(right)]), head, begin, end
        low = high + 1


def _send_runs(width: int):
    """Homes: sorted runs (kind 0, by hash range) and ranges removed at once (kind 1, by home)."""

    def of_range(suffix: bytes) -> int:
        return xxhash.xxh3_64_intdigest(suffix[1 : 1 + suffix[0]], 5) % width

    def run(texts: pa.Table, grams: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        home = None
        wanted, hot = [np.empty(0, np.uint64)], [np.empty(0, bool)]
        for at, payload in zip(grams.column("home").to_pylist(), grams.column("payload").to_pylist(), strict=True):
            home = at
            of, marks, often = pickle.loads(payload)
            wanted.append((np.uint64(of) << np.uint64(32)) | marks.astype(np.uint64))
            hot.append(often)
        repeated = np.concatenate(wanted)
        order = np.argsort(repeated)
        repeated, is_hot = repeated[order], np.concatenate(hot)[order]
        seen: dict[bytes, tuple] = {}
        gone: dict[tuple[int, bytes], list[tuple[int, int]]] = {}

        def flush() -> None:
            by_range: dict[int, list[bytes]] = {}
            for suffix in seen:
                by_range.setdefault(of_range(suffix), []).append(suffix)
            for k, suffixes in by_range.items():
                suffixes.sort()
                owners = [seen[s] for s in suffixes]
                names = {key: n for n, key in enumerate(dict.fromkeys(o[0] for o in owners))}
                columns = (np.array([names[o[0]] for o in owners], np.uint32), np.array([o[1] for o in owners], np.uint32))
                rows.append((0, k, packed(home, list(names), *columns, *front_coded(suffixes))))
            seen.clear()

        for batch in _batches(texts) if len(repeated) else ():
            *columns, h = anchors([data for _, data, _ in batch])
            keys = _gram_keys(h, width)
            at = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
            mine = np.flatnonzero(repeated[at] == keys)
            for number, place, first, last, often in zip(*[c[mine].tolist() for c in columns], is_hot[at[mine]].tolist(), strict=True):
                key, data, low = batch[number]
                for suffix, head, begin, end in _zone_pieces(data, place, first, last, often):
                    own = (key, low + head, low + begin, low + end)
                    other = seen.setdefault(suffix, own)
                    if other is not own:
                        if own[:2] < other[:2]:
                            seen[suffix], own = own, other
                        gone.setdefault(own[0], []).append((own[2], own[3] + LENGTH))
            if len(seen) >= RUN_ROWS:
                flush()
        flush()
        if gone:
            rows.append((1, home, packed(gone)))
        return pa.table({"kind": pa.array([r[0] for r in rows], pa.int32()), "to": pa.array([r[1] for r in rows], pa.int32()), "payload": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _settle(group: list[tuple[bytes, tuple, int]], out) -> None:
    """Windows of the distinct zones of one group: all but the earliest of equal ones are removed."""
    zones = []
    for suffix, key, place in group:
        right = suffix[-1]
        zones.append((key, place, suffix[1 + right : -1][::-1], suffix[1 : 1 + right]))
    zones.sort(key=lambda z: z[:2])
    # a window that begins `back` bytes before the place ends LENGTH - back bytes after it
    for back in range(min(max(0, LENGTH - len(z[3])) for z in zones), max(len(z[2]) for z in zones) + 1):
        seen = set()
        for key, place, left, right in zones:
            if back <= len(left) and LENGTH - back <= len(right):
                window = left[len(left) - back :] + right[: LENGTH - back]
                if window in seen:
                    out(key, place - back, place - back + LENGTH)
                else:
                    seen.add(window)


def _merge_runs(batches):
    """Rows (home, payload) of removed ranges, from the runs of each hash range."""

    def rows():
        for batch in batches:
            for kind, to, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                yield kind, to, payload

    def emit(homes: dict):
        out = {h: packed(g) for h, g in homes.items() if g}
        return pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array(list(out.values()), pa.binary())], names=["home", "payload"])

    def solved(payloads: list[bytes]):
        homes: dict[int, dict] = {}
        runs, keys = [], {}
        for payload in payloads:
            home, names, docs, places, shared, sizes, rest = unpacked(payload)
            run = Run(shared, sizes, rest, [docs, places])
            keys[id(run)] = [(*name, home) for name in names]
            runs.append(run)

        def out(key, start, end):
            homes.setdefault(key[2], {}).setdefault(key[:2], []).append((start, end))

        group: list[tuple[bytes, tuple, int]] = []
        before = b""
        for suffix, lcp, run, at in merged(runs):
            key, place = keys[id(run)][run.owner[0][at]], int(run.owner[1][at])
            if group and lcp < 1 + before[0]:
                if len(group) > 1:
                    _settle(group, out)
                group = []
            if group and lcp == len(suffix) == len(before):
                _, other, spot = group[-1]
                mine = (key, place)
                if (key, place) < (other, spot):
                    group[-1] = (suffix, key, place)
                    mine = (other, spot)
                right = suffix[-1]
                out(mine[0], mine[1] - (len(suffix) - 2 - right), mine[1] + right)
            else:
                group.append((suffix, key, place))
            before = suffix
        if len(group) > 1:
            _settle(group, out)
        return homes

    at, hold = None, []
    for kind, to, payload in rows():
        if kind == 1:
            yield pa.RecordBatch.from_arrays([pa.array([to], pa.int32()), pa.array([payload], pa.binary())], names=["home", "payload"])
            continue
        if to != at and hold:
            yield emit(solved(hold))
            hold = []
        at = to
        hold.append(payload)
    if hold:
        yield emit(solved(hold))


def spans_of(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def _finish(texts: pa.Table, removed: pa.Table) -> pa.Table:
    gone: dict[tuple[int, bytes], list] = {}
    for payload in removed.column("payload").to_pylist():
        for key, ranges in unpacked(payload)[0].items():
            gone.setdefault(key, []).extend(ranges)
    columns: list[list] = [[], [], [], [], []]
    for i, key, data, copies in _documents(texts):
        spans = spans_of(gone.get(key, []))
        kept, at = hashlib.sha256(), 0
        for start, end in spans:
            kept.update(data[at:start])
            at = end
        kept.update(data[at:])
        for c, x in zip(columns, (i, len(data), [{"start": s, "end": e} for s, e in spans], kept.hexdigest(), copies), strict=True):
            c.append(x)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = (pa.int64(), pa.int64(), spans_type, pa.string(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "removed", "kept_sha256", "copies"])


def repeated_strings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, removed, kept_sha256): every document with the maximal runs of bytes to remove."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length(docs[text])), F.lit(0))).first()[0]
    width = max(shuffle_width(spark), total // SHARE_BYTES + 1)
    homes = max(width, total // HOME_BYTES + 1)
    home = F.pmod(F.xxhash64(docs[doc_id].cast("long"), docs[text]), F.lit(homes)).cast("int")
    rows = docs.select(home.alias("home"), docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    texts = rows.mapInArrow(_pack_texts, "home int, payload binary")
    grams = texts.groupBy("home").applyInArrow(_send_grams(width), "range int, payload binary")
    grams = grams.repartition(width, "range").sortWithinPartitions("range").mapInArrow(_repeated_grams, "home int, payload binary")
    runs = texts.groupBy("home").cogroup(grams.groupBy("home")).applyInArrow(_send_runs(width), "kind int, to int, payload binary")
    runs = runs.repartition(width, "to").sortWithinPartitions("kind", "to")
    removed = runs.mapInArrow(_merge_runs, "home int, payload binary")
    found = texts.groupBy("home").cogroup(removed.groupBy("home")).applyInArrow(
        _finish, "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept_sha256 string, copies long"
    )
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_strings(table(spark, sf_dir, "documents"))
    n_removed = F.expr("aggregate(removed, 0L, (n, s) -> n + s.end - s.start)")
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


#: Every window by its bytes, the runs of those that start earlier too, and what is left between the runs.
OP2_SQL = f"""
WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i AS start, md5_number(substr(h, 2 * i + 1, {2 * LENGTH})) AS s FROM d, unnest(range(0, n - {LENGTH - 1})) AS t(i) WHERE n >= {LENGTH}),
r AS (SELECT doc_id, start FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, start) > 1),
g AS (SELECT *, start > coalesce(lag(start) OVER (PARTITION BY doc_id ORDER BY start), -{LENGTH + 1}) + {LENGTH} AS fresh FROM r),
i AS (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM g),
u AS (SELECT doc_id, min(start) AS s, max(start) + {LENGTH} AS e FROM i GROUP BY doc_id, run),
v AS (SELECT *, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM u),
k AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS kept FROM v JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
