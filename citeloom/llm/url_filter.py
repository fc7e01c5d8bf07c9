"""URL filters: rules first, then naive Bayes over segmented host and path words.

A rule is a host with a path prefix; it fits the host and its subdomains, and of the fitting rules the longest decides.
Other urls are judged by multinomial naive Bayes. Their hosts are often words run together, so every host label is split by
Viterbi over a unigram model; host words and path words are the tokens, and runs of digits are one token.

The unigram model counts all words of all page titles, and its total is over all of them. Each different host is split once:
its labels' pieces meet the word counts in a join, and a label with the counts of its own pieces is a row that Viterbi reads.
So no vocabulary has to fit the driver or a broadcast, and no word is left out for its rank. Hosts and labels go by numbers,
and a bit for each of `SIEVE` hashes of title words keeps back pieces that can't be words, so what is sent grows with the
length of a label, not with its square. Naive Bayes learns from all urls that a rule decides: counts of the hashed tokens
(`SLOTS`) of blocked and allowed ones. Having no other labels, it mostly learns the given rules again.

Defined cases: a null url, or one without `://`, has an empty host and path and no tokens, so the class shares decide;
without urls of both kinds to learn from, what no rule blocks is allowed; null page ids stay null; repeated rows are judged
one by one; of two fitting rules of one length the longer host decides; hosts and labels of any length are split whole (a
test has one of 1,000,000 letters); empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, arrow_map, checkpointed, slices, spread_join, table

#: Fixed by the contract: verdict, host, path prefix.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
LONGEST_WORD = 24
SLOTS = 1 << 16
#: Bits that tell which pieces may be words, and pieces of an Arrow batch.
SIEVE = 1 << 22
_PIECES = 1 << 16
_LOWER = {c: c + 32 for c in range(65, 91)}
_HOST = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")
_WORD = re.compile(r"[^\W\d_]+|\d+")


def parts_of(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = _HOST.match(rest).group()
    return host.translate(_LOWER), _PATH.match(rest, len(host)).group()


class Rules:
    def __init__(self, rules=RULES) -> None:
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host, []).append((path, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest fitting rule, as written, and its verdict; of equally long ones that of the longer host."""
        best = None
        for name, rules in self.by_host.items():
            if host != name and not host.endswith("." + name):
                continue
            for prefix, verdict in rules:
                if path.startswith(prefix) and (best is None or (len(name) + len(prefix), len(name)) > best[0]):
                    best = ((len(name) + len(prefix), len(name)), name + prefix, verdict)
        return best and best[1:]


def pieces_of(run: str) -> Iterator[str]:
    """What a split of a run of letters can hold, in order of place and length."""
    for k in range(len(run)):
        for n in range(1, min(LONGEST_WORD, len(run) - k) + 1):
            yield run[k : k + n]


def sieve_of(counts: DataFrame) -> np.ndarray:
    """A bit for each hash that a counted word has: SIEVE numbers come to the driver at most."""
    bits = np.zeros(SIEVE, bool)
    bits[counts.select(F.pmod(F.crc32("word"), F.lit(SIEVE)).alias("bit")).distinct().toArrow().column(0).to_numpy()] = True
    return np.packbits(bits)


def may_be_word(piece: str, sieve: np.ndarray) -> bool:
    bit = zlib.crc32(piece.encode("utf-8", "surrogatepass")) % SIEVE
    return bool(sieve[bit >> 3] >> (7 - (bit & 7)) & 1)


def split_run(run: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest split under the unigram model; unknown pieces cost by their length."""
    total = max(1, total)
    n = len(run)
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            cost = best[start] + cost_of(run[start:end], counts, total)
            if cost > best[end]:
                best[end], back[end] = cost, start
    out = []
    while n:
        out.append(run[back[n] : n])
        n = back[n]
    return out[::-1]


def cost_of(piece: str, counts: dict[str, int], total: int) -> float:
    n = counts.get(piece)
    return math.log(n / total) if n else math.log(1.0 / total) - 2.3 * len(piece)


def tokens_of(host_words: list[str], path: str) -> list[str]:
    return [f"h:{w}" for w in host_words] + [f"p:{w.lower() if w.isalpha() else '0'}" for w in _WORD.findall(path)]


@dataclass
class Bayes:
    """Log odds of block over allow, by hashed token."""

    prior: float
    odds: np.ndarray

    def score(self, tokens: list[str]) -> float:
        return self.prior + sum(float(self.odds[slot_of(t)]) for t in tokens)


def slot_of(token: str) -> int:
    return int.from_bytes(hashlib.md5(token.encode("utf-8", "surrogatepass")).digest()[:4]) % SLOTS


def title_words(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n): counts of the words of all titles."""
    title = F.lower(F.regexp_extract(pages[html], r"(?is)<title[^>]*>(.*?)</title>", 1))
    words = pages.select(F.explode(F.split(title, r"[^\p{L}]+")).alias("word")).where("word <> ''")
    return checkpointed(words.groupBy("word").agg(F.count("*").alias("n")))


def parsed(pages: DataFrame, *, keep: list[str], url: str = "url", rules=RULES) -> DataFrame:
    """Columns `keep` of pages with host, path, rule and the rule's verdict (decided)."""

    def setup():
        known = Rules(rules)

        def run(urls):
            parts = [parts_of(value) for value in urls.to_pylist()]
            found = [known.find(*p) or (None, None) for p in parts]
            return [pa.array([x[k] for x in rows], pa.string()) for rows in (parts, found) for k in range(2)]

        return run

    return arrow_map(pages, [url], keep, [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "decided")], setup)


def split_hosts(hosts: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(host, host_words) of different hosts, with word counts (word, n) of which `total` is the sum."""

    shared = hosts.sparkSession.sparkContext.broadcast(sieve_of(counts))

    def made(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))

    def in_batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += 16 + sum(len(x) for x in row if isinstance(x, str | list))
            if len(held) >= _PIECES or size > SLICE_BYTES:
                yield made(held, kinds)
                held, size = [], 0
        yield made(held, kinds)

    def rows_of(batches) -> Iterator[tuple]:
        for whole in batches:
            for batch in slices(whole):
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    def runs(batches):
        found = ((number, at, run) for number, host in rows_of(batches) for at, run in enumerate(_WORD.findall(host)))
        yield from in_batches(found, {"host_no": pa.int64(), "at": pa.int32(), "run": pa.string()})

    def pieces(batches):
        def found():
            for number, run in rows_of(batches):
                seen: set[str] = set()
                for piece in pieces_of(run):
                    if piece not in seen and may_be_word(piece, shared.value):
                        if len(seen) < _PIECES:  # what is said again beyond that is met again, and counts once below
                            seen.add(piece)
                        yield number, piece

        yield from in_batches(found(), {"run_no": pa.int64(), "word": pa.string()})

    def splits(batches):
        found = ((run, split_run(run, dict(known or ()), total)) for run, known in rows_of(batches))
        yield from in_batches(found, {"run": pa.string(), "words": pa.list_(pa.string())})

    # numbers stay as they are once they are written
    named = checkpointed(hosts.select(F.monotonically_increasing_id().alias("host_no"), "host"))
    placed = checkpointed(named.mapInArrow(runs, "host_no long, at int, run string"))
    letters = placed.where(~F.col("run").rlike(r"^\d")).select("run").distinct()
    letters = checkpointed(letters.select(F.monotonically_increasing_id().alias("run_no"), "run"))
    # a piece such as a single letter is in very many runs
    meets = spread_join(checkpointed(letters.mapInArrow(pieces, "run_no long, word string")), counts, "word").where("n is not null").distinct()
    known = meets.groupBy("run_no").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))
    split = checkpointed(letters.join(known, "run_no", "left").select("run", "known").mapInArrow(splits, "run string, words array<string>"))
    joined = spread_join(placed, split, "run").withColumn("words", F.coalesce("words", F.array(F.lit("0"))))  # runs of digits
    words = joined.groupBy("host_no").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x.words)).alias("host_words"))
    return named.join(words, "host_no").select("host", "host_words")


def segmented(pages: DataFrame, *, keep: list[str], url: str = "url", html: str = "html", rules=RULES) -> DataFrame:
    """Columns `keep` of pages with host, path, rule, decided and host_words; the unigram model is of the pages' titles."""
    counts = title_words(pages, html)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = checkpointed(parsed(pages, keep=[c for c in keep if c != html], url=url, rules=rules))
    made = checkpointed(split_hosts(rows.select("host").distinct(), counts, total))
    return spread_join(rows, made, "host").withColumn("host_words", F.coalesce("host_words", F.array().cast("array<string>")))


def fitted(rows: DataFrame) -> Bayes:
    """Counts the tokens of all rows of segmented() that a rule decides."""

    def count(batches):
        seen: dict[str, Counter] = {"block": Counter(), "allow": Counter()}
        for batch in batches:
            for words, path, verdict in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                seen[verdict].update(map(slot_of, tokens_of(words, path)))
                seen[verdict][-1] += 1  # urls
        rows = [(s, seen["block"][s], seen["allow"][s]) for s in seen["block"].keys() | seen["allow"].keys()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["slot", "block", "allow"])

    each = rows.where("decided is not null").select("host_words", "path", "decided").mapInArrow(count, "slot long, block long, allow long")
    counts = each.groupBy("slot").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).collect()  # SLOTS + 1 rows at most
    table_ = np.zeros((SLOTS, 2))
    urls = np.zeros(2)
    for r in counts:
        if r["slot"] < 0:
            urls[:] = r["block"], r["allow"]
        else:
            table_[r["slot"]] = r["block"], r["allow"]
    if not urls.all():
        return Bayes(-1.0, np.zeros(SLOTS))
    chance = np.log((table_ + 1) / (table_.sum(axis=0) + SLOTS))
    return Bayes(float(np.log(urls[0] / urls[1])), chance[:, 0] - chance[:, 1])


def judged(rows: DataFrame, bayes: Bayes, *, keep: list[str]) -> DataFrame:
    """Columns `keep` of segmented() with host, path, rule, host_words, block_odds and verdict."""
    shared = rows.sparkSession.sparkContext.broadcast(bayes)

    def setup():
        return lambda words, paths: [pa.array([shared.value.score(tokens_of(*row)) for row in zip(words.to_pylist(), paths.to_pylist(), strict=True)], pa.float64())]

    own = [*keep, "host", "path", "rule", "decided", "host_words"]
    scored = arrow_map(rows, ["host_words", "path"], own, [T.StructField("block_odds", T.DoubleType())], setup)
    verdict = F.coalesce("decided", F.when(F.col("block_odds") > 0, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).drop("decided")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checkpointed(segmented(table(spark, sf_dir, "pages"), keep=["page_id"]))
    return judged(rows, fitted(rows), keep=["page_id"]).select("page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)
#: Rules by suffix and prefix; splits by a fold over the ends of pieces with their costs; naive Bayes by counts of slots.
OP3_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest, html FROM pages),
v AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path, row_number() OVER () AS id FROM v),
rules(verdict, h, f) AS (VALUES {_RULES_SQL}),
fits AS (SELECT id, arg_max(h || f, length(h || f) * 1000 + length(h)) AS rule, arg_max(verdict, length(h || f) * 1000 + length(h)) AS decided FROM p JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, f) GROUP BY id),
words AS (SELECT w, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '[^\\p{{L}}]+')) AS w FROM u) WHERE w <> '' GROUP BY 1),
total AS (SELECT greatest(1, coalesce(sum(n), 0)) AS n FROM words),
runs AS (SELECT host, i, found[i] AS run FROM (SELECT DISTINCT host, regexp_extract_all(host, '\\p{{L}}+|\\p{{Nd}}+') AS found FROM p), unnest(range(1, len(found) + 1)) AS t(i)),
letters AS (SELECT DISTINCT run FROM runs WHERE NOT regexp_matches(run, '^\\p{{Nd}}')),
pieces AS (SELECT run, a AS low, b AS high, substr(run, a + 1, b - a) AS piece FROM letters, unnest(range(1, length(run) + 1)) AS x(b), unnest(range(greatest(0, b - {LONGEST_WORD}), b)) AS y(a)),
costs AS (SELECT run, high, min(low) AS low, list(CASE WHEN words.n IS NOT NULL THEN ln(words.n / total.n) ELSE ln(1.0::DOUBLE / total.n) - 2.3::DOUBLE * length(piece) END ORDER BY low) AS costs FROM pieces LEFT JOIN words ON w = piece, total GROUP BY 1, 2),
steps AS (SELECT run, list({{'best': []::DOUBLE[], 'split': []::VARCHAR[], 'costs': costs, 'low': low, 'high': high, 'run': run}} ORDER BY high) AS steps FROM costs GROUP BY 1),
folded AS (SELECT run, list_reduce(list_prepend({{'best': [0.0::DOUBLE], 'split': [''], 'costs': []::DOUBLE[], 'low': 0::BIGINT, 'high': 0::BIGINT, 'run': run}}, steps), lambda s, x: {{
  'best': list_append(s.best, list_max(list_transform(x.costs, lambda c, i: s.best[x.low + i] + c))),
  'split': list_append(s.split, s.split[x.low + list_position(list_transform(x.costs, lambda c, i: s.best[x.low + i] + c), list_max(list_transform(x.costs, lambda c, i: s.best[x.low + i] + c)))]
    || chr(9) || substr(x.run, x.low + list_position(list_transform(x.costs, lambda c, i: s.best[x.low + i] + c), list_max(list_transform(x.costs, lambda c, i: s.best[x.low + i] + c))), x.high + 1 - x.low - list_position(list_transform(x.costs, lambda c, i: s.best[x.low + i] + c), list_max(list_transform(x.costs, lambda c, i: s.best[x.low + i] + c))))),
  'costs': x.costs, 'low': x.low, 'high': x.high, 'run': x.run}}) AS f FROM steps),
tokens AS (SELECT id, 'h:' || unnest(string_split(coalesce(substr(f.split[-1], 2), '0'), chr(9))) AS token FROM p JOIN runs USING (host) LEFT JOIN folded USING (run)
  UNION ALL SELECT id, 'p:' || CASE WHEN regexp_matches(w, '^\\p{{L}}') THEN lower(w) ELSE '0' END FROM (SELECT id, unnest(regexp_extract_all(path, '\\p{{L}}+|\\p{{Nd}}+')) AS w FROM p)),
slots AS (SELECT id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {SLOTS} AS slot FROM tokens),
seen AS (SELECT slot, count(*) FILTER (decided = 'block') AS b, count(*) FILTER (decided = 'allow') AS a FROM slots JOIN fits USING (id) GROUP BY 1),
sums AS (SELECT coalesce(sum(b), 0) + {SLOTS} AS b, coalesce(sum(a), 0) + {SLOTS} AS a FROM seen),
urls AS (SELECT count(*) FILTER (decided = 'block') AS b, count(*) FILTER (decided = 'allow') AS a FROM fits),
odds AS (SELECT id, sum(ln((coalesce(seen.b, 0) + 1) / sums.b) - ln((coalesce(seen.a, 0) + 1) / sums.a)) AS odds FROM slots LEFT JOIN seen USING (slot), sums GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN urls.b > 0 AND urls.a > 0 AND ln(urls.b / urls.a) + coalesce(odds, 0) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits USING (id) LEFT JOIN odds USING (id), urls"""
