"""Token counts of greedy longest-match word pieces by a linear automaton.

The vocabulary has pieces that begin a word and pieces that go on. Both are tries, and every trie node has a failure link
and the number of pieces that following it pops: those that a longest match takes off the front of what was read. A word
is then read once, letter by letter; where the trie has no way on, the count rises by the node's popped pieces and reading
goes on at its failure link. No piece is ever built. A word that can't be covered counts as one unknown token.

Words are runs of word characters, and single characters that are neither those nor spaces. The counts of frequent words
are kept in a bounded table of each task.

Defined cases: null, empty and blank texts have 0 words and tokens; repeated rows are counted one by one; a null doc_id
stays null; texts are counted whole, and so are words of any length; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD = re.compile(r"\w+|[^\w\s]")
_KEPT_WORDS = 1 << 19
_CODES = 21  # bits of a code point


class LongestMatch:
    """Counts pieces of words; `begin` pieces start a word and `go_on` pieces follow."""

    ROOT, SUFFIX = 0, 1

    def __init__(self, begin: Iterable[str], go_on: Iterable[str]) -> None:
        self.next: dict[int, int] = {}
        parent, letter, piece = [0, 0], [0, 0], [False, False]
        for root, pieces in ((self.ROOT, begin), (self.SUFFIX, go_on)):
            for word in pieces:
                node = root
                for c in word:
                    key = node << _CODES | ord(c)
                    if key not in self.next:
                        self.next[key] = len(parent)
                        parent.append(node)
                        letter.append(ord(c))
                        piece.append(False)
                    node = self.next[key]
                piece[node] |= node > self.SUFFIX
        self.fail, self.pops = [-1] * len(parent), [0] * len(parent)
        children: dict[int, list[int]] = {}
        for node in range(2, len(parent)):
            children.setdefault(parent[node], []).append(node)
        level = children.get(self.ROOT, []) + children.get(self.SUFFIX, [])
        while level:  # by depth: links lead to nodes of lesser depth
            for node in level:
                if piece[node]:
                    self.fail[node], self.pops[node] = self.SUFFIX, 1
                    continue
                at, popped = self.fail[parent[node]], self.pops[parent[node]]
                while at >= 0 and (at << _CODES | letter[node]) not in self.next:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.pops[node] = self.next[at << _CODES | letter[node]], popped
            level = [c for node in level for c in children.get(node, ())]

    def count(self, word: str) -> int:
        """Pieces of the word; 0 if it can't be covered."""
        step, fail, pops = self.next.get, self.fail, self.pops
        node, total = self.ROOT, 0
        for c in word:
            code = ord(c)
            while (to := step(node << _CODES | code)) is None:
                if fail[node] < 0:
                    return 0
                total += pops[node]
                node = fail[node]
            node = to
        while node != self.SUFFIX:
            if fail[node] < 0:
                return 0
            total += pops[node]
            node = fail[node]
        return total


def pieces_of(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that go on, from a sentencepiece model; special pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    named = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    mark = "▁"
    return [p[1:] for p in named if p.startswith(mark) and len(p) > 1], [p for p in named if mark not in p]


class _Counts(dict):
    def __init__(self, automaton: LongestMatch) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word)
        if len(self) >= _KEPT_WORDS:
            self.clear()
        self[word] = n
        return n


def token_counts(docs: DataFrame, *, keep: list[str], text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Columns `keep` of docs with n_words, n_tokens and n_unknown."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces_of(vocabulary))

    def setup():
        counts = _Counts(LongestMatch(*shared.value))

        def run(texts):
            n_words, n_tokens, n_unknown = [], [], []
            for value in texts.to_pylist():
                found = list(map(counts.__getitem__, WORD.findall(value))) if value else []
                unknown = found.count(0)
                n_words.append(len(found))
                n_tokens.append(sum(found) + unknown)
                n_unknown.append(unknown)
            return [pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown)]

        return run

    return arrow_map(docs, [text], keep, [T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens", "n_unknown")], setup)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(F.col("doc_id"), "n_words", "n_tokens", "n_unknown")


def oracle_sql(vocabulary: str = VOCABULARY) -> str:
    """SQL for op7: the longest piece at every place of every different word, then a walk over its places."""
    begin, go_on = pieces_of(vocabulary)
    quoted = lambda piece: "'" + piece.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(p)}, {start})" for pieces, start in ((begin, "true"), (go_on, "false")) for p in pieces)
    longest = max(map(len, [*begin, *go_on]))
    return f"""
WITH v(piece, begins) AS (VALUES {rows}),
w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}]') AS words FROM documents),
d AS (SELECT DISTINCT unnest(words) AS word FROM w),
p AS (SELECT word, CAST(i AS INT) AS spot, CAST(n AS INT) AS n FROM d, unnest(range(1, length(word) + 1)) AS a(i), unnest(range(1, least({longest}, length(word) - i + 1) + 1)) AS b(n)),
m AS (SELECT word, spot, max(n) AS n FROM p JOIN v ON v.piece = substr(word, spot, n) AND v.begins = (spot = 1) GROUP BY 1, 2),
g AS (SELECT word, list({{'following': 0, 'pieces': 0, 'spot': spot, 'n': n}} ORDER BY spot) AS steps FROM m GROUP BY 1),
e AS (SELECT word, list_reduce(list_prepend({{'following': 1, 'pieces': 0, 'spot': 0, 'n': 0}}, steps),
  lambda a, x: CASE WHEN x.spot = a.following THEN {{'following': a.following + x.n, 'pieces': a.pieces + 1, 'spot': 0, 'n': 0}} ELSE a END) AS walk FROM g),
c AS (SELECT word, CASE WHEN walk.following = length(word) + 1 THEN walk.pieces ELSE 0 END AS n FROM d LEFT JOIN e USING (word)),
t AS (SELECT doc_id, sum(greatest(n, 1)) AS n_tokens, count(*) FILTER (n = 0) AS n_unknown FROM (SELECT doc_id, unnest(words) AS word FROM w) JOIN c USING (word) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_tokens, 0) AS BIGINT) AS n_tokens, CAST(coalesce(n_unknown, 0) AS BIGINT) AS n_unknown FROM w LEFT JOIN t USING (doc_id)"""
