"""Spelling variants: words one inserted, deleted or replaced character apart.

Letters fall into a few groups; a word's counts of letters per group are its
path in a trie, one level a group.  One edit changes the counts by one surplus
letter and one missing letter at most, so a word's near words lie on the paths
that a depth-first search reaches while it spends one surplus and one deficit.
Words at the leaves are verified character by character.

The trie is spread over the cluster by its own subtrees: a subtree with more
words than fit a task is cut at the next level, a leaf with more into chunks.
A word is sent to the subtrees its budget reaches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ragged, saved

GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "lu", "cd", "mpg")  # every other character: one more group
LONGEST_ROW = 32  # longer words are verified one by one
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(text: Column, least: int = 1) -> Column:
    """All maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of ``least`` or more, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("([a-zÀ-ÿ]{%d,})" % least), F.lit(1))


def _count(word: Column, level: int, groups: Sequence[str]) -> Column:
    """Letters of the word in the group of a level."""
    if level < len(groups):
        return F.length(word) - F.length(F.translate(word, groups[level], ""))
    return F.length(F.translate(word, "".join(groups), ""))


def _path(word: Column, depth: int, groups: Sequence[str]) -> Column:
    return F.concat_ws(".", *[_count(word, level, groups).cast("string") for level in range(depth)])


def _reach(asked: DataFrame, level: int, groups: Sequence[str]) -> DataFrame:
    """(word, path, up, down) one level deeper: the same count, one more or one less while the budget lasts."""
    c = _count(F.col("word"), level, groups)

    def step(at: Column, up: Column, down: Column) -> Column:
        return F.struct(at.cast("string").alias("at"), up.alias("up"), down.alias("down"))

    ways = F.array(step(c, F.col("up"), F.col("down")),
                   F.when(~F.col("up"), step(c + 1, F.lit(True), F.col("down"))),
                   F.when(~F.col("down") & (c > 0), step(c - 1, F.col("up"), F.lit(True))))
    path = F.when(F.col("path") == "", F.col("to.at")).otherwise(F.concat_ws(".", "path", "to.at"))
    return (asked.select("word", "path", F.explode(F.filter(ways, lambda x: x.isNotNull())).alias("to"))
            .select("word", path.alias("path"), "to.up", "to.down"))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters as numbers, and how many each word has."""
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32), lens


class Words:
    """Words as counts per group and, where short, as rows of characters."""

    def __init__(self, words: list[str], groups: Sequence[str]):
        self.words = words
        flat, self.lens = _codes(words)
        levels = len(groups) + 1
        group_of = np.full(max((ord(c) for g in groups for c in g), default=0) + 2, levels - 1)
        for level, letters in enumerate(groups):
            group_of[[ord(c) for c in letters]] = level
        row = np.repeat(np.arange(len(words)), self.lens)
        group = group_of[np.minimum(flat, len(group_of) - 1)]
        self.counts = np.bincount(row * levels + group, minlength=levels * len(words)).reshape(-1, levels)
        short = np.repeat(self.lens <= LONGEST_ROW, self.lens)
        at = ragged(np.zeros(len(words), dtype=np.int64), self.lens)
        self.rows = np.zeros((len(words), LONGEST_ROW + 1), dtype=np.uint32)
        self.rows[row[short], at[short]] = flat[short]

    def take(self, index: np.ndarray) -> list[str]:
        return [self.words[i] for i in index.tolist()]


def one_edit(a: str, b: str) -> bool:
    """True if one inserted, deleted or replaced character turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[lo + (len(a) == len(b)):] == b[lo + 1:]


def _edit_apart(left: Words, i: np.ndarray, right: Words, j: np.ndarray) -> np.ndarray:
    """``one_edit`` of the pairs (left[i], right[j])."""
    out = np.zeros(len(i), dtype=bool)
    a, b = left.lens[i], right.lens[j]
    long = np.maximum(a, b) > LONGEST_ROW
    for k in np.flatnonzero(long & (np.abs(a - b) <= 1)).tolist():
        out[k] = one_edit(left.words[i[k]], right.words[j[k]])
    same = np.flatnonzero(~long & (a == b))
    out[same] = (left.rows[i[same]] != right.rows[j[same]]).sum(axis=1) == 1
    for shorter, x, longer, y, at in ((left, i, right, j, np.flatnonzero(~long & (a + 1 == b))),
                                      (right, j, left, i, np.flatnonzero(~long & (b + 1 == a)))):
        if len(at):
            s, t = shorter.rows[x[at]], longer.rows[y[at]]
            first = (s != t).argmax(axis=1)  # the longer word's last character is one, if nothing before
            moved = s[:, :-1] != t[:, 1:]
            last = np.where(moved.any(axis=1), moved.shape[1] - 1 - moved[:, ::-1].argmax(axis=1), -1)
            out[at] = last < first
    return out


class Trie:
    """Words of one subtree in the order of their counts; a node of a level is a run of them."""

    def __init__(self, members: Words, weights: np.ndarray, depth: int, groups: Sequence[str]):
        self.members, self.weights, self.depth = members, weights, depth
        counts = members.counts
        self.levels = counts.shape[1]
        order = np.lexsort(counts.T[::-1])
        self.order = order
        counts = counts[order]
        self.span = int(counts.max(initial=0)) + 2
        node = np.zeros(len(order), dtype=np.int64)
        self.keys: list[np.ndarray] = []  # per level: parent node * span + count, ascending; the place is the node
        for level in range(depth, self.levels):
            key = node * self.span + counts[:, level]
            first = np.concatenate([[True], np.diff(key) != 0])
            self.keys.append(key[first])
            node = np.cumsum(first) - 1
        self.leaf = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(node) != 0])), [len(order)]])
        ranked = sorted(range(len(weights)), key=lambda k: (-weights[k], members.words[k]))
        self.rank = np.empty(len(ranked), dtype=np.int64)
        self.rank[ranked] = np.arange(len(ranked))
        self.ranked = np.array(ranked, dtype=np.int64)

    def search(self, asked: Words, up: np.ndarray, down: np.ndarray, most: int = 300_000):
        """Pairs (query, member) whose counts differ by the budget at most, a bounded number at a time.

        Depth first: a set of (query, node) goes down level by level; one that has
        grown beyond ``most`` is halved and the halves go down one after the other.
        """
        q = np.arange(len(asked.words))
        stack = [(self.depth, q, np.zeros(len(q), dtype=np.int64), up, down)]
        while stack:
            level, q, node, up, down = stack.pop()
            if len(q) > most:
                half = len(q) // 2
                stack += [(level, *(x[half:] for x in (q, node, up, down))),
                          (level, *(x[:half] for x in (q, node, up, down)))]
                continue
            if level == self.levels:
                start = self.leaf[node]
                size = self.leaf[node + 1] - start
                yield np.repeat(q, size), self.order[ragged(start, size)]
                continue
            keys, own, found = self.keys[level - self.depth], asked.counts[q, level], []
            for more in (0, 1, -1):
                able = np.arange(len(q)) if not more else np.flatnonzero(~up if more > 0 else (~down & (own > 0)))
                count = own[able] + more
                able, count = able[count < self.span], count[count < self.span]
                key = node[able] * self.span + count
                to = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[to] == key
                able = able[hit]
                found.append((q[able], to[hit], up[able] | (more > 0), down[able] | (more < 0)))
            stack.append((level + 1, *(np.concatenate(x) for x in zip(*found))))

    def near(self, asked: Words, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query: how many members are one edit away, and the best of them (heaviest, then first in order)."""
        n = np.zeros(len(asked.words), dtype=np.int64)
        best = np.full(len(asked.words), len(self.rank), dtype=np.int64)
        for q, m in self.search(asked, up, down):
            for lo in range(0, len(q), 200_000):
                a, b = q[lo:lo + 200_000], m[lo:lo + 200_000]
                ok = _edit_apart(asked, a, self.members, b)
                n += np.bincount(a[ok], minlength=len(n))
                np.minimum.at(best, a[ok], self.rank[b[ok]])
        return n, best


def _near_words(batches: Iterator[pa.RecordBatch], groups: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """(path, chunk, asked, word, n) rows in order, members before queries -> (word, n_near, best_n, best)."""
    key, held, trie = None, [], None
    for batch in batches:
        path, chunk, word = (batch.column(c) for c in (0, 1, 3))
        chunk, asked, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 4))
        label = path.dictionary_encode()
        code = label.indices.to_numpy()
        names = label.dictionary.to_pylist()
        edges = np.flatnonzero((np.diff(code) != 0) | (np.diff(chunk) != 0) | (np.diff(asked) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(code)]):
            if lo == hi:
                continue
            here = (names[code[lo]], int(chunk[lo]))
            if here != key:
                key, held, trie = here, [], None
            words = word.slice(lo, hi - lo).to_pylist()
            if not asked[lo]:
                held.append((words, n[lo:hi]))
                continue
            fixed = np.array([int(x) for x in key[0].split(".")], dtype=np.int64)
            if trie is None:
                if not held:
                    continue
                trie = Trie(Words([w for h in held for w in h[0]], groups),
                            np.concatenate([h[1] for h in held]), len(fixed), groups)
                held = []
            for at in range(0, len(words), 4096):
                some = Words(words[at:at + 4096], groups)
                gap = fixed - some.counts[:, :len(fixed)]
                n_near, best = trie.near(some, (gap > 0).any(axis=1), (gap < 0).any(axis=1))
                hit = np.flatnonzero(n_near)
                top = trie.ranked[best[hit]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.take(hit), pa.string()), pa.array(n_near[hit]), pa.array(trie.weights[top]),
                     pa.array(trie.members.take(top), pa.string())], names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, groups: Sequence[str] = GROUPS, subtree: int = 30_000, depth: int = 2) -> DataFrame:
    """(word, n_near, best, best_n) of every word of ``words`` (word, n; words once each) that has near words.

    ``best`` is the near word of largest n, of several the first in code-point
    order.  ``subtree`` bounds the words that a task holds at once; ``depth`` is
    the level at which the trie is cut first.  Nothing is capped: a larger
    subtree is cut deeper, a larger leaf into chunks that all its queries visit.
    """
    levels = len(groups) + 1
    members, asked = words, words.select("word", F.lit("").alias("path"), F.lit(False).alias("up"),
                                         F.lit(False).alias("down"))
    for level in range(depth):
        asked = _reach(asked, level, groups)
    found: list[DataFrame] = []
    while True:
        own = members.withColumn("path", _path(F.col("word"), depth, groups))
        chunks = F.ceil(F.count("*") / F.lit(subtree)).cast("int")
        nodes = saved(own.groupBy("path").agg(chunks.alias("chunks")), "subtrees")
        fits = F.lit(True) if depth == levels else F.col("chunks") == 1
        here = nodes.where(fits)
        found.append(own.join(here, "path").select(
            "path", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("asked"),
            "word", "n"))
        found.append(asked.join(here, "path").select(
            "path", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("asked"),
            "word", F.lit(0).cast("long").alias("n")))
        rest = nodes.where(~fits).select("path")
        if rest.isEmpty():
            break
        members = own.join(rest, "path", "left_semi").select("word", "n")
        asked = saved(_reach(asked.join(rest, "path", "left_semi"), depth, groups), "asked")
        depth += 1
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    placed = rows.repartition("path", "chunk").sortWithinPartitions("path", "chunk", "asked", "word")
    near = placed.mapInArrow(lambda b: _near_words(b, groups), "word string, n_near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("top")
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), top).select(
        "word", "n_near", F.col("top.word").alias("best"), (-F.col("top.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: the end of the chain of forms.

    Each round doubles the steps taken, so a chain of k forms takes log k rounds.
    """
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        both = saved(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        now = both.select("word", "root")
        if both.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame, factor: int = 2, **kw) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word string, n long).

    A word's form is its near word of largest n (ties: first in code-point
    order) if that n is at least ``factor`` times the word's own, else null; the
    root is the end of its chain of forms, itself if it has none.  Null words
    are left out; a repeated word counts once, with the sum of its n; words
    with no characters are near to those of one.  No words give no rows.  Extra
    columns are not read.
    """
    words = saved(words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    near = saved(words.join(near_words(words, **kw), "word", "left"), "near")
    good = F.col("best_n") >= factor * F.col("n")
    forms = near.withColumns({"form": F.when(good, F.col("best")), "form_n": F.when(good, F.col("best_n"))})
    ends = roots(forms.where("form IS NOT NULL"))
    return forms.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
