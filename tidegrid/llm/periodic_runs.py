"""Periodic run detection by a suffix automaton with link-cut access (operator 13).

A run is a stretch of words with smallest period q that repeats it at least EXPONENT
times, holds at least SHORTEST words, and goes on in neither direction.

*Automaton.* The suffix automaton of a text's words is built word by word; its suffix
links form a tree whose path from a prefix's state to the root holds all suffixes of that
prefix. The states' last occurrences are kept as colours of preferred paths, one splay
tree each. Appending word i accesses the state of its prefix: the whole path to the root
becomes one preferred path of colour i. On the way up, each path segment recoloured says
that its longest suffix, of some length l, ended at e before and ends at i now. For the
distance d = i - e, the l + d words up to i have period d; l >= d is a square, and
l >= (EXPONENT - 1) d is a run's beginning. It starts where the run starts, for a longer
suffix ended elsewhere, and d is its smallest period, for a smaller one would have left a
later occurrence. The same start and period come again with each further word of the
run, which extends it to its end.

*Stretches.* Every three consecutive words inside a run occur three times in it. The
parts of a text where this holds, found by counting and counted again within themselves,
are all that the automaton has to be built for; a run is never cut by this.

Rows are independent, so nothing is shuffled; what a task holds is a few texts and the
automaton of one stretch, in arrays. Words are known by 64-bit hashes.

Defined cases: null and empty texts and texts without words have no words, no runs and
an empty collapsed text; a null key is returned as null; repeated rows give repeated
results; an empty table gives an empty result. Columns other than key and text are never
read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.llm.common import WordHashes, gram_hashes, map_rows, scan, texts

# The fewest words and repetitions of a run.
SHORTEST = 6
EXPONENT = 4
# Consecutive words counted to find stretches, and rounds of counting within stretches.
GRAM = 3
ROUNDS = 8

# From key and number of words to the places the words are taken from (None: as they are).
Rewrite = Callable[[object, int], np.ndarray | None]


class SuffixAutomaton:
    """States of a word sequence: lengths, suffix links, and the state of each prefix.

    Nearly all states have one transition, kept in two arrays; only the others have a table.
    """

    def __init__(self, words: list[int]) -> None:
        self.length, self.link = array("i", [0]), array("i", [-1])
        self.word, self.next = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.prefix = array("i")
        last = 0
        for word in words:
            last = self.append(last, word)
            self.prefix.append(last)

    def state(self, length: int, link: int, word: int, following: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(word)
        self.next.append(following)
        return len(self.length) - 1

    def append(self, last: int, word: int) -> int:
        words, following, more, link = self.word, self.next, self.more, self.link
        new = self.state(self.length[last] + 1, 0, -1, 0)
        at = last
        while at >= 0:
            if words[at] == word:
                met = following[at]
                break
            if words[at] < 0:
                words[at], following[at] = word, new
            else:
                table = more.get(at)
                if table is None:
                    more[at] = {word: new}
                elif word in table:
                    met = table[word]
                    break
                else:
                    table[word] = new
            at = link[at]
        else:
            return new
        if self.length[met] == self.length[at] + 1:
            link[new] = met
            return new
        clone = self.state(self.length[at] + 1, link[met], words[met], following[met])
        if met in more:
            more[clone] = dict(more[met])
        link[met] = link[new] = clone
        while at >= 0:
            if words[at] == word:
                if following[at] != met:
                    break
                following[at] = clone
            else:
                table = more.get(at)
                if table is None or table.get(word) != met:
                    break
                table[word] = clone
            at = link[at]
        return new


class LastEnds:
    """Preferred paths of the link tree, as splay trees ordered by depth.

    A path's colour is where its strings ended last; it is kept at the splay tree's root.
    State 0, the empty string, is left out and stands for "none".
    """

    def __init__(self, automaton: SuffixAutomaton) -> None:
        states = len(automaton.length)
        self.length = automaton.length
        self.up = array("i", [max(x, 0) for x in automaton.link])
        self.upper, self.lower = array("i", bytes(4 * states)), array("i", bytes(4 * states))
        self.colour = array("i", [-1]) * states

    def splay(self, x: int) -> None:
        """Bring a state to the root of its path's tree; the colour moves along."""
        up, upper, lower, colour = self.up, self.upper, self.lower, self.colour
        while True:
            f = up[x]
            left = upper[f] == x
            if not f or not (left or lower[f] == x):
                return
            g = up[f]
            over = upper[g] == f
            if not g or not (over or lower[g] == f):
                colour[x] = colour[f]
                self.rotate(x, f, left)
                return
            h = up[g]
            if not h or not (upper[h] == g or lower[h] == g):
                colour[x] = colour[g]
            if left == over:
                self.rotate(f, g, over)
                self.rotate(x, f, left)
            else:
                self.rotate(x, f, left)
                self.rotate(x, g, over)

    def rotate(self, x: int, f: int, left: bool) -> None:
        up, upper, lower = self.up, self.upper, self.lower
        g = up[f]
        if g:
            if upper[g] == f:
                upper[g] = x
            elif lower[g] == f:
                lower[g] = x
        if left:
            child = lower[x]
            upper[f], lower[x] = child, f
        else:
            child = upper[x]
            lower[f], upper[x] = child, f
        if child:
            up[child] = f
        up[f], up[x] = x, g

    def access(self, x: int, now: int, runs: dict[tuple[int, int], int]) -> None:
        """Colour the path from x to the root with `now`; squares that show are extended."""
        up, lower, colour, length = self.up, self.lower, self.colour, self.length
        below, seen = 0, -1
        while x:
            self.splay(x)
            end = colour[x]
            if end > seen:
                seen, period, held = end, now - end, length[x]
                if held >= (EXPONENT - 1) * period and held + period >= SHORTEST:
                    runs[now - held - period + 1, period] = now
            if lower[x]:
                # deeper states keep their colour, on a path of their own
                colour[lower[x]] = end
            lower[x] = below
            below, x = x, up[x]
        colour[below] = now


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """Parts of a text, as (first, end), that hold all runs."""
    found, todo = [], [(0, len(words), 0)]
    while todo:
        first, end, level = todo.pop()
        if end - first < SHORTEST:
            continue
        grams = gram_hashes(words[first:end], GRAM)
        _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
        often = times[which] >= EXPONENT - 1
        if level == ROUNDS or often.all():
            found.append((first, end))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], often.view(np.int8), [0]))))
        todo += [(first + a, first + b + GRAM - 1, level + 1) for a, b in edges.reshape(-1, 2).tolist()]
    return found


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of hashed words as (start, length, period), by start, then period."""
    out = []
    for first, end in stretches(words):
        _, names = np.unique(words[first:end], return_inverse=True)
        automaton = SuffixAutomaton(names.tolist())
        ends, runs = LastEnds(automaton), {}
        for now, state in enumerate(automaton.prefix):
            ends.access(state, now, runs)
        out += [(first + start, last - start + 1, period) for (start, period), last in runs.items()]
    return sorted(out, key=lambda run: (run[0], run[2]))


def repeated(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word lies in a run after the run's first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) > 0


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """One row per document: key, n_words, runs (start, length, period; by start, then
    period), collapsed (the words that no run repeats, joined by spaces)."""
    dtype = docs.schema[key].dataType

    def make():
        memory = WordHashes()

        def one(name, content: bytes):
            words = content.split()
            places = rewrite(name, len(words)) if rewrite else None
            if places is not None:
                words = [words[i] for i in places.tolist()]
            runs = runs_of(memory.of(words)) if len(words) >= SHORTEST else []
            if runs:
                kept = np.flatnonzero(~repeated(len(words), runs)).tolist()
                return len(words), runs, b" ".join([words[i] for i in kept])
            return len(words), runs, b" ".join(words)

        def work(columns):
            keys, column = columns
            rows = [one(k, t) for k, t in zip(keys.to_pylist(), texts(column))]
            counts, runs, kept = zip(*rows) if rows else ((), (), ())
            spans = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
            return [keys, list(counts), pa.array(spans, RUNS), pa.array(kept, pa.binary()).cast(pa.string())]

        return work

    arrow = pa.schema([("_key", to_arrow_type(dtype)), ("n_words", pa.int64()), ("runs", RUNS), ("collapsed", pa.string())])
    schema = f"_key {dtype.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    out = map_rows(docs.select(F.col(key), F.col(text).cast("string")), make, schema, arrow)
    return out.withColumnRenamed("_key", key)


def tail_repeated(key, n: int) -> np.ndarray | None:
    """The rewriting of op13: in a tenth of the documents, by the key's checksum, the words
    from some place on repeat the first of them."""
    if key is None or n == 0:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    places = np.arange(n)
    places[first:] = first + (places[first:] - first) % period
    return places


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(scan(spark, sf_dir, "documents"), rewrite=tail_repeated)
    # of equal lengths the first counts: runs are in order of start, then period
    longest = F.array_max(F.transform("runs", lambda r: r["length"]))
    best = F.get(F.filter("runs", lambda r: r["length"] == F.col("_longest")), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (
        found.withColumn("_longest", longest)
        .withColumn("_best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            "_best.start",
            "_best.length",
            "_best.period",
            F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )
