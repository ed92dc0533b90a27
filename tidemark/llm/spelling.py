"""Spelling variants: pairs of words one edit apart, found by finite-state composition, and the forms they lead to.

The vocabulary is an acceptor A. Composed with a transducer T that inserts, deletes or replaces one character, and with A
again, it accepts exactly the pairs of words one edit apart. The composition is enumerated per partition of initial
states: a state is what a prefix leads to, and its words are a task's work. A state with too many words is split: the
edit is taken at the state itself, by a join on what the edit leaves of the words, and otherwise both words go on along
the same arc, into a smaller state. In a state that is small enough the acceptor of the rest of its words is minimised
and composed in the task. Each pair is found once: its edit lies where the two words first differ.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, stored

LEAST_LETTERS, LEAST_COUNT, EVERY = 5, 3, 97
#: Words of a state that one task composes; a state with more of them is split.
BLOCK = 4000
#: Different words that a task holds before it hands on their counts.
HELD = 300_000
RUN = re.compile("[a-zÀ-ÿ]+")


def _word_counts(docs: DataFrame, id_col: str, text_col: str, least: int, every: int) -> DataFrame:
    """``word, n`` summed per task: a frequent word sends one row of each."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches, "text", 2 << 20):
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                before = zlib.crc32(f"{own}:".encode())
                for word, n in Counter(RUN.findall((text or b"").lower().decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), before)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least:
                        total[word] += n
            if len(total) > HELD:
                yield out(total)
                total.clear()
        yield out(total)

    return rows.mapInArrow(work, "word string, n long")


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    every: int = EVERY,
) -> DataFrame:
    """``word, n``: lower-cased runs of letters, every so many of them with one letter left out."""
    counts = _word_counts(docs, id_col, text_col, least_letters, every)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Acceptor:
    """The minimal acceptor of sorted words; ``below`` counts the words from a state on, so paths number the words."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        open_: list[tuple[int, str, int]] = []
        last = ""

        def close(depth: int) -> None:
            while len(open_) > depth:
                parent, letter, state = open_.pop()
                mark = (self.final[state], tuple(self.arcs[state].items()))
                self.arcs[parent][letter] = known.setdefault(mark, state)

        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            close(same)
            state = open_[-1][2] if open_ else 0
            for letter in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                new = len(self.arcs) - 1
                self.arcs[state][letter] = new
                open_.append((state, letter, new))
                state = new
            self.final[state] = True
            last = word
        close(0)
        self.order = self._reached()
        self.below: dict[int, int] = {}
        self.starts: dict[int, dict[str, int]] = {}
        for state in self.order:
            n, starts = int(self.final[state]), {}
            for letter, to in self.arcs[state].items():
                starts[letter] = n
                n += self.below[to]
            self.below[state], self.starts[state] = n, starts

    def _reached(self) -> list[int]:
        """States that count, each after all that its arcs lead to."""
        order, seen, stack = [], {0}, [(0, iter(self.arcs[0].values()))]
        while stack:
            state, rest = stack[-1]
            for to in rest:
                if to not in seen:
                    seen.add(to)
                    stack.append((to, iter(self.arcs[to].values())))
                    break
            else:
                order.append(state)
                stack.pop()
        return order


def one_edit_pairs(words: list[str]) -> list[tuple[int, int]]:
    """Numbers of the pairs of sorted words that the acceptor, one edit and the acceptor again accept; each pair once."""
    machine = Acceptor(words)
    arcs, final, below, starts = machine.arcs, machine.final, machine.below, machine.starts
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * max(map(len, words), default=0) + 1000))
    met: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def common(x: int, y: int, but: str = "") -> list[tuple[int, int]]:
        """Words that both states accept, as their numbers from either; the first letter may be barred."""
        if x == y and not but:
            return [(n, n) for n in range(below[x])]
        found = None if but else met.get((x, y))
        if found is None:
            found = [(0, 0)] if final[x] and final[y] else []
            own, other = arcs[x], arcs[y]
            for letter in own.keys() & other.keys():
                if letter != but:
                    a, b = starts[x][letter], starts[y][letter]
                    found += [(a + i, b + j) for i, j in common(own[letter], other[letter])]
            if not but:
                met[(x, y)] = found
        return found

    within: dict[int, list[tuple[int, int]]] = {}
    for state in machine.order:
        own = list(arcs[state].items())
        pairs = []
        for k, (a, x) in enumerate(own):
            at = starts[state][a]
            pairs += [(at + i, at + j) for i, j in within[x]]
            pairs += [(at + i, j) for i, j in common(x, state, a)]
            for b, y in own[k + 1 :]:
                other = starts[state][b]
                pairs += [(at + i, other + j) for i, j in common(x, y)]
        within[state] = pairs
    return within[0]


def _composed(leaves: DataFrame) -> DataFrame:
    """``word, n_near, best``: what the states that need no split say of their words."""
    kind = "word string, n_near long, best struct<less: long, word: string>"

    def met(depth: int, words: list[str], counts: list[int]) -> pa.RecordBatch:
        order = sorted(range(len(words)), key=words.__getitem__)
        words, counts = [words[k] for k in order], [counts[k] for k in order]
        near, best = Counter(), {}
        for i, j in one_edit_pairs([w[depth:] for w in words]):
            for a, b in ((i, j), (j, i)):
                near[a] += 1
                best[a] = min(best.get(a, (0, "")), (-counts[b], words[b]))
        best_of = pa.StructArray.from_arrays(
            [pa.array([best[k][0] for k in near], pa.int64()), pa.array([best[k][1] for k in near], pa.string())], ["less", "word"]
        )
        columns = [pa.array([words[k] for k in near], pa.string()), pa.array(near.values(), pa.int64()), best_of]
        return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, words, counts = None, [], []
        for batch in batches:
            for prefix, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if prefix != state:
                    if len(words) > 1:
                        yield met(len(state), words, counts)
                    state, words, counts = prefix, [], []
                words.append(word)
                counts.append(n)
        if len(words) > 1:
            yield met(len(state), words, counts)

    dealt = leaves.select("prefix", "word", "n").repartition("prefix").sortWithinPartitions("prefix")
    return dealt.mapInArrow(work, kind)


def _joined(edits: DataFrame) -> DataFrame:
    """``word, n_near, best`` from edits taken at split states: words that leave the same behind.

    Words of one key differ in one letter at one place or lack it, so a key holds no more words than places and letters.
    """
    met = edits.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("less", "word", "role"))).alias("met"))
    met = met.filter(F.size("met") > 1)
    first, second, size = F.col("met")[0], F.col("met")[1], F.size("met").cast("long")
    replaced = met.filter("met[0].role = 'replaced'").select(F.explode("met").alias("m"), first.alias("f"), F.get("met", F.lit(1)).alias("s"), size.alias("k"))
    replaced = replaced.select("m.word", (F.col("k") - 1).alias("n_near"), F.when(F.col("m.word") == F.col("f.word"), F.col("s")).otherwise(F.col("f")).alias("b"))
    shorter = F.filter("met", lambda m: m["role"] == "whole")
    longer = F.filter("met", lambda m: m["role"] == "longer")
    grown = met.select(F.get(shorter, F.lit(0)).alias("short"), longer.alias("longer")).filter("short is not null and size(longer) > 0")
    up = grown.select("short.word", F.size("longer").cast("long").alias("n_near"), F.col("longer")[0].alias("b"))
    down = grown.select(F.explode("longer").alias("m"), "short").select("m.word", F.lit(1).cast("long").alias("n_near"), F.col("short").alias("b"))
    return replaced.unionByName(up).unionByName(down).select("word", "n_near", F.struct("b.less", "b.word").alias("best"))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best`` of every word (``word, n``, each once) that has a word one edit away.

    ``best`` is ``less, word``: minus the count of the near word that occurs most often, ties to the first in order.
    """
    empty = words.sparkSession.createDataFrame([], "key string, less long, word string, role string")
    active, depth, leaves, edits = words.withColumn("prefix", F.lit("")), 0, [], []
    if words.limit(block + 1).count() <= block:
        leaves.append(active)
        active = None
    while active is not None:
        word, head, rest = F.col("word"), F.substring("word", 1, depth), F.expr(f"substring(word, {depth + 2})")

        def row(key: Column, role: str) -> Column:
            return F.struct(key.alias("key"), (-F.col("n")).alias("less"), "word", F.lit(role).alias("role"))

        longer_than = F.length(word) > depth
        ends_run = F.substring("word", depth + 1, 1) != F.substring("word", depth + 2, 1)
        taken = [
            F.when(longer_than, row(F.concat(head, F.lit("\0"), rest), "replaced")),
            F.when(longer_than & ends_run, row(F.concat(head, rest), "longer")),
        ]
        taken += [row(word, "whole")] if depth == 0 else []
        edits.append(active.select(F.explode(F.array_compact(F.array(*taken))).alias("e")).select("e.*"))
        depth += 1
        child = active.filter(F.length("word") >= depth).select("word", "n", F.substring("word", 1, depth).alias("prefix"))
        large = child.groupBy("prefix").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > block)
        child = child.join(large, "prefix", "left").select("word", "n", "prefix", F.col("words").isNotNull().alias("split"))
        child = stored(child, f"words-by-{depth}")
        leaves.append(child.filter("not split").select("word", "n", "prefix"))
        active = child.filter("split").select("word", "n", "prefix")
        if active.isEmpty():
            active = None
    all_edits, all_leaves = empty, leaves[0]
    for part in edits:
        all_edits = all_edits.unionByName(part)
    for part in leaves[1:]:
        all_leaves = all_leaves.unionByName(part.select(all_leaves.columns))
    found = _joined(all_edits).unionByName(_composed(all_leaves))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms followed to the last, twice as far each round. Forms have no circles."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    every: int = EVERY,
    block: int = BLOCK,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words come from runs of ``A-Z a-z`` and U+00C0 to U+00FF, lower-cased in A-Z only. Where ``every`` divides the CRC-32 of
    ``<id>:<run>``, one letter of the run is left out; a null id is empty there. Null and empty texts have no words. Repeated
    rows count each. A word's form is its near word of largest count, ties to the first in code points, if it occurs twice
    as often at least; its root is the last form from there on, or the word itself. An empty table gives no rows. Only id and
    text are read. A task holds the words of one state, ``block`` at most.
    """
    words = stored(vocabulary(docs, id_col, text_col, least_letters, least_count, every), "vocabulary")
    near = near_words(words, block)
    best_n = -F.col("best.less")
    has = best_n >= 2 * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.word")).alias("form"), F.when(has, best_n).alias("form_n"),
    )
    joined = stored(joined, "forms")
    roots = last_forms(joined.filter("form is not null"))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
