"""Spelling variants: words one edit apart, found by walking a trie that is a table.

The trie of all words is a distributed edge table (node, character, child).
A state (word, position, node, edits) says that the word up to the position
spells the node's prefix with so many edits.  Level by level the states of a
depth are joined with the edges of that depth: a state without an edit leaves
out a character of the word, or takes a greater one instead; a state with an
edit only goes where its word goes.  A state that ends where another word ends
makes the two neighbours.

* Neighbours are mutual: a character that one word lacks is one that the other
  leaves out, and of two characters one is greater.  So each pair is found from
  one of its words and then turned around.
* An edit is in the later half of a word, or in the later half of the word
  read backwards.  So there are two tries, one of the reversed words, and a
  state starts at the node of its word's first half, where few words are left.
* A node below which one word is left ends the walk: the rests are compared.
* A state goes on only if its next character follows the node it comes to.
* Nodes are named by a 64-bit hash of their prefix.  A collision can only add
  states, and every pair is held against the exact distance at the end.
* Nodes with very many words are salted, so no task receives a hot prefix.
* The levels end where the last two words part.  Words of more than
  ``TRIE_LETTERS`` letters would make many levels; they meet in their strings
  with one letter left out, whose groups the alphabet bounds.

Null texts have no words; a null id counts as an empty one.  Rows that repeat
count each.  Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import Scratch, cut, reachable
from gapweave.operators.attach import attach_split

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-zÀ-ÿ]"
END = "\0"  # stands behind every word of the tries
TRIE_LETTERS = 48
#: Words at a node beyond which its states are salted.
HOT = 100_000


def lowered(run: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 5, rarest: int = 3,
                slip: int = 97) -> DataFrame:
    """``word``, ``n``: letter runs of all texts; where ``slip`` divides the hash of id and run, the run loses a letter."""
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", lowered(F.col("run")).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    without = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = rows.select(F.when(F.col("h") % slip == 0, without).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= rarest)


def _paths(words: DataFrame) -> DataFrame:
    """``dir, depth, node, ch, child, s``: the way of every word through the later half of its tries.

    A word reaches words of its length or one letter shorter, whose halves begin no later.
    """
    both = words.select(F.explode(F.array(
        F.struct(F.lit(0).alias("dir"), F.concat("word", F.lit(END)).alias("s")),
        F.struct(F.lit(1).alias("dir"), F.concat(F.reverse("word"), F.lit(END)).alias("s")))).alias("x")).select("x.dir", "x.s")
    letters = F.length("s") - 1
    half = F.when(F.col("dir") == 0, F.floor(letters / 2)).otherwise(F.ceil(letters / 2))
    first = F.greatest(F.lit(1), half).cast("int")

    def step(d: Column) -> Column:
        return F.struct(d.alias("depth"), F.xxhash64("dir", F.substr("s", F.lit(1), d)).alias("node"),
                        F.substr("s", d + 1, F.lit(1)).alias("ch"), F.xxhash64("dir", F.substr("s", F.lit(1), d + 1)).alias("child"))

    steps = F.explode(F.transform(F.sequence(first, F.length("s") - 1), step)).alias("x")
    return both.select("dir", "s", steps).select("dir", "x.depth", "x.node", "x.ch", "x.child", "s")


def _salts(crowd: str) -> Column:
    return F.ceil(F.col(crowd) / HOT).cast("int")


def _moves(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one level down: ``dir, s, node, pos, crowd, target``; a target is a neighbour found."""
    states = states.withColumn("salt", F.pmod(F.xxhash64("s"), _salts("crowd")).cast("int")).drop("crowd")
    edges = edges.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts("crowd") - 1))).drop("crowd")
    met = states.join(edges, ["dir", "node", "salt"])
    own, ch, pos = F.substr("s", F.col("pos") + 1, F.lit(1)), F.col("ch"), F.col("pos")
    goes = F.when(F.col("edits") == 1, ch == own).otherwise((own != END) & (ch > own))
    moved = met.filter(goes).withColumn("pos", pos + 1)
    alone = F.col("below") == 1
    rest = F.substr("s", F.col("pos") + 1) == F.substr("target", F.col("depth") + 2)
    follows = F.instr(F.col("nexts"), F.substr("s", F.col("pos") + 1, F.lit(1))) > 0
    return moved.filter(F.when(alone, rest).otherwise(follows)).select(
        "dir", "s", F.col("child").alias("node"), "pos", F.col("below").alias("crowd"), F.when(alone, F.col("target")).alias("target"))


def _trie_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``word``, ``near`` candidates of words short enough for the tries."""
    paths = scratch.keep(_paths(words.filter(F.length("word") <= TRIE_LETTERS)))
    at = ["dir", "depth", "node"]
    nodes = scratch.keep(paths.groupBy(*at).agg(
        F.count(F.lit(1)).alias("crowd"), F.array_join(F.collect_set("ch"), "").alias("nexts")).filter("crowd > 1"))
    most = max(HOT, (nodes.agg(F.sum("crowd")).first()[0] or 0) // 100_000)  # so at most 100,000 nodes are broadcast
    named = attach_split(paths, nodes.select(*at, "crowd", F.col("crowd").alias("weight")), at, "weight", heavy_rows=most, how="inner")
    shared = scratch.keep(named.filter(F.col("crowd").isNotNull()), by="depth")
    below = nodes.select("dir", (F.col("depth") - 1).alias("depth"), F.col("node").alias("child"), "nexts")
    edges = shared.groupBy(*at, "ch", "child").agg(
        F.max("crowd").alias("crowd"), F.count(F.lit(1)).alias("below"), F.min("s").alias("target"))
    edges = scratch.keep(edges.join(below, ["dir", "depth", "child"], "left"), by="depth")
    depths = shared.agg(F.min("depth"), F.max("depth")).first()
    found, live = [], None
    for depth in range(depths[0], depths[1] + 1) if depths[0] is not None else ():
        here = shared.filter(F.col("depth") == depth)
        start = here.select("dir", "s", "node", F.lit(depth).alias("pos"), "crowd", F.lit(0).alias("edits"))
        skipped = start.filter(F.length("s") - 1 > depth).withColumns({"pos": F.lit(depth + 1), "edits": F.lit(1)})
        states = start.unionByName(skipped)
        if live is not None:
            states = states.unionByName(live)
        moved = scratch.keep(_moves(states, edges.filter(F.col("depth") == depth)))
        found.append(moved.filter("target is not null").select("dir", "s", "target"))
        live = moved.filter("target is null").drop("target").withColumn("edits", F.lit(1))
    if not found:
        return words.select("word", F.col("word").alias("near")).limit(0)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)

    def plain(s: str) -> Column:
        word = F.substr(s, F.lit(1), F.length(s) - 1)
        return F.when(F.col("dir") == 0, word).otherwise(F.reverse(word))

    found = pairs.select(plain("s").alias("word"), plain("target").alias("near"))
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


PRIME, BASE = (1 << 61) - 1, 1_000_003


def deletion_hashes(word: str) -> list[int]:
    """A hash of the word, then of the word without its first, second, ... letter."""
    before, powers = [0], [1]
    for c in word:
        before.append((before[-1] * BASE + ord(c) + 1) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)
    whole, n = before[-1], len(word)
    return [whole, *(((before[i] - before[i + 1]) * powers[n - 1 - i] + whole) % PRIME for i in range(n))]


def _long_pairs(words: DataFrame, longest: int = TRIE_LETTERS) -> DataFrame:
    """``word``, ``near`` candidates where one word at least is too long for the tries."""
    long = words.filter(F.length("word") >= longest).select(F.xxhash64("word").alias("id"), "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                hashes = deletion_hashes(word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(hashes), pa.int64()), pa.array(hashes, pa.int64()),
                     pa.array([True] + [False] * len(word))], ["id", "key", "whole"])

    rows = reachable(long).mapInArrow(run, "id long, key long, whole boolean").distinct()
    a, b = rows.alias("a"), rows.alias("b")
    met = a.join(b, F.col("a.key") == F.col("b.key")).filter((F.col("a.id") != F.col("b.id")) & ~(F.col("a.whole") & F.col("b.whole")))
    ids = met.select(F.col("a.id").alias("id"), F.col("b.id").alias("other")).distinct()
    named = ids.join(long, "id").join(long.select(F.col("id").alias("other"), F.col("word").alias("near")), "other")
    return named.filter(F.greatest(F.length("word"), F.length("near")) > longest).select("word", "near")


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``near``: all ordered pairs of the distinct ``word`` that are one edit apart."""
    scratch = Scratch(words.sparkSession, "spelling")
    pairs = _trie_pairs(words, scratch).unionByName(_long_pairs(words))
    pairs = cut(pairs.distinct().filter(F.levenshtein("word", "near", 1) == 1))
    scratch.drop()
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last of the forms that follow from a word; counts rise on the way, so it ends."""
    at = cut(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(at.join(ahead, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the rows ``word, n`` and their neighbours."""
    near = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("b"))
    judged = words.join(best, "word", "left").withColumn("strong", -F.col("b.least") >= 2 * F.col("n"))
    forms = cut(judged.select(
        "word", F.when(F.col("strong"), F.col("b.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("strong"), -F.col("b.least")).alias("form_n")))
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word of the texts with the form it is a variant of, if any; see above and ``word_counts``."""
    words = cut(word_counts(df, key, text))
    return variants(words, neighbours(words))
