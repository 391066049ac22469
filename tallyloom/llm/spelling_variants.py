"""Spelling variants: words one edit apart, found level by level in a trie that is a table of edges."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize

LETTERS = "[A-Za-zÀ-ÿ]+"
_LEVELS_AT_ONCE = 4  #: levels between two scratch tables


def lower_ascii(word: Column) -> Column:
    """Only A-Z lowered."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def words_of(docs: DataFrame, min_length: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, word``: every maximal run of letters of the whole texts with ``min_length`` code points or more, A-Z lowered.

    Null and empty texts have none; repeated rows count again; null keys stay; other columns are not read.
    """
    runs = docs.select(F.col(key), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(LETTERS), F.lit(0))).alias("word"))
    return runs.where(F.char_length("word") >= min_length).select(F.col(key), lower_ascii(F.col("word")).alias("word"))


def count_words(words: DataFrame, min_length: int = 6, min_count: int = 5, word: str = "word") -> DataFrame:
    """Rows ``word, n`` of the words that are long and frequent enough; counts combine before the shuffle."""
    counted = words.where(F.char_length(word) >= min_length).groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def level_depths(longest: int, single: int = 16, share: int = 8) -> list[int]:
    """Depths of the trie's levels up to ``longest``: one code point a level at first, below that a ``share``-th of the depth.

    So a word of any length has prefixes on a number of levels that grows with its logarithm.
    """
    depths = [0]
    while depths[-1] < longest:
        depths.append(depths[-1] + (1 if depths[-1] < single else max(1, depths[-1] // share)))
    return depths


def _join(left: DataFrame, right: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the vocabulary: never by a broadcast.

    Spark would size either side by its compressed files, and as if an explode kept the number of its rows, and so take millions of rows for
    a table of a few megabytes and build it in the driver.
    """
    return left.hint("merge").join(right.hint("merge"), on, how)


def near_words(vocabulary: DataFrame, word: str = "word") -> DataFrame:
    """Rows ``word, near``: all ordered pairs of distinct words that one inserted, deleted or replaced code point turns into each other.

    The words and their reversals form a trie, stored as a table of edges ``node, label, ends`` (a node is named by its prefix). A state
    is a word, the position reached in it, a node and whether the edit was made. A word's own path needs no search: it starts halfway
    down, with one state on each of its nodes, as an edit in its other half is found in the reversed word. At each of these the edit is
    tried against the node's edges: a label that replaces code points, or one that lacks a code point of the word; insertions are the deletions of the other word. Edited
    states then go down level by level through joins with the edges by node and next code point, and are pairs where word and edges end
    together. Rows meet by node, of which all words but those below it keep clear, and never pair by pair.

    Null words are left out, repeated ones are one; an empty table gives no rows; other columns are not read. Every few levels end in a scratch
    table, so a lost executor costs no more than these. Only the longest length and whether states are left reach the driver.
    """
    words = materialize(vocabulary.select(F.col(word).cast("string").alias("word")).where("word is not null and word <> ''").distinct(), "trie-words")
    longest = words.agg(F.max(F.char_length("word"))).first()[0] or 0
    depths = level_depths(longest)
    both = F.array(F.struct(F.lit(">").alias("way"), F.col("word").alias("letters")), F.struct(F.lit("<").alias("way"), F.reverse("word").alias("letters")))
    paths = words.select("word", F.explode(both).alias("path")).select("word", "path.way", "path.letters")
    levels = F.array(*[F.struct(F.lit(a).alias("at"), F.lit(b).alias("next")) for a, b in zip(depths, depths[1:])] or [F.lit(None).cast("struct<at: int, next: int>")])
    size = F.char_length("letters")
    on = paths.select("*", F.explode(F.filter(levels, lambda level: level["at"] < size)).alias("level")).select("*", "level.at", "level.next").drop("level")
    on = on.withColumn("node", F.concat("way", F.substring("letters", F.lit(1), F.col("at"))))
    steps = on.select("node", F.substring("letters", F.col("at") + 1, F.col("next") - F.col("at")).alias("label"), (size <= F.col("next")).alias("ends"))
    edges = materialize(steps.groupBy("node", "label").agg(F.max("ends").alias("ends")).withColumn("first", F.substring("label", 1, 1)), "trie-edges")

    # Halfway down: the lowest level from which every later edit is met by a node of the word itself.
    half = F.floor((size - 1) / 2)
    start = F.array_max(F.filter(F.array(*[F.lit(depth) for depth in depths]), lambda depth: depth <= half))
    begun = on.where(F.col("at") >= start).select("word", "letters", "node", "at")
    span = F.char_length("label")
    own = F.substring("letters", F.col("at") + 1, span)
    longer = F.substring("letters", F.col("at") + 1, span + 1)
    # Of two words of one length the smaller one is turned into the other.
    replaced = (F.char_length(own) == span) & (F.col("label") > own) & (F.levenshtein(own, F.col("label"), 1) == 1)
    at_end = F.col("ends") & (F.col("at") + span + 1 == size)
    shortened = (F.char_length(longer) == span + 1) & (F.levenshtein(longer, F.col("label"), 1) == 1) & ((own != F.col("label")) | at_end)
    moves = F.array_compact(F.array(F.when(replaced, F.col("at") + span), F.when(shortened, F.col("at") + span + 1)))
    edited = _join(begun, edges, "node").select("word", "letters", F.concat("node", "label").alias("node"), "ends", F.explode(moves).alias("position"))
    together = (F.col("position") == size) & F.col("ends")
    tables = []
    states = edited.where((F.col("position") < size) | together)
    while True:
        for _ in range(_LEVELS_AT_ONCE):
            states = _go_down(states, edges)
        states = materialize(states, f"trie-states-{len(tables)}")
        tables.append(states.where(together).select("word", "node"))
        states = states.where(F.col("position") < size)
        if states.isEmpty():
            break
    letters = F.expr("substring(node, 2)")
    near = F.when(F.col("node").startswith("<"), F.reverse(letters)).otherwise(letters)
    pairs = reduce(DataFrame.unionByName, tables).select("word", near.alias("near"))
    turned = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return pairs.select(F.explode(turned).alias("pair")).select("pair.word", "pair.near").distinct()


def _go_down(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one level further down; those that are pairs already stay, those without an edge go."""
    size, span = F.char_length("letters"), F.char_length("label")
    under = edges.select(F.col("node").alias("_node"), F.col("first").alias("_first"), "label", F.col("ends").alias("_ends"))
    on_way = F.col("position") < size
    # A pair has no next code point and so meets no edge.
    asked = states.withColumn("first", F.when(on_way, F.substring("letters", F.col("position") + 1, F.lit(1))))
    met = _join(asked, under, (F.col("node") == F.col("_node")) & (F.col("first") == F.col("_first")), "left")
    follows = F.substring("letters", F.col("position") + 1, span) == F.col("label")
    moved = met.where(~on_way | follows).select(
        "word",
        "letters",
        F.when(on_way, F.concat("node", "label")).otherwise(F.col("node")).alias("node"),
        F.when(on_way, F.col("_ends")).otherwise(F.col("ends")).alias("ends"),
        F.when(on_way, F.col("position") + span).otherwise(F.col("position")).alias("position"),
    )
    return moved.where((F.col("position") < size) | ((F.col("position") == size) & F.col("ends")))


def spelling_variants(vocabulary: DataFrame, ratio: float = 5) -> DataFrame:
    """Rows ``word, form, root, n, n_near, form_n`` from the distinct words and counts ``word, n`` of ``vocabulary``.

    ``form`` is the near word with the largest count (of equal ones the smallest by code points) if that is at least ``ratio`` times the
    word's own, else null; ``root`` is what the forms lead to, the word itself without one. ``ratio`` must be over 1, so that counts grow along the forms and no
    circle can arise. Null words are left out; an empty table gives no rows.
    """
    if ratio <= 1:
        raise ValueError("ratio must be more than 1")
    counts = materialize(vocabulary.select("word", "n").where("word is not null"), "variants-counts")
    pairs = near_words(counts)
    near = _join(pairs, counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = _join(counts, best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")
    is_form = -F.col("best.less") >= F.col("n") * F.lit(ratio)
    named = named.select("word", "n", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    named = materialize(named, "variants-forms")
    roots = forms_to_roots(named.where("form is not null").select("word", "form"))
    found = _join(named, roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def forms_to_roots(forms: DataFrame) -> DataFrame:
    """Rows ``word, root`` of all words that have a form, by steps of doubling length through scratch tables."""
    reached = materialize(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if _join(reached, further, "root", "left_semi").isEmpty():
            return reached
        stepped = _join(reached, further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
        reached = materialize(stepped, "variants-roots")
