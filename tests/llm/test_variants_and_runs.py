"""Exact-complement packing, spelling variants and periodic runs against plain forms, whole queries included."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import spelling_variants as variants
from tallyloom.llm.exact_fill import pack_best_fit, plan_sequences, token_pieces
from tallyloom.llm.periodic_runs import SquareCatcher, find_runs, periodic_runs
from tallyloom.llm.queries import op11_exact_fill, op12_spelling_variants, op13_periodic_runs
from tallyloom.llm.spelling_variants import count_words, level_depths, near_words, spelling_variants, words_of
from tests.llm.fixtures_of_texts import ODD_TEXTS, documents


def used_by(patterns, limit):
    used = Counter()
    for times, parts in patterns:
        assert times > 0 and sum(length * copies for length, copies in parts) <= limit
        for length, copies in parts:
            used[length] += copies * times
    return used


def test_plans_use_every_item_once():
    rng = random.Random(1)
    for _ in range(400):
        limit = rng.randint(1, 30)
        counts = {length: rng.choice([0, 0, 1, 2, 3, 9, 100]) for length in range(1, limit + 1)}
        assert used_by(plan_sequences(counts, limit), limit) == +Counter(counts)


@pytest.mark.parametrize("counts", [{3: 100, 7: 100}, {2: 50, 3: 50, 5: 50}, {1: 20, 2: 20, 3: 20, 4: 20}, {l: 7 for l in range(1, 11)}])
def test_exact_complements_leave_no_room(counts):
    patterns = plan_sequences(counts, 10)
    assert sum(times for times, _ in patterns) == -(-sum(length * n for length, n in counts.items()) // 10)


def test_best_fit_takes_the_least_room():
    patterns = plan_sequences({7: 1, 6: 1, 3: 1}, 11)
    assert sorted(sum(length * copies for length, copies in parts) for _, parts in patterns) == [6, 10]


def placed(rows, limit):
    by = defaultdict(list)
    for row in rows:
        by[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_items_of_a_hot_length_and_clashing_names(spark):
    items = spark.range(3000, numPartitions=11).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 13 + 1).otherwise(4).alias("size"), F.lit("x").alias("offset"))
    rows = pack_best_fit(items, 13, "size").withColumnRenamed("size", "length").collect()
    assert sorted(row["id"] for row in rows) == list(range(3000))
    assert placed(rows, 13) <= 1.02 * sum(row["length"] for row in rows) / 13  # three of the hot length leave 1
    assert pack_best_fit(items.limit(0), 13, "size").count() == 0
    for bad in (0, 14, None):
        with pytest.raises(Exception, match="cannot pack the length"):
            pack_best_fit(spark.createDataFrame([(1, bad)], "id int, length int"), 13).collect()


def test_packing_query_against_the_library(spark, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*ODD_TEXTS, *(f"word{i} " * i for i in range(60)), "long text. " * 9000]
    documents(spark, texts, repeat=2).unionByName(documents(spark, ["no key"]).withColumn("doc_id", F.lit(None).cast("long"))).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op11_exact_fill(spark, str(tmp_path)).collect()
    want = Counter()
    for key, text in [*enumerate(texts)] * 2 + [(None, "no key")]:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        for piece, stop in enumerate(range(first, len(ids) + 1, 2048)):
            start = max(0, stop - 2048) if piece else 0
            want[key, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())] += 1
    assert Counter((row["doc_id"], row["piece"], row["start"], row["length"], row["ids_crc32"]) for row in rows) == want
    assert placed(rows, 2048) == -(-sum(row["length"] for row in rows) // 2048)
    assert token_pieces(documents(spark, [])).count() == 0


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_levels_reach_every_length():
    depths = level_depths(100_000)
    assert depths[:17] == list(range(17)) and depths[-1] >= 100_000 and len(depths) < 120 and level_depths(0) == [0]


def test_near_words_are_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choices("aabbcdeàé", k=rng.randint(1, 9))) for _ in range(300)} | {"a" * i for i in range(1, 30)} | {"ab" * i for i in range(1, 20)}
    words |= {"x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149, "y" + "x" * 299, "x" * 299 + "y"}
    base = "".join(rng.choices("abcdefgh", k=60))
    for i in rng.sample(range(60), 25):
        words |= {base[:i] + "z" + base[i:], base[:i] + base[i + 1 :], base[:i] + rng.choice("abz") + base[i + 1 :]}
    table = spark.createDataFrame([(word,) for word in [*words, *words, None, ""]], "word string")
    got = [tuple(row) for row in near_words(table).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in words for b in words if one_edit(a, b)}


def plain_variants(counts):
    near = {word: [other for other in counts if other != word and one_edit(word, other)] for word in counts}

    def form(word):
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        return best if best is not None and counts[best] >= 5 * counts[word] else None

    def root(word):
        return root(form(word)) if form(word) else word

    return {(word, form(word), root(word), n, len(near[word]), counts.get(form(word))) for word, n in counts.items()}


def test_forms_and_roots(spark):
    counts = {"letter": 1000, "leter": 200, "lettr": 200, "lette": 40, "letten": 199, "lett": 8, "leteer": 39, "other": 5, "iothers": 7, "others": 35, "otherss": 7}
    got = spelling_variants(spark.createDataFrame([*counts.items(), (None, 9)], "word string, n long")).collect()
    assert {tuple(row) for row in got} == plain_variants(counts)
    assert {row["word"]: row["root"] for row in got}["lett"] == "letter"
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_tables_of_words_are_never_broadcast(spark, monkeypatch):
    plans = []
    told = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    written = variants.materialize
    monkeypatch.setattr(variants, "materialize", lambda df, name: written(told(df), name))
    counts = [("letter", 1000), ("leter", 200), ("lettr", 200), ("lette", 40), ("other", 5)]
    told(spelling_variants(spark.createDataFrame(counts, "word string, n long"))).collect()
    joins = [line for plan in plans for line in plan.splitlines() if "Join" in line]
    # However small the files are that Spark sizes the tables by: an explode makes many rows of one.
    assert len(joins) >= 8 and not [line for line in joins if "SortMergeJoin" not in line]


def test_variants_query_against_all_pairs(spark, tmp_path):
    rng = random.Random(5)
    stems = ["".join(rng.choices("abcdeéÀß", k=rng.randint(5, 9))) for _ in range(12)]
    texts = []
    for _ in range(400):
        picked = [rng.choice(stems[: rng.randint(1, 12)]) for _ in range(60)]
        texts.append(", ".join(word.upper() if rng.random() < 0.1 else word for word in picked) + "x1y_z×÷")
    texts += [*ODD_TEXTS, "x" * 100_000 + " " + "y" * 5000]
    docs = documents(spark, texts).unionByName(documents(spark, texts[:50]).withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    counts = Counter()
    for key, text in [*enumerate(texts), *((None, text) for text in texts[:50])]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += len(word) >= 6
    want = plain_variants({word: n for word, n in counts.items() if n >= 5})
    got = [tuple(row) for row in op12_spelling_variants(spark, str(tmp_path)).collect()]
    assert len(got) == len(want) > 20 and set(got) == want
    assert words_of(documents(spark, [None, "", "1 2"])).count() == 0 and count_words(words_of(documents(spark, []))).count() == 0


def plain_runs(words, exponent=4, least=6):
    found = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                if all(any(words[x] != words[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                    found.add((i, length, q))
            i = j + 1
    return sorted(found)


def some_sequence(rng):
    n, kind = rng.randint(0, 150), rng.random()
    if kind < 0.4:
        return [rng.randrange(2 + (kind < 0.2)) for _ in range(n)]
    words = []
    while len(words) < n:
        words += [rng.randrange(3) for _ in range(rng.randint(1, 12))] * rng.randint(1, 7) + [rng.randrange(4)] * rng.randint(0, 1)
    return words[: max(n - rng.randint(0, 9), 0)]


def test_runs_are_those_of_all_periods_however_words_come():
    rng = random.Random(7)
    for _ in range(300):
        words, exponent = some_sequence(rng), rng.choice([3, 4, 5])
        want = plain_runs(words, exponent)
        assert [tuple(run) for run in find_runs(np.array(words, np.int64), exponent).tolist()] == want
        catcher, at = SquareCatcher(exponent), 0
        while at < len(words):
            step = rng.randint(1, 6)
            catcher.append(np.array(words[at : at + step], np.int64))
            at += step
        online = [(a, b - a, q) for a, b, q in zip(*(values.tolist() for values in catcher.stretches())) if b - a >= max(6, exponent * q)]
        assert sorted(online) == want
    with pytest.raises(ValueError):
        SquareCatcher(2)


def test_long_periodic_texts_take_no_square_time():
    assert find_runs(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]
    assert find_runs(np.arange(300_000) % 70_000).tolist() == [[0, 300_000, 70_000]]


def collapse(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def test_runs_query_against_plain_forms(spark, tmp_path):
    rng = random.Random(9)
    texts = [*ODD_TEXTS, "ha " * 40, "ha\x0bha\x0cha ha\tha\nha", "a b a b a b a b c " * 5, "a\xa0b " * 9]
    texts += [" ".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(rng.randint(0, 120))) for _ in range(120)]
    texts += [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(1, 300))) for _ in range(100)] + [" ".join(map(str, range(40_000)))]
    docs = documents(spark, texts).unionByName(documents(spark, ["ha " * 9]).withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {row["doc_id"]: row for row in op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts) + 1 and got[None]["n_runs"] == 1
    planted = 0
    for key, text in enumerate(texts):
        words, h = re.findall("[^\x20\x09-\x0d]+", text or ""), zlib.crc32(str(key).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = [(0, 0, 0)][:0] if n > 30_000 and h % 10 else plain_runs(words)
        best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None,) * 3)
        want = (key, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2])
        want += tuple(hashlib.sha256(value.encode()).hexdigest() for value in ("".join(f"{a},{b},{c}\n" for a, b, c in runs), collapse(words, runs)))
        assert tuple(got[key]) == want, text
    assert planted > 15
    assert periodic_runs(documents(spark, [])).count() == 0
    again = periodic_runs(documents(spark, ["b b b b b b c"], repeat=2).withColumn("runs", F.lit(1))).collect()
    assert [row["collapsed"] for row in again] == ["b c"] * 2 and [row["n_words"] for row in again] == [7, 7]
