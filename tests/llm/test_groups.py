"""Near duplicates, similar vectors and top scores against all pairs; components; toxicity on held-out rows; the pipeline."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm.components import connected_components
from tallyloom.llm.cover_tree import close_pairs, similar_vectors
from tallyloom.llm.simhash import fingerprint, link_fingerprints, near_duplicates
from tallyloom.llm.top_scores import exact_top_k
from tallyloom.llm.toxicity import ToxicityModel, fit_toxicity, is_held_out, score_toxicity
from tests.llm.fixtures_of_texts import ODD_TEXTS, documents


def roots(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 202), (202, 200), (202, 202)]
    random.Random(2).shuffle(links)
    got = {row["node"]: row["component"] for row in connected_components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    want = roots(210, links)
    assert got == {node: want[node] for node in {n for link in links for n in link}}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


@pytest.mark.parametrize(("distance", "segments"), [(4, 3), (3, 4), (5, 2)])
def test_no_link_of_fingerprints_is_lost(spark, distance, segments):
    rng = random.Random(distance)
    prints = [rng.getrandbits(64) for _ in range(40)]
    prints += [p ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(1, distance + 1))) for p in prints for _ in range(6)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= distance]
    want = roots(len(prints), links)
    rows = link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), distance, segments).collect()
    got = {row["node"]: row["component"] for row in rows}
    classes = {}
    for p, root in zip(signed, want):
        classes.setdefault(root, set()).add(got.get(p, p))
    assert all(len(found) == 1 for found in classes.values()) and len({*map(min, classes.values())}) == len(classes)


def test_near_duplicates_of_odd_rows(spark):
    rows = near_duplicates(documents(spark, repeat=2), words=4).collect()
    prints = [fingerprint(text or "", 4) for text in ODD_TEXTS]
    want = roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    assert sorted((row["doc_id"], row["component"]) for row in rows) == sorted(2 * list(enumerate(want)))
    assert prints[0] == prints[1] == prints[2] == 0 and want[1] == want[2] == 0
    assert near_duplicates(documents(spark, [])).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, id long, n_links int, score int")


def some_vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 8))
    x = np.concatenate([base, base[:15] + rng.normal(size=(15, 8)) * 0.15, base[:5], rng.normal(size=(60, 8))])
    rows = [(i, row.tolist(), [0, 1, None][i % 15 % 3], 1, 1, 1) for i, row in enumerate(x)]
    rows += [(500, None, 0, 1, 1, 1), (501, [], 0, 1, 1, 1), (502, [0.0] * 8, 0, 1, 1, 1), (503, [math.nan] * 8, 0, 1, 1, 1), (504, [1.0, None], 0, 1, 1, 1), (505, [1e200] * 8, 0, 1, 1, 1), (506, [2e200] * 8, 0, 1, 1, 1)]
    return rows


def unit(v):
    v = np.array(v) / np.abs(v).max()
    return v / np.sqrt(v @ v)


@pytest.mark.parametrize("leaf_rows", [4, 1000])
def test_similar_vectors_are_all_pairs(spark, leaf_rows):
    rows = some_vectors()
    usable = [i for i, r in enumerate(rows) if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    links = [(i, j) for i in usable for j in usable if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit(rows[i][1]) @ unit(rows[j][1]) >= 0.93]
    want = roots(len(rows), links)
    got = {row["vec_id"]: (row["n_links"], row["component"]) for row in similar_vectors(vectors(spark, rows), leaf_rows=leaf_rows, chunk_rows=16).collect()}
    assert len(links) > 20
    assert got == {r[0]: (sum(a == i for a, _ in links), rows[want[i]][0]) for i, r in enumerate(rows)}
    assert similar_vectors(vectors(spark, [])).count() == 0


def test_traversal_of_equal_and_close_points():
    x = np.array([unit(v) for v in [[1, 0], [1, 0], [1, 1e-9], [0, 1], [1, 0.2], [-1, 0]]])
    found = {(int(a), int(b)) for us, vs in close_pairs(x, x, 0.93, same=True) for a, b in zip(us, vs)}
    assert found == {(i, j) for i in range(6) for j in range(i + 1, 6) if x[i] @ x[j] >= 0.93}


def beside_scaled_copies():
    """Scaled copies of one direction, nearly equal but not bit for bit, beside a cluster of at least three levels that links with them."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=8)
    copies = [base * scale for scale in (1.0, 1 / 3, 0.7, 7.1, 1e-3, 13.7)]
    return np.array(copies + [base + rng.normal(size=8) * size for size in (0.02, 0.1, 0.3) for _ in range(20)])


def test_traversal_of_scaled_copies_beside_a_deep_cluster():
    x = np.array([unit(v) for v in beside_scaled_copies()])
    assert len({row.tobytes() for row in x[:6]}) > 1
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if x[i] @ x[j] >= 0.93}
    found = [(int(a), int(b)) for us, vs in close_pairs(x, x, 0.93, same=True) for a, b in zip(us, vs)]
    assert len(want) > 200 and sorted(found) == sorted(want)
    found = [(int(a), int(b)) for us, vs in close_pairs(x[:6], x[6:], 0.93) for a, b in zip(us, vs)]
    assert sorted(found) == [(i, j - 6) for i, j in sorted(want) if i < 6 <= j]


def test_no_link_at_the_bound_is_lost_to_rounding():
    rng = np.random.default_rng(3)
    for case in range(300):
        base, side = rng.normal(size=(2, rng.integers(2, 80)))
        base = unit(base)
        side = unit(side - (side @ base) * base)
        cosine = 0.93 + 1e-10
        other = cosine * base + math.sqrt(1 - cosine**2) * side
        near = [unit(base * scale + rng.normal(size=len(base)) * 1e-9 * (case % 2)) for scale in (1.0, 1 / 3, 0.7, 7.1, 1e-3, 13.7)]
        x = np.array([unit(other), *near])
        want = {(0, j) for j in range(1, 7) if x[0] @ x[j] >= 0.93}
        found = {(int(a), int(b)) for us, vs in close_pairs(x, x, 0.93, same=True) for a, b in zip(us, vs) if a == 0}
        found_apart = {(int(a), int(b) + 1) for us, vs in close_pairs(x[:1], x[1:], 0.93) for a, b in zip(us, vs)}
        assert found == found_apart == want, case


def test_top_scores_are_those_of_all_pairs(spark):
    rows = [(i, v, None, 1, 1, 1) for i, v, *_ in some_vectors()[:110]] + some_vectors()[110:115]
    rows += [(r[0] + 300, r[1], 0, 1, 1, 1) for r in rows[:40]] + [(None, [1.0] * 8, 0, 1, 1, 1), rows[0]]
    usable = {r[0]: r[1] for r in rows if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all()}
    scaled = {name: np.floor(256 * np.array(v)).astype(int) for name, v in usable.items()}
    want = []
    for query in (name for name in scaled if name % 10 == 0):
        scores = sorted((-int(scaled[query] @ v), name) for name, v in scaled.items() if name != query and len(v) == len(scaled[query]))[:5]
        want += [(query, i + 1, name, -score) for i, (score, name) in enumerate(scores)]
    got = exact_top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, item_block=32, query_block=4).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    few = exact_top_k(vectors(spark, rows[:3]), F.col("vec_id") == 0, lists=3).collect()
    assert [row["rank"] for row in few] == [1, 2]
    assert exact_top_k(vectors(spark, []), F.col("vec_id") == 0).count() == 0


def toxic_corpus(spark, n=900):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    texts, toxic = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 80))
        toxic.append(int(i % 6 == 0))
        if toxic[-1]:
            for _ in range(3 + len(text) // 15):
                text.insert(rng.randrange(len(text)), rng.choice(["nasty", "Vile,", "rotten", "gemeinheiten"]))
        texts.append(" ".join(text))
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic) if i % 5], "doc_id long, toxic int")
    return docs, labels, toxic


def test_toxicity_on_held_out_rows(spark):
    docs, labels, toxic = toxic_corpus(spark)
    model = fit_toxicity(docs, labels, ~is_held_out())
    rows = score_toxicity(docs, model).withColumn("held", is_held_out()).collect()
    held = [(row["score"] >= 0.7, bool(toxic[row["doc_id"]])) for row in rows if row["held"]]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    again = fit_toxicity(docs, labels.where(~is_held_out()), ~is_held_out())
    assert again == model  # held-out labels change nothing


def test_toxicity_of_odd_tables(spark):
    docs, labels, _ = toxic_corpus(spark, 60)
    none = labels.where("false")
    assert fit_toxicity(docs, none, ~is_held_out()) == ToxicityModel()
    assert fit_toxicity(docs.where("false"), labels, ~is_held_out()) == ToxicityModel()
    model = fit_toxicity(docs, labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")), ~is_held_out())
    scores = [row["score"] for row in score_toxicity(documents(spark, repeat=2), model).collect()]
    assert len(scores) == 2 * len(ODD_TEXTS) and all(0 <= score <= 1 for score in scores)
    assert score_toxicity(documents(spark, []), model).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs, labels, toxic = toxic_corpus(spark)
    extra = [(2000, "one two three four five six seven eight nine ten eleven twelve token = abcdef123456"), (2001, "one two three four five six seven eight nine ten eleven twelve token = abcdef123456"), (2002, None), (2003, ""), (None, "alpha beta"), (None, "gamma delta"), (2000, "one two three four five six seven eight nine ten eleven twelve token = abcdef123456")]
    more = spark.createDataFrame([(i, text, None, None, 3) for i, text in extra], "doc_id long, text string, lang string, source string, n_chars long")
    docs.select(*corpus_pipeline.COLUMNS).unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, str(tmp_path))
        kept[name] = table
    clean = {row[0] for row in kept["toxicity"].select("doc_id").collect()}
    wrong = {i for i, bad in enumerate(toxic) if bad} & clean | ({i for i, bad in enumerate(toxic) if not bad} - clean)
    assert len(wrong) < 20 and {2000, 2001, 2002, 2003} <= clean
    rows = [row[0] for row in kept["simhash"].select("doc_id").collect()]
    assert rows.count(2000) == 1 and rows.count(None) == 2
    unique = set(rows)
    assert {2000, 2002} <= unique and not {2001, 2003} & unique and unique <= clean
    masked = {row["doc_id"]: row["text"] for row in kept["secrets"].collect()}
    assert masked.keys() == unique and masked[2000].endswith("twelve [SECRET]") and masked[2002] is None
    assert {row[0] for row in kept["packing"].select("doc_id").distinct().collect()} == unique
    assert all(kept[name].columns == list(corpus_pipeline.COLUMNS) for name, _ in corpus_pipeline.STAGES[:-1])
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length")).first() == kept["packing"].agg(F.sum("length")).first()


def near_copies():
    """Texts with copies of which one word in so many is another, on both sides of the bound."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    texts = []
    for _ in range(12):
        text = rng.choices(words, k=rng.randint(6, 150))
        texts.append(" ".join(text))
        for one_in in (15, 25, 40, 60, 100):
            texts.append(" ".join(w if rng.random() > 1 / one_in else rng.choice(words) for w in text))
        texts.append(" ".join(text[: len(text) * 9 // 10]).upper())
    return texts + texts[:3] + [" ", "", None, "one two", "One  two"]


def test_near_duplicate_stage_is_all_pairs(spark, tmp_path):
    block = " ".join(f"b{i}" for i in range(300))  # stands in all of these, so many are near each other
    texts = near_copies() + [f"{block} {a} {b}" for a in "uvwxyz" for b in ("", "q", "r s")] + ["a b c d"] * 40
    prints = [fingerprint(text or "", 4) for text in texts]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = roots(len(prints), links)
    assert len(set(want)) < len(set(texts)) - 20
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, texts), str(tmp_path)).collect()
    assert sorted(row["doc_id"] for row in kept) == sorted(set(want))
    assert corpus_pipeline.drop_near_duplicates(spark, documents(spark, []), str(tmp_path)).count() == 0


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (None, base.upper()), (None, base + " "), (None, "x y z"), (None, "X Y z"), (7, "other text"), (7, base), (8, base), (9, "Other text"), (1, base)]
    rows += [(None, "left alone"), (None, "left alone"), (None, None), (20, ""), (5, "one key"), (5, "two texts")]
    docs = spark.createDataFrame([(i, text, None, None, 3) for i, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(row["doc_id"], row["text"]) for row in corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()]
    assert len(kept) == len(set(kept)) == 7
    assert set(kept) - {(None, "x y z"), (None, "X Y z")} == {(1, base), (7, "other text"), (None, "left alone"), (20, ""), (5, "one key"), (5, "two texts")}
