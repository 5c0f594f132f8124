import random

from helpers import brute_components, empty, odd_documents, prose

from nearkin.llm import bottom_k as B


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def check(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    sets = {i: shingles(t) for i, t in texts.items()}
    of = brute_components(sets)
    want = sorted((i, len(s), of[i], of[i] == i) for i, s in sets.items())
    assert sorted(map(tuple, B.near_duplicates(df).collect())) == want


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_components_equal_brute_force(spark):
    rng = random.Random(11)
    texts = {}
    passage = [f"p{i}" for i in range(60)]
    for group in range(8):
        base = [f"g{group}x{rng.randrange(400)}" for _ in range(rng.choice([6, 9, 30, 120, 300]))]
        for _ in range(12):
            words = edited(rng, base, rng.randint(0, max(1, len(base) // 12)))
            texts[len(texts) * 3 + 1] = " ".join(words)
    for _ in range(60):  # unlike texts around a passage that most of them share
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randint(5, 90))]
        texts[len(texts) * 3 + 1] = " ".join([*own, *passage])
    for _ in range(20):  # and some that are like through it
        texts[len(texts) * 3 + 1] = " ".join([*edited(rng, passage, 1), f"o{rng.randrange(10**6)}"])
    check(spark, texts)


def test_chain_of_near_copies_and_short_texts(spark):
    rng = random.Random(12)
    words = [f"c{i}" for i in range(200)]
    texts = {}
    for step in range(15):
        words = edited(rng, words, 2)
        texts[100 - step] = " ".join(words)
    texts |= {1: "", 2: " ", 3: "a b", 4: "A  b", 5: "a b c", 6: "a b c d e f g h", 7: "a b c d e f g h i", 8: "x"}
    check(spark, texts)


def test_odd_rows(spark):
    rows = odd_documents(spark)
    found = B.near_duplicates(rows).collect()
    assert len(found) == rows.count()
    of = {r.doc_id: r.component_id for r in found}
    assert of[5] == of[11] == of[12] == 5 and of[7] == of[13] == 7 and of[0] == 0 and of[1] == 1 and of[None] is None
    kept = B.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [None, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]))
    assert B.near_duplicates(empty(spark, "doc_id long, text string")).count() == 0


def test_an_id_with_two_texts_ties_them(spark):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (2, "q r s t u v"), (3, "A b c d e f"), (4, "other words")]
    found = B.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    rng.shuffle(edges)
    found = {r.id: r.component for r in B.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)}
