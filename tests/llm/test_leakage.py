import random

from marlstone.llm import leakage as lk


def brute(docs, items, n):
    words = lk.Words()
    grams = {}
    for i, t in items:
        s = words(t) if i is not None else []
        for k in range(len(s) - n + 1):
            grams.setdefault(tuple(s[k : k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        s = words(t) if d is not None else []
        for k in range(len(s) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(s[k : k + n]), ())}
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, 1) for d, t in docs], "id long, t string, term int"), spark.createDataFrame([(i, t, "x") for i, t in items], "item long, t string, doc string")


def found(spark, docs, items, n=4):
    d, i = frames(spark, docs, items)
    return {(r.doc, r.item): r for r in lk.leaks(d, "id", "t", i, "item", "t", n).collect()}


def test_random_against_brute_force(spark):
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(12)]  # few words: ties, repeats, overlaps
    items = [(i, " ".join(r.choices(vocab, k=r.randrange(0, 15)))) for i in range(12)] + [(12, None), (None, "w1 w2 w3 w4")]
    docs = [(i, " ".join(r.choices([*vocab, "zz", "yy"], k=r.randrange(0, 60)))) for i in range(150)] + [(500, None), (501, ""), (None, "w1 w2 w3 w4 w5")]
    docs += [(900, items[0][1] + " ."), (900, "w1, W2"), docs[3]]
    assert set(found(spark, docs, items)) == brute(docs, items, 4)


def test_not_letter_for_letter(spark):
    items = [(1, "The naïve café sold 12 Oranges today")]
    docs = [
        (1, "xx THE, naïve—ca​fé;\n sold yy"),
        (2, "the naïve ｃａｆé ѕоld zz"),
        (3, "the naive café sold"),  # a missing accent is another word
        (4, "the naïve big café sold"),  # a word between
        (5, "café naïve the sold"),
    ]
    assert set(found(spark, docs, items)) == {(1, 1), (2, 1)}


def test_longest_run_and_place(spark):
    got = found(spark, [(1, "a b one two three four five six c")], [(7, "zero one two three four five six seven")])
    r = got[1, 7]
    assert (r.item_from, r.doc_from, r.words) == (1, 2, 6)


def test_texts_of_one_key_do_not_mix(spark):
    items = [(1, "one two three four")]
    assert not found(spark, [(1, "one two x one two"), (1, "y y three four three four")], items)
    assert set(found(spark, [(1, "one two"), (1, "one two three four")], items)) == {(1, 1)}


def test_long_text_and_hot_words(spark):
    long = "the " * 50000 + "alpha beta gamma delta " + "the " * 50000
    assert set(found(spark, [(1, long), (2, "the the the the")], [(5, "alpha beta gamma delta"), (6, "the the the the")])) == {(1, 5), (1, 6), (2, 6)}


def test_runs_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(lk, "BLOCK", 8)
    item = " ".join(f"t{i}" for i in range(30))
    got = found(spark, [(1, "x " + item + " y"), (2, " ".join(f"t{i}" for i in range(5, 17))), (3, "t0 t1"), (4, "t2 t3 t4")], [(3, item)])
    assert (got[1, 3].words, got[1, 3].doc_from) == (30, 1) and got[2, 3].words == 12 and len(got) == 2


def test_small_blocks_against_brute_force(spark, monkeypatch):
    r = random.Random(12)
    vocab = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(r.choices(vocab, k=r.randrange(3, 14)))) for i in range(10)]
    docs = [(i, " ".join(r.choices([*vocab, "zz"], k=r.randrange(0, 70)))) for i in range(120)]
    want = brute(docs, items, 4)
    for size in (5, 17, 64):
        monkeypatch.setattr(lk, "BLOCK", size)
        assert set(found(spark, docs, items)) == want


def test_items_searched_part_by_part(spark, monkeypatch):
    r = random.Random(14)
    vocab = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(r.choices(vocab, k=12))) for i in range(12)]
    docs = [(i, " ".join(r.choices(vocab, k=40))) for i in range(60)]
    monkeypatch.setattr(lk, "MOST_WORDS", 40)
    assert len(lk.parts(frames(spark, docs, items)[1], "item", "t")) > 3
    assert set(found(spark, docs, items)) == brute(docs, items, 4)


def test_one_index_serves_phrases_of_any_length(spark):
    d, i = frames(spark, [(1, "a b c d e f"), (2, "c d x e f")], [(9, "b c d e")])
    index, items = lk.postings(d, "id", "t").cache(), lk.Items.collect(i, "item", "t")
    got = {n: {r.doc for r in lk.phrase_matches(index, items, n).collect()} for n in (1, 2, 3, 4)}
    assert got == {1: {1, 2}, 2: {1, 2}, 3: {1}, 4: {1}}


def test_long_texts_have_the_same_words(monkeypatch):
    text = "One, two  thréé ＦＯＵＲ five_six " * 20
    words = list(lk.Words()(text))
    monkeypatch.setattr(lk.Words, "LONG", 10)
    assert list(lk.Words()(text)) == words and words[:6] == ["one", "two", "thréé", "four", "five", "six"]


def test_empty(spark):
    assert not found(spark, [], [(1, "a b c d")]) and not found(spark, [(1, "a b c d")], []) and not found(spark, [(1, "a b c d")], [(1, "a b")])


def test_proximity(spark):
    d, i = frames(spark, [(1, "rare1 x x rare2 x rare3"), (2, "rare1" + " x" * 30 + " rare2 rare3"), (3, "rare3 rare1 rare2"), (4, "rare1 rare2")], [(9, "rare1 rare2 rare3"), (8, "rare1 nowhere rare2"), (7, "two words")])
    got = {r.doc: r.span for r in lk.near(d, "id", "t", i, "item", "t", 3, 10).collect()}
    assert got == {1: 6, 3: 3}


def test_proximity_against_brute_force(spark, monkeypatch):
    r = random.Random(15)
    vocab = [f"w{i}" for i in range(14)]
    docs = [(i, " ".join(r.choices(vocab, weights=range(1, 15), k=r.randrange(0, 60)))) for i in range(80)]
    items = [(i, " ".join(r.sample(vocab, k=r.randrange(2, 8)))) for i in range(8)]
    split = {d: t.split() for d, t in docs}
    often = {w: sum(t.count(w) for t in split.values()) for w in vocab}
    want = {}
    for i, t in items:
        few = sorted(set(t.split()), key=lambda w: (often[w], w))[:3]
        for d, words in split.items():
            spans = [n for n in range(3, 9) for s in range(len(words) - n + 1) if len(few) == 3 and set(few) <= set(words[s : s + n])]
            if spans:
                want[d, i] = min(spans)
    d, i = frames(spark, docs, items)
    assert {(r.doc, r.item): r.span for r in lk.near(d, "id", "t", i, "item", "t", 3, 8).collect()} == want and want
