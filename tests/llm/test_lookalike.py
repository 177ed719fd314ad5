import random

import pytest

from marlstone.llm import alike_pairs
from marlstone.llm.lookalike import LOOKALIKES, Normaliser

N = Normaliser()


@pytest.mark.parametrize(("a", "b"), [
    ("full width 12%", "ｆｕｌｌ ｗｉｄｔｈ １２％"), ("office flow", "oﬃce ﬂow"), ("café", "café"), ("ガ", "ｶﾞ"), ("a b", "a b"), ("a b", "a b"), ("a b", "a　b"),
    ("zero", "ze​ro"), ("soft", "so­ft"), ("﻿bom", "bom"), ("re-price", "re‑price"), ("scope", "ѕсоре"), ("tone", "tоne"), ("BETA", "ΒΕΤΑ"), ("Kelvin", "Kelvin"),
    ("Компания", "Кoмпaния"), ("ёлка", "ëлка"), ("объём", "oбъём"),
])
def test_alike(a, b):
    assert a != b and N.form(a) == N.form(b)


@pytest.mark.parametrize(("a", "b"), [("Case", "case"), ("cafe", "café"), ("m²", "m2"), ("a  b", "a b"), ("one two", "one too"), ("a\nb", "a b"), ("½", "1/2"), ("12", "13"), ("и", "u"), ("ж", "x"), ("αβγ", "abg"), ("𝟏", "1"), ("ψ", "y")])
def test_really_different(a, b):
    assert N.form(a) != N.form(b)


def test_resolution():
    assert N.spelling("tоne") == "tone" and N.spelling("Кoмпaния") == "Компания"
    assert N.spelling("сор") == "cop"  # wholly of look-alikes
    assert N.spelling("жzо") == "жzo"  # truly mixed
    assert N.kind("tоne") == "mixed" and N.kind("сор") == "whole" and N.kind("tone") == N.kind("Компания") == "single" and N.kinds("tоne сор é AB社") == (1, 1)


def test_any_disguise_has_the_same_form():
    r = random.Random(3)
    alike = {}
    for row in LOOKALIKES:
        for c in row:
            alike[c] = row
    for word in ("Investment", "Хроника", "Ποσοστο", "COPE", "объёмный", "naïve", "Zürich"):
        for _ in range(40):
            other = "".join(r.choice(alike.get(c, [c])) for c in word)
            assert N.form(other) == N.form(word) and N.form(N.form(other)) == N.form(other)


def test_every_letter_and_script_pair():
    """Each look-alike of each letter stands for it, alone in a word and in a word of its own script."""
    for row in LOOKALIKES:
        for a in row:
            for b in row:
                assert N.form(f"b{a}g rest") == N.form(f"b{b}g rest") and N.form(a) == N.form(b)


@pytest.mark.parametrize(("a", "b"), [
    ("papa", "ραρα"), ("tu ky", "τυ κγ"), ("go", "ɡo"), ("i", "ı"), ("Bold 𝑡ext", "𝐁𝐨𝐥𝐝 text"), ("a b", "a\u2028b"), ("xy", "x\U000e0041y"), ("xy", "x\U000e0101y"), ("on", "օո"), ("AB", "ᎪᏴ"), ("LISU", "ꓡꓲꓢꓴ"), ("ⲟⲭ", "ox"), ("5 μm", "5 µm"),
])
def test_alike_beyond_cyrillic(a, b):
    assert a != b and N.form(a) == N.form(b)


def test_emoji_sequences_stay_apart():
    assert N.form("👨\u200d👩\u200d👧") != N.form("👨👩👧") and N.form("🏴\U000e0067\U000e0062\U000e007f") != N.form("🏴")
    assert N.form("👨\u200d👩") == N.form("👨\u200d👩\u200b") and N.form("a\u200db") == "ab"


def test_pairs(spark):
    rows = [(1, "tone a"), (2, "tоne a"), (3, "tone a"), (4, None), (5, ""), (6, "  "), (7, "  "), (8, "other"), (9, "ｔｏｎｅ a"), (2, "tоne a"), (None, "t​one a")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "id long, text string, form string")
    assert {tuple(r) for r in alike_pairs.pairs(df, "id", "text").distinct().collect()} == {(1, 2), (2, 3), (1, 9), (3, 9), (2, 9)}
    got = {(r.id, r["class"], r.spellings) for r in alike_pairs.classes(df.where("id is not null"), "id", "text").collect()}
    assert got == {(1, 1, 3), (2, 1, 3), (3, 1, 3), (9, 1, 3), (8, 8, 1)}


def test_hot_form_and_long_text(spark):
    hot = [(i, "same text") for i in range(300)] + [(1000, "ѕame text")]
    long = "word " * 20000
    df = spark.createDataFrame([*hot, (2000, long), (2001, long.replace("o", "о", 1))], "id long, text string")
    assert alike_pairs.pairs(df, "id", "text").count() == 301


def test_empty(spark):
    assert alike_pairs.pairs(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0
