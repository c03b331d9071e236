import difflib
import random

import pytest
from helpers import rows

from tillroll.functions import fixed_values as fixed
from tillroll.operators import vocab
from tillroll.operators.skew import HotRule
from tillroll.session import cut_lineage


def frame(spark, words, name="word"):
    return spark.createDataFrame([(w,) for w in words], f"{name} string")


def brute(words, known):
    """The standard library over every pair."""
    out = {}
    for w in set(words):
        if w in known or "ml" in w or all(c.isdigit() for c in w):
            continue
        close = difflib.get_close_matches(w, sorted(known), 1, cutoff=0.90)
        if close:
            out[w] = close[0]
    return out


def damage(r, word, times):
    letters = list(word)
    for _ in range(times):
        i = r.randrange(len(letters))
        kind = r.choice(["drop", "add", "swap", "change"])
        if kind == "drop" and len(letters) > 1:
            letters.pop(i)
        elif kind == "add":
            letters.insert(i, r.choice("abcde"))
        elif kind == "change":
            letters[i] = r.choice("abcde")
        elif i:
            letters[i - 1], letters[i] = letters[i], letters[i - 1]
    return "".join(letters)


@pytest.mark.parametrize("most", [0, vocab.MOST_BROADCAST_KEYS], ids=["shuffled", "broadcast"])
@pytest.mark.parametrize(
    "low,high,n", [(4, 10, 120), (9, 16, 120), (13, 24, 90), (25, 60, 40), (90, 130, 8)]
)
def test_corrections_equal_brute_force(session, monkeypatch, low, high, n, most):
    """No close match is missed, whatever the length of the words."""
    monkeypatch.setattr(vocab, "MOST_BROADCAST_KEYS", most)
    r = random.Random(low)
    known = {"".join(r.choice("abcde") for _ in range(r.randint(low, high))) for _ in range(n)}
    words = [
        damage(r, w, r.randint(1, max(1, len(w) // 10))) for w in sorted(known) for _ in range(4)
    ]
    words += ["12345678901", "abcdemlabcde"]
    got = dict(rows(vocab.corrections(frame(session, words), frame(session, sorted(known)))))
    assert got == brute(words, known)
    assert len(got) > n / 3


def test_a_huge_word_costs_nothing(session):
    """No vocabulary word is near its length, so it gives no keys."""
    words = ["x" * 50_000, "antarticaa"]
    got = vocab.corrections(frame(session, words), frame(session, ["antarctica", "y" * 30]))
    assert rows(got) == [("antarticaa", "antarctica")]


def test_a_long_word_meets_a_vocabulary_of_long_words(session):
    """Keys grow with the length of a word, not with the lengths there are. (From 200
    letters on the library ignores frequent letters, so its answer is what counts.)"""
    r = random.Random(5)
    known = ["".join(r.choice("abcdefghij") for _ in range(n)) for n in range(820, 1200, 7)]
    words = [damage(r, known[26], 60), known[30] + "x"]
    got = vocab.corrections(frame(session, words), frame(session, known))
    assert dict(rows(got)) == brute(words, set(known))
    pairs = vocab.candidate_pairs(frame(session, words), frame(session, known))
    assert set(rows(pairs)) >= {(words[0], known[26]), (words[1], known[30])}


def test_repeated_rows_are_repaired_alike(spark):
    df = spark.createDataFrame([(1, "brahmaa ln"), (1, "brahmaa ln"), (1, "brahmaa lt"), (2, "brahmaa ln")], "id int, t string")
    got = vocab.repair_typos(df, "t", frame(spark, ["brahma", "ln", "lt"]), "out")
    assert sorted((x["id"], x["out"]) for x in got.collect()) == [(1, "brahma ln"), (1, "brahma ln"), (1, "brahma lt"), (2, "brahma ln")]


def test_ties_go_to_the_greatest(spark):
    got = vocab.corrections(
        frame(spark, ["abcdefghijz", "brahmaa"]),
        frame(spark, ["abcdefghijx", "abcdefghijy", "brahma", "brahmab", "brahmac"]),
    )
    assert rows(got) == [("abcdefghijz", "abcdefghijy"), ("brahmaa", "brahma")]


def test_a_lower_cutoff_is_refused(session):
    with pytest.raises(ValueError):
        vocab.corrections(frame(session, ["a"]), frame(session, ["b"]), cutoff=0.8)


def test_vocabulary(spark):
    master = frame(spark, ["skol lt 350ml x", "brahma  lt"], "d")
    got = {r[0] for r in vocab.vocabulary(master, "d").collect()}
    assert got == {"skol", "lt", "350ml", "brahma"} | set(fixed.KEY_TERMS)


TEXTS = [
    (1, "cervejaa brahmaa 350ml"), (2, "zzz  skol"), (3, ""), (4, None),
    (5, "refrigerantte 12 brahmaa"), (6, "skol"),
]


@pytest.mark.parametrize("rule", [None, HotRule(min_rows=0)], ids=["plain", "hot"])
def test_repair_keeps_or_drops_unknown_words(spark, rule):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    known = frame(spark, ["cerveja", "brahma", "skol", "refrigerante"])
    few = 0 if rule else 1000
    kept = vocab.repair_typos(df, "t", known, "out", "keep", rule, few).select("id", "out")
    assert rows(kept) == [
        (1, "cerveja brahma 350ml"), (2, "zzz  skol"), (3, None), (4, None),
        (5, "refrigerante 12 brahma"), (6, "skol"),
    ]
    dropped = vocab.repair_typos(df, "t", known, "out", "drop", rule, few).select("id", "out")
    assert rows(dropped)[1] == (2, " skol")
    with pytest.raises(ValueError):
        vocab.repair_typos(df, "t", known, "out", "glue")


def test_repair_equals_brute_force_on_the_sample_sentences(session):
    sentences = [
        "brahma malzebier ln", "cerveja brahma garrafa 300ml 300ml unidade",
        "pack cerveja brahma malzbier ln 6unidade 355ml", "refrigerante cerveja brahma d malte",
        "brahma pilsen buchudinha 300ml", "garrafao brahma 1000ml unidade", "antartica budweisr",
    ]
    master = frame(
        session, ["antarctica budweiser malzbier garrafa", "refrigerantes cervejas unidades"], "d"
    )
    known = {r[0] for r in vocab.vocabulary(master, "d").collect()}
    fixes = brute(" ".join(sentences).split(" "), known)
    df = session.createDataFrame(list(enumerate(sentences)), "id int, t string")
    got = vocab.repair_typos(df, "t", vocab.vocabulary(master, "d"), "out")
    assert rows(got.select("id", "out")) == [
        (i, " ".join(fixes.get(w, w) for w in s.split(" "))) for i, s in enumerate(sentences)
    ]
    assert fixes["antartica"] == "antarctica"


@pytest.mark.parametrize("unmatched", ["keep", "drop"])
def test_a_long_text_is_not_searched_in_a_map_for_each_word(session, unmatched):
    """Every word is unknown to the vocabulary, so the text's repairs are as many."""
    words = [f"palavra{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{i}" for i in range(3000)]
    text = " ".join([*words, "antarticaa", "", "antarticaa", "12", "500ml", "ow", ""])
    df = session.createDataFrame([(1, text), (2, "ow antarticaa"), (3, "ow"), (4, ""), (5, None)], "k int, t string")
    got = vocab.repair_typos(df, "t", frame(session, ["antarctica", "ow"]), "out", unmatched)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "element_at" not in plan and "map_contains_key" not in plan
    some = " ".join(words) + " " if unmatched == "keep" else ""
    end = "antarctica  antarctica 12 500ml ow "
    want = {1: some + end, 2: "ow antarctica", 3: "ow", 4: None, 5: None}
    assert {r["k"]: r["out"] for r in got.collect()} == want


def test_the_keys_of_a_word_are_few_and_find_two_letters_too_many(session):
    """Words are many: one has a key a letter and half a letter more, not one a pair of letters."""
    r = random.Random(9)
    pairs = set()
    for _ in range(60):
        known = "".join(r.choice("abcde") for _ in range(r.randint(9, 13)))
        word = known
        for _ in range(2):
            i = r.randrange(len(word) + 1)
            word = word[:i] + r.choice("abcdefg") + word[i:]
        pairs.add((word, known))
    words = frame(session, sorted({w for w, _ in pairs}))
    keys = vocab._keys(words, "word", False).groupBy("word").count().collect()
    assert len(keys) == words.count() and all(x["count"] <= 2 * len(x["word"]) + 4 for x in keys)
    assert set(rows(vocab.candidate_pairs(words, frame(session, sorted({k for _, k in pairs}))))) >= pairs


def test_few_repairs_meet_the_words_where_the_texts_are(session, monkeypatch):
    """Texts are only told apart, by a shuffle of all of them, for repairs that are many."""
    stored = []
    monkeypatch.setattr(vocab, "cut_lineage", lambda df: stored.append(df.columns) or cut_lineage(df))
    df = session.createDataFrame([(1, "cervejaa ow cervejaa"), (2, "cervejaa ow cervejaa"), (3, "ow")], "k int, t string")
    want = [(1, "cerveja ow cerveja"), (2, "cerveja ow cerveja"), (3, "ow")]
    for few, tokens in ((1000, 0), (0, 1)):
        stored.clear()
        got = vocab.repair_typos(df, "t", frame(session, ["cerveja", "ow"]), "out", broadcast_rows=few)
        assert rows(got.select("k", "out")) == want
        assert stored.count(["_text1", "_text2", "word"]) == tokens
