import random

from tokenizers import Tokenizer

import __spark_entry__ as repo
from tillroll.llm import token_counts as tc
from tillroll.llm.texts import tokenizer_path

PATH = tokenizer_path(tc.VOCABULARY)
ODD = ["a", "B", "é", "é", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "1", "23", "'s", "'", "!", "##", "<|endoftext|>", "<|startoftext|>", "Σ", "字", "🙂", "́", "\x00"]


def whole(texts):
    return [len(e) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_pieces_count_like_the_whole_text():
    rng = random.Random(1)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 30))) for _ in range(4000)]
    assert tc.count_batch(texts, PATH) == whole(texts)


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tc, "KEPT", 3)
    monkeypatch.setattr(tc, "_counts", {})
    texts = ["one two three four", "two five", "one six seven " * 50]
    assert [tc.count_batch([t], PATH)[0] for t in texts] == whole(texts)


def test_nulls_long_texts_and_clashing_columns(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "word " * 50_000, 7), (3, "word " * 50_000, 7), (None, "x" * 100_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = tc.with_token_counts(docs, PATH, 2048).collect()
    assert [r.n_tokens for r in got] == [0, 0, 50_000, 50_000, whole(["x" * 100_000])[0]]
    assert [r.n_bytes for r in got] == [0, 0, 250_000, 250_000, 100_000]
    assert [r.over_limit for r in got] == [False, False, True, True, True]
    assert tc.with_token_counts(docs.limit(0), PATH, 9).count() == 0


def test_query_equals_the_library(session):
    texts = {r.doc_id: r.text or "" for r in session.read.parquet(f"{repo.SMALL}/documents.parquet").collect()}
    got = repo.queries()["op8_token_counts"](session, repo.SMALL).collect()
    want = dict(zip(texts, whole(list(texts.values()))))
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(texts)
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) for r in got)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
