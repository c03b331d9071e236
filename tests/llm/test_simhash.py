import random
import re

import numpy as np
import xxhash

import __spark_entry__ as repo
from tillroll.llm import simhash as sh
from tillroll.llm.components import components


def plain_print(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest id reachable, over all pairs."""
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints.items():
            for b, y in prints.items():
                if (x ^ y).bit_count() <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return group


def test_golay_decodes_within_three_bits_and_files_within_four():
    golay, rng = sh.Golay(), random.Random(2)
    for _ in range(300):
        message = rng.randrange(1 << 12)
        word = message << 11 | int(golay.remainders[message])
        for n in range(5):
            bad = word
            for b in rng.sample(range(23), n):
                bad ^= 1 << b
            near = golay.near(np.array([bad]))[0]
            assert message in near
            assert n > 3 or near[0] == message


def test_keys_meet_for_all_pairs_of_up_to_two_bits():
    golay, rng = sh.Golay(), random.Random(4)
    base = rng.getrandbits(64)
    others = [base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i, 64)] + [base ^ (1 << i) for i in range(64)]
    asked = set(sh.fuzzy_keys(np.array([base], dtype=np.uint64).view(np.int64), golay, False)[0])
    filed = sh.fuzzy_keys(np.array(others, dtype=np.uint64).view(np.int64), golay, True)
    assert all(asked & set(row) - {-1} for row in filed)


def test_fingerprints_follow_the_definition():
    texts = [None, "", " \n", "One", "one TWO", "Ä É ä é", "a b c d e f " * 30, "x\x1cy z\x0bw", "repeat " * 9]
    for t in texts:
        assert sh.fingerprint_of(sh.shingle_hashes(t, 3)) & (1 << 64) - 1 == plain_print(t)


def test_links_equal_all_pairs(spark):
    rng = random.Random(7)
    prints = {0, -1, 2**63 - 1, -(2**63)}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(8):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            prints.add(x - (1 << 64) if x >> 63 else x)
    got = {tuple(r) for r in sh.fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & mask).bit_count() <= 2}
    assert got == want and want


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    links = chain + star + [(5, 5), (1, 2), (2, 1), (2, 3), (3, 1), (None, 4), (160, 150)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    want = {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(200, 260)} | {1: 1, 2: 1, 3: 1}
    assert got == want
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_rows_with_nulls_ties_and_clashing_columns(spark):
    long = "many words in a long text " * 400
    rows = [(3, "A b c d", "q"), (1, "a B c d", None), (1, "a b c d", "q"), (2, None, "q"), (9, " ", "q"), (8, long, "q"), (None, "solo", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", sh.F.lit("old"))
    got = sh.with_near_duplicates(df)
    assert got.columns == ["doc_id", "text", "fp", "fingerprint", "component_id"]
    assert sorted((r.component_id, r.doc_id) for r in got.collect() if r.doc_id) == [(1, 1), (1, 1), (1, 3), (2, 2), (2, 9), (8, 8)]
    assert {r.fingerprint for r in got.collect() if r.doc_id in (2, 9)} == {"0" * 16}
    assert sh.with_near_duplicates(df.limit(0)).count() == 0
    kept = sh.without_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 8]
    assert sh.without_near_duplicates(df.limit(0)).count() == 0


def test_query_equals_brute_force(session):
    texts = {r.doc_id: r.text for r in session.read.parquet(f"{repo.SMALL}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    want = plain_groups(prints)
    got = repo.queries()["op7_simhash_near_dedup"](session, repo.SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
    assert len(got) == len(texts)
