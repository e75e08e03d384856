"""SimHash groups against a brute-force version."""

import random
import re

import pytest
import xxhash

from importlens.llm import simhash_dedup as sd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    group = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (doc_id, fp) in enumerate(prints):
        ids = [d for (d, _), g in zip(prints, group) if g == group[i] and d is not None]
        out.append((doc_id, f"{fp:016x}", min(ids) if ids else None))
    return out


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([3, 40, 200]))]
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "Two words"), (904, "two  WORDS"), (905, "É x"), (906, "é x"),
             (907, "a b c d"), (908, "x " * 30000), (7, rows[7][1]), (None, "alone here now"), (None, rows[3][1])]
    return rows


def test_groups_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in sd.simhash_groups(df).collect()]
    assert sorted(got, key=str) == sorted(slow_components(rows), key=str)


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_covering_links_reach_every_pair(spark, radius):
    rng = random.Random(radius)
    prints = {0}
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(30):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, radius + 3))))
    prints = sorted(prints)
    df = spark.createDataFrame([(sd._signed(p),) for p in prints], "fp long")
    links = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in sd.covering_links(df, radius).collect()]
    assert all((a ^ b).bit_count() <= radius for a, b in links)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                assert find(a) == find(b)


def test_one_row_of_each_group_stays(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    want = {(d, c) for d, _, c in slow_components(rows)}
    kept = sd.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, c in want if d == c)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", fp string, root string, k string, t string")
    assert sd.simhash_groups(df).count() == 0
    one = spark.createDataFrame([(1, "a b c d", "en", "s", 7, "x", "y", "z", "q")], df.schema)
    assert sd.keep_one(one).collect()[0].asDict()["fp"] == "x"


def test_query_over_the_given_documents(spark):
    out = sd.op9_simhash_dedup(spark, "/root/testdata/sf0.001")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(map(tuple, out.select("doc_id", "fingerprint", "component_id").collect())) == sorted(slow_components(docs))
