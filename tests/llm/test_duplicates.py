import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quotemill.llm import passages, simhash, substring_repeats
from quotemill.llm.components import components
from quotemill.llm.induced_sort import RepeatFinder
from tests.llm.tables import awkward, empty, prose


def find_roots(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(k, k + 1) for k in range(400, 460)] + [(500, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == find_roots(nodes, edges_without_loops(edges))
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def edges_without_loops(edges):
    return [e for e in edges if e[0] != e[1]]


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = docs.select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = find_roots(range(len(rows)), edges)
    least = {}
    for i, row in enumerate(rows):
        ids = least.setdefault(roots[i], [])
        if row.doc_id is not None:
            ids.append(row.doc_id)
    wanted = Counter((r.doc_id, p, min(least[roots[i]], default=None)) for i, (r, p) in enumerate(zip(rows, prints)))
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == wanted
    assert simhash.near_duplicates(empty(spark)).collect() == []


@pytest.mark.parametrize("tile", [2048, 3])
def test_simhash_links_of_near_values(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(tile)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:40]:
        values.add(v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
        values.add(v ^ (7 << rng.randrange(61)))
    values = sorted(values)
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    got = {r.node % 2**64: r.root % 2**64 for r in components(simhash.links(frame)).collect()}
    edges = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2]
    wanted = find_roots(values, edges)
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in m.values()}
    assert groups(got) == {g for g in groups(wanted) if len(g) > 1}


def test_one_row_of_each_group_stays(spark):
    kept = simhash.drop_near_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None)
    assert ids == sorted(set(ids)) and {0, 2, 12} <= set(ids) and not {1, 3, 4} & set(ids)


@pytest.mark.parametrize("seed", range(4))
def test_repeats_of_small_sequences(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, length = rng.randint(0, 60), rng.randint(1, 6)
        text = [rng.choice([0] * (rng.random() < 0.3) + [1, 2, 3][: rng.randint(1, 3)]) for _ in range(n)]
        if rng.random() < 0.5:
            text = text + [0] + text[: rng.randint(0, n)]
        got = RepeatFinder(np.array(text, np.int16), length, held=rng.choice([3, 10**6])).places()
        strings = Counter(tuple(text[i : i + length]) for i in range(len(text) - length + 1))
        for i in range(len(text) - length + 1):
            if 0 not in text[i : i + length]:
                assert got[i] == (strings[tuple(text[i : i + length])] > 1), (text, length, i)


def slow_removal(rows, length):
    data = [(r.text or "").encode() for r in rows]
    held = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for row, d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if held[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((row.doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [200, 50])
def test_removed_substrings(spark, monkeypatch, length):
    monkeypatch.setattr(substring_repeats, "PIECE", 1500)
    docs = awkward(spark)
    wanted = slow_removal(docs.select("doc_id", "text").collect(), length)
    assert Counter(map(tuple, substring_repeats.digest(docs, length).collect())) == Counter(wanted)
    assert substring_repeats.digest(empty(spark)).collect() == []


def test_copies_of_a_stretch_are_searched_once(spark):
    shared, other = prose(90, 5), prose(40, 6)
    texts = [shared] * 4 + [other + " " + shared[:400], shared[300:] + " " + other, other, shared[250:520] + "!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = substring_repeats._keyed(docs)
    stretches = substring_repeats._stretches(substring_repeats._packed(keyed), substring_repeats._anchor_table(keyed, 200), 200)
    held = stretches.where("stretch IS NOT NULL").groupBy(F.spark_partition_id(), "h", "b").count()
    assert {r["count"] for r in held.collect()} == {1}
    wanted = slow_removal(docs.collect(), 200)
    assert Counter(map(tuple, substring_repeats.digest(docs).collect())) == Counter(wanted)


def test_compact_windows_cover_every_subsequence_once():
    rng = np.random.default_rng(4)
    for n in (0, 3, 9, 30):
        values = rng.integers(0, 2**63, n).astype(np.uint64)
        l, c, r = passages.compact_windows(values, 4)
        for i in range(n):
            for j in range(i + 3, n):
                holders = [k for k in range(len(c)) if l[k] <= i <= c[k] <= j <= r[k]]
                assert [c[k] for k in holders] == [i + int(np.argmin(values[i : j + 1]))]

def test_runs_of_one_word_share_few_keys(spark):
    short = [" ".join([f"a{i}"] * 31 + ["the"] * 31 + [f"b{i}"] * 31) for i in range(40)]
    texts = short + ["the " * 300 + "end", "the " * 60 + prose(40, 3), prose(60, 4) + " the" * 90]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = passages._keyed(docs)
    members = passages._members(passages._window_table(keyed, passages.Settings()), passages.Settings())
    assert members.groupBy("k", "uid").count().agg(F.max("count")).first()[0] <= 6
    found = passages.near_passages(docs).collect()
    pairs = {(r.doc_id, r.other_doc_id) for r in found}
    # Runs as long as a passage have the first document, shorter ones the last of the long.
    assert {(40, 0), (41, 0), (42, 0), (42, 1), (42, 39)} <= pairs and len(pairs) < 100
    covered = {w for r in found if r.doc_id == 40 for w in range(r.start_word, r.end_word)}
    assert set(range(300)) <= covered


def test_near_passages(spark):
    shared = prose(90, 1).split()
    edited = shared[:40] + ["other"] + shared[41:]
    rows = [
        (1, prose(100, 2)), (2, prose(50, 3) + " " + " ".join(shared) + " " + prose(40, 4)),
        (3, " ".join(edited) + " " + prose(60, 5)), (4, prose(30, 6) + " " + " ".join(shared[:40])), (5, None), (6, ""), (7, prose(100, 2).upper()),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.other_doc_id) for r in passages.near_passages(docs).collect()}
    assert found == {(3, 2), (7, 1)}
    left = {r.doc_id: r.text for r in passages.drop_repeated_passages(docs).collect()}
    assert left[2] == rows[1][1] and left[1] == rows[0][1] and left[4] == rows[3][1] and left[5] is None
    assert left[7] == "" and left[3].strip() == prose(60, 5)


def test_passages_of_awkward_rows(spark):
    docs = awkward(spark)
    left = passages.drop_repeated_passages(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    texts = {r.doc_id: r.text for r in left.select("doc_id", "text").collect() if r.doc_id != 12}
    assert texts[0] and texts[1] == "" and texts[2] is None and texts[8].split() == (prose(70, 8) + " " + prose(20, 9)).split()
    assert passages.near_passages(empty(spark)).collect() == []


def similar_between_common_shingles(a, b):
    """Whether what lies between the first and last common shingle makes a passage of each."""
    a, b = passages.shingles(a, 5), passages.shingles(b, 5)
    met, others = [i for i, x in enumerate(a) if x in b], [i for i, x in enumerate(b) if x in a]
    a, b = a[met[0] : met[-1] + 1], b[others[0] : others[-1] + 1]
    return min(len(a), len(b)) >= 46 and len({*a} & {*b}) >= 0.8 * len({*a} | {*b})


@pytest.mark.parametrize("n", [50, 51, 65, 80])
def test_passages_with_a_word_more_or_less_at_every_place(spark, n):
    rng, rows, wanted = random.Random(n), [], set()
    fresh = lambda k: [b"w%d" % rng.getrandbits(40) for _ in range(k)]
    for p in range(n + 1):
        for more in (True, False):
            base = fresh(n)
            other = base[:p] + fresh(1) + base[p:] if more else base[:p] + base[p + 1 :]
            rows += [fresh(30) + base + fresh(40), fresh(rng.randint(5, 60)) + other + fresh(30)]
            if similar_between_common_shingles(*rows[-2:]):
                wanted.add((len(rows), len(rows) - 1))
    docs = spark.createDataFrame([(i + 1, b" ".join(r).decode()) for i, r in enumerate(rows)], "doc_id long, text string")
    found = {(r.doc_id, r.other_doc_id) for r in passages.near_passages(docs).collect()}
    assert len(wanted) > n // 2 and found >= wanted and all(b % 2 and a == b + 1 for a, b in found)


def test_a_head_without_the_passage_hides_no_pair(spark):
    rng = random.Random(8)
    fresh = lambda k: " ".join(f"w{rng.getrandbits(40)}" for _ in range(k))
    line, others = fresh(30), [fresh(25) for _ in range(4)]
    rows = [(i, f"{fresh(40)} {line} {fresh(40)}") for i in range(1, 8)]
    rows += [(10 * (j + 1) + i, f"{fresh(20)} {line} {other} {fresh(20)}") for j, other in enumerate(others) for i in range(3)]
    rows += [(90, f"{fresh(20)} {line} {fresh(60)} {line} {others[0]} {fresh(9)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.other_doc_id) for r in passages.near_passages(docs).collect()}
    assert {a for a, _ in found} == {*[10 * j + i for j in range(1, 5) for i in (1, 2)], 90}
    assert all(a // 10 == b // 10 or a == 90 and b // 10 == 1 for a, b in found)


def test_a_passage_with_another_head_hides_no_pair(spark):
    rng, rows, wanted = random.Random(5), [], []
    fresh = lambda k: " ".join(f"w{rng.getrandbits(40)}" for _ in range(k))
    for g in range(20):
        line, start, a, b = fresh(48), fresh(3), fresh(30), fresh(30)
        texts = [f"{fresh(30)} {line} {fresh(30)}", f"{fresh(30)} {line} {a}", f"{fresh(30)} {line} {b}",
                 f"{fresh(30)} {start} {line} {a}", f"{fresh(30)} {start} {line} {b}"]
        rows += [(10 * g + i, t) for i, t in enumerate(texts)]
        wanted.append((10 * g + 4, 10 * g + 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.other_doc_id) for r in passages.near_passages(docs).collect()}
    heads = lambda d: {b for a, b in found if a == d}
    assert [p for p in wanted if p not in found and not heads(p[0]) & (heads(p[1]) | {p[1]})] == []


def test_passages_of_copies_and_of_repeated_ids_with_different_texts(spark):
    a, b = prose(120, 31), prose(70, 32) + " " + prose(60, 33)
    rows = [(1, a, 9), (2, a, 9), (2, prose(20, 34) + " " + prose(60, 33), 9), (3, b, 9), (None, a, 9), (4, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cut int").coalesce(1)
    left = passages.drop_repeated_passages(docs)
    assert left.columns == docs.columns
    assert {(r.doc_id, (r.text or "").strip()) for r in left.collect()} == {
        (1, a), (2, ""), (2, rows[2][1]), (3, prose(70, 32)), (None, ""), (4, ""),
    }
    pairs = [(r.doc_id, r.other_doc_id) for r in passages.near_passages(docs).collect()]
    assert sorted(pairs, key=str) == sorted([(2, 1), (None, 1), (3, 2)], key=str)


def test_classes_of_documents_do_not_compare_all_of_a_family(spark, monkeypatch):
    rng, rows = random.Random(3), []
    fresh = lambda k: [f"w{rng.getrandbits(40)}" for _ in range(k)]
    base = fresh(400)
    for i in range(60):
        rows.append((i, " ".join(w if rng.random() > 0.03 else fresh(1)[0] for w in base)))
    line, chain = fresh(30), [fresh(60) for _ in range(6)]
    rows += [(100 + i, " ".join(fresh(40) + line + fresh(40))) for i in range(5)]
    rows += [(200 + i, " ".join(fresh(20) + chain[i] + fresh(9) + chain[i + 1])) for i in range(5)]
    rows += [(300, rows[5][1]), (301, "short text"), (302, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, verified = [], passages._verified
    monkeypatch.setattr(passages, "_verified", lambda links, *rest: pairs.append(links.count()) or verified(links, *rest))
    got = {r.doc_id: r for r in passages.linked_documents(docs).collect()}
    # Far fewer than the 1770 pairs of the family.
    assert len(got) == len(rows) and sum(pairs) < 350
    wanted = {i: 0 if i < 100 or i == 300 else 200 if 200 <= i < 205 else i for i, _ in rows}
    assert {i: r.component_id for i, r in got.items()} == wanted
    texts = {i: (t or "").split() for i, t in rows}
    for r in got.values():
        linked = r.doc_id < 60 or 200 <= r.doc_id < 205 or r.doc_id == 300
        assert (r.other_doc_id is not None) == linked
        if linked:
            mine, others = texts[r.doc_id][r.start_word : r.end_word], texts[r.other_doc_id][r.other_start_word : r.other_end_word]
            mine, others = ({*passages.shingles([w.encode() for w in x], 5)} for x in (mine, others))
            assert abs(len(mine & others) / len(mine | others) - r.similarity) < 1e-9 and r.similarity >= 0.8


def test_classes_equal_those_of_all_listed_passages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    listed = passages.near_passages(docs).select(F.col("doc_id").alias("u"), F.col("other_doc_id").alias("v"))
    wanted = {r.node: r.root for r in components(listed).collect()}
    got = passages.linked_documents(docs).collect()
    assert len(got) == docs.count() and wanted
    assert {r.doc_id: r.component_id for r in got} == {r.doc_id: wanted.get(r.doc_id, r.doc_id) for r in got}


def test_classes_of_awkward_rows(spark):
    got = passages.linked_documents(awkward(spark)).collect()
    assert len(got) == awkward(spark).count()
    assert {r.component_id for r in got if r.doc_id in (7, 8)} == {7} and {r.component_id for r in got if r.doc_id in (0, 1)} == {0}
    assert {r.component_id for r in got if r.doc_id == 12} == {12}
    assert passages.linked_documents(empty(spark)).collect() == []
