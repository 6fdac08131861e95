"""The forest's components against all pairs compared by their sets."""

import random

import numpy as np
import pytest

from quotemill.llm import minhash_forest as M
from tests.llm.tables import awkward, empty, prose


def word_sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def brute(rows):
    """(doc_id, n, component, kept) from all pairs."""
    sets = [word_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    out = [(d, len(s), ids.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    return sorted([(*r, r[0] == r[2]) for r in out], key=repr)


def found(docs):
    return sorted([tuple(r) for r in M.with_kept(docs).collect()], key=repr)


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert M.with_kept(empty(spark)).count() == 0


def corpus():
    """Groups of edited copies around the bound, chains, a frequent line, short texts, a hub."""
    rng = random.Random(11)
    texts = []
    for g in range(60):
        base = prose(rng.choice([8, 30, 60, 150, 400]), 1000 + g).split()
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(edited(base, rng.randrange(0, max(2, len(base) // 30)), rng)))
    line = prose(60, 5)
    texts += [f"{line} {prose(rng.choice([4, 9, 20, 70]), 3000 + i)}" for i in range(150)]
    hub = prose(200, 77).split()
    texts += [" ".join(edited(hub, 7, rng)) for _ in range(150)] + [" ".join(hub)]
    chain = prose(100, 9).split()
    for _ in range(60):
        chain = edited(chain, 2, rng)
        texts.append(" ".join(chain))
    texts += ["a", "A", "a b", "a b c", "a b c d", "a b c d e", "b b b b b b", "b b b b", "", " \n", None, prose(9000, 4), prose(9000, 4) + " tail"]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def test_components_equal_all_pairs(spark):
    rows = corpus()
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_tiles_lose_no_link(spark, monkeypatch):
    """No chains, small tiles: everything is left to the regions."""
    monkeypatch.setattr(M, "CHAINS", 0)
    monkeypatch.setattr(M, "TILE_ROWS", 16)
    rows = corpus()
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8):
        agree = []
        for _ in range(60):
            common = rng.integers(0, 2**63, int(300 * share), np.uint64)
            rest = (300 - len(common)) // 2
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, rest, np.uint64)])) for _ in range(2))
            agree.append(int((M.signature(a) == M.signature(b)).sum()))
        assert abs(np.mean(agree) / (M.TREES * M.KEYS) - share) < 0.02
        assert share < 0.8 or min(agree) > M.AGREE


@pytest.mark.parametrize("one, other, common, wanted", [(1, 1, 1, True), (4, 5, 4, True), (10, 10, 8, False), (9, 9, 8, True)])
def test_bound_is_exact(one, other, common, wanted):
    assert M.similar(one, other, common) is wanted
