"""Spelling variants, circulant MinHash and the conversation trie on small cases, against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from entigrid.llm import circulant, prefix_trie, queries, spelling
from entigrid.llm.common import prepare
from entigrid.session import scratch_path

DOCS = "doc_id long, text string, word string, n long, m int, cls long, host long"
TURNS = "conv_id long, turn long, role string, text string, host long, digest string, own string, seq string"


def saved_as(spark, name, rows, schema):
    """A folder that holds one table."""
    folder = scratch_path(spark, name)
    prepare(spark).createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


# 11 spelling variants --------------------------------------------------------


def plain_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form, close = set(), {}, {w: [v for v in n if near(w, v)] for w in n}
    for w, others in close.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None))
    return out


def few_letters(seed, rows=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("aBé") for _ in range(rnd.choice([4, 5, 6, 7])))
    texts = [" ".join(word() for _ in range(30)) for _ in range(rows)] + [None, "", "12 -- ×÷", "İ \U0001f389 \0"]
    long = "Z" * 5000 + " " + "Z" * 4999 + "y"
    return [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(5, long)] * 4 + [(8, texts[0])] * 3


@pytest.mark.parametrize("tile", [3, 16, 128])
def test_variants_equal_plain(spark, tile):
    rows = few_letters(tile)
    docs = prepare(spark).createDataFrame([(*r, "w", 1, 2, 3, 4) for r in rows], DOCS)
    got = [tuple(r) for r in spelling.variants(docs, tile).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants(rows)


def test_spelling_query_equals_plain(spark):
    rows = few_letters(9)
    folder = saved_as(spark, "documents", [(*r, "w", 1, 2, 3, 4) for r in rows], DOCS)
    got = queries.QUERIES["op11_spelling"](spark, folder)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain_variants(rows)


def test_hot_beginning_splits_without_loss(spark):
    # a third of all words begin alike, so the first halves are far above the tile
    rnd = random.Random(4)
    words = {"beginning" + "".join(rnd.choice("abcd") for _ in range(4)) for _ in range(150)}
    words |= {"".join(rnd.choice("efgh") for _ in range(8)) for _ in range(300)}
    rows = [(i, " ".join(sorted(words))) for i in range(3)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in spelling.variants(docs, tile=8).collect()} == plain_variants(rows)


def test_variants_of_nothing(spark):
    empty = prepare(spark).createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).collect() == []
    assert spelling.variants(prepare(spark).createDataFrame([(1, None), (None, "ab cd")], "doc_id long, text string")).collect() == []


def test_block_pairs_are_prefix_plus_suffix():
    words = ["abcde", "abde", "abxde", "bcde", "abcdef", "aabcde", "abcd", "edcba"]
    m = 5
    front, back = spelling.matrix([w[:m] for w in words], m), spelling.matrix([w[:m] for w in words], m, from_end=True)
    size = np.array([min(len(w), m) for w in words])
    near = spelling.near_in_blocks(front[None], back[None], front[None], back[None], size[None], size[None], m, 0, m)[0]
    assert near[0].tolist() == [False, True, True, True, False, False, True, False]
    assert (near == near.T).all()


# 12 circulant MinHash --------------------------------------------------------


def plain_components(rows, k=2):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        out[(doc_id, len(sets[i]), least, doc_id == least)] += 1
    return out


def near_texts(seed):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(400)}" for _ in range(rnd.choice([1, 2, 4, 12, 60, 200]))] for _ in range(12)]
    rows = []
    for i in range(90):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, len(words) // 12, len(words) // 8])):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(30)}"
        rows.append((i if i % 11 else None, (" " if i % 2 else "\t\n ").join(words)))
    return rows + [(None, None), (200, ""), (201, " .. "), (202, None), (3, rows[3][1]), (3, rows[3][1]), (203, "One"), (204, "one  "), (205, "y" * 30_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_circulant_query_equals_plain(spark, seed):
    rows = near_texts(seed)
    folder = saved_as(spark, "documents", [(*r, "w", 1, 2, 3, 4) for r in rows], DOCS)
    got = queries.QUERIES["op12_circulant"](spark, folder)
    assert Counter(map(tuple, got.select("doc_id", "n_shingles", "component_id", "kept").collect())) == plain_components(rows)


def test_large_groups_of_copies(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([f"own{i}", *words])) for i in range(150)] + [(1000 + i, " ".join(words)) for i in range(150)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    got = circulant.near_components(docs).collect()
    assert {r.component_id for r in got} == {0} and [r.doc_id for r in got if r.kept] == [0]


def test_circulant_of_nothing(spark):
    assert circulant.near_components(prepare(spark).createDataFrame([], "doc_id long, text string")).collect() == []


def test_permutations_and_estimates():
    places = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(circulant.pi(places * np.uint32(65537)))) == 1 << 16
    rnd = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.8):
        for _ in range(30):
            x = rnd.integers(0, 1 << 63, 1000, dtype=np.uint64)
            common = int(1000 * share)
            a, b = x[: common + (1000 - common) // 2], np.concatenate([x[:common], x[common + (1000 - common) // 2 :]])
            errors.append(np.mean(circulant.signature(a) == circulant.signature(b)) - share)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2


# 13 conversation trie --------------------------------------------------------


def plain_trie(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs.setdefault(conv_id, []).append((turn, role or "", text or ""))
    digest = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()[:16]
    own = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0, digest(t)))] for c, v in convs.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:])
    members, children, below, out = {}, {}, {}, set()
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        own_children = children.get(p, [])
        leaves = sum(below[k][0] for k in own_children) or 1
        saved = sum(below[k][1] for k in own_children) + (len(members[p]) - 1) * words
        below[p] = leaves, saved
        ends = ",".join(str(c) for c in sorted(members[p]) if len(seqs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.add((min(members[p]), len(p), parent, len(members[p]), len(own_children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def some_turns(seed, conversations):
    rnd, rows = random.Random(seed), []
    for c in range(conversations):
        for t in range(rnd.choice([0, 1, 2, 3, 4, 6, 12])):
            text = rnd.choice(["a b", "c", "d e\x0bf", None, "", "\xa0"]) if rnd.random() < 0.9 else "hot turn"
            rows.append((c if rnd.random() < 0.95 else None, rnd.choice([t, t, t, None]), rnd.choice(["u", "u", None]), text))
    # a third are copies of one conversation, one is long
    rows += [(1000 + c, t, "u", f"copy {t}") for c in range(conversations // 2) for t in range(4)]
    rows += [(7, t, "u", f"long {t}") for t in range(300)] + [(8, t, "u", f"long {t}") for t in range(250)]
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 3])
def test_trie_query_equals_plain(spark, seed, monkeypatch):
    rows = some_turns(seed, 90)
    folder = saved_as(spark, "conversations", [(*r, 1, "d", "o", "s") for r in rows], TURNS)
    monkeypatch.setattr(prefix_trie, "IDS", 16)
    got = [tuple(r) for r in queries.QUERIES["op13_prefix_trie"](spark, folder).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(rows)


@pytest.mark.parametrize("classes, parts", [(1, 1), (2, 1), (5, 7), (8192, 3)])
def test_forests_merge_across_boundaries(spark, classes, parts):
    rows = some_turns(classes, 60)
    turns = prepare(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seqs = prefix_trie.sequences(prefix_trie.rebuilt(turns))
    got = [tuple(r) for r in prefix_trie.trie(seqs, block_classes=classes, parts=parts).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(rows)


def test_trie_edges(spark):
    make = lambda rows: prefix_trie.trie(prefix_trie.sequences(prefix_trie.rebuilt(prepare(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    for rows in ([], [(None, 1, "u", "x")], [(0, 0, "u", "x")], [(41, 0, "u", "x")], [(41, 0, "u", "x"), (41, 1, "a", "y"), (42, 0, None, None), (5, 3, None, None), (46, None, "u", "x")]):
        assert {tuple(r) for r in make(rows).collect()} == plain_trie(rows)


def test_union_find_makes_branches_by_depth():
    depth, first, last, parent, children = prefix_trie.merged_by_depth([2, 3, 3, 1, 2], [2, 1, 0, 0])
    tree = {(int(d), int(f), int(e)): int(n) for d, f, e, n in zip(depth, first, last, children)}
    assert tree == {(2, 0, 1): 1, (3, 1, 1): 0, (3, 2, 2): 0, (1, 3, 3): 0, (2, 4, 4): 0, (1, 0, 2): 2, (0, 0, 4): 3}
    assert sorted(np.flatnonzero(parent < 0).tolist()) == [int(np.flatnonzero((depth == 0))[0])]


def test_long_common_prefixes():
    a = bytes(range(256)) * 100
    assert prefix_trie.common_turns(a, a) == len(a) // 16
    assert prefix_trie.common_turns(a, a[:1600]) == 100
    b = bytearray(a)
    b[5000] ^= 1
    assert prefix_trie.common_turns(a, bytes(b)) == 5000 // 16
    assert prefix_trie.common_turns(b"", a) == 0
