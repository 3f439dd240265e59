"""Operators 11 to 13 against plain versions, with edge cases."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from sevlens.llm import merkle, prefix_trie, substrings  # noqa: E402

FULL = "doc_id long, source string, lang string, n_chars long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def passage(n, seed, words=5000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


# -- 11

def leaves():
    r = random.Random(11)
    rows = [(i, r.choice(["b", "a", "\u00e9", "z", None]), r.choice(["en", None]), i, f"line {i}\nnext \U0001f600") for i in range(60)]
    rows += [(None, "a", None, None, "x\ny"), (None, "a", None, None, "w"), (100, "lone", "en", 1, None), (101, "", "en", 1, ""), (5, "a", "en", 2, "other\n"),
             (7, "b", "en", 3, "again"), (7, "b", "en", 3, "again"), (200, "z", "en", None, "long\n" * 400_000)]
    return rows


@pytest.mark.parametrize("height", [1, 2, 6])
def test_merkle_equals_plain_trees(spark, height):
    rows = leaves()
    df = spark.createDataFrame(rows, FULL).selectExpr("*", "1 AS tree", "2 AS pos", "3 AS size", "4 AS block", "5 AS k", "6 AS tie", "7 AS path")
    got = merkle.proofs(df, height).collect()
    assert sorted(map(tuple, got), key=str) == brute.merkle(rows)
    assert any(r.verified for r in got) and not all(r.verified for r in got)


def test_merkle_small_and_empty_tables(spark):
    for rows in ([], [(1, None, None, None, None)], [(2, "s", "en", 1, "x\n")]):
        got = merkle.proofs(spark.createDataFrame(rows, FULL)).collect()
        assert sorted(map(tuple, got), key=str) == brute.merkle(rows)


def test_merkle_blocks_lie_in_van_emde_boas_order(spark):
    for levels in range(1, 7):
        own = [merkle.address(levels, d, np.arange(3 ** d)) for d in range(levels)]
        assert sorted(np.concatenate(own).tolist()) == list(range(merkle.subtree(levels)))
        top = levels // 2
        if top:     # the upper half first, then every lower subtree in one piece
            assert max(x.max() for x in own[:top]) < merkle.subtree(top) == own[top][0]
            size = merkle.subtree(levels - top)
            assert all(np.array_equal((own[d] - merkle.subtree(top)) // size, np.arange(3 ** d) // 3 ** (d - top)) for d in range(top, levels))
    _, lower, upper, _ = merkle.manifest(spark.createDataFrame(leaves(), FULL), 1)
    assert len(lower) > 1 and len(upper) > 1
    for r in lower[0].collect():
        block = merkle.Block(r["levels"], r["n"], r["data"])
        assert len(r["data"]) == 32 * merkle.subtree(r["levels"]) and merkle.Block.built(block.level(0), r["size"], 1).data == r["data"]


# -- 12

def documents():
    r, base = random.Random(12), passage(180, 1)
    w = base.split()
    rows = [(0, base), (9, base), (4, passage(30, 2) + " " + " ".join(w[40:95]) + " " + passage(30, 3)), (5, " ".join(w[100:149])), (6, " ".join(w[100:150])),
            (7, None), (8, ""), (10, " \t\n\x0b\x0c\r "), (11, "\u00a0".join(w)), (12, " ".join(w[:60]) + "\x85" + " ".join(w[60:])), (13, "\n".join(w)),
            (14, "x " * 400), (15, "x " * 300), (16, base + " " + base), (17, passage(60_000, 4)), (18, passage(20, 5) + " " + " ".join(passage(60_000, 4).split()[500:700]))]
    for i in range(20, 60):     # near copies
        v = list(w)
        for _ in range(r.randint(0, 3)):
            v[r.randrange(len(v))] = f"new{r.randrange(9)}"
        rows.append((i, " ".join(v)))
    line = passage(12, 6)       # one line in many texts
    rows += [(100 + i, f"{passage(45, 200 + i)} {line} {passage(45, 300 + i % 9)}") for i in range(60)]
    return rows


@pytest.mark.parametrize("sketch", [{}, {"width": 1 << 16, "depth": 1}])
def test_repeated_windows_equal_a_table_of_all(spark, sketch):
    rows = documents()
    for given, parts in ((rows, 3), (rows[::-1], 1), (rows + rows[:9], 4)):
        df = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS h", "3 AS spans", "4 AS windows").repartition(parts)
        got = [(r[0], tuple(r)[1:]) for r in substrings.kept_words(substrings.with_repeats(df, **sketch)).collect()]
        want = brute.kept_words(rows)
        assert len(got) == len(given) and dict(got) == {i: x for (i, _), x in want.items()}


def test_windows_of_any_length_in_a_full_sketch(spark):
    r = random.Random(13)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randint(0, 40)))) for i in range(120)]
    for least in (3, 8, 11):
        got = {x[0]: tuple(x)[1:] for x in substrings.kept_words(substrings.with_repeats(spark.createDataFrame(rows, "doc_id long, text string"), least, 1 << 16)).collect()}
        assert got == {i: x for (i, _), x in brute.kept_words(rows, least).items()}


def test_equal_and_null_ids_keep_their_own_texts(spark):
    a, b = passage(70, 20), passage(70, 21)
    rows = [(1, a), (1, b + " tail"), (1, a + " tail"), (None, b), (2, a + " " + b), (None, b + " end")]
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in substrings.kept_words(substrings.with_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect())
    assert got == sorted((str(i), *x) for (i, _), x in brute.kept_words(rows).items())


def test_no_documents_no_windows(spark):
    assert substrings.kept_words(substrings.with_repeats(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_sketch_never_underestimates(spark):
    rows = [(i, passage(60, i // 2)) for i in range(40)] + [(100 + i, passage(60, 1000 + i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "xxhash64(text) AS h").repartition(5)
    bits = substrings.repeated_cells(df, 50, 1 << 16, 2)
    windows = substrings.Windows(50)
    for i, t in rows:
        for row in range(2):
            at = substrings.cells(windows([t.encode()])["anchor"], row, 1 << 16)
            often = np.unpackbits(bits[row])[at]
            assert often.all() if i < 100 else often.mean() < 0.5


# -- 13

def conversations(seed, n=150):
    r, rows = random.Random(seed), []
    for c in r.sample(range(-150, 420), n) + [0, 100]:
        rows += [(c, t if r.random() < 0.9 else None, r.choice(["user", "bot", None]), r.choice(["", "a", "b\u00e9", None, "ccc"])) for t in range(r.randint(1, 12))]
    ties = {}
    for c, t, role, text in rows:        # one null turn for each conversation: its place is defined
        ties.setdefault((c, t), (c, t, role, text))
    rows = list(ties.values())
    rows += [(1000 + c, t, "user", "the same") for c in range(300, 400) for t in range(4)]      # a large group of copies
    rows += [(2000, t, "user", f"turn {t % 3}") for t in range(700)] + [(2001, t, "user", f"turn {t % 3}") for t in range(690)]
    return [(c, t, role, text) for c, t, role, text in rows if not (c < 0 and c % 100)]


@pytest.mark.parametrize("run,batch,bits", [(20_000, 1_000, 5), (9, 4, 1), (1, 1, 2)])
def test_trie_equals_all_prefixes(spark, run, batch, bits):
    rows = conversations(run)
    df = spark.createDataFrame(rows + [(None, 1, "user", "lost")], TURNS).selectExpr("*", "1 AS keys", "2 AS n", "3 AS low", "4 AS base", "5 AS own").repartition(3)
    got = sorted(map(tuple, prefix_trie.trie_nodes(prefix_trie.rebuilt(df), run, batch, bits).collect()), key=str)
    assert got == brute.trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefix_trie.trie_nodes(prefix_trie.rebuilt(spark.createDataFrame([], TURNS))).count() == 0
    rows = [(c, 0, "user", "x") for c in range(1, 30)]      # without conversation 0 and with h > 0 they are turnless
    got = sorted(map(tuple, prefix_trie.trie_nodes(prefix_trie.rebuilt(spark.createDataFrame(rows, TURNS))).collect()), key=str)
    assert got == brute.trie(rows) and any(r[1] == 0 and r[4] == 1 for r in got)


def test_two_fattest_numbers():
    for a in range(-1, 40):
        for b in range(max(a + 1, 1), 41):
            f = prefix_trie.two_fattest(a, b)
            assert a < f <= b and (f & -f) == max(x & -x for x in range(max(a + 1, 1), b + 1)) or a == -1 and f == 0


def test_fat_search_finds_the_exit_node():
    r, trie, seen = random.Random(5), prefix_trie.ZFastTrie(), set()
    for _ in range(60):
        batch = {"".join(r.choice("ab") for _ in range(r.randint(0, 12))) for _ in range(6)} - seen
        seen |= batch
        trie.insert_batch([(prefix_trie.chained(list(x)), [1] * len(x), 1, 1, x) for x in sorted(batch)])
        for _ in range(40):
            x = prefix_trie.chained([r.choice("abc") for _ in range(r.randint(0, 14))])
            node = trie.exit(x, trie.root)
            at = trie.root                          # the same, edge by edge
            while at.depth < len(x) and x[:at.depth] == at.keys[:at.depth]:
                down = [c for c in at.children if c.keys[at.depth] == x[at.depth]]
                if not down:
                    break
                at = down[0]
            assert node is at
        assert all(trie.handles[n.handle()] is n for n in trie.handles.values())
    ends, todo = set(), [trie.root]
    while todo:
        n = todo.pop()
        todo += n.children
        ends |= {n.ends} - {None}
    assert ends == seen
